"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark
decontamination and packing, each stage on what its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs; all but the last return
the columns of ``documents``."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from twinsift.llm import langid_ecoc, line_cuckoo, lsi_decontam, packing_cg, simhash_tiles  # noqa: E402
from twinsift.llm.common import small_batches, stage, text_or_empty  # noqa: E402
from twinsift.llm.queries import VOCABULARY, vocabulary_path  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Languages that the corpus wants; None stands for all that its labels name.
WANTED: tuple[str, ...] | None = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter go: they have no language. So do texts of a
    language that isn't wanted, where the prediction is sure. ``lang`` takes the
    prediction where it is sure and no label or another one was there; ambiguous
    texts, short clean ones among them, stay with the label they have, and so
    do all others where there was no label to learn from. Repeated rows and
    ties are predicted alike; columns beside those of documents are left out."""
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    model = langid_ecoc.train(docs.where(~langid_ecoc.held_out()))
    lettered = text_or_empty().rlike(r"\p{L}")
    if not model.langs:
        return docs.where(lettered)
    got = langid_ecoc.identify(docs, model).where(F.col("lang_pred") != "und")
    sure = ~F.col("ambiguous") & (F.col("score") >= 0.9)
    if WANTED is not None:
        got = got.where(~sure | F.col("lang_pred").isin(*WANTED))
    return got.withColumn("lang", F.when(sure, F.col("lang_pred")).otherwise(F.col("lang"))).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents hold stay in the last of them; n_chars follows
    the text. Rows with one id are one document; null ids hold nothing."""
    small_batches(spark)
    got = line_cuckoo.drop_lines(docs.select(*COLUMNS))
    return got.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within four differing bits stays: the one
    with the smallest id, and one row of it. Rows with a null id stay only if
    no row of their group has an id."""
    small_batches(spark)
    return simhash_tiles.keep_one(docs.select(*COLUMNS), shingle=4, radius=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, repeated rows alike."""
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return lsi_decontam.find(docs.select(*COLUMNS), benchmark).where(~F.col("contaminated")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, one row a piece."""
    small_batches(spark)
    return packing_cg.pack(docs.select(*COLUMNS), vocabulary_path(), VOCABULARY)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

#: Classifier, hashes, latent space and linear program are beyond SQL; the
#: tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, f) in enumerate(STAGES):
        docs = f(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, name)
    return docs
