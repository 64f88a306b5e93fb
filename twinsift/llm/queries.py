"""The registered queries of the training-data operators: each applies its
operator, with production parameters, to the whole table and derives the
agreed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twinsift.llm import (
    kd_shards,
    langid_ecoc,
    line_cuckoo,
    lsi_decontam,
    merkle_climb,
    packing_cg,
    piece_bpe,
    pii_feistel,
    pivot_index,
    quality_fm,
    simhash_tiles,
    spelling_gram,
    suffix_array,
)
from twinsift.llm.common import remainder, small_batches

PII_KEY = "twinsift-demo-key"  # a production job passes its own secret
VOCABULARY = 49408


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = quality_fm.held_out()
    model = quality_fm.train(docs, _table(spark, sf_dir, "labels"), ~held)
    got = quality_fm.classify(docs.select("doc_id", "text", "n_chars"), model)
    return got.select("doc_id", held.alias("held_out"), "score", "predicted")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix_array.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii_feistel.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    return got.select("doc_id", "text", "n_pii", "kinds")


def op4_langid_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = langid_ecoc.held_out()
    got = langid_ecoc.identify(docs.select("doc_id", "text"), langid_ecoc.train(docs.where(~held)))
    return got.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def op5_lsi_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lsi_decontam.find(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "contaminated", "item_ids")


def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = kd_shards.kd_shards(_table(spark, sf_dir, "documents"), shards=8)
    return got.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "text_hash")


def op7_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_index.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_packing_cg(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = packing_cg.pack(_table(spark, sf_dir, "documents"), vocabulary_path(), VOCABULARY)
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_line_cuckoo(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = line_cuckoo.drop_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tiles.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = pieces_path()
    got = piece_bpe.decode(piece_bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    return got.select("doc_id", piece_bpe.n_ids(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    columns = lambda text: [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    leaf = merkle_climb.leaf_hash(columns(F.col("text")))
    tampered = merkle_climb.leaf_hash(columns(F.translate("text", "\n", "")))
    claimed = F.when(remainder("doc_id", 2) == 0, tampered).otherwise(leaf)
    got = merkle_climb.manifest(docs.select("doc_id", "source", leaf.alias("leaf"), claimed.alias("claimed")), "source", "doc_id")
    return got.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op13_spelling_gram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_gram.group_spellings(_table(spark, sf_dir, "documents"), noise=97)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_quality_fm,
            op2_suffix_dedup,
            op3_pii_feistel,
            op4_langid_ecoc,
            op5_lsi_decontam,
            op6_kd_shards,
            op7_pivot_index,
            op8_packing_cg,
            op9_line_cuckoo,
            op10_simhash_tiles,
            op11_piece_bpe,
            op12_merkle_climb,
            op13_spelling_gram,
            pipeline,
        )
    }


#: Line dedup as SQL. Blanks are chr(32) and chr(9) to chr(13).
OP9_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), keyed AS (
  SELECT doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), common AS (
  SELECT k, max(doc_id) AS last_doc FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.doc_id, l.i, l.line, (c.k IS NOT NULL AND l.doc_id <> c.last_doc) AS gone
  FROM keyed l LEFT JOIN common c ON l.k = c.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


#: The table of crc32, and crc32 of a list of bytes that is called ``b`` (``crc.t`` is the table).
CRC_TABLE = """bits(i, k, c) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8)"""
CRC_OF_B = "xor(list_reduce(b, lambda h, x: xor(h >> 8, crc.t[(xor(h, x) & 255) + 1]), 4294967295::BIGINT), 4294967295)"

#: The tree, its proofs and the fold, level by level.
OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, bytes AS (
  SELECT *, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT) AS b FROM documents
), hashed AS (
  SELECT doc_id, source,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
         text, CASE WHEN {CRC_OF_B} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS claim
  FROM bytes, crc
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(claim) || ':' || claim, '-')) AS claimed
  FROM hashed
), trees AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT source FROM leaves)
), placed AS (
  SELECT l.*, t.tree, row_number() OVER (PARTITION BY t.tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p
  FROM leaves l JOIN trees t ON l.source IS NOT DISTINCT FROM t.source
), low(tree, k, p, h) AS (
  SELECT tree, 0, p, leaf FROM placed
  UNION ALL
  SELECT tree, k + 1, p // 3, sha256(string_agg(h, '' ORDER BY p))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS m FROM low) WHERE m > 1 GROUP BY tree, k, p // 3
), tops AS (SELECT tree, max(k) AS height, arg_max(h, k) AS h FROM low GROUP BY tree
), high(k, p, h) AS (
  SELECT 0, tree, h FROM tops
  UNION ALL
  SELECT k + 1, p // 3, sha256(string_agg(h, '' ORDER BY p))
  FROM (SELECT *, count(*) OVER () AS m FROM high) WHERE m > 1 GROUP BY k, p // 3
), top AS (SELECT max(k) AS height, arg_max(h, k) AS h FROM high
), runs AS (
  SELECT tree, k, p // 3 AS q, list(h ORDER BY p) AS hs FROM low GROUP BY ALL
  UNION ALL
  SELECT -1, k, p // 3, list(h ORDER BY p) FROM high GROUP BY ALL
), up(tree, p, pos, k, now, folded, proof) AS (
  SELECT tree, p, p, 0, tree, claimed, '' FROM placed
  UNION ALL
  SELECT u.tree, u.p,
         CASE WHEN u.now >= 0 AND u.k = t.height THEN u.tree ELSE u.pos // 3 END,
         CASE WHEN u.now >= 0 AND u.k = t.height THEN 0 ELSE u.k + 1 END,
         CASE WHEN u.now >= 0 AND u.k = t.height THEN -1 ELSE u.now END,
         CASE WHEN u.now >= 0 AND u.k = t.height THEN u.folded
              ELSE sha256(array_to_string(r.hs[1:u.pos % 3], '') || u.folded || array_to_string(r.hs[u.pos % 3 + 2:], '')) END,
         CASE WHEN u.now >= 0 AND u.k = t.height THEN u.proof
              ELSE u.proof || array_to_string(r.hs[1:u.pos % 3], '') || array_to_string(r.hs[u.pos % 3 + 2:], '') END
  FROM up u JOIN tops t ON u.tree = t.tree, top
  JOIN runs r ON r.tree = u.now AND r.k = u.k AND r.q = u.pos // 3
  WHERE u.now >= 0 OR u.k < top.height
)
SELECT d.doc_id, d.leaf, t.h AS subroot, top.h AS root, sha256(u.proof) AS proof_sha256,
       u.folded AS folded_root, u.folded = top.h AS verified
FROM placed d JOIN tops t ON d.tree = t.tree, top
JOIN up u ON u.tree = d.tree AND u.p = d.p AND u.now = -1 AND u.k = top.height
"""

#: Letters beyond ASCII are two bytes in UTF-8: 195 and the code point less 64.
OP13_SQL = f"""
WITH RECURSIVE {CRC_TABLE}, runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents
), counted AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head, w, count(*) AS n FROM runs GROUP BY ALL HAVING length(w) >= 5
), bytes AS (
  SELECT *, list_transform(string_split(head, ''), lambda c: ord(c)::BIGINT)
            || flatten(list_transform(string_split(w, ''), lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END)) AS b
  FROM counted
), hashed AS (SELECT w, n, {CRC_OF_B} AS h FROM bytes, crc
), noisy AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM noisy WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (  -- two words one edit apart: equal but for the letter at one place, or one is the other without a letter
  SELECT word, n, k, word[1:k] || word[k + 2:] AS rest FROM words, unnest(range(length(word))) u(k)
), pairs AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word FROM words a JOIN cut b ON a.word = b.rest
  UNION
  SELECT b.word, a.word FROM words a JOIN cut b ON a.word = b.rest
), best AS (
  SELECT p.a AS word, count(*) AS n_near, arg_min(p.b, (-w.n, p.b)) AS b, max(w.n) AS b_n
  FROM pairs p JOIN words w ON p.b = w.word GROUP BY p.a
), told AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.b_n >= 2 * w.n THEN b.b END AS form, CASE WHEN b.b_n >= 2 * w.n THEN b.b_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), way(word, root) AS (
  SELECT word, word FROM told
  UNION ALL
  SELECT y.word, t.form FROM way y JOIN told t ON y.root = t.word WHERE t.form IS NOT NULL
)
SELECT t.word, t.form, y.root, t.n, t.n_near, t.form_n
FROM told t JOIN way y ON t.word = y.word JOIN told e ON y.root = e.word AND e.form IS NULL
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_line_cuckoo": OP9_SQL, "op12_merkle_climb": OP12_SQL, "op13_spelling_gram": OP13_SQL}
