"""A split-block Bloom filter kept as a table, built, merged and probed with
DataFrame operations only.

All bits of a key lie in one block of 256 bits, eight words of 32: the key's
first hash says which block, five bits each of its second hash say which bit
of a word. A row of the filter is a block, ``(block, w0, w1, w2, w3)`` with
two words to a long; blocks without a key have no row. So building makes one
row a key (bits of a block are put together by ``bit_or``, on the map side
first), and probing joins one row a key with one row of the filter. Filters of
the same spec merge by ``bit_or`` as well.

The filter has at most ``m / 256`` rows of 40 bytes whatever the data; it is
AQE that broadcasts it to the probe where its measured bytes allow, and deals
both by block beyond, evenly, since blocks are hashed. Probing works on
DISTINCT keys, so a hot key costs one probe, not millions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 256
WORDS = 8
WORD_BITS = BLOCK_BITS // WORDS
LONGS = ["w0", "w1", "w2", "w3"]


def block_fpp(keys_per_block: float, k: int = WORDS) -> float:
    """False-positive rate of blocks that hold this many keys on average (the
    keys of a block are Poisson distributed)."""
    total, p = 0.0, math.exp(-keys_per_block)
    for i in range(1, int(keys_per_block + 12 * math.sqrt(keys_per_block) + 24)):
        p *= keys_per_block / i
        total += p * (1 - (1 - 1 / WORD_BITS) ** i) ** k
    return total


@dataclass(frozen=True)
class BloomSpec:
    m: int  # number of bits, rounded up to whole blocks
    k: int = WORDS  # bits a key sets, at most one in each of a block's words

    @staticmethod
    def for_items(expected_items: int, fpp: float = 0.01) -> BloomSpec:
        """The smallest filter for ``expected_items`` keys that keeps the
        false-positive rate ``fpp``."""
        low, high = 1e-3, float(BLOCK_BITS)
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if block_fpp(mid) <= fpp else (low, mid)
        return BloomSpec(max(1, math.ceil(max(int(expected_items), 1) / low)) * BLOCK_BITS)

    @property
    def blocks(self) -> int:
        return max(1, -(-self.m // BLOCK_BITS))

    @property
    def words(self) -> int:
        return max(1, min(self.k, WORDS))

    @property
    def size_bytes(self) -> int:
        return self.blocks * (BLOCK_BITS // 8)


def _block(key: Column, spec: BloomSpec) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(spec.blocks)).alias("block")


def _masks(key: Column, spec: BloomSpec) -> list[Column]:
    """The bits of a key in its block, as four longs named like the filter's."""
    h = F.xxhash64(F.lit("bits"), key)

    def word(i: int) -> Column:
        if i >= spec.words:
            return F.lit(0).cast("bigint")
        bit = F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit + F.lit(WORD_BITS * (i % 2)))

    return [word(2 * j).bitwiseOR(word(2 * j + 1)).alias(w) for j, w in enumerate(LONGS)]


def _union(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in LONGS])


def build(df: DataFrame, key: str, spec: BloomSpec) -> DataFrame:
    """Filter table holding every non-NULL key of ``df``."""
    k = F.col(key)
    return _union(df.filter(k.isNotNull()).select(_block(k, spec), *_masks(k, spec)))


def merge(*filters: DataFrame) -> DataFrame:
    """Union of filters built with the same spec."""
    out = filters[0]
    for f in filters[1:]:
        out = out.unionByName(f)
    return _union(out)


def maybe_keys(df: DataFrame, key: str, bloom: DataFrame, spec: BloomSpec) -> DataFrame:
    """The distinct non-NULL keys of ``df`` the filter may contain (false
    positives possible, false negatives never), as one column ``key``."""
    keys = df.select(F.col(key).alias("key")).filter(F.col("key").isNotNull()).distinct()
    return _held(keys, bloom, spec).select(F.col("key").alias(key))


def _held(keys: DataFrame, bloom: DataFrame, spec: BloomSpec) -> DataFrame:
    """The rows of ``keys(key)`` whose key the filter may hold."""
    k = F.col("key")
    asked = keys.select("key", _block(k, spec), *[m.alias(f"m{j}") for j, m in enumerate(_masks(k, spec))])
    both = [F.col(w).bitwiseAND(F.col(f"m{j}")) == F.col(f"m{j}") for j, w in enumerate(LONGS)]
    return asked.join(bloom, "block").filter(both[0] & both[1] & both[2] & both[3]).select("key")


def probe(df: DataFrame, key: str, bloom: DataFrame, spec: BloomSpec, flag: str = "maybe_seen") -> DataFrame:
    """``df`` with a boolean ``flag``: True when the key may be in the filter;
    NULL keys are False."""
    hits = maybe_keys(df, key, bloom, spec).withColumn(flag, F.lit(True))
    # rows without a key match nothing: they are kept out of the join, where they would meet in one task
    keyed, rest = df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())
    flagged = keyed.join(hits, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return flagged.unionByName(rest.withColumn(flag, F.lit(False)))


def flag_new_rows(existing: DataFrame, new: DataFrame, key: str, spec: BloomSpec) -> DataFrame:
    """Every new row with ``maybe_seen``: False is certain, True needs a look
    (``unseen_verified`` has it). No row is dropped on the filter's word."""
    return probe(new, key, build(existing, key, spec), spec)


def surely_new(existing: DataFrame, new: DataFrame, key: str, spec: BloomSpec) -> DataFrame:
    """New rows that the filter alone proves unseen; rows it can't tell are
    not among them (take ``flag_new_rows`` to have both)."""
    return flag_new_rows(existing, new, key, spec).filter(~F.col("maybe_seen")).drop("maybe_seen")


def unseen_verified(existing: DataFrame, new: DataFrame, key: str, spec: BloomSpec, bloom: DataFrame | None = None) -> DataFrame:
    """Bloom prefilter, then an exact check of what it lets through only. The
    result equals ``unseen_rows``; the existing keys are never shuffled whole.

    With ``bloom``, the stored filter of the existing keys, only the new keys
    it may hold are looked up there: the existing keys are cut to them by a
    semi join (AQE broadcasts the maybe-set when its runtime size allows).
    Without one, the filter is that of the new keys (``spec`` is then for
    these): existing keys that it rules out are of no new row and are dropped
    where they are read. Either way the new rows are anti-joined, exactly, with
    the existing keys that remain."""
    if bloom is not None:
        seen = existing.select(key).join(maybe_keys(new, key, bloom, spec), key, "left_semi")
    else:
        keys = existing.select(F.col(key).alias("key")).filter(F.col("key").isNotNull())
        seen = _held(keys, build(new, key, spec), spec).select(F.col("key").alias(key))
    return new.join(seen.distinct(), key, "left_anti")
