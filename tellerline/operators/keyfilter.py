"""Which groups of a table may hold some keys: Bloom bitmaps per group, made and asked with SQL aggregates.

A key sets four bits of one word of 64. A group's words are as many as its keys need, a power of two, so
a fragment made of a few keys is small and several fragments of a group, of any sizes, are simply
kept side by side: a key may be in the group if any of them has its bits. An answer may be yes
by chance, but no is certain, so whoever asks still has to look.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a group's bitmap per key: about one absent key in forty passes.
BITS_PER_KEY = 12
BITS = 4
COLUMNS = (("words", "long"), ("word", "long"), ("bits", "long"))


def _hash(key: str) -> Column:
    return F.xxhash64(F.col(key).cast("long"))


def _word(key: str, words: Column) -> Column:
    return F.shiftrightunsigned(_hash(key), 6 * BITS).bitwiseAND(words - 1)


def _mask(key: str) -> Column:
    out = None
    for k in range(BITS):
        place = F.shiftright(_hash(key), 6 * k).bitwiseAND(F.lit(63).cast("long")).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        out = bit if out is None else out.bitwiseOR(bit)
    return out


def key_fragments(rows: DataFrame, key: str, group: str) -> DataFrame:
    """``group, words, word, bits`` of the keys of some rows; rows without a key are left out. Groups may be NULL.

    A group's words are counted first. Counts and words are aggregated before they are shuffled, so a group may hold any share of the rows.
    """
    keyed = rows.where(F.col(key).isNotNull()).select(key, F.col(group).alias("_group"))
    needed = F.greatest(F.lit(1.0), F.count(F.lit(1)) * BITS_PER_KEY / 64)
    sizes = keyed.groupBy(F.col("_group").alias("_sized")).agg(F.pow(F.lit(2.0), F.ceil(F.log2(needed))).cast("long").alias("words"))
    placed = keyed.join(sizes, F.col("_group").eqNullSafe(F.col("_sized")))
    found = placed.groupBy("_group", "words", _word(key, F.col("words")).alias("word")).agg(F.bit_or(_mask(key)).alias("bits"))
    return found.select(F.col("_group").alias(group), "words", "word", "bits")


def groups_that_may_hold(fragments: DataFrame, keys: DataFrame, key: str, group: str) -> DataFrame:
    """The distinct groups whose fragments pass some of the keys. Sizes of fragments are powers of two, so few are collected."""
    sizes = sorted(r[0] for r in fragments.select("words").distinct().collect())
    probes = keys.where(F.col(key).isNotNull()).select(key, F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])).alias("words"))
    probes = probes.select("words", _word(key, F.col("words")).alias("word"), _mask(key).alias("mask")).distinct()
    hit = fragments.join(probes, ["words", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return hit.select(group).distinct()
