"""Sharding by bytes: minimax contiguous partition of ordered groups of equal texts.

Groups are ordered by a hash of their text. The smallest capacity that a given
number of shards can keep to is found by binary search with a greedy check. The
check walks prefix sums; those of all groups do not fit in one place, so they are
held by ranges of the order: first by its leading 16 bits, and then finer wherever
a cut may fall, until what is left undecided is single groups. The result is
that of the check on all groups, and the driver sees a bounded table of sums.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerline.llm.common import durable, numbered

FIRST_BITS = 16
MORE_BITS = 6


@dataclass(frozen=True, order=True)
class Range:
    """Groups whose order key begins with ``prefix`` (``bits`` leading bits, signed)."""

    first: int  # the lowest key that may be in it
    bits: int
    prefix: int
    size: int
    groups: int


class Line:
    """Ranges side by side; places are bytes from the start."""

    def __init__(self, ranges: list[Range]):
        self.ranges = sorted(ranges)
        self.starts = [0, *accumulate(r.size for r in self.ranges)]
        self.total = self.starts[-1]

    def walk(self, capacity: int, shards: int, whole: bool) -> list[int]:
        """Greedy cuts, one per shard. A range of several groups can be cut anywhere, or (``whole``) nowhere inside."""
        at, cuts = 0, []
        for _ in range(shards):
            at = self._reach(at + capacity, at, whole)
            cuts.append(at)
        return cuts

    def _reach(self, target: int, at: int, whole: bool) -> int:
        if target >= self.total:
            return self.total
        k = bisect_right(self.starts, target) - 1
        if self.starts[k] == target or (not whole and self.ranges[k].groups > 1):
            return target
        return max(at, self.starts[k])

    def least(self, shards: int, low: int, whole: bool) -> int:
        """The smallest capacity at which the walk reaches the end."""
        high = max(low, self.total)
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, shards, whole)[-1] == self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def unsure(self, low: int, high: int, shards: int) -> list[Range]:
        """Ranges of several groups in which some cut of some capacity from ``low`` to ``high`` may lie."""
        found = {}
        for a, b in zip(self.walk(low, shards, True), self.walk(high, shards, False), strict=True):
            for k in range(max(0, bisect_right(self.starts, a) - 1), min(len(self.ranges), bisect_left(self.starts, b) + 1)):
                if self.ranges[k].groups > 1 and self.starts[k + 1] > a and self.starts[k] < b:
                    found[k] = self.ranges[k]
        return list(found.values())

    def even(self, capacity: int, shards: int) -> list[int]:
        """Places of ``shards - 1`` cuts at ranges' ends: each shard within ``capacity`` and as near the mean of the rest as that allows."""
        needed, at = [self.total], self.total
        for _ in range(shards - 1):  # the first place from which the shards behind suffice
            at = self.starts[bisect_left(self.starts, at - capacity)]
            needed.append(at)
        cuts, at = [], 0
        for left in range(shards, 1, -1):
            goal = at + (self.total - at) / left
            k = bisect_left(self.starts, goal)
            near = min(self.starts[max(0, k - 1) : k + 1], key=lambda s: abs(s - goal))
            most = self.starts[bisect_right(self.starts, at + capacity) - 1]
            at = max(at, needed[left - 1], min(near, most))
            cuts.append(at)
        return cuts


def ranges_of(groups: DataFrame, bits: int, within: list[Range] | None = None) -> list[Range]:
    """Sums of the ranges of ``bits`` leading bits, of all groups or of those in some wider ranges."""
    prefix = F.shiftright("key", 64 - bits)
    if within is not None:
        wide = within[0].bits
        groups = groups.where(F.shiftright("key", 64 - wide).isin([r.prefix for r in within]))
    found = groups.groupBy(prefix.alias("prefix")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups"))
    return [Range(r["prefix"] << (64 - bits), bits, r["prefix"], r["size"], r["groups"]) for r in found.collect()]


def thresholds(groups: DataFrame, shards: int) -> list[int]:
    """First keys of the shards after the first: the minimax partition of ``groups(key, size)`` in key order."""
    largest = groups.agg(F.max("size").alias("m")).first()["m"]
    if largest is None or shards < 2:
        return []
    line = Line(ranges_of(groups, FIRST_BITS))
    while True:
        low = max(largest, -(-line.total // shards))
        low = line.least(shards, low, whole=False)
        high = line.least(shards, low, whole=True)
        unsure = line.unsure(low, high, shards)
        if low == high or not unsure:
            break
        split = set(unsure)
        kept = [r for r in line.ranges if r not in split]
        for bits in sorted({r.bits for r in unsure}):
            kept += ranges_of(groups, min(64, bits + MORE_BITS), [r for r in unsure if r.bits == bits])
        line = Line(kept)
    firsts = [r.first for r in line.ranges] + [None]
    keys = [firsts[line.starts.index(cut)] for cut in line.even(high, shards)]
    return [k for k in keys if k is not None]


def own_shards(groups: DataFrame, shards: int) -> list[int]:
    """Keys of groups as large as the mean of what they leave, or larger: each fills a shard of its own."""
    top = groups.orderBy(F.desc("size"), "key").limit(shards).collect()
    left, total, alone = shards, groups.agg(F.sum("size").alias("s")).first()["s"] or 0, []
    for row in top:
        if left < 2 or row["size"] * left < total:
            break
        alone.append(row["key"])
        left, total = left - 1, total - row["size"]
    return alone


def sharded(docs: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """Per document: ``doc_id, size, text_crc32, shard, slot``.

    ``size`` is the text's UTF-8 bytes and ``overhead``. Equal texts (all null texts among
    them) share a shard, and the largest shard is as small as the order of the groups
    allows; groups at or over the mean first get shards of their own. ``slot`` is gapless
    from 0 in each shard. Null texts have crc 0. Equal rows get slots of their own; with fewer groups than
    shards some shards stay empty; an empty table has no rows.
    """
    key = F.xxhash64("text")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long")
    crc = F.coalesce(F.crc32("text"), F.lit(0)).cast("long")
    # Kept in files as large as these few columns need, not one for each part of the texts that were read.
    own = durable(docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), key.alias("key")).hint("rebalance"))
    groups = durable(own.groupBy("key").agg(F.sum("size").alias("size")))
    alone = own_shards(groups, shards)
    rest = groups.where(~F.col("key").isin(alone)) if alone else groups
    cuts = thresholds(rest, shards - len(alone))
    shard: Column = F.lit(len(alone))
    for cut in cuts:
        shard = shard + (F.col("key") >= F.lit(cut)).cast("int")
    for k, single in enumerate(alone):
        shard = F.when(F.col("key") == F.lit(single), F.lit(k)).otherwise(shard)
    dealt = own.withColumn("shard", shard.cast("int"))
    slotted = numbered(dealt, ["shard"], ["doc_id", "key", "size", "text_crc32"], "slot")
    return slotted.select("doc_id", "size", "text_crc32", "shard", "slot")
