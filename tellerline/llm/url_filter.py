"""URL filters: host rules, and exact list membership by a cascade of Bloom filters.

Level 1 of a cascade holds the listed keys. Keys of the corpus that are not listed
but pass it are held by level 2, listed keys that pass level 2 by level 3, and so
on until none is left. The first level that a key fails tells whether it is
listed; as the levels were built over every key that occurs, the answer is exact
for each, without a join. Bits are counted, set and tested by SQL functions alone.

A level lets about as many wrong keys pass as it holds right ones, so the next one is no larger. Keys of a long
list are dealt to several cascades by hash, and rows are laid out by the same hash, so each cascade reads its own.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerline.llm.common import durable, shared_dir, unused

#: Hash functions of a level: two to this power is how many wrong keys are told off for one that passes.
FEWEST, MOST = 4, 24
#: Bits per key of a level with the fewest hash functions; one with more has as many more bits.
BITS_PER_KEY = 6
#: Keys that one filter may hold (3 MB of bits with four hash functions, 18 MB with the most).
FILTER_KEYS = 4_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty without ``://``; the path begins with its slash, or is empty."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, url.substr(mark + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule (``host/path``) that fits, or null. A rule fits its host and all subdomains of it."""
    found: Column | None = None
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, _, start = rule.partition("/")
        fits = ((host == F.lit(name)) | host.endswith("." + name)) & path.startswith("/" + start)
        found = F.when(fits, F.lit(rule)) if found is None else found.when(fits, F.lit(rule))
    return found if found is not None else F.lit(None).cast("string")


def bit_of(place: Column) -> Column:
    """The bit of a place within its word of 64."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))


@dataclass(frozen=True)
class Level:
    bits: int
    salt: int
    hashes: int
    keys: int
    words: DataFrame  # one row, one column: the bits as an array of longs

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.salt + h)), F.lit(self.bits)) for h in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        array, out = self.words.scalar(), None
        for place in self.places(key):
            word = F.get(array, F.shiftright(place, 6).cast("int"))
            hit = word.bitwiseAND(bit_of(place)) != 0
            out = hit if out is None else out & hit
        return out


def level_over(keys: DataFrame, n: int, others: int, salt: int) -> Level:
    """A filter of ``n`` keys that about ``n`` of the others pass, or one in sixteen if there are not many others."""
    hashes = min(MOST, max(FEWEST, ceil(log2(max(1, others / n)))))
    words = ceil(n * BITS_PER_KEY * hashes / FEWEST / 64)
    level = Level(64 * words, salt, hashes, n, keys)
    place = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("place"))
    filled = place.groupBy(F.shiftright("place", 6).alias("id")).agg(F.bit_or(bit_of(F.col("place"))).alias("word"))
    empty = keys.sparkSession.range(words).select("id", F.lit(0).cast("long").alias("word"))
    every = filled.union(empty).groupBy("id").agg(F.bit_or("word").alias("word"))
    listed = F.array_sort(F.collect_list(F.struct("id", "word")))
    dense = every.agg(F.transform(listed, lambda x: x["word"]).alias("words"))
    return Level(64 * words, salt, hashes, n, durable(dense))


class TooManyKeys(ValueError):
    """A level would hold more keys than a filter may."""


def cascade(listed: DataFrame, others: DataFrame, salt: int = 0, filter_keys: int = FILTER_KEYS) -> list[Level]:
    """Levels that tell all of ``listed(key)`` from all of ``others(key)``; both distinct, disjoint and durable."""
    levels: list[Level] = []
    include, exclude, n, others_n = listed, others, listed.count(), others.count()
    while n:
        if n > filter_keys:
            raise TooManyKeys(f"{n} keys in a level")
        level = level_over(include, n, others_n, salt + MOST * len(levels))
        levels.append(level)
        include, exclude, others_n = durable(exclude.where(level.passes(F.col("key")))), include, n
        n = include.count()
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: it is if it fails an even level, or passes all of an odd number."""
    out = F.lit(len(levels) % 2 == 1)
    for k in range(len(levels) - 1, -1, -1):
        out = F.when(~levels[k].passes(key), F.lit(k % 2 == 1)).otherwise(out)
    return out


def cascades(keys: DataFrame, shares: int, filter_keys: int) -> list[list[Level]]:
    """A cascade for each share of ``keys(key, listed, share)``."""
    out = []
    for share in range(shares):
        mine = keys.where(F.col("share") == share)
        out.append(cascade(mine.where("listed").select("key"), mine.where("not listed").select("key"), 1, filter_keys))
    return out


def share_of(shares: int) -> Column:
    """The share of a key; null keys are in the first."""
    return F.coalesce(F.pmod(F.xxhash64("key"), F.lit(shares)), F.lit(0)).cast("int")


def with_membership(rows: DataFrame, listed: DataFrame, name: str = "listed", filter_keys: int = FILTER_KEYS) -> DataFrame:
    """``rows`` with whether their ``key`` is among ``listed(key)``.

    Keys that do not occur in ``rows`` are not encoded. No level of a cascade holds more
    than ``filter_keys`` keys: where one would, keys are dealt by hash to more cascades. If there are several, rows are written once, by share, and
    each share is read by its own cascade. A null key is not listed. ``rows`` should be durable or cheap to read again.
    """
    both = rows.select("key", F.lit(False).alias("listed"), F.lit(True).alias("there"))
    both = both.union(listed.select("key", F.lit(True), F.lit(False))).where("key is not null")
    universe = durable(both.groupBy("key").agg(F.max("listed").alias("listed"), F.max("there").alias("there")).where("there").drop("there"))
    shares = max(1, ceil(universe.where("listed").count() / filter_keys))
    while True:
        dealt = universe.withColumn("share", share_of(shares))
        try:
            known = cascades(dealt if shares == 1 else durable(dealt), shares, filter_keys)
            break
        except TooManyKeys:
            shares *= 2
    if shares == 1:
        return rows.withColumn(name, F.col("key").isNotNull() & member(known[0], F.col("key")))
    own = unused(rows, "_share")
    place = f"{shared_dir(rows.sparkSession)}/url-shares-{uuid.uuid4().hex}"
    rows.withColumn(own, share_of(shares)).write.partitionBy(own).parquet(place)
    out = None
    for share, levels in enumerate(known):
        folder = f"{place}/{own}={share}"
        if _any(rows, folder):
            part = rows.sparkSession.read.schema(rows.schema).parquet(folder)
            part = part.withColumn(name, F.col("key").isNotNull() & member(levels, F.col("key")))
            out = part if out is None else out.union(part)
    return rows.withColumn(name, F.lit(False)).where("false") if out is None else out


def _any(rows: DataFrame, path: str) -> bool:
    """Whether a share has rows."""
    place = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).exists(place)


def judged(pages: DataFrame, listed: DataFrame, block: list[str], allow: list[str]) -> DataFrame:
    """Per page: ``page_id, host, path, rule, verdict, listed``.

    ``listed(key)`` holds addresses (host and path) to block. The longest fitting rule
    decides; where none fits, a listed address is blocked and any other allowed. Null urls and urls without
    ``://`` have empty host and path. Equal rows are judged alike; extra columns are not read.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = durable(rows.withColumn("key", F.concat("host", "path")))
    found = with_membership(rows, listed)
    rule = rule_for(F.col("host"), F.col("path"), block + allow)
    verdict = F.when(F.col("rule").isin(block), "block").when(F.col("rule").isNotNull(), "allow")
    verdict = verdict.otherwise(F.when(F.col("listed"), "block").otherwise("allow"))
    return found.withColumn("rule", rule).withColumn("verdict", verdict).select("page_id", "host", "path", "rule", "verdict", "listed")
