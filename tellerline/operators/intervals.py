"""Few intervals that cover the keys of a batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUANTILES, STEPS, INTERVALS = 32, 32, 64


def key_intervals(rows: DataFrame, key: str) -> list[tuple[int, int]]:
    """At most ``INTERVALS`` closed intervals that hold every value of a whole-number column.

    Values are sorted into quantiles and those into equal steps, so that clusters and
    outliers part at any scale; the intervals are the values' own bounds there, joined
    across the smallest gaps. What is collected is at most a row per step.
    """
    values = rows.select(F.col(key).alias("k")).where("k is not null")
    cuts = values.agg(F.percentile_approx("k", [i / QUANTILES for i in range(QUANTILES + 1)]).alias("c")).first()["c"]
    if not cuts:
        return []
    cuts = sorted(set(cuts))
    at = reduce(lambda a, b: a + b, [(F.col("k") >= F.lit(c)).cast("int") for c in cuts])
    low, high = (F.element_at(F.array(*map(F.lit, ends)), at) for ends in (cuts, [*cuts[1:], cuts[-1]]))
    step = F.floor((F.col("k") - low) / F.greatest(high - low, F.lit(1)) * STEPS)
    found = values.groupBy(at.alias("q"), step.alias("s")).agg(F.min("k").alias("low"), F.max("k").alias("high"))
    parts = sorted((r["low"], r["high"]) for r in found.collect())
    gaps = sorted(range(1, len(parts)), key=lambda i: parts[i][0] - parts[i - 1][1], reverse=True)
    opens = [0, *sorted(gaps[: INTERVALS - 1])]
    return [(parts[a][0], parts[b - 1][1]) for a, b in zip(opens, [*opens[1:], len(parts)])]


def in_intervals(column: Column, intervals: list[tuple[int, int]]) -> Column:
    tests = [column.between(F.lit(low), F.lit(high)) for low, high in intervals]
    return reduce(lambda a, b: a | b, tests, F.lit(False))
