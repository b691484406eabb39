"""Chains of versions: type-2 history from several deliveries of a key at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerline.functions.columns import any_changed


def version_chain(
    rows: DataFrame, key: str, order: Sequence[str], tracked: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """The rows that differ from the one before them in a tracked column, in delivery order.

    Adds ``chain_first`` (nothing came before) and ``chain_last`` (nothing comes after).
    A key's rows are as many as it was delivered, and are brought to one task.
    """
    kept = version_runs(rows, key, order, tracked, null_safe).where("chain_new").drop("chain_new")
    return kept.withColumn("chain_last", F.lead(F.lit(1)).over(Window.partitionBy(key).orderBy(*order)).isNull())


def version_runs(
    rows: DataFrame, key: str, order: Sequence[str], tracked: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """All rows, with ``chain_first`` and whether each is a version (``chain_new``) or repeats the row before it."""
    along = Window.partitionBy(key).orderBy(*order)
    before = F.lag(F.struct(*tracked)).over(along)
    numbered = rows.withColumn("_before", before).withColumn("chain_first", F.row_number().over(along) == 1)
    pairs = [(F.col(f"_before.{c}"), F.col(c)) for c in tracked]
    return numbered.withColumn("chain_new", F.col("chain_first") | any_changed(pairs, null_safe)).drop("_before")


def spliced(
    versions: DataFrame, repeats: DataFrame, deliveries: DataFrame, key: str, order: Sequence[str], tracked: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """The chain of stored versions, of what is known to have repeated them, and of new deliveries, wherever in it they fall.

    ``repeats(key, order)`` are times at which a stored version was delivered again. A new delivery between a version and its
    repeat parts them: the repeat is then a version of its own. A stored version that a new one before it
    makes superfluous becomes a repeat. Needs nothing but what is stored, and gives what
    the chain of all deliveries would give. Rows are those of ``version_runs``; a known delivery that comes again counts once.
    """
    columns = versions.columns
    stored = versions.withColumn("_kind", F.lit(0))
    again = repeats.select(key, *order).distinct().withColumn("_kind", F.lit(1))
    known = stored.unionByName(again, allowMissingColumns=True)
    upto = Window.partitionBy(key).orderBy(*order, "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.last(F.when(F.col("_kind") == 0, F.struct(*columns)), ignorenulls=True).over(upto)
    filled = [F.col(f"_whole.{c}").alias(c) for c in columns if c not in (key, *order)]
    known = known.withColumn("_whole", whole).where("_whole is not null").select(key, *order, *filled, "_kind")
    events = known.unionByName(deliveries.select(*columns).withColumn("_kind", F.lit(2)))
    first = F.row_number().over(Window.partitionBy(key, *order).orderBy("_kind"))
    events = events.withColumn("_first", first).where("_first = 1 or _kind = 0").drop("_first")
    return version_runs(events, key, order, tracked, null_safe).withColumnRenamed("_kind", "chain_source")


def not_later(order: Sequence[str], other: Sequence[Column]) -> Column:
    """Whether a row's delivery is known to be no later than another, also known one."""
    known = F.col(order[0]).isNotNull() & other[0].isNotNull()
    return known & (F.struct(*order) <= F.struct(*[c.alias(n) for c, n in zip(other, order)]))
