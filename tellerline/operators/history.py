"""Type-2 history: one open version per key, closed versions kept for ever."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerline.functions.columns import any_changed
from tellerline.operators.merge import (
    ACTION,
    CLOSE,
    INSERT,
    KEEP,
    keys_equal,
    side,
    with_action,
    without_label,
)

MERGE_KEY = "merge_key"
_SIDE, _OPEN, _SEEN, _IN_BATCH = "_side", "open", "seen", "_in_batch"


def _differs(tracked: Sequence[str], null_safe: bool) -> Column:
    return any_changed(zip(side("t", tracked), side("u", tracked)), null_safe)


def changed_current(
    target: DataFrame, updates: DataFrame, key: str, tracked: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Batch rows whose open version in the target differs in a tracked column."""
    open_rows = target.where(F.col("current")).select(key, *tracked).alias("t")
    joined = updates.alias("u").join(open_rows, keys_equal([key]), "inner")
    return joined.where(_differs(tracked, null_safe)).select("u.*")


def scd2_staged(
    target: DataFrame, updates: DataFrame, key: str, tracked: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """The batch keyed for matching, plus each changed row again without a key.

    The keyed copy closes the open version, the keyless copy is the new one.
    """
    keyed = updates.select(F.col(key).alias(MERGE_KEY), "*")
    changed = changed_current(target, updates, key, tracked, null_safe)
    keyless = changed.select(F.lit(None).cast(updates.schema[key].dataType).alias(MERGE_KEY), "*")
    return keyed.unionByName(keyless)


def scd2_apply(
    target: DataFrame,
    updates: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of: Column,
    first_effective: str | None = None,
    null_safe: bool = True,
    history_complete: bool = False,
    labelled: bool = False,
) -> DataFrame:
    """Target after the batch: changed open versions closed, new ones opened.

    * new key: insert an open version effective ``as_of``;
    * open version differs in a tracked column: close it (``current``,
      ``end_date``, ``update_ts``) and insert the new open version;
    * otherwise nothing, also when only untracked columns differ.

    ``first_effective`` names a batch column that dates the first version of a
    key instead of ``as_of``. Closed versions are not joined: they pass through
    and only their distinct keys take part, so that a key known from closed
    versions alone is not taken for new. ``history_complete=True`` states that
    every known key has an open version, which makes those keys unnecessary.
    """
    is_open = F.coalesce(F.col("current"), F.lit(False))
    keyed_open = target.where(is_open & F.col(key).isNotNull())
    known = keyed_open.withColumn(_SIDE, F.lit(_OPEN))
    if not history_complete:
        seen = target.where(~is_open & F.col(key).isNotNull()).select(key).distinct()
        known = known.unionByName(seen.withColumn(_SIDE, F.lit(_SEEN)), allowMissingColumns=True)

    batch = updates.where(F.col(key).isNotNull()).withColumn(_IN_BATCH, F.lit(True))
    joined = known.alias("t").join(batch.alias("u"), keys_equal([key]), "full_outer")

    open_here = F.col(_SIDE) == _OPEN
    changed = open_here & F.col(_IN_BATCH).isNotNull() & _differs(tracked, null_safe)
    first = F.col(_SIDE).isNull()
    # One joined row becomes the closed version and its successor; a key known
    # from closed versions only becomes nothing.
    actions = (
        F.when(changed, F.array(F.lit(CLOSE), F.lit(INSERT)))
        .when(open_here, F.array(F.lit(KEEP)))
        .when(first, F.array(F.lit(INSERT)))
    )
    versions = joined.withColumn(ACTION, F.explode(actions))

    opening = _opening_columns(as_of, first, first_effective)
    closing = {"current": F.lit(False), "end_date": as_of, "update_ts": F.col("u.update_ts")}
    inserted, closed = F.col(ACTION) == INSERT, F.col(ACTION) == CLOSE
    columns = []
    for c in target.columns:
        value = F.when(inserted, opening.get(c, F.col(f"u.{c}") if c in updates.columns else None))
        if c in closing:
            value = value.when(closed, closing[c])
        columns.append(value.otherwise(F.col(f"t.{c}")).alias(c))
    merged = versions.select(*columns, ACTION)

    # Two filters, so that a table partitioned by ``current`` is pruned for both.
    for untouched in (target.where(~is_open), target.where(is_open & F.col(key).isNull())):
        merged = merged.unionByName(with_action(untouched, KEEP))
    keyless = updates.where(F.col(key).isNull())
    keyless_open = _opening_columns(as_of, F.lit(True), first_effective, prefix="")
    keyless_rows = keyless.withColumns(keyless_open).select(*target.columns)
    return without_label(merged.unionByName(with_action(keyless_rows, INSERT)), labelled)


def _opening_columns(
    as_of: Column, first: Column, first_effective: str | None, prefix: str = "u."
) -> dict[str, Column]:
    effective = as_of
    if first_effective:
        effective = F.when(first, F.coalesce(F.col(f"{prefix}{first_effective}"), as_of)).otherwise(as_of)
    return {
        "current": F.lit(True),
        "effective_date": effective,
        "end_date": F.lit(None).cast("date"),
    }
