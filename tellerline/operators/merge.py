"""Merges of an update batch into a target, as DataFrames.

Every merge is one equi join of the target with the batch. Rows whose key
contains a NULL match nothing, so they bypass the join: NULL keys would
otherwise all hash to one task.

The batch must hold each key once (``dedupe_latest``). With ``labelled=True``
the result carries what happened to each row in ``_action``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerline.functions.columns import any_changed, has_null

ACTION = "_action"
KEEP, INSERT, UPDATE, CLOSE, DELETE = "keep", "insert", "update", "close", "delete"

_IN_TARGET, _IN_BATCH = "_in_target", "_in_batch"


def side(alias: str, columns: Sequence[str]) -> list[Column]:
    return [F.col(f"{alias}.{c}") for c in columns]


def keys_equal(keys: Sequence[str], null_safe: bool = False) -> Column:
    pairs = zip(side("t", keys), side("u", keys))
    return reduce(lambda a, b: a & b, [t.eqNullSafe(u) if null_safe else t == u for t, u in pairs])


def with_action(df: DataFrame, action: str) -> DataFrame:
    return df.withColumn(ACTION, F.lit(action))


def without_label(df: DataFrame, labelled: bool) -> DataFrame:
    return df if labelled else df.drop(ACTION)


def _match(target: DataFrame, updates: DataFrame, condition: Column) -> DataFrame:
    left = target.withColumn(_IN_TARGET, F.lit(True)).alias("t")
    right = updates.withColumn(_IN_BATCH, F.lit(True)).alias("u")
    return left.join(right, condition, "full_outer")


def insert_if_absent(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch to append: those whose key the target does not hold."""
    held = target.where(~has_null(keys)).select(*keys)
    new = updates.where(~has_null(keys)).join(held, list(keys), "left_anti").select(*updates.columns)
    return new.unionByName(updates.where(has_null(keys)))


def matching_rows(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the target that also occur in the batch.

    Probing the target with the batch keys first lets Spark broadcast them when
    they are few, so the target is scanned but not shuffled.
    """
    return target.select(*keys).join(updates.select(*keys), list(keys), "left_semi")


def upsert_latest(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], labelled: bool = False
) -> DataFrame:
    """Overwrite every column of matched rows, insert the others (type 1)."""
    joined = _match(target.where(~has_null(keys)), updates.where(~has_null(keys)), keys_equal(keys))
    hit = F.col(_IN_BATCH).isNotNull()
    action = (
        F.when(hit & F.col(_IN_TARGET).isNotNull(), UPDATE).when(hit, INSERT).otherwise(KEEP).alias(ACTION)
    )
    merged = joined.select(
        *[F.when(hit, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns],
        action,
    )
    result = merged.unionByName(with_action(target.where(has_null(keys)), KEEP)).unionByName(
        with_action(updates.select(*target.columns).where(has_null(keys)), INSERT)
    )
    return without_label(result, labelled)


def upsert_if_changed(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    update_stamp: str = "update_ts",
    nullable_keys: Sequence[str] = (),
    literal: bool = False,
    labelled: bool = False,
    drop_vanished: bool = False,
) -> DataFrame:
    """Update the compared columns and the stamp of changed rows only.

    Unchanged rows stay as they are, new keys are inserted, and columns outside
    ``compare`` (such as a creation stamp) survive an update.

    A NULL in one of ``nullable_keys`` is a value like any other, so that
    re-running a summary with a group for it changes nothing. Those few rows are
    joined apart: for the others the plain comparison lets a batch that was
    grouped by the keys be joined as it is partitioned, without a shuffle.

    ``drop_vanished=True`` is for a batch that recomputes all of the target: rows
    whose key it no longer has are removed (labelled ``delete``). Otherwise, and
    always with ``literal=True``, they stay.

    ``literal=True`` puts the change test, with ``<>``, into the match condition:
    a key that did not change is "not matched" and is inserted once more.
    """

    def merge(t: DataFrame, u: DataFrame, null_safe_keys: bool = False) -> DataFrame:
        differs = any_changed(zip(side("t", compare), side("u", compare)), null_safe=not literal)
        same_key = keys_equal(keys, null_safe_keys)
        joined = _match(t, u, same_key & differs if literal else same_key)
        in_target, in_batch = F.col(_IN_TARGET).isNotNull(), F.col(_IN_BATCH).isNotNull()
        update = in_target & in_batch & differs
        replaced = {*compare, update_stamp}
        columns = [
            F.when(~in_target | update if c in replaced else ~in_target, F.col(f"u.{c}"))
            .otherwise(F.col(f"t.{c}"))
            .alias(c)
            for c in t.columns
        ]
        action = F.when(~in_target, INSERT).when(update, UPDATE)
        if drop_vanished and not literal:
            action = action.when(~in_batch, DELETE)
        return joined.select(*columns, action.otherwise(KEEP).alias(ACTION))

    if literal or not nullable_keys:
        merged = merge(target, updates)
    else:
        without = has_null(nullable_keys)
        merged = merge(target.where(~without), updates.where(~without)).unionByName(
            merge(target.where(without), updates.where(without), null_safe_keys=True)
        )
    return merged if labelled else merged.where(F.col(ACTION) != DELETE).drop(ACTION)
