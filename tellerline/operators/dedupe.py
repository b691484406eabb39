"""In-batch de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerline.functions.columns import has_null

_RANK = "_rank"


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row per key with the greatest ``order_by`` values."""
    return _first_per_key(df, keys, order_by, F.desc)


def dedupe_earliest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row per key with the smallest ``order_by`` values."""
    return _first_per_key(df, keys, order_by, F.asc)


def _first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], direction) -> DataFrame:
    """One row per key; ties are broken by all other columns, so it is determined.

    Rows with a NULL in the key are no duplicates of each other and all stay.

    ``row_number() = 1`` is planned with a group limit before the shuffle: each
    task sends at most one row per key, however often a key repeats.
    """
    others: list[str] = [c for c in df.columns if c not in keys and c not in order_by]
    order: list[Column] = [direction(c) for c in (*order_by, *others)]
    ranked = df.where(~has_null(keys)).withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where(F.col(_RANK) == 1).drop(_RANK).unionByName(df.where(has_null(keys)))
