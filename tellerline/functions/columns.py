"""Built-in column expressions only, so everything stays inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the two-valued tag; any other tag counts in neither total.
WITHDRAWAL_TAG = "withdrawl"
DEPOSIT_TAG = "deposit"
UNKNOWN_BANK = "UNKNOWN"

# Bucket of rows whose key has a NULL: they match nothing, so no merge ever
# reads or rewrites them.
NULL_KEY_BUCKET = -1


def amount_of(tag: str) -> Column:
    """The amount of rows carrying this tag, NULL for the others."""
    return F.when(F.col("withdrawl_or_deposit") == tag, F.col("amount"))


def split_amounts(df: DataFrame) -> DataFrame:
    return df.withColumns({"withdrawl_amt": amount_of(WITHDRAWAL_TAG), "deposit_amt": amount_of(DEPOSIT_TAG)})


def bank_or_unknown(bank: Column) -> Column:
    return F.coalesce(bank, F.lit(UNKNOWN_BANK))


def stamped(df: DataFrame, stamp: Column, *names: str) -> DataFrame:
    return df.withColumns({name: stamp for name in names})


def any_changed(pairs: Iterable[tuple[Column, Column]], null_safe: bool = True) -> Column:
    """True where any pair differs.

    With ``null_safe=False`` the comparison is ``<>``: a change from or to NULL
    is unknown and therefore does not count.
    """
    tests = [~old.eqNullSafe(new) if null_safe else old != new for old, new in pairs]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def has_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Layout bucket of a key; must be computed the same way on every write."""
    bucket = F.pmod(F.hash(*keys), F.lit(buckets))
    return F.when(has_null(keys), F.lit(NULL_KEY_BUCKET)).otherwise(bucket)
