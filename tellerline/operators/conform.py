"""By-name projection onto a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Declared columns in declared order and type; extra columns are dropped."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the target: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def assert_schema(df: DataFrame, schema: StructType) -> None:
    """Raise unless names, order and types are the declared ones."""
    actual = [(f.name, f.dataType) for f in df.schema]
    declared = [(f.name, f.dataType) for f in schema]
    if actual != declared:
        raise ValueError(f"schema mismatch: got {df.schema.simpleString()}, declared {schema.simpleString()}")
