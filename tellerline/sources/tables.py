"""Layer tables: where they live, how they are created and read.

Jobs work by path. The catalog entries made by ``create_layer_tables`` are a
convenience for SQL users; jobs refresh those that exist.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerline.params import JobConfig
from tellerline.schemas import LAYER_TABLES, SIDE_TABLES, TableSpec, changes_of, splits_of
from tellerline.sources import files

# How a partition folder spells NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

#: Partitions that one statement adds to the catalog.
PARTITIONS_AT_ONCE = 500


def table_path(config: JobConfig, spec: TableSpec) -> str:
    return f"{config.layer_root(spec.layer)}/{spec.name}"


def pending_path(config: JobConfig, spec: TableSpec) -> str:
    """Where a merge result waits until it is in place."""
    return f"{config.layer_root(spec.layer)}/_pending/{spec.name}"


def progress_path(config: JobConfig, spec: TableSpec) -> str:
    """Where a job notes how far a table's deliveries have come."""
    return f"{config.layer_root(spec.layer)}/_progress/{spec.name}"


def qualified_name(config: JobConfig, spec: TableSpec) -> str:
    return f"{config.layer_schema(spec.layer)}.{spec.name}"


def files_name(config: JobConfig, spec: TableSpec) -> str:
    """The registered table over the files; where it has hidden columns, a view under the table's name hides them."""
    return qualified_name(config, spec) + ("_files" if spec.physical_schema != spec.schema else "")


def partition_folder(spec: TableSpec, values: Sequence) -> str:
    """The folder of a partition within the table, as Spark's writer names it."""

    def spelled(value) -> str:
        return NULL_PARTITION if value is None else str(value).lower() if isinstance(value, bool) else str(value)

    return "/".join(f"{c}={spelled(v)}" for c, v in zip(spec.partition_by, values, strict=True))


def partition_in(spec: TableSpec, values: Iterable[Sequence]) -> Column:
    """Whether a row lies in one of some partitions; literals, so that partitions are pruned.

    Those that differ in the last column alone are one list: a test for each would nest too deep for thousands.
    """
    *outer, last = spec.partition_by
    lists: dict[tuple, list] = {}
    for *first, value in sorted(values, key=str):
        lists.setdefault(tuple(first), []).append(value)

    def one_of(some: list) -> Column:
        known = [v for v in some if v is not None]
        test = F.col(last).isNotNull() & F.col(last).isin(known)
        return test if len(known) == len(some) else test | F.col(last).isNull()

    tests = [
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(outer, first, strict=True)], one_of(some))
        for first, some in lists.items()
    ]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def checkpoint_dir(config: JobConfig, stage: str, source: str, target: str) -> str:
    """``<root>/<stage>/<source>-<target>``, e.g. stage ``bronze-silver``."""
    return f"{config.checkpoint_root}/{stage}/{source}-{target}"


def ensure_layer(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")


def _columns_ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def create_layer_tables(spark: SparkSession, config: JobConfig, layer: str, reset: bool = False) -> list[str]:
    """Register the layer's external tables; ``reset`` also empties them.

    Checkpoints are left alone: a job that is to load everything again needs a
    new checkpoint root.
    """
    schema = config.layer_schema(layer)
    ensure_layer(spark, schema)
    names = []
    for spec in LAYER_TABLES[layer]:
        name, path = qualified_name(config, spec), table_path(config, spec)
        stored = files_name(config, spec)
        if reset:
            if stored != name:
                spark.sql(f"DROP VIEW IF EXISTS {name}")
            spark.sql(f"DROP TABLE IF EXISTS {stored}")
            beside = SIDE_TABLES.get(spec.name, ()) if layer != "bronze" else ()
            for own in (spec, changes_of(spec), splits_of(spec), *beside):
                files.remove_dir(spark, table_path(config, own))
                files.remove_dir(spark, pending_path(config, own))
                files.remove_dir(spark, progress_path(config, own))
        files.make_dir(spark, path)
        partitioning = f"PARTITIONED BY ({', '.join(spec.partition_by)})" if spec.partition_by else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {stored} ({_columns_ddl(spec.physical_schema)}) "
            f"USING parquet {partitioning} LOCATION '{path}'"
        )
        if stored != name:
            columns = ", ".join(f"`{c}`" for c in spec.schema.names)
            spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS SELECT {columns} FROM {stored}")
        names.append(name)
    return names


def refresh_catalog(spark: SparkSession, config: JobConfig, layer: str) -> None:
    """Let registered tables see partitions and files the jobs wrote by path."""
    for spec in LAYER_TABLES[layer]:
        refresh_registered(spark, config, spec)


def refresh_registered(spark: SparkSession, config: JobConfig, spec: TableSpec) -> None:
    """The same for one table, if it is registered."""
    name = files_name(config, spec)
    if not spark.catalog.tableExists(name):
        return
    if spec.partition_by:
        _add_partitions(spark, config, spec, name)
    spark.catalog.refreshTable(name)


def _add_partitions(spark: SparkSession, config: JobConfig, spec: TableSpec, name: str) -> None:
    """Registers the partition folders that the catalog does not know; of the others no files are listed."""
    levels = len(spec.partition_by)
    there = files.listed(spark, f"{table_path(config, spec)}/" + "/".join(f"{c}=*" for c in spec.partition_by))
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new = []
    for folder in (path.rsplit("/", levels)[1:] for path in there):
        if "/".join(folder) not in known:
            values = (level.split("=", 1) for level in folder)
            new.append(", ".join(f"`{c}`={'null' if v == NULL_PARTITION else repr(v)}" for c, v in values))
    for start in range(0, len(new), PARTITIONS_AT_ONCE):
        some = " ".join(f"PARTITION ({values})" for values in new[start : start + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {some}")


def read_physical(spark: SparkSession, config: JobConfig, spec: TableSpec) -> DataFrame:
    """All stored columns, the hidden ones included.

    Built anew for each job or micro-batch, so the file listing is fresh.
    """
    path = table_path(config, spec)
    files.make_dir(spark, path)
    return spark.read.schema(spec.physical_schema).parquet(path).select(*spec.physical_schema.names)


def read_partitions(
    spark: SparkSession, config: JobConfig, spec: TableSpec, values: Iterable[str], hidden: bool = False
) -> DataFrame:
    """Stored rows of some values of the first partition column (globs allowed).

    Only those folders are listed: a large table's other files are not looked at
    even on the driver.
    """
    path, names = table_path(config, spec), ",".join(values)
    folders = f"{path}/{spec.partition_by[0]}={{{names}}}"
    columns = (spec.physical_schema if hidden else spec.schema).names
    if not names or not files.matches(spark, folders):
        return spark.createDataFrame([], spec.physical_schema).select(*columns)
    reader = spark.read.schema(spec.physical_schema).option("basePath", path)
    return reader.parquet(folders).select(*columns)


def read_table(spark: SparkSession, config: JobConfig, spec: TableSpec) -> DataFrame:
    return read_physical(spark, config, spec).select(*spec.schema.names)


def ensure_buckets(spark: SparkSession, config: JobConfig, spec: TableSpec) -> None:
    """Hold a table to the number of key buckets it was first written with.

    With another number, stored keys would be looked for in the wrong buckets.
    """
    path = table_path(config, spec)
    marker = f"{path}/_key_buckets-{config.key_buckets}"
    if files.matches(spark, marker):
        return
    if files.matches(spark, f"{path}/_key_buckets-*"):
        raise ValueError(f"{path} was created with another number of key buckets than {config.key_buckets}")
    files.touch(spark, marker)


def stream_table(spark: SparkSession, config: JobConfig, spec: TableSpec) -> DataFrame:
    """A table as a streaming source: each new file is read once.

    A stream matches a batch's columns to its own by place, and batches have partition columns last; so must
    the stream, also if the table has no partition yet that would tell it so.
    """
    path = table_path(config, spec)
    files.make_dir(spark, path)
    limit = config.max_bronze_files_per_trigger
    last = sorted(spec.schema.fields, key=lambda f: f.name in spec.partition_by)
    reader = spark.readStream.schema(StructType(last)).option("maxFilesPerTrigger", limit)
    return reader.parquet(path).select(*spec.schema.names)
