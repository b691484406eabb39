"""Run log: what each job did to a table, newest first on reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerline.params import JobConfig, Stamp
from tellerline.schemas import TableSpec
from tellerline.sources import files

#: Files of a table's log before they are made one.
COMPACT_FILES = 100

_SCHEMA = StructType()
for _column in ("table_name", "operation", "query_id"):
    _SCHEMA.add(_column, "string")
for _column in ("batch_id", "input_rows", "inserted", "updated", "closed", "kept"):
    _SCHEMA.add(_column, "long")
_SCHEMA.add("run_ts", "timestamp")


def _path(config: JobConfig, spec: TableSpec) -> str:
    """A folder per table: jobs on different tables may write at the same time."""
    return f"{config.layer_root(spec.layer)}/run_log/{spec.name}"


def record_run(
    spark: SparkSession,
    config: JobConfig,
    spec: TableSpec,
    operation: str,
    counts: dict[str, int],
    query_id: str | None = None,
    batch_id: int | None = None,
    input_rows: int | None = None,
) -> None:
    """Append one line to the table's log."""
    done = [counts.get(action, 0) for action in ("insert", "update", "close", "keep")]
    values = (spec.name, operation, query_id, batch_id, input_rows, *done)
    columns = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, _SCHEMA)]
    line = spark.range(0, 1, 1, 1).select(*columns, Stamp.at().ts.alias("run_ts"))
    line.write.mode("append").parquet(_path(config, spec))
    _compact(spark, _path(config, spec))


def _compact(spark: SparkSession, path: str) -> None:
    """Makes one file of many. Lost half-way it leaves lines twice, which ``history`` shows once."""
    old = files.listed(spark, f"{path}/part-*")
    if len(old) < COMPACT_FILES:
        return
    lines = spark.read.schema(_SCHEMA).parquet(*old).distinct().coalesce(1)
    lines.write.mode("overwrite").parquet(f"{path}_compacting")
    for file in files.listed(spark, f"{path}_compacting/part-*"):
        files.move(spark, file, f"{path}/{file.rsplit('/', 1)[1]}")
    for file in old:
        files.remove_dir(spark, file)
    files.remove_dir(spark, f"{path}_compacting")


def history(spark: SparkSession, config: JobConfig, spec: TableSpec) -> DataFrame:
    """All recorded runs on a table, newest first."""
    path = _path(config, spec)
    files.make_dir(spark, path)
    return spark.read.schema(_SCHEMA).parquet(path).distinct().orderBy(F.desc("run_ts"), F.desc("batch_id"))
