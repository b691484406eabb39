"""Staged JSON -> bronze, one job for any of the staged folders."""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from tellerline.operators.conform import conform
from tellerline.operators.merge import INSERT
from tellerline.params import JobConfig, TriggerMode
from tellerline.schemas import CORRUPT_COLUMN, LAYER_TABLES, RESCUE_COLUMN, TableSpec, staged_schema
from tellerline.session import require_time_zone
from tellerline.sources import files
from tellerline.sources.audit import record_run
from tellerline.sources.publish import publish, recover
from tellerline.sources.staged import read_staged
from tellerline.sources.tables import checkpoint_dir, read_physical, refresh_registered, table_path
from tellerline.streaming.metrics import Metrics, keys_of

_POLL_SECONDS = 5.0

#: Staged bytes that one task may write to one partition of a bronze table.
TASK_BYTES = 256 << 20


def bronze_spec(folder: str, table: str | None = None) -> TableSpec:
    """The bronze table of a staged folder, under another name if one is given."""
    staged_schema(folder)
    spec = next(spec for spec in LAYER_TABLES["bronze"] if spec.name == folder)
    return replace(spec, name=table) if table else spec


def rescued_spec(spec: TableSpec) -> TableSpec:
    """A bronze table with the VARIANT of fields that its columns do not hold; NULL in files written without."""
    return replace(spec, schema=StructType(list(spec.schema.fields)).add(RESCUE_COLUMN, "variant"))


def quarantine_path(config: JobConfig, table: str) -> str:
    return f"{config.bronze_root}/quarantine/{table}"


def await_query(query: StreamingQuery, config: JobConfig, timeout: float | None) -> dict[int, int]:
    """Wait for the query; returns the rows read per micro-batch.

    Batch runs end by themselves. A streaming run is left running and returns
    at once, or after the timeout.
    """
    rows: dict[int, int] = {}
    if config.trigger_mode is TriggerMode.STREAMING and timeout is None:
        return rows
    deadline = None if timeout is None else time.monotonic() + timeout
    while True:
        left = _POLL_SECONDS if deadline is None else min(_POLL_SECONDS, deadline - time.monotonic())
        ended = query.awaitTermination(max(left, 0.001))
        # Only the latest progress reports are kept, so they are taken as they come.
        rows.update({p["batchId"]: p["numInputRows"] for p in query.recentProgress if p["numInputRows"]})
        if ended or (deadline is not None and time.monotonic() >= deadline):
            return rows


def progress(query: StreamingQuery) -> dict:
    """Status and last progress for the job log."""
    return {"status": query.status, "last_progress": query.lastProgress}


def run_stage_to_bronze(
    spark: SparkSession,
    config: JobConfig,
    folder: str,
    table: str | None = None,
    quarantine: bool = False,
    timeout: float | None = None,
    rescue: bool = False,
    measure: bool = False,
    late_before: dt.date | None = None,
) -> StreamingQuery:
    """Append new staged rows to the bronze table, by default of the same name.

    With ``quarantine=True`` lines that do not parse go to a folder of their own
    with their text. Staged files are read once for both; a micro-batch's rows, its rejected lines and a note
    that it was stored are published in one step, so a batch that is run again adds nothing. A table is fed one way or the
    other from its first row on. ``rescue=True`` keeps fields that the declared columns do not hold in a VARIANT column
    beside them (``rescued_spec``). ``measure=True`` counts each micro-batch's rows, null keys, rejected lines
    and rows before ``late_before`` (``stream_metrics``). A run that ends is logged as a whole, one that is left running by micro-batch.
    """
    require_time_zone(spark, config.time_zone)
    spec = bronze_spec(folder, table)
    path = table_path(config, spec)
    files.make_dir(spark, f"{config.stage_root}/{folder}")
    rows = read_staged(spark, config.stage_root, folder, config.max_files_per_trigger, quarantine, rescue)
    # A file sink's own list hides files that others put there, and a new list hides those of before.
    listed = files.exists(spark, f"{path}/_spark_metadata")
    if listed == quarantine and (listed or files.matches(spark, f"{path}{'/*' * len(spec.partition_by)}/part-*")):
        raise ValueError(f"{path} was written with{'out' if quarantine else ''} quarantine; the same must hold for every run")
    stored = rescued_spec(spec) if rescue else spec
    metrics = Metrics(spark, config, spec, keys_of(folder), late_before) if measure else None
    if metrics:
        rows = metrics.on(rows)
        spark.streams.addListener(metrics)
    try:
        query = _split(config, rows, stored, folder) if quarantine else _append(config, rows, path, spec.partition_by, spec.name, folder)
    except Exception:
        if metrics:
            spark.streams.removeListener(metrics)
        raise
    if config.trigger_mode is TriggerMode.STREAMING:
        spark.streams.addListener(_RunLog(spark, config, spec, query.id))
        if metrics:
            metrics.leave_with(query)
        await_query(query, config, timeout)
        return query
    try:
        read = await_query(query, config, timeout)
    finally:
        if metrics and not query.isActive:
            metrics.finish(query)
        elif metrics:
            metrics.leave_with(query)
    if read:
        total = sum(read.values())
        record_run(spark, config, spec, "append", {INSERT: total}, query.id, max(read), total)
        refresh_registered(spark, config, spec)
    return query


def _append(
    config: JobConfig, rows: DataFrame, path: str, partition_by: tuple[str, ...], target: str, folder: str
) -> StreamingQuery:
    gathered = _gathered(config, rows, partition_by).drop("_size", "_block")
    writer = (
        gathered.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint_dir(config, "stage-bronze", folder, target))
        .trigger(**config.trigger)
    )
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def quarantine_spec(spec: TableSpec) -> TableSpec:
    """Lines of a bronze table's staged files that do not parse."""
    schema = StructType(list(spec.schema.fields)).add(CORRUPT_COLUMN, "string")
    return TableSpec("bronze", f"quarantine/{spec.name}", schema)


def batches_spec(spec: TableSpec) -> TableSpec:
    """Which micro-batches a bronze table holds."""
    return TableSpec("bronze", f"{spec.name}_batches", StructType().add("query_id", "string").add("batch_id", "long"))


def _split(config: JobConfig, rows: DataFrame, spec: TableSpec, folder: str) -> StreamingQuery:
    """Rows to the table and lines that do not parse beside it, from one reading of each micro-batch."""
    rejects, batches = quarantine_spec(spec), batches_spec(spec)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        recover(session, config, spec)
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not read_physical(session, config, batches).where((F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)).isEmpty():
            return
        batch.persist()
        try:
            good, broken = (batch.where(test) for test in (F.col(CORRUPT_COLUMN).isNull(), F.col(CORRUPT_COLUMN).isNotNull()))
            mark = session.range(1).select(F.lit(query_id).alias("query_id"), F.lit(batch_id).cast("long").alias("batch_id"))
            also = [(rejects, conform(broken, rejects.schema)), (batches, mark)]
            publish(session, config, spec, (), None, conform(good, spec.schema), also)
        finally:
            batch.unpersist()

    return (
        rows.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint_dir(config, "stage-bronze", folder, f"{spec.name}-split"))
        .trigger(**config.trigger)
        .start()
    )


def _gathered(config: JobConfig, rows: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """A partition's rows of a micro-batch in one task, and so in one file, or in several if the files are large.

    A micro-batch has at most ``max_files_per_trigger`` files. Of files of a size that
    could fill more than one task, each goes to one of as many tasks, or its blocks do.
    """
    tasks = F.ceil(F.col("_size") * config.max_files_per_trigger / TASK_BYTES)
    place = F.xxhash64("_ingest_file", F.floor(F.col("_block") / TASK_BYTES))
    share = F.pmod(place, F.greatest(tasks, F.lit(1)))
    return rows.repartition(*map(F.col, partition_by), share)


class _RunLog(StreamingQueryListener):
    """Logs every micro-batch of one query that is left running, and shows it to the catalog; goes when the query ends."""

    def __init__(self, spark: SparkSession, config: JobConfig, spec: TableSpec, query_id: str):
        self.spark, self.config, self.spec, self.query_id = spark, config, spec, query_id

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        done = event.progress
        if str(done.id) == self.query_id and done.numInputRows:
            counts = {INSERT: done.numInputRows}
            record_run(self.spark, self.config, self.spec, "append", counts, self.query_id, done.batchId, done.numInputRows)
            refresh_registered(self.spark, self.config, self.spec)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        if str(event.id) == self.query_id:
            self.spark.streams.removeListener(self)
