"""Storing merge results in plain Parquet tables.

A merge writes beside the table, under a name of its own, what changes: whole partitions that take the
place of stored ones, rows that are added to others, and rows of the table's side tables. Partitions
without a change are neither read nor written. When all is written, a marker is set that names the
stored files which the new ones replace. Then the new files are renamed into the tables one by one and the named
ones are removed. File names are never used twice, so each step may be done any number of times, in
any order, by anyone who has read the marker, and the rows are the same in the end.

Only the table's writer moves files, under the table's lease. A driver lost half-way leaves the marker, and the
writer's next run goes on from it (``recover``). Readers move nothing: they wait for a publish under way and
refuse one that was left behind (``settle``). One writer per table.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tellerline.operators.conform import assert_schema, conform
from tellerline.operators.merge import ACTION, DELETE, INSERT, KEEP, UPDATE
from tellerline.params import JobConfig, Stamp
from tellerline.schemas import AFTER, BEFORE, CHANGE_COLUMN, TableSpec, changes_of
from tellerline.sources import files
from tellerline.sources.lease import Lease
from tellerline.sources.tables import partition_folder, partition_in, pending_path, read_physical, table_path

_READY = "_READY-"

#: Files of a table without partitions before they are gathered.
GATHERED_FILES = 200

Result = TypeVar("Result")


class PublishUnderway(RuntimeError):
    """A publish of a table that is to be read was not finished in time; its writer's next run finishes it."""


def _laid_out(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Few files per partition, a partition with much data over many tasks."""
    df = df.hint("rebalance", *spec.partition_by)
    order = (*spec.partition_by, *spec.cluster_by)
    return df.sortWithinPartitions(*order) if order else df


def _write(rows: DataFrame, spec: TableSpec, path: str) -> int:
    """Writes rows beside the table; returns how many, counted in the writing stage: there a task that runs again is counted once."""
    assert_schema(rows, spec.physical_schema)
    seen = Observation()
    counted = _laid_out(rows, spec).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").partitionBy(*spec.partition_by).parquet(path)
    return seen.get["rows"]


def publish(
    spark: SparkSession,
    config: JobConfig,
    spec: TableSpec,
    touched: Iterable[Sequence],
    replacing: DataFrame | None,
    adding: DataFrame | None = None,
    also: Iterable[tuple[TableSpec, DataFrame]] = (),
) -> int:
    """Replace the ``touched`` partitions (tuples of partition values) and add rows to others; returns how many were added.

    ``replacing`` holds every row that those partitions are to have; one without rows becomes empty.
    ``also`` has rows to add to side tables of the same layer in the same step.
    """
    added = prepare(spark, config, spec, touched, replacing, adding, also)
    recover(spark, config, spec)
    return added


def prepare(
    spark: SparkSession,
    config: JobConfig,
    spec: TableSpec,
    touched: Iterable[Sequence],
    replacing: DataFrame | None,
    adding: DataFrame | None = None,
    also: Iterable[tuple[TableSpec, DataFrame]] = (),
) -> int:
    """The first half of ``publish``: all is written and the marker set, nothing is moved."""
    name = uuid.uuid4().hex
    beside, table = f"{pending_path(config, spec)}/{name}", table_path(config, spec)
    also, added = list(also), 0
    if replacing is not None:
        _write(replacing, spec, f"{beside}/{spec.name}")
    if adding is not None:
        added = _write(adding, spec, f"{beside}/{spec.name}")
    for other, rows in also:
        _write(rows, other, f"{beside}/{other.name}")
    folders = sorted(partition_folder(spec, values) for values in touched)
    old = [f"{folder}/{f.rsplit('/', 1)[1]}".lstrip("/") for folder in folders for f in files.listed(spark, f"{table}/{folder}/part-*".replace("//part", "/part"))]
    levels = {s.name: len(s.partition_by) for s in (spec, *(other for other, _ in also))}
    lines = [*(f"table {n} {k}" for n, k in levels.items()), *(f"old {f}" for f in old)]
    files.write_text(spark, f"{pending_path(config, spec)}/{_READY}{name}", "\n".join(lines))
    return added


def _markers(spark: SparkSession, config: JobConfig, spec: TableSpec) -> list[str]:
    found = files.listed(spark, f"{pending_path(config, spec)}/{_READY}*")
    return [m for m in found if not m.endswith(".new")]


def recover(spark: SparkSession, config: JobConfig, spec: TableSpec) -> bool:
    """Move what was prepared into place; for the table's writer, also before it reads the table. Whether there was anything."""
    if not _markers(spark, config, spec):
        return False
    with Lease(spark, config, spec) as lease:
        for marker in _markers(spark, config, spec):
            _finish(spark, config, spec, marker, lease)
    return True


def _finish(spark: SparkSession, config: JobConfig, spec: TableSpec, marker: str, lease: Lease) -> None:
    pending, table = pending_path(config, spec), table_path(config, spec)
    name = marker.rsplit(_READY, 1)[1]
    lines = [line.split(" ", 1) for line in files.read_text(spark, marker).splitlines()]
    for kind, text in lines:
        if kind == "table":
            target, levels = text.rsplit(" ", 1)
            for file in files.listed(spark, f"{pending}/{name}/{target}{'/*' * int(levels)}/part-*"):
                lease.renew()
                place = file.split(f"/{name}/{target}/", 1)[1]
                files.move_if_there(spark, file, f"{config.layer_root(spec.layer)}/{target}/{place}")
    for kind, text in lines:
        if kind == "old":
            lease.renew()
            files.remove_dir(spark, f"{table}/{text}")
    lease.renew()
    files.remove_dir(spark, f"{pending}/{name}")
    files.write_text(spark, _version_path(config, spec), name)
    files.remove_dir(spark, marker)


def _version_path(config: JobConfig, spec: TableSpec) -> str:
    return f"{config.layer_root(spec.layer)}/_version/{spec.name}"


def settle(spark: SparkSession, config: JobConfig, spec: TableSpec) -> str | None:
    """For readers: wait until no publish is under way; returns the name of the last one.

    One that is not finished within ``publish_grace_seconds`` raises ``PublishUnderway``: its files are its writer's to move.
    """
    deadline = time.monotonic() + config.publish_grace_seconds
    while True:
        path = _version_path(config, spec)
        version = files.read_text(spark, path) if files.exists(spark, path) else None
        if not _markers(spark, config, spec):
            return version
        if time.monotonic() >= deadline:
            raise PublishUnderway(f"a publish of {spec.layer}.{spec.name} is not finished; its job's next run does that")
        time.sleep(min(1.0, max(0.01, deadline - time.monotonic())))


def consistent(spark: SparkSession, config: JobConfig, specs: Sequence[TableSpec], build: Callable[[], Result]) -> Result:
    """``build()``, which lists files of some tables, done anew until no publish fell between.

    Files are listed when a DataFrame over them is made. If a later publish removes some of them
    before they are read, the job fails, and does not read half of a change.
    """
    while True:
        before = [settle(spark, config, spec) for spec in specs]
        result = build()
        if [settle(spark, config, spec) for spec in specs] == before:
            return result


def change_rows(config: JobConfig, spec: TableSpec, stamp: Stamp, before: DataFrame | None, after: DataFrame | None) -> list[tuple[TableSpec, DataFrame]]:
    """What a merge takes out of a table and puts into it, to be published along with it; nothing unless ``config`` asks for it.

    The table's rows, less all that was ever taken out, with all that was put in, are the table's later rows.
    """
    if not config.change_rows:
        return []
    other, every = changes_of(spec), None
    for rows, kind in ((before, BEFORE), (after, AFTER)):
        if rows is not None:
            part = rows.select(*spec.physical_schema.names, F.lit(kind).alias(CHANGE_COLUMN), stamp.ts.alias("_change_ts"))
            every = part if every is None else every.unionByName(part)
    return [(other, conform(every, other.schema))]


def gather_files(spark: SparkSession, config: JobConfig, spec: TableSpec) -> None:
    """Few files of many, for a table without partitions that is added to in small steps."""
    if len(files.listed(spark, f"{table_path(config, spec)}/part-*")) >= GATHERED_FILES:
        publish(spark, config, spec, [()], read_physical(spark, config, spec))


def publish_labelled(
    spark: SparkSession, config: JobConfig, spec: TableSpec, merged: DataFrame, stored: DataFrame, stamp: Stamp, also: Sequence[tuple[TableSpec, DataFrame]] = ()
) -> dict[str, int]:
    """Store a labelled merge result that holds whole partitions of ``stored``; returns the number of rows per action.

    Only partitions with a change are written. What is collected is a row per
    partition and action.
    """
    merged = merged.select(*spec.physical_schema.names, ACTION).persist()
    try:
        counts: dict[str, int] = {}
        touched = set()
        for *values, action, n in merged.groupBy(*spec.partition_by, ACTION).count().collect():
            counts[action] = counts.get(action, 0) + n
            if action != KEEP:
                touched.add(tuple(values))
        if touched or also:
            kept = merged.where((F.col(ACTION) != DELETE) & partition_in(spec, touched)).drop(ACTION)
            gone = merged.where(F.col(ACTION).isin(UPDATE, DELETE)).select(*[F.col(k).alias(f"_{k}") for k in spec.keys])
            same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in spec.keys])
            after = merged.where(F.col(ACTION).isin(UPDATE, INSERT))
            changes = change_rows(config, spec, stamp, stored.join(gone, same, "left_semi"), after)
            publish(spark, config, spec, touched, kept if touched else None, None, [*also, *changes])
        return counts
    finally:
        merged.unpersist()
