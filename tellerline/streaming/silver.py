"""Bronze -> silver, one merge per micro-batch.

Each micro-batch is applied as a key merge, so a batch that is delivered again
after a failure changes nothing (rows without a key excepted: they match
nothing and are inserted each time).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tellerline import schemas
from tellerline.functions.columns import NULL_KEY_BUCKET, stamped
from tellerline.operators.conform import conform
from tellerline.operators.dedupe import dedupe_earliest, dedupe_latest
from tellerline.operators.intervals import in_intervals, key_intervals
from tellerline.operators.keyfilter import groups_that_may_hold, key_fragments
from tellerline.operators.merge import ACTION, CLOSE, INSERT, KEEP, UPDATE, insert_if_absent
from tellerline.operators.versions import not_later, spliced, version_runs
from tellerline.params import JobConfig, Stamp
from tellerline.schemas import BUCKET_COLUMN, TableSpec
from tellerline.session import require_time_zone
from tellerline.sources import files
from tellerline.sources.audit import record_run
from tellerline.sources.buckets import ancestors, bucket_of, split_buckets
from tellerline.sources.publish import change_rows, gather_files, publish, recover
from tellerline.sources.tables import (
    NULL_PARTITION,
    checkpoint_dir,
    ensure_buckets,
    partition_in,
    progress_path,
    qualified_name,
    read_partitions,
    read_physical,
    refresh_registered,
    stream_table,
    table_path,
)
from tellerline.streaming.bronze import await_query

# Delivery order; customers and locations have no time of their own.
INGEST_ORDER = ("_ingest_ts", "_ingest_file")

BatchStep = Callable[[SparkSession, JobConfig, DataFrame, Stamp], dict[str, int]]


def prepare_visits(bronze: DataFrame, stamp: Stamp) -> DataFrame:
    dated = bronze.withColumn("transaction_dt", F.to_date("transaction_ts"))
    return stamped(dated, stamp.ts, "load_ts")


def prepare_locations(bronze: DataFrame, stamp: Stamp) -> DataFrame:
    """Address struct flattened; a missing struct gives three NULLs."""
    flat = bronze.select("*", "city_state_zip.*").drop("city_state_zip")
    return stamped(flat, stamp.ts, "load_ts")


def prepare_customers(bronze: DataFrame, stamp: Stamp) -> DataFrame:
    return stamped(bronze, stamp.ts, "load_ts", "update_ts")


def apply_visits(spark: SparkSession, config: JobConfig, batch: DataFrame, stamp: Stamp) -> dict[str, int]:
    """Append the visits of a batch that the table does not hold yet.

    Of two deliveries of one visit the earlier stays, within a batch as across
    batches. A delivery that comes after a later one takes its place, which rewrites the
    dates concerned; so the result does not depend on where batches are cut.
    """
    spec = schemas.SILVER_VISITS
    key = spec.keys[0]
    prepared = dedupe_earliest(prepare_visits(batch, stamp), spec.keys, INGEST_ORDER)
    updates = conform(prepared, spec.physical_schema).persist()
    held = None
    try:
        size = updates.count()
        stored = read_partitions(spark, config, spec, _dates_to_probe(spark, config, updates.select(key)), hidden=True)
        # Rows outside the intervals cannot match: an exact filter that skips
        # files and row groups by their statistics.
        stored = stored.where(in_intervals(F.col(key), key_intervals(updates, key)))
        # Probing the table with the batch's keys lets Spark broadcast them when they
        # are few, so the table is scanned but not shuffled.
        found = stored.select(key, "transaction_dt", *INGEST_ORDER).join(updates.select(key), key, "left_semi")
        held = found.persist()
        earlier = updates.alias("u").join(held.alias("t"), key).where(
            F.col("u._ingest_ts").isNotNull()
            & F.col("t._ingest_ts").isNotNull()
            & (F.struct(*[f"u.{c}" for c in INGEST_ORDER]) < F.struct(*[f"t.{c}" for c in INGEST_ORDER]))
        )
        new = insert_if_absent(held, updates, spec.keys)
        # Bounded by the number of calendar days.
        dates = {r[0] for r in earlier.select("t.transaction_dt").distinct().collect()}
        if not dates:
            beside = [(schemas.VISIT_KEYS, key_fragments(new, key, "transaction_dt")), *change_rows(config, spec, stamp, None, new)]
            return {"input": size, INSERT: publish(spark, config, spec, (), None, new, beside)}
        late = earlier.select("u.*").persist()
        try:
            kept = read_partitions(spark, config, spec, _folders(dates), hidden=True)
            touched = [(d,) for d in dates]
            inside = partition_in(spec, touched)
            every = late.unionByName(new)
            replacing = kept.join(late.select(key), key, "left_anti").select(*kept.columns).unionByName(every.where(inside))
            counts = {"input": size, INSERT: new.count(), UPDATE: late.count()}
            keys = key_fragments(every, key, "transaction_dt")
            changes = change_rows(config, spec, stamp, kept.join(late.select(key), key, "left_semi").select(*kept.columns), every)
            publish(spark, config, spec, touched, replacing, every.where(~inside), [(schemas.VISIT_KEYS, keys), *changes])
            return counts
        finally:
            late.unpersist()
    finally:
        if held is not None:
            held.unpersist()
        updates.unpersist()


def _folders(days: Iterable[dt.date | None]) -> list[str]:
    return [NULL_PARTITION if d is None else str(d) for d in days]


def _dates_to_probe(spark: SparkSession, config: JobConfig, keys: DataFrame) -> list[str]:
    """Folders of the dates that may hold some of the keys, at most one per calendar day.

    The bitmaps of a table that was written without them are made once, from its keys.
    """
    spec, side = schemas.SILVER_VISITS, schemas.VISIT_KEYS
    recover(spark, config, side)
    if not files.matches(spark, f"{table_path(config, side)}/part-*"):
        if not files.matches(spark, f"{table_path(config, spec)}/*/part-*"):
            return []
        publish(spark, config, side, (), None, key_fragments(read_physical(spark, config, spec), spec.keys[0], "transaction_dt"))
    gather_files(spark, config, side)
    fragments = read_physical(spark, config, side)
    return _folders(r[0] for r in groups_that_may_hold(fragments, keys, spec.keys[0], "transaction_dt").collect())


def apply_locations(spark: SparkSession, config: JobConfig, batch: DataFrame, stamp: Stamp) -> dict[str, int]:
    """Overwrite known locations, unless a later delivery did so before; insert new ones."""
    spec = schemas.SILVER_LOCATIONS
    key = spec.keys[0]
    prepared = dedupe_latest(prepare_locations(batch, stamp), spec.keys, INGEST_ORDER)
    updates, sizes = _bucketed(spark, config, spec, prepared)
    try:
        stored = read_partitions(spark, config, spec, _keyed(sizes), hidden=True)
        seen = [F.col(c).alias(f"_stored{c}") for c in INGEST_ORDER]
        held = stored.select(key, *seen, F.lit(True).alias("_held")).join(updates.select(key), key, "left_semi")
        # Few rows on either side: those of the batch.
        matched = updates.join(held, key, "left")
        stale = not_later(INGEST_ORDER, [F.col(f"_stored{c}") for c in INGEST_ORDER])
        action = F.when(F.col("_held").isNull(), INSERT).when(stale, KEEP).otherwise(UPDATE)
        changed = matched.select(*updates.columns, action.alias(ACTION)).persist()
        try:
            counts, touched = _tally(changed)
            rows = changed.where(F.col(ACTION) != KEEP).drop(ACTION)
            changes = change_rows(config, spec, stamp, stored.join(rows.select(key), key, "left_semi"), rows)
            _publish_buckets(spark, config, spec, stored, rows, rows.select(key), touched, changes)
            return {"input": sum(sizes.values()), **counts}
        finally:
            changed.unpersist()
    finally:
        updates.unpersist()


def apply_customers(
    spark: SparkSession,
    config: JobConfig,
    batch: DataFrame,
    stamp: Stamp,
    first_effective: str | None = None,
    null_safe: bool = True,
) -> dict[str, int]:
    """Every delivered version of a customer in delivery order: changed ones close the one before.

    Of several rows of a customer in one staged file one counts. A delivery that may
    not be the customer's latest, because it is no later than what the table has seen, is spliced into the customer's
    stored versions, so the result does not depend on where batches are cut. That needs to know when versions
    were repeated, which a side table keeps; it does not read bronze.
    """
    spec = schemas.SILVER_CUSTOMERS
    key = spec.keys[0]
    prepared = dedupe_latest(prepare_customers(batch, stamp), [*spec.keys, *INGEST_ORDER], ())
    prepared = stamped(prepared, F.lit(None), "current", "effective_date", "end_date")
    updates, sizes = _bucketed(spark, config, spec, prepared)
    changed = runs = late = None
    try:
        seen = _progress(spark, config, spec)
        moment = F.struct(F.unix_micros(INGEST_ORDER[0]).alias("at"), F.col(INGEST_ORDER[1]).alias("file"))
        latest = updates.where(F.col(INGEST_ORDER[0]).isNotNull()).agg(F.max(moment).alias("o")).first()["o"]
        opened = read_partitions(spark, config, spec, ["true"], hidden=True).where(F.col(BUCKET_COLUMN).isin(_keyed(sizes, int)))
        held = opened.join(updates.select(key), key, "left_semi")
        stamps = held.select(key, *[F.col(c).alias(f"_stored{c}") for c in INGEST_ORDER])
        no_later = not_later(INGEST_ORDER, [F.col(f"_stored{c}") for c in INGEST_ORDER])
        if seen:
            no_later = no_later | not_later(INGEST_ORDER, [F.timestamp_micros(F.lit(seen[0])), F.lit(seen[1])])
        late = updates.join(stamps, key, "left").where(no_later).select(key).distinct().persist()
        # Written before the table: to be too high costs a rebuild, to be too low a version.
        _set_progress(spark, config, spec, seen, latest)

        keyed = updates.where(F.col(key).isNotNull()).join(late, key, "left_anti").select(*updates.columns)
        known = held.join(late, key, "left_anti").select(*updates.columns)
        both = known.withColumn("_new", F.lit(0)).unionByName(keyed.withColumn("_new", F.lit(1)))
        along = ("_new", *INGEST_ORDER)
        runs = version_runs(both, key, along, schemas.TRACKED_CUSTOMER_COLUMNS, null_safe).persist()
        chain = runs.where("chain_new").withColumn("chain_last", F.lead(F.lit(1)).over(Window.partitionBy(key).orderBy(*along)).isNull())
        repeats = runs.where("not chain_new and _ingest_ts is not null").select(*schemas.CUSTOMER_REPEATS.physical_schema.names)
        is_new, closing = F.col("_new") == 1, ~F.col("chain_last")
        action = F.when(is_new, INSERT).when(closing, CLOSE).otherwise(KEEP)
        versions = chain.withColumns(
            {
                ACTION: action,
                "current": F.col("chain_last"),
                "effective_date": F.when(is_new, _effective(stamp, first_effective)).otherwise(F.col("effective_date")),
                "end_date": F.when(closing, stamp.day),
                "update_ts": F.when(is_new | closing, stamp.ts).otherwise(F.col("update_ts")),
            }
        )
        unkeyed = updates.where(F.col(key).isNull()).withColumns(
            {
                ACTION: F.lit(INSERT),
                "current": F.lit(True),
                "effective_date": _effective(stamp, first_effective, F.lit(True)),
                "end_date": F.lit(None).cast("date"),
            }
        )
        columns = [*spec.physical_schema.names, ACTION]
        changed = versions.select(*columns).unionByName(unkeyed.select(*columns)).persist()
        counts, touched = _tally(changed, F.col("current") | (F.col(ACTION) == CLOSE))
        rows = changed.where(F.col(ACTION) != KEEP)
        closed = rows.where(F.col(ACTION) == CLOSE).select(key)
        if late.isEmpty():
            changes = change_rows(config, spec, stamp, opened.join(closed, key, "left_semi"), rows)
            _publish_buckets(spark, config, spec, opened, rows.drop(ACTION), closed, touched, [(schemas.CUSTOMER_REPEATS, repeats), *changes])
        else:
            merge = _Merge(rows, closed, touched, counts, repeats)
            counts = _splice(spark, config, stamp, updates.join(late, key, "left_semi"), late, merge, first_effective, null_safe)
        return {"input": sum(sizes.values()), **counts}
    finally:
        for df in (changed, runs, late, updates):
            if df is not None:
                df.unpersist()


def _effective(stamp: Stamp, first_effective: str | None, first: Column | None = None) -> Column:
    if not first_effective:
        return stamp.day
    first = F.col("chain_first") if first is None else first
    return F.when(first, F.coalesce(F.col(first_effective), stamp.day)).otherwise(stamp.day)


@dataclass(frozen=True)
class _Merge:
    """What a batch changes for customers without a late delivery."""

    rows: DataFrame
    closed: DataFrame
    touched: set[tuple]
    counts: dict[str, int]
    repeats: DataFrame


def _splice(
    spark: SparkSession,
    config: JobConfig,
    stamp: Stamp,
    deliveries: DataFrame,
    late: DataFrame,
    merge: _Merge,
    first_effective: str | None,
    null_safe: bool,
) -> dict[str, int]:
    """Publishes a merge along with the histories of the customers in ``late``, ``deliveries`` spliced into them.

    Versions that the table has keep their dates and stamps. A version that arrives late is
    effective when its successor is, at the latest. Open and closed versions of the
    buckets concerned are rewritten where a history comes out different.
    """
    spec, side = schemas.SILVER_CUSTOMERS, schemas.CUSTOMER_REPEATS
    key, order = spec.keys[0], list(INGEST_ORDER)
    physical = spec.physical_schema.names
    bucket = bucket_of(spark, config, spec)
    buckets = [r[0] for r in late.select(bucket).distinct().collect()]
    stored = read_physical(spark, config, spec).where(F.col(BUCKET_COLUMN).isin(buckets))
    own = stored.join(late, key, "left_semi").select(*physical).persist()
    # Repeats stay where they were noted when their bucket is split.
    noted_in = {*buckets, *(a for b in buckets for a in ancestors(b, config.key_buckets))}
    seen_again = read_partitions(spark, config, side, map(str, noted_in), hidden=True).join(late, key, "left_semi")
    one_each = deliveries.select(*physical)
    runs = spliced(own, seen_again, one_each, key, order, schemas.TRACKED_CUSTOMER_COLUMNS, null_safe).persist()
    # A delivery that is a version no more, or that came late and repeats one.
    demoted = runs.where("not chain_new and chain_source <> 1").select(key, *order, BUCKET_COLUMN)
    repeats = merge.repeats.unionByName(demoted.select(*side.physical_schema.names))
    following = Window.partitionBy(key).orderBy(*order)
    after, upto = (following.rowsBetween(a, b) for a, b in ((0, Window.unboundedFollowing), (Window.unboundedPreceding, 0)))
    is_stored = F.col("chain_source") == 0
    old = {f"_old_{c}": F.when(is_stored, F.col(c)) for c in ("effective_date", "end_date", "current", "load_ts", "update_ts")}
    # A stored first version may be dated by another column than the run's day; it keeps that only while it is the first.
    first = is_stored & (F.count(F.when(is_stored, 1)).over(upto) == 1)
    own_date = F.when(~(first & F.lit(bool(first_effective))), F.col("_old_effective_date"))
    # A version is effective when its first delivery or any after it was, also one that now merely repeats it.
    date = F.coalesce(own_date, F.when(F.col("chain_new"), stamp.day))
    dated = runs.withColumns(old).withColumn("_date", date).withColumn("effective_date", F.min("_date").over(after)).where("chain_new")
    dated = dated.withColumn("chain_last", F.lead(F.lit(1)).over(following).isNull())
    if first_effective:
        dated = dated.withColumn(
            "effective_date", F.when(F.col("chain_first"), F.coalesce(F.col(first_effective), F.col("effective_date"))).otherwise(F.col("effective_date"))
        )
    dated = dated.withColumns({"current": F.col("chain_last"), "end_date": F.lead("effective_date").over(following)})
    same = F.col("end_date").eqNullSafe(F.col("_old_end_date")) & F.col("current").eqNullSafe(F.col("_old_current"))
    stamps = {
        "load_ts": F.coalesce("_old_load_ts", stamp.ts),
        "update_ts": F.when(same, F.col("_old_update_ts")).otherwise(stamp.ts),
        BUCKET_COLUMN: bucket,
    }
    built = dated.withColumns(stamps).select(*physical).persist()
    changed = built.exceptAll(own).select(key).union(own.exceptAll(built).select(key)).distinct().persist()
    try:
        pairs = own.select(*order, key, F.lit(True).alias("_known"))
        new = built.join(changed, key, "left_semi").join(pairs, [key, *order], "left_anti").count()
        shut = own.where("current").join(built.where("not current"), [key, *order], "left_semi").count()
        counts = {**merge.counts, INSERT: merge.counts.get(INSERT, 0) + new, CLOSE: merge.counts.get(CLOSE, 0) + shut}
        moved = [r[0] for r in changed.select(bucket).distinct().collect()]
        touched = {*merge.touched, *((flag, b) for b in moved for flag in (True, False))}
        result = built.join(changed, key, "left_semi").select(*physical)
        inside = partition_in(spec, touched)
        every = merge.rows.drop(ACTION).unionByName(result)
        base = read_physical(spark, config, spec).where(inside)
        # Of customers that are not rebuilt only the open version is closed here; their history stays.
        rebuilt = changed.select(key, F.lit(True).alias("_rebuilt"))
        ended = merge.closed.select(key, F.lit(True).alias("_ended"))
        left = base.join(rebuilt, key, "left").join(ended, key, "left")
        left = left.where(F.col("_rebuilt").isNull() & (F.col("_ended").isNull() | ~F.col("current"))).select(*physical)
        replacing = left.unionByName(every.where(inside)) if touched else None
        before = base.join(rebuilt, key, "left").join(ended, key, "left")
        before = before.where(F.col("_rebuilt").isNotNull() | (F.col("_ended").isNotNull() & F.col("current"))).select(*physical)
        changes = change_rows(config, spec, stamp, before, every)
        publish(spark, config, spec, touched, replacing, every.where(~inside), [(side, repeats), *changes])
        return {a: n for a, n in counts.items() if n}
    finally:
        for df in (changed, built, runs, own):
            df.unpersist()


# --- buckets ------------------------------------------------------------------


def _bucketed(
    spark: SparkSession, config: JobConfig, spec: TableSpec, prepared: DataFrame
) -> tuple[DataFrame, dict[int, int]]:
    """The batch with its rows' buckets, kept, and the number of rows per bucket (at most one entry per bucket)."""
    ensure_buckets(spark, config, spec)
    bucket = bucket_of(spark, config, spec)
    updates = conform(prepared.withColumn(BUCKET_COLUMN, bucket), spec.physical_schema).persist()
    return updates, dict(updates.groupBy(BUCKET_COLUMN).count().collect())


def _keyed(sizes: dict[int, int], kind: type = str) -> list:
    return [kind(b) for b in sizes if b != NULL_KEY_BUCKET]


def _tally(changed: DataFrame, rewriting: Column | None = None) -> tuple[dict[str, int], set[tuple]]:
    """Rows per action, and the buckets to rewrite; rows without a key are only ever added."""
    spec_columns = ["current", BUCKET_COLUMN] if "current" in changed.columns else [BUCKET_COLUMN]
    rewriting = F.lit(True) if rewriting is None else rewriting
    rewriting = rewriting & (F.col(ACTION) != KEEP) & (F.col(BUCKET_COLUMN) != NULL_KEY_BUCKET)
    counts: dict[str, int] = {}
    touched = set()
    for action, bucket, rewrite, n in changed.groupBy(ACTION, BUCKET_COLUMN, rewriting.alias("r")).count().collect():
        counts[action] = counts.get(action, 0) + n
        if rewrite:
            touched.add((True, bucket) if "current" in spec_columns else (bucket,))
    return counts, touched


def _publish_buckets(
    spark: SparkSession,
    config: JobConfig,
    spec: TableSpec,
    stored: DataFrame,
    rows: DataFrame,
    gone: DataFrame,
    touched: set[tuple],
    also: Sequence[tuple[TableSpec, DataFrame]] = (),
) -> None:
    """Stored rows of the touched buckets, less ``gone`` keys, with ``rows``; rows of other partitions are added."""
    if rows.isEmpty() and all(df.isEmpty() for _, df in also):
        return
    inside = partition_in(spec, touched)
    left = stored.where(inside).join(gone, list(spec.keys), "left_anti").select(*spec.physical_schema.names)
    replacing = left.unionByName(rows.where(inside)) if touched else None
    publish(spark, config, spec, touched, replacing, rows.where(~inside), also)


def _progress(spark: SparkSession, config: JobConfig, spec: TableSpec) -> tuple[int, str] | None:
    """The latest delivery that a merge has been given: microseconds and file."""
    path = progress_path(config, spec)
    if not files.exists(spark, path):
        return None
    moment, file = files.read_text(spark, path).split(" ", 1)
    return int(moment), file


def _set_progress(spark: SparkSession, config: JobConfig, spec: TableSpec, seen: tuple[int, str] | None, latest) -> None:
    if latest is not None and (seen is None or tuple(latest) > seen):
        files.write_text(spark, progress_path(config, spec), f"{latest[0]} {latest[1]}")


def _run(
    spark: SparkSession,
    config: JobConfig,
    source: TableSpec,
    target: TableSpec,
    operation: str,
    step: BatchStep,
    as_of: dt.datetime | None,
    timeout: float | None,
    within: str | None = None,
) -> StreamingQuery:
    require_time_zone(spark, config.time_zone)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        recover(session, config, target)
        batch.persist()
        try:
            counts = step(session, config, batch, Stamp.at(as_of))
        finally:
            batch.unpersist()
        # The query's id is a property of the job; the variable may not be set yet.
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        record_run(session, config, target, operation, counts, query_id, batch_id, counts["input"])
        if target.bucketed and config.split_rows:
            split_buckets(session, config, target, config.split_rows)
        refresh_registered(session, config, target)

    names = qualified_name(config, source), qualified_name(config, target)
    rows = stream_table(spark, config, source)
    query = (
        (once_within(rows, target.keys[0], within) if within else rows)
        .writeStream.foreachBatch(on_batch)
        .outputMode("update")
        .option("checkpointLocation", checkpoint_dir(config, "bronze-silver", *names))
        .trigger(**config.trigger)
        .start()
    )
    await_query(query, config, timeout)
    return query


def once_within(rows: DataFrame, key: str, within: str) -> DataFrame:
    """A stream's rows, but of those of one key that arrive within a time of each other only the first. Rows without a key all stay."""
    own = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("none "), F.expr("uuid()")))
    watched = rows.withColumn("_key", own).withWatermark(INGEST_ORDER[0], within)
    return watched.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def run_visits(
    spark: SparkSession,
    config: JobConfig,
    as_of: dt.datetime | None = None,
    timeout: float | None = None,
    once_in: str | None = None,
) -> StreamingQuery:
    """``once_in``, such as ``"2 days"``, drops visits that come again within that time before the merge sees them.

    Their keys are then kept in the query's state for as long. A delivery that is dropped is not
    compared with the stored one, so this is for feeds that deliver again what they delivered before; later than that
    the merge finds it. The option holds for a checkpoint from its first run on.
    """
    source, target = schemas.BRONZE_VISITS, schemas.SILVER_VISITS
    return _run(spark, config, source, target, "insert_if_absent", apply_visits, as_of, timeout, once_in)


def run_locations(
    spark: SparkSession, config: JobConfig, as_of: dt.datetime | None = None, timeout: float | None = None
) -> StreamingQuery:
    return _run(
        spark,
        config,
        schemas.BRONZE_LOCATIONS,
        schemas.SILVER_LOCATIONS,
        "upsert_latest",
        apply_locations,
        as_of,
        timeout,
    )


def run_customers(
    spark: SparkSession,
    config: JobConfig,
    as_of: dt.datetime | None = None,
    timeout: float | None = None,
    first_effective: str | None = None,
    literal: bool = False,
) -> StreamingQuery:
    """``literal=True`` compares with ``<>``, so changes from or to NULL are missed."""

    def step(session: SparkSession, cfg: JobConfig, batch: DataFrame, stamp: Stamp) -> dict[str, int]:
        return apply_customers(session, cfg, batch, stamp, first_effective, not literal)

    return _run(
        spark, config, schemas.BRONZE_CUSTOMERS, schemas.SILVER_CUSTOMERS, "scd2_apply", step, as_of, timeout
    )
