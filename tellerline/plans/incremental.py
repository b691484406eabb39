"""Daily totals by bank kept up from what merges changed, whatever the dates.

``run_daily`` recomputes a trailing window, so a visit that arrives later than that is never summed. Here
each change of the visits table is a signed amount: rows put in count once, rows taken out count back. Sums
and counts of amounts by day and ATM are kept, so that a total whose last amount was taken back is NULL again; totals
by bank are made anew, from those, for the days that changed, or for all days when ATMs changed banks.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerline import schemas
from tellerline.functions.columns import DEPOSIT_TAG, WITHDRAWAL_TAG, amount_of, stamped
from tellerline.operators.conform import conform
from tellerline.operators.merge import upsert_if_changed
from tellerline.params import JobConfig, Stamp, TriggerMode
from tellerline.plans.daily import TOTALS, with_bank
from tellerline.schemas import AFTER, CHANGE_COLUMN
from tellerline.session import require_time_zone
from tellerline.sources import files
from tellerline.sources.audit import record_run
from tellerline.sources.publish import consistent, publish, publish_labelled, recover, settle
from tellerline.sources.tables import (
    NULL_PARTITION,
    checkpoint_dir,
    progress_path,
    read_partitions,
    read_physical,
    read_table,
    refresh_registered,
    table_path,
)

COUNTS = ("n_withdrawls", "n_deposits")
SUMS = ("visits", TOTALS[0], COUNTS[0], TOTALS[1], COUNTS[1])


def signed_totals(changes: DataFrame) -> DataFrame:
    """Changes of visits as changes of the sums of a day and ATM."""
    sign = F.when(F.col(CHANGE_COLUMN) == AFTER, F.lit(1)).otherwise(F.lit(-1))
    columns = [F.sum(sign).alias("visits")]
    for total, count, tag in zip(TOTALS, COUNTS, (WITHDRAWAL_TAG, DEPOSIT_TAG)):
        amount = amount_of(tag)
        columns += [F.sum(F.coalesce(amount, F.lit(0)) * sign).alias(total), F.sum(F.when(amount.isNotNull(), sign).otherwise(0)).alias(count)]
    return changes.groupBy("transaction_dt", "atm_id").agg(*columns)


def summed(stored: DataFrame, deltas: DataFrame) -> DataFrame:
    """Sums with changes added; a day and ATM without a visit left is gone."""
    keys = schemas.DAILY_BY_ATM.keys
    both = stored.select(*keys, *SUMS).unionByName(deltas.select(*keys, *SUMS))
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS]).where("visits <> 0")


def totals_by_bank(by_atm: DataFrame, locations: DataFrame) -> DataFrame:
    """As ``daily_by_bank``: a total without an amount is NULL."""
    own = by_atm.select("transaction_dt", "atm_id", *[F.when(F.col(n) > 0, F.col(t)).alias(t) for t, n in zip(TOTALS, COUNTS)])
    return with_bank(own, locations).groupBy("transaction_dt", "bank").agg(*[F.sum(c).alias(c) for c in TOTALS])


def _folder(day: dt.date | None) -> str:
    return NULL_PARTITION if day is None else str(day)


def _days_of(rows: DataFrame) -> set:
    """Bounded by the number of calendar days."""
    return {r[0] for r in rows.select("transaction_dt").distinct().collect()}


def apply_changes(spark: SparkSession, config: JobConfig, changes: DataFrame, query_id: str, batch_id: int) -> set:
    """Adds a batch of changes to the sums, once; returns the days concerned."""
    spec, side = schemas.DAILY_BY_ATM, schemas.DAILY_BATCHES
    recover(spark, config, spec)
    days = _days_of(changes)
    done = read_physical(spark, config, side).where((F.col("query_id") == query_id) & (F.col("batch_id") == batch_id))
    if days and done.isEmpty():
        stored = read_partitions(spark, config, spec, map(_folder, days))
        sums = conform(summed(stored, signed_totals(changes)), spec.schema)
        mark = spark.range(1).select(F.lit(query_id).alias("query_id"), F.lit(batch_id).cast("long").alias("batch_id"))
        publish(spark, config, spec, [(d,) for d in days], sums, None, [(side, mark)])
    return days


def store_totals(spark: SparkSession, config: JobConfig, days: set, stamp: Stamp) -> dict[str, int]:
    """Totals by bank of some days from the sums; of all days if the locations are not those of the last time."""
    spec, source = schemas.GOLD_DAILY, schemas.SILVER_LOCATIONS
    recover(spark, config, spec)
    note = f"{progress_path(config, spec)}-locations"
    version = settle(spark, config, source) or ""
    used = files.read_text(spark, note) if files.exists(spark, note) else ""
    if version != used:
        days = days | _days_of(read_table(spark, config, schemas.DAILY_BY_ATM)) | _days_of(read_table(spark, config, spec))
    if not days:
        return {}
    folders = [_folder(d) for d in days]
    locations = consistent(spark, config, (source,), lambda: read_table(spark, config, source))
    totals = totals_by_bank(read_partitions(spark, config, schemas.DAILY_BY_ATM, folders), locations)
    updates = conform(stamped(totals, stamp.ts, "create_ts", "update_ts"), spec.schema)
    stored = read_partitions(spark, config, spec, folders)
    merged = upsert_if_changed(stored, updates, spec.keys, TOTALS, nullable_keys=("transaction_dt",), labelled=True, drop_vanished=True)
    counts = publish_labelled(spark, config, spec, merged, stored, stamp)
    files.write_text(spark, note, version)
    return counts


def run_daily_incremental(spark: SparkSession, config: JobConfig, as_of: dt.datetime | None = None, timeout: float | None = None) -> dict[str, int]:
    """Sums what the visits' merges changed since the last run and stores the totals it changes; returns rows per action.

    The visits table must have been kept with ``change_rows`` from its first row on. A batch that is
    delivered again after a failure is added once. The summary equals one of all days made anew.
    """
    require_time_zone(spark, config.time_zone)
    visits = schemas.SILVER_VISITS
    changes = schemas.changes_of(visits)
    if not config.change_rows:
        raise ValueError("incremental summaries need change_rows")
    stamp, counts = Stamp.at(as_of), {}
    settle(spark, config, visits)
    path = table_path(config, changes)
    files.make_dir(spark, path)

    def stored(totals: dict[str, int]) -> None:
        for action, n in totals.items():
            counts[action] = counts.get(action, 0) + n

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        query_id = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.persist()
        try:
            days = apply_changes(session, config, batch, query_id, batch_id)
        finally:
            batch.unpersist()
        stored(store_totals(session, config, days, stamp))

    query = (
        spark.readStream.schema(changes.schema)
        .option("maxFilesPerTrigger", config.max_bronze_files_per_trigger)
        .parquet(path)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint_dir(config, "silver-gold", changes.name, schemas.DAILY_BY_ATM.name))
        .trigger(**TriggerMode.BATCH.options)
        .start()
    )
    query.awaitTermination(timeout)
    stored(store_totals(spark, config, set(), stamp))
    record_run(spark, config, schemas.GOLD_DAILY, "signed_totals", counts)
    refresh_registered(spark, config, schemas.GOLD_DAILY)
    return counts
