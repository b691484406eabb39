"""Streaming queries: driver tables are staged as JSON files and taken through
the real jobs; the result must equal the batch result over the same rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerline import schemas
from tellerline.functions.columns import key_bucket
from tellerline.operators import conform, upsert_latest
from tellerline.params import DayWindow, JobConfig, MonthWindow, Stamp, TriggerMode
from tellerline.plans import run_daily, run_daily_incremental, run_monthly
from tellerline.registry.shapes import FIRST_FEED, SECOND_FEED, customer_deliveries, customers, locations, moved_locations, visits
from tellerline.session import scratch_dir
from tellerline.sources import create_layer_tables, history, read_table, recover
from tellerline.sources.publish import prepare
from tellerline.sources.tables import read_physical
from tellerline.streaming import prepare_locations, run_customers, run_locations, run_stage_to_bronze, run_visits, supervise
from tellerline.streaming.bronze import quarantine_path, rescued_spec
from tellerline.streaming.metrics import COUNTS, stream_metrics
from tellerline.streaming.silver import apply_customers, apply_visits

FIRST_DAY = dt.datetime(2024, 1, 1, 12)
SECOND_DAY = dt.datetime(2024, 2, 1, 12)
THIRD_DAY = dt.datetime(2024, 2, 2, 12)


def _config(spark: SparkSession, name: str) -> JobConfig:
    return JobConfig.under(
        scratch_dir(spark, name),
        # As many buckets as the cluster merges at once.
        key_buckets=max(8, spark.sparkContext.defaultParallelism),
        time_zone=spark.conf.get("spark.sql.session.timeZone"),
    )


def _deliver(spark: SparkSession, config: JobConfig, folder: str, rows: DataFrame) -> None:
    """Write rows as staged files and ingest them into bronze."""
    (
        rows.write.mode("append")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .json(f"{config.stage_root}/{folder}")
    )
    run_stage_to_bronze(spark, config, folder)


def _without_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_ts", F.col("transaction_ts").cast("timestamp_ntz"))


def stream_stage_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, "stage-to-bronze")
    _deliver(spark, config, "atm_visits", visits(spark, sf_dir))
    columns = schemas.STAGED["atm_visits"].names
    return _without_zone(read_table(spark, config, schemas.BRONZE_VISITS).select(*columns))


def stream_silver_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, "silver-visits")
    for factor, as_of in ((FIRST_FEED, FIRST_DAY), (SECOND_FEED, SECOND_DAY)):
        _deliver(spark, config, "atm_visits", visits(spark, sf_dir, factor))
        run_visits(spark, config, as_of)
    return _without_zone(read_table(spark, config, schemas.SILVER_VISITS)).drop("load_ts")


def stream_silver_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _config(spark, "silver-locations")
    for factor, as_of in ((FIRST_FEED, FIRST_DAY), (SECOND_FEED, SECOND_DAY)):
        _deliver(spark, config, "atm_locations", locations(spark, sf_dir, factor))
        run_locations(spark, config, as_of)
    return read_table(spark, config, schemas.SILVER_LOCATIONS)


def _customer_history(spark: SparkSession, sf_dir: str, name: str) -> JobConfig:
    config = _config(spark, name)
    for factor, as_of in ((FIRST_FEED, FIRST_DAY), (SECOND_FEED, SECOND_DAY)):
        _deliver(spark, config, "atm_customers", customers(spark, sf_dir, factor))
        run_customers(spark, config, as_of)
    return config


def stream_silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _customer_history(spark, sf_dir, "silver-customers")
    return read_table(spark, config, schemas.SILVER_CUSTOMERS).drop("load_ts", "update_ts")


def stream_silver_customers_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries waiting in bronze, merged file by file."""
    config = replace(_config(spark, "customer-versions"), max_bronze_files_per_trigger=1)
    for rows in customer_deliveries(spark, sf_dir):
        _deliver(spark, config, "atm_customers", rows)
    run_customers(spark, config, SECOND_DAY)
    columns = ("customer_id", "first_name", "current", "effective_date", "end_date")
    return read_table(spark, config, schemas.SILVER_CUSTOMERS).select(*columns)


def _bronze_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three deliveries of every customer as bronze holds them, an hour apart."""
    return [
        rows.withColumns({"_ingest_ts": F.lit(f"2024-01-01 0{i}:00:00").cast("timestamp"), "_ingest_file": F.lit(f"delivery-{i}")})
        for i, rows in enumerate(customer_deliveries(spark, sf_dir))
    ]


def late_customer_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of three deliveries is merged last: it is spliced into the stored versions, bronze is not there."""
    config = _config(spark, "late-customers")
    first, second, third = _bronze_batches(spark, sf_dir)
    for batch, day in ((first, FIRST_DAY), (third, SECOND_DAY), (second, THIRD_DAY)):
        apply_customers(spark, config, batch, Stamp.at(day))
    columns = ("customer_id", "first_name", "current", "effective_date", "end_date")
    return read_table(spark, config, schemas.SILVER_CUSTOMERS).select(*columns)


def recovered_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds of locations; each merge is written and left, and the table's next run moves it into place."""
    config, spec = _config(spark, "recovered"), schemas.SILVER_LOCATIONS
    for factor, as_of in ((FIRST_FEED, FIRST_DAY), (SECOND_FEED, SECOND_DAY)):
        rows = prepare_locations(locations(spark, sf_dir, factor), Stamp.at(as_of))
        rows = rows.withColumns({"_ingest_ts": F.lit(as_of).cast("timestamp"), "_ingest_file": F.lit("feed")})
        bucket = key_bucket(spec.keys, config.key_buckets).cast("int")
        updates = conform(rows.withColumn(schemas.BUCKET_COLUMN, bucket), spec.physical_schema)
        merged = upsert_latest(read_physical(spark, config, spec), updates, spec.keys)
        touched = [(b,) for b in range(config.key_buckets)]
        prepare(spark, config, spec, touched, conform(merged, spec.physical_schema))
        recover(spark, config, spec)
    return read_table(spark, config, spec)


def customer_changes_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change rows of the second feed's merge, replayed over the table as it was before."""
    config = replace(_config(spark, "changes"), change_rows=True)
    spec = schemas.SILVER_CUSTOMERS
    first, second = (customers(spark, sf_dir, factor) for factor in (FIRST_FEED, SECOND_FEED))
    stamps = [F.lit(f"2024-01-0{d} 06:00:00").cast("timestamp") for d in (1, 2)]
    batches = [rows.withColumns({"_ingest_ts": at, "_ingest_file": F.lit("feed")}) for rows, at in zip((first, second), stamps)]
    apply_customers(spark, config, batches[0], Stamp.at(FIRST_DAY))
    old = f"{config.silver_root}/before"
    read_physical(spark, config, spec).write.parquet(old)
    apply_customers(spark, config, batches[1], Stamp.at(SECOND_DAY))
    changes = read_physical(spark, config, schemas.changes_of(spec)).where(F.col("_change_ts") == Stamp.at(SECOND_DAY).ts)
    names = spec.physical_schema.names
    taken, put = (changes.where(F.col(schemas.CHANGE_COLUMN) == kind).select(*names) for kind in (schemas.BEFORE, schemas.AFTER))
    replayed = spark.read.parquet(old).select(*names).exceptAll(taken).unionByName(put)
    return replayed.select(*spec.schema.names).drop("load_ts", "update_ts")


def stream_incremental_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds of visits over the same days, each summed from its change rows; between them banks merge."""
    config = replace(_config(spark, "incremental"), change_rows=True)
    feeds = ((FIRST_FEED, FIRST_DAY, locations), (SECOND_FEED, SECOND_DAY, moved_locations))
    for factor, as_of, places in feeds:
        _deliver(spark, config, "atm_visits", visits(spark, sf_dir, factor))
        _deliver(spark, config, "atm_locations", places(spark, sf_dir))
        run_visits(spark, config, as_of)
        run_locations(spark, config, as_of)
        run_daily_incremental(spark, config, as_of)
    return read_table(spark, config, schemas.GOLD_DAILY).drop("create_ts", "update_ts")


def stream_visits_delivered_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits delivered twice: the second delivery is dropped by the stream's state and never merged."""
    config = _config(spark, "again")
    for as_of in (FIRST_DAY, SECOND_DAY):
        _deliver(spark, config, "atm_visits", visits(spark, sf_dir))
        run_visits(spark, config, as_of, once_in="1 day")
    merged = history(spark, config, schemas.SILVER_VISITS).agg(F.sum("input_rows")).first()[0]
    received = read_table(spark, config, schemas.BRONZE_VISITS).groupBy("visit_id").agg(F.count(F.lit(1)).alias("received"))
    stored = read_table(spark, config, schemas.SILVER_VISITS).select("visit_id", "customer_id", "amount")
    return stored.join(received, "visit_id").withColumn("merged", F.lit(merged))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged locations, each beside a line that does not parse: the lines that were split off."""
    config = _config(spark, "quarantine")
    rows = locations(spark, sf_dir)
    good = rows.select(F.to_json(F.struct("*")).alias("value"))
    broken = rows.select(F.concat(F.lit('{"atm_id": broken '), "atm_id").alias("value"))
    good.unionByName(broken).write.text(f"{config.stage_root}/atm_locations")
    run_stage_to_bronze(spark, config, "atm_locations", quarantine=True)
    kept = read_table(spark, config, schemas.BRONZE_LOCATIONS).select("atm_id", F.lit(None).cast("string").alias("line"))
    rejected = spark.read.parquet(quarantine_path(config, "atm_locations"))
    return kept.unionByName(rejected.select("atm_id", F.col(schemas.CORRUPT_COLUMN).alias("line")))


def stream_rescued_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that has drifted: visits with an undeclared object, those reported as fraud with their amount as text."""
    config = _config(spark, "rescued")
    rows = visits(spark, sf_dir).withColumn("channel", F.struct((F.col("customer_id") % 3).alias("terminal")))
    fraud = F.col("fraud_report") == "Y"
    told = rows.where(fraud).withColumn("amount", F.concat(F.col("amount").cast("string"), F.lit(" cents")))
    lines = [part.select(F.to_json(F.struct("*")).alias("value")) for part in (rows.where(~fraud), told)]
    lines[0].unionByName(lines[1]).write.text(f"{config.stage_root}/atm_visits")
    run_stage_to_bronze(spark, config, "atm_visits", rescue=True)
    return read_physical(spark, config, rescued_spec(schemas.BRONZE_VISITS)).select(
        "visit_id",
        "amount",
        "date",
        F.try_variant_get("_rescued", "$.channel.terminal", "bigint").alias("terminal"),
        F.try_variant_get("_rescued", "$.amount", "string").alias("told"),
    )


def stream_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the bronze stream counted of visits, of which some have no id, beside a line that does not parse for each deposit."""
    config = _config(spark, "measured")
    rows = visits(spark, sf_dir)
    rows = rows.withColumn("visit_id", F.when(F.col("fraud_report") == "N", F.col("visit_id")))
    good = rows.select(F.to_json(F.struct("*")).alias("value"))
    broken = rows.where("withdrawl_or_deposit = 'deposit'").select(F.concat(F.lit('{"atm_id": broken '), "atm_id").alias("value"))
    good.unionByName(broken).write.text(f"{config.stage_root}/atm_visits")
    late_before = dt.date(2024, 1, 10)
    run_stage_to_bronze(spark, config, "atm_visits", quarantine=True, measure=True, late_before=late_before)
    counted = stream_metrics(spark, config, schemas.BRONZE_VISITS)
    return counted.groupBy("table_name").agg(*[F.sum(c).alias(c) for c in COUNTS])


def stream_supervised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds of visits waiting; the jobs to bronze and to silver run side by side until they have taken up both."""
    config = replace(_config(spark, "supervised"), trigger_mode=TriggerMode.STREAMING, poll_seconds=1)
    for factor in (FIRST_FEED, SECOND_FEED):
        visits(spark, sf_dir, factor).write.mode("append").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(
            f"{config.stage_root}/atm_visits"
        )
    jobs = {
        "bronze": lambda: run_stage_to_bronze(spark, config, "atm_visits"),
        "silver": lambda: run_visits(spark, config, SECOND_DAY),
    }
    # Nothing more is to come: the jobs are started, take up what there is and stop in order.
    supervise(spark, jobs, lambda: True)
    return _without_zone(read_table(spark, config, schemas.SILVER_VISITS)).drop("load_ts")


def stream_customers_in_growing_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds of customers into one bucket, which is split as it fills."""
    config = replace(_config(spark, "growing"), key_buckets=1, split_rows=1000)
    for factor, as_of in ((FIRST_FEED, FIRST_DAY), (SECOND_FEED, SECOND_DAY)):
        _deliver(spark, config, "atm_customers", customers(spark, sf_dir, factor))
        run_customers(spark, config, as_of)
    return read_table(spark, config, schemas.SILVER_CUSTOMERS).drop("load_ts", "update_ts")


def replayed_visits_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A micro-batch of visits that is merged twice, as after a failure."""
    config = _config(spark, "replayed")
    delivered = {"_ingest_ts": F.lit("2024-02-01 06:00:00").cast("timestamp"), "_ingest_file": F.lit("feed")}
    batch = visits(spark, sf_dir).withColumn("transaction_ts", F.col("transaction_ts").cast("timestamp")).withColumns(delivered)
    again = [apply_visits(spark, config, batch, Stamp.at(day)) for day in (SECOND_DAY, THIRD_DAY)][1]
    added = F.lit(again.get("insert", 0) + again.get("update", 0)).cast("long").alias("changed_again")
    return read_table(spark, config, schemas.SILVER_VISITS).select("visit_id", "amount", "transaction_dt", F.to_date("load_ts").alias("loaded"), added)


def catalog_daily_by_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored daily summary and its sources, by their names in the catalog."""
    mark = uuid.uuid4().hex[:12]
    names = {f"{layer}_schema": f"{layer}_{mark}" for layer in ("bronze", "silver", "gold")}
    config = replace(_config(spark, "catalog"), **names)
    for layer in ("silver", "gold"):
        create_layer_tables(spark, config, layer)
    _load_silver(spark, sf_dir, config)
    run_daily(spark, config, DayWindow.resolve("20240130", 29), SECOND_DAY)
    return spark.sql(
        f"""SELECT s.transaction_dt, s.bank, s.total_withdrawls, s.total_deposits,
                   (SELECT COUNT(*) FROM {config.silver_schema}.atm_visits) AS visits,
                   (SELECT COUNT(*) FROM {config.silver_schema}.atm_locations) AS atms
            FROM {config.gold_schema}.daily_transaction_summary_by_bank s"""
    )


def stream_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run log says the customer job did."""
    config = _customer_history(spark, sf_dir, "run-log")
    log = history(spark, config, schemas.SILVER_CUSTOMERS)
    sums = [F.sum(c).alias(c) for c in ("input_rows", "inserted", "updated", "closed")]
    return log.groupBy("table_name", "operation").agg(*sums)


def _silver_for_gold(spark: SparkSession, sf_dir: str, name: str) -> JobConfig:
    return _load_silver(spark, sf_dir, _config(spark, name))


def _load_silver(spark: SparkSession, sf_dir: str, config: JobConfig) -> JobConfig:
    _deliver(spark, config, "atm_visits", visits(spark, sf_dir))
    _deliver(spark, config, "atm_locations", locations(spark, sf_dir))
    run_visits(spark, config, SECOND_DAY)
    run_locations(spark, config, SECOND_DAY)
    return config


def stream_end_to_end_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _silver_for_gold(spark, sf_dir, "daily")
    run_daily(spark, config, DayWindow.resolve("20240130", 29), SECOND_DAY)
    return read_table(spark, config, schemas.GOLD_DAILY).drop("create_ts", "update_ts")


def stream_end_to_end_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _silver_for_gold(spark, sf_dir, "monthly")
    run_monthly(spark, config, MonthWindow.resolve("202402", 1), SECOND_DAY)
    return read_table(spark, config, schemas.GOLD_MONTHLY).drop("create_ts", "update_ts")


STREAMS = (
    stream_stage_to_bronze,
    stream_silver_visits,
    stream_silver_locations,
    stream_silver_customers,
    stream_silver_customers_versions,
    late_customer_delivery,
    recovered_publish,
    customer_changes_replayed,
    stream_incremental_daily,
    stream_visits_delivered_again,
    stream_quarantine,
    stream_rescued_fields,
    stream_measured,
    stream_supervised,
    stream_customers_in_growing_buckets,
    replayed_visits_batch,
    catalog_daily_by_bank,
    stream_run_log,
    stream_end_to_end_daily,
    stream_end_to_end_monthly,
)
