"""Daily withdrawal and deposit totals by bank."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerline import schemas
from tellerline.functions.columns import bank_or_unknown, split_amounts, stamped
from tellerline.operators.conform import conform
from tellerline.operators.merge import upsert_if_changed
from tellerline.params import DayWindow, JobConfig, Stamp
from tellerline.sources.audit import record_run
from tellerline.session import require_time_zone
from tellerline.sources.publish import consistent, publish_labelled, recover
from tellerline.sources.tables import read_partitions, read_table, refresh_registered

TOTALS = ("total_withdrawls", "total_deposits")


def totals(literal: bool = False):
    """Sums of the split amounts; a group without such rows has a NULL total.

    ``literal=True`` reports the withdrawals in both columns.
    """
    deposits = "withdrawl_amt" if literal else "deposit_amt"
    return F.sum("withdrawl_amt").alias(TOTALS[0]), F.sum(deposits).alias(TOTALS[1])


def daily_by_atm(visits: DataFrame, window: DayWindow, literal: bool = False) -> DataFrame:
    in_window = visits.where(window.contains(F.col("transaction_dt")))
    return split_amounts(in_window).groupBy("transaction_dt", "atm_id").agg(*totals(literal))


def distinct_atm_bank(locations: DataFrame) -> DataFrame:
    return locations.select("atm_id", "bank").distinct()


def with_bank(rows: DataFrame, locations: DataFrame) -> DataFrame:
    """Each row with the bank of its ATM, ``UNKNOWN`` where there is none.

    An ATM listed under two banks yields one row for each.
    """
    banks = distinct_atm_bank(locations)
    return rows.join(banks, "atm_id", "left").withColumn("bank", bank_or_unknown(F.col("bank")))


def daily_by_bank(
    visits: DataFrame, locations: DataFrame, window: DayWindow, literal: bool = False
) -> DataFrame:
    """Totals by ATM first, so the join sees one row per day and ATM."""
    by_atm = with_bank(daily_by_atm(visits, window, literal), locations)
    sums = [F.sum(c).alias(c) for c in TOTALS]
    return by_atm.groupBy("transaction_dt", "bank").agg(*sums)


def run_daily(
    spark: SparkSession,
    config: JobConfig,
    window: DayWindow | None = None,
    as_of: dt.datetime | None = None,
    literal: bool = False,
) -> dict[str, int]:
    """Recompute the window and store what changed; returns rows per action.

    Groups that the recomputed window no longer has are removed, unless ``literal``.

    The date is part of the key, so reading only the window's partitions of the
    stored summary is exact.
    """
    require_time_zone(spark, config.time_zone)
    window = window or DayWindow.resolve(zone=config.time_zone)
    spec = schemas.GOLD_DAILY
    recover(spark, config, spec)

    def sources() -> tuple[DataFrame, DataFrame]:
        visits = read_partitions(spark, config, schemas.SILVER_VISITS, window.days)
        return visits, read_table(spark, config, schemas.SILVER_LOCATIONS)

    visits, locations = consistent(spark, config, (schemas.SILVER_VISITS, schemas.SILVER_LOCATIONS), sources)
    summary = daily_by_bank(visits, locations, window, literal)
    stamp = Stamp.at(as_of)
    updates = conform(stamped(summary, stamp.ts, "create_ts", "update_ts"), spec.schema)
    stored = read_partitions(spark, config, spec, window.days)
    merged = upsert_if_changed(stored, updates, spec.keys, TOTALS, literal=literal, labelled=True, drop_vanished=True)
    counts = publish_labelled(spark, config, spec, merged, stored, stamp)
    record_run(spark, config, spec, "upsert_if_changed", counts)
    refresh_registered(spark, config, spec)
    return counts
