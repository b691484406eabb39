"""Monthly withdrawal and deposit totals by customer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerline import schemas
from tellerline.functions.columns import split_amounts, stamped
from tellerline.operators.conform import conform
from tellerline.operators.merge import upsert_if_changed
from tellerline.params import JobConfig, MonthWindow, Stamp
from tellerline.plans.daily import TOTALS, totals
from tellerline.sources.audit import record_run
from tellerline.session import require_time_zone
from tellerline.sources.publish import consistent, publish_labelled, recover
from tellerline.sources.tables import read_partitions, refresh_registered


def month_key(day: Column, literal: bool = False) -> Column:
    """``yyyyMM`` as an INT; ``literal=True`` is the month number alone."""
    if literal:
        return F.month(day)
    return F.year(day) * 100 + F.month(day)


def monthly_by_customer(visits: DataFrame, window: MonthWindow, literal: bool = False) -> DataFrame:
    day = F.col("transaction_dt")
    keyed = visits.where(window.contains(day)).withColumn("transaction_month", month_key(day, literal))
    return split_amounts(keyed).groupBy("transaction_month", "customer_id").agg(*totals(literal))


def run_monthly(
    spark: SparkSession,
    config: JobConfig,
    window: MonthWindow | None = None,
    as_of: dt.datetime | None = None,
    literal: bool = False,
) -> dict[str, int]:
    """Recompute the window and store what changed, as ``run_daily`` does; returns rows per action."""
    require_time_zone(spark, config.time_zone)
    window = window or MonthWindow.resolve(zone=config.time_zone)
    spec = schemas.GOLD_MONTHLY
    recover(spark, config, spec)
    months = [f"{m:%Y-%m}-*" for m in window.months]
    source = schemas.SILVER_VISITS
    visits = consistent(spark, config, (source,), lambda: read_partitions(spark, config, source, months))
    summary = monthly_by_customer(visits, window, literal)
    stamp = Stamp.at(as_of)
    updates = conform(stamped(summary, stamp.ts, "create_ts", "update_ts"), spec.schema)
    stored = read_partitions(spark, config, spec, map(str, window_months(window, literal)))
    merged = upsert_if_changed(
        stored, updates, spec.keys, TOTALS, nullable_keys=("customer_id",), literal=literal, labelled=True, drop_vanished=True
    )
    counts = publish_labelled(spark, config, spec, merged, stored, stamp)
    record_run(spark, config, spec, "upsert_if_changed", counts)
    refresh_registered(spark, config, spec)
    return counts


def window_months(window: MonthWindow, literal: bool = False) -> list[int]:
    """The partitions of the stored summary that the window can touch."""
    return sorted({m.month if literal else m.year * 100 + m.month for m in window.months})
