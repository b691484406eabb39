"""Batch queries: each runs library operators over whole driver tables.

Clocks are fixed. Stamps are zone-less literals, so results do not depend on
the session time zone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerline import plans, schemas
from tellerline.functions.columns import split_amounts, stamped
from tellerline.operators import (
    changed_current,
    conform,
    dedupe_earliest,
    dedupe_latest,
    groups_that_may_hold,
    insert_if_absent,
    key_fragments,
    scd2_apply,
    scd2_staged,
    upsert_if_changed,
    upsert_latest,
    version_chain,
)
from tellerline.operators.merge import ACTION, INSERT
from tellerline.params import DayWindow, MonthWindow, Stamp
from tellerline.plans import daily_by_atm, daily_by_bank, monthly_by_customer, with_bank
from tellerline.plans.daily import TOTALS
from tellerline.registry import streams
from tellerline.registry.shapes import (
    FIRST_FEED,
    SECOND_FEED,
    customer_deliveries,
    customers,
    dated,
    locations,
    moved_locations,
    visits,
    visits_long,
)
from tellerline.streaming import prepare_locations, prepare_visits

TRACKED = schemas.TRACKED_CUSTOMER_COLUMNS

# The whole month of visits, the default lookback, and the whole of the long visits.
ALL_DAYS = DayWindow.resolve("20240130", 29)
DEFAULT_DAYS = DayWindow.resolve("20240120")
ALL_MONTHS = MonthWindow.resolve("200109", 80)
SIX_MONTHS = MonthWindow.resolve("199507", 6)
NOON = Stamp.at(dt.datetime(2024, 2, 1, 12))


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _flat_locations(spark: SparkSession, sf_dir: str, factor: int = 1) -> DataFrame:
    return conform(prepare_locations(locations(spark, sf_dir, factor), NOON), schemas.SILVER_LOCATIONS.schema)


# --- silver -----------------------------------------------------------------


def silver_visits_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conform(prepare_visits(visits(spark, sf_dir), NOON), schemas.SILVER_VISITS.schema)
    return rows.drop("load_ts").withColumn("transaction_ts", F.col("transaction_ts").cast("timestamp_ntz"))


def silver_locations_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_locations(spark, sf_dir)


def _visit_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return dated(visits(spark, sf_dir, FIRST_FEED)), dated(visits(spark, sf_dir, SECOND_FEED))


def silver_visits_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = _visit_feeds(spark, sf_dir)
    return target.unionByName(insert_if_absent(target, updates, ["visit_id"]))


def visits_held_by_key_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored visits that a batch delivers again: looked for on the dates whose key bitmaps allow it."""
    target, updates = _visit_feeds(spark, sf_dir)
    fragments = key_fragments(target, "visit_id", "transaction_dt")
    dates = groups_that_may_hold(fragments, updates, "visit_id", "transaction_dt")
    probed = target.select("visit_id", "transaction_dt").join(dates, "transaction_dt", "left_semi")
    return probed.join(updates.select("visit_id"), "visit_id", "left_semi").select("visit_id", "transaction_dt")


def _type1(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _flat_locations(spark, sf_dir, FIRST_FEED)
    updates = stamped(_flat_locations(spark, sf_dir, SECOND_FEED), F.lit("2024-02-02").cast("date"), "load_ts")
    return upsert_latest(target, updates, ["atm_id"], labelled=True)


def silver_locations_type1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _type1(spark, sf_dir).drop(ACTION)


def _customer_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A stored history (an open and a closed version per key) and a batch."""
    first = stamped(customers(spark, sf_dir, FIRST_FEED), _ts("2024-01-01 08:00:00"), "load_ts", "update_ts")

    def version(rows: DataFrame, current: bool, effective: str, end: str | None) -> DataFrame:
        return rows.withColumns(
            {
                "current": F.lit(current),
                "effective_date": F.lit(effective).cast("date"),
                "end_date": F.lit(end).cast("date"),
            }
        )

    opened = version(first, True, "2024-01-01", None)
    closed = version(first.withColumn("first_name", F.lit("EARLIER")), False, "2022-06-30", "2024-01-01")
    second = customers(spark, sf_dir, SECOND_FEED)
    return opened.unionByName(closed), stamped(second, _ts("2024-02-01 12:00:00"), "load_ts", "update_ts")


def _type2(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    target, updates = _customer_feeds(spark, sf_dir)
    today = F.lit("2024-02-01").cast("date")
    return scd2_apply(target, updates, "customer_id", TRACKED, today, **options)


def silver_customers_type2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _type2(spark, sf_dir)


def silver_customers_type2_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _type2(spark, sf_dir, null_safe=False)


def silver_customers_type2_since_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _type2(spark, sf_dir, first_effective="customer_since_date")


def silver_customers_staged_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_staged(*_customer_feeds(spark, sf_dir), "customer_id", TRACKED)


def changed_current_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_current(*_customer_feeds(spark, sf_dir), "customer_id", TRACKED)


def changed_current_customers_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_current(*_customer_feeds(spark, sf_dir), "customer_id", TRACKED, null_safe=False)


def scd2_multi_version_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of one batch that holds three deliveries of every customer."""
    numbered = [rows.withColumn("delivery", F.lit(i)) for i, rows in enumerate(customer_deliveries(spark, sf_dir))]
    batch = numbered[0].unionByName(numbered[1]).unionByName(numbered[2])
    return version_chain(batch, "customer_id", ["delivery"], TRACKED)


def dedupe_earliest_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_earliest(visits(spark, sf_dir), ["customer_id"], ["transaction_ts", "visit_id"])


def dedupe_latest_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_latest(visits(spark, sf_dir), ["customer_id"], ["transaction_ts", "visit_id"])


# --- windows, projections, joins ----------------------------------------------


def visits_in_day_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(visits(spark, sf_dir)).where(DEFAULT_DAYS.contains(F.col("transaction_dt")))


def visits_in_month_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dated(visits_long(spark, sf_dir)).where(SIX_MONTHS.contains(F.col("transaction_dt")))


def visit_amount_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_amounts(visits(spark, sf_dir)).select("visit_id", "withdrawl_amt", "deposit_amt")


def distinct_atm_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.distinct_atm_bank(locations(spark, sf_dir))


def visits_with_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = visits(spark, sf_dir).select("visit_id", "atm_id", "amount")
    return with_bank(rows, locations(spark, sf_dir))


# --- gold -------------------------------------------------------------------


def gold_daily_by_atm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_by_atm(dated(visits(spark, sf_dir)), ALL_DAYS)


def _by_bank(spark: SparkSession, sf_dir: str, window: DayWindow, literal: bool = False) -> DataFrame:
    return daily_by_bank(dated(visits(spark, sf_dir)), locations(spark, sf_dir), window, literal)


def gold_daily_by_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_bank(spark, sf_dir, ALL_DAYS)


def gold_daily_by_bank_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_bank(spark, sf_dir, ALL_DAYS, literal=True)


def gold_daily_by_bank_default_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_bank(spark, sf_dir, DEFAULT_DAYS)


def gold_daily_by_bank_current_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchored at today, looking back far enough to see all days."""
    return _by_bank(spark, sf_dir, DayWindow.resolve(lookback_days=20_000))


def gold_daily_by_two_banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some ATMs are listed under their old bank and their new one, and count for both."""
    listed_twice = locations(spark, sf_dir).unionByName(moved_locations(spark, sf_dir))
    return daily_by_bank(dated(visits(spark, sf_dir)), listed_twice, ALL_DAYS)


def gold_monthly_by_customer_last_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months up to the last one, looking back far enough to see all."""
    return monthly_by_customer(dated(visits_long(spark, sf_dir)), MonthWindow.resolve(lookback_months=600))


def _daily_upsert(spark: SparkSession, sf_dir: str, literal: bool) -> DataFrame:
    """Stored on the 25th at noon, recomputed on the 30th for the last 15 days:
    the first days are kept, the 25th changes, the days after it are new.
    """
    rows, atms = dated(visits(spark, sf_dir)), locations(spark, sf_dir)
    early = rows.where(F.col("transaction_ts") < _ts("2024-01-25 12:00:00"))
    stored = daily_by_bank(early, atms, DayWindow.resolve("20240125", 24))
    staged = daily_by_bank(rows, atms, DayWindow.resolve("20240130", 14))
    return upsert_if_changed(
        stamped(stored, _ts("2024-01-25 12:00:00"), "create_ts", "update_ts"),
        stamped(staged, _ts("2024-01-31 06:00:00"), "create_ts", "update_ts"),
        schemas.GOLD_DAILY.keys,
        TOTALS,
        literal=literal,
        labelled=True,
    )


def gold_daily_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_upsert(spark, sf_dir, literal=False).drop(ACTION)


def gold_daily_upsert_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_upsert(spark, sf_dir, literal=True).drop(ACTION)


def _moved_bank(spark: SparkSession, sf_dir: str, literal: bool) -> DataFrame:
    """Recomputed after some banks have no ATM left: their stored totals go, unless literal."""
    rows = dated(visits(spark, sf_dir))
    stored = daily_by_bank(rows, locations(spark, sf_dir), ALL_DAYS)
    staged = daily_by_bank(rows, moved_locations(spark, sf_dir), ALL_DAYS)
    return upsert_if_changed(
        stamped(stored, _ts("2024-01-31 06:00:00"), "create_ts", "update_ts"),
        stamped(staged, _ts("2024-02-01 06:00:00"), "create_ts", "update_ts"),
        schemas.GOLD_DAILY.keys,
        TOTALS,
        literal=literal,
        drop_vanished=True,
    )


def gold_daily_upsert_moved_bank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moved_bank(spark, sf_dir, literal=False)


def gold_daily_upsert_moved_bank_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moved_bank(spark, sf_dir, literal=True)


def gold_monthly_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_by_customer(dated(visits_long(spark, sf_dir)), ALL_MONTHS)


def gold_monthly_by_customer_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_by_customer(dated(visits_long(spark, sf_dir)), ALL_MONTHS, literal=True)


def _monthly_upsert(spark: SparkSession, sf_dir: str, literal: bool) -> DataFrame:
    """Stored in the middle of June 2000, recomputed for the last 24 months."""
    rows = dated(visits_long(spark, sf_dir))
    early = rows.where(F.col("transaction_ts") < _ts("2000-06-15 00:00:00"))
    stored = monthly_by_customer(early, MonthWindow.resolve("200007", 66))
    staged = monthly_by_customer(rows, MonthWindow.resolve("200109", 24))
    return upsert_if_changed(
        stamped(stored, _ts("2000-06-15 00:00:00"), "create_ts", "update_ts"),
        stamped(staged, _ts("2001-09-01 06:00:00"), "create_ts", "update_ts"),
        schemas.GOLD_MONTHLY.keys,
        TOTALS,
        nullable_keys=("customer_id",),
        literal=literal,
        labelled=True,
    )


def gold_monthly_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly_upsert(spark, sf_dir, literal=False).drop(ACTION)


def gold_monthly_upsert_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly_upsert(spark, sf_dir, literal=True).drop(ACTION)


def merge_action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each merge inserts, updates, closes and keeps."""
    new_visits = insert_if_absent(*_visit_feeds(spark, sf_dir), ["visit_id"]).withColumn(ACTION, F.lit(INSERT))
    labelled = {
        "insert_if_absent": new_visits,
        "upsert_latest": _type1(spark, sf_dir),
        "scd2_apply": _type2(spark, sf_dir, labelled=True),
        "upsert_if_changed": _daily_upsert(spark, sf_dir, literal=False),
    }
    counts = None
    for operation, rows in labelled.items():
        part = rows.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("row_count"))
        part = part.select(F.lit(operation).alias("operation"), "action", "row_count")
        counts = part if counts is None else counts.unionByName(part)
    return counts


_BATCH = (
    silver_visits_prepare,
    silver_locations_flatten,
    silver_visits_insert_only,
    visits_held_by_key_filter,
    silver_locations_type1,
    silver_customers_type2,
    silver_customers_type2_literal,
    silver_customers_type2_since_date,
    silver_customers_staged_updates,
    changed_current_customers,
    changed_current_customers_literal,
    scd2_multi_version_batch,
    dedupe_earliest_visits,
    dedupe_latest_visits,
    visits_in_day_window,
    visits_in_month_window,
    visit_amount_split,
    distinct_atm_bank,
    visits_with_bank,
    gold_daily_by_atm,
    gold_daily_by_bank,
    gold_daily_by_bank_literal,
    gold_daily_by_bank_default_window,
    gold_daily_by_bank_current_date,
    gold_daily_by_two_banks,
    gold_monthly_by_customer_last_month,
    gold_daily_upsert,
    gold_daily_upsert_literal,
    gold_daily_upsert_moved_bank,
    gold_daily_upsert_moved_bank_literal,
    gold_monthly_by_customer,
    gold_monthly_by_customer_literal,
    gold_monthly_upsert,
    gold_monthly_upsert_literal,
    merge_action_counts,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (*_BATCH, *streams.STREAMS)
}
