"""ATM-shaped views of the driver tables, always over the whole table.

A merge needs keys that only the target holds, that only the batch holds and
that both hold. Two *feeds* of the same table provide them at any scale: the
first multiplies the keys by 2, the second by 3, so multiples of 6 meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_FEED, SECOND_FEED = 2, 3

# Declared, so that no job has to open files just to infer a schema.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _tag(column: str, withdrawal: str, deposit: str) -> str:
    return f"CASE {column} WHEN '{withdrawal}' THEN 'withdrawl' WHEN '{deposit}' THEN 'deposit' ELSE 'inquiry' END"


def visits(spark: SparkSession, sf_dir: str, factor: int = 1) -> DataFrame:
    """Visits of one month, one per event. A user's id is also their ATM's id:
    a third of the users have an id above the last ATM's, whose bank is unknown.
    """
    return table(spark, sf_dir, "events").selectExpr(
        f"event_id * {factor} AS visit_id",
        "user_id AS customer_id",
        "user_id AS atm_id",
        f"{_tag('event_type', 'purchase', 'signup')} AS withdrawl_or_deposit",
        "CAST(round(value * 100) AS BIGINT) AS amount",
        "IF(event_type = 'error', 'Y', 'N') AS fraud_report",
        "ts AS transaction_ts",
        "to_date(ts) AS date",
    )


def visits_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits over several years, one per order."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS visit_id",
        "o_custkey AS customer_id",
        "o_custkey AS atm_id",
        f"{_tag('o_orderstatus', 'F', 'O')} AS withdrawl_or_deposit",
        "CAST(round(o_totalprice * 100) AS BIGINT) AS amount",
        "IF(o_orderpriority = '1-URGENT', 'Y', 'N') AS fraud_report",
        "o_orderdate AS transaction_ts",
        "to_date(o_orderdate) AS date",
    )


def dated(rows: DataFrame) -> DataFrame:
    """Visits with the silver date column."""
    return rows.withColumnRenamed("date", "transaction_dt")


def locations(spark: SparkSession, sf_dir: str, factor: int = 1) -> DataFrame:
    """ATMs with their address as a struct, as staged files hold it."""
    nation = table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.selectExpr(
        f"s_suppkey * {factor} AS atm_id",
        "struct(s_name AS city, n_name AS state, CAST(s_nationkey AS STRING) AS zip) AS city_state_zip",
        "IF(s_acctbal > 0, 'yes', 'no') AS pos_capability",
        "IF(s_nationkey < 13, 'onsite', 'offsite') AS offsite_or_onsite",
        "n_name AS bank",
    )


def customer_deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three deliveries of every customer: some change and change back, some change once, some never."""
    rows = customers(spark, sf_dir)
    third_part = F.col("customer_id") % 3
    second = rows.withColumn("first_name", F.when(third_part == 0, F.col("first_name")).otherwise(F.lit("MOVED")))
    third = rows.withColumn("first_name", F.when(third_part == 1, F.lit("MOVED")).otherwise(F.col("first_name")))
    return [rows, second, third]


def moved_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ATMs after some banks have given theirs away."""
    bank = F.when(F.col("city_state_zip.zip").cast("int") < 5, F.lit("MERGED")).otherwise(F.col("bank"))
    return locations(spark, sf_dir).withColumn("bank", bank)


def customers(spark: SparkSession, sf_dir: str, factor: int = 1) -> DataFrame:
    """Card and last name follow from the id, so between two feeds only
    ``first_name`` and ``preferred`` (sometimes NULL) tell whether a row changed.
    """
    key = f"c_custkey * {factor}"
    return table(spark, sf_dir, "customer").selectExpr(
        f"{key} AS customer_id",
        f"{key} * 7 + 1000 AS card_number",
        "IF(c_acctbal < 5000, 'checking', 'savings') AS checking_savings",
        "c_mktsegment AS first_name",
        f"concat('Customer ', {key}) AS last_name",
        "date_add(DATE '2020-01-01', c_nationkey) AS customer_since_date",
        "CASE WHEN c_acctbal >= 0 THEN IF(c_nationkey < 13, 1, 0) END AS preferred",
    )
