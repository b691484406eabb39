import datetime as dt

from pyspark.sql import functions as F

from tellerline.params import DayWindow, MonthWindow
from tellerline.plans import daily_by_bank, monthly_by_customer

VISITS = "transaction_dt string, atm_id long, customer_id long, withdrawl_or_deposit string, amount long"
DAY = dt.date(2024, 1, 20)


def visits(spark, *rows):
    return spark.createDataFrame(list(rows), VISITS).withColumn("transaction_dt", F.col("transaction_dt").cast("date"))


def atms(spark, *rows):
    return spark.createDataFrame(list(rows), "atm_id long, bank string")


def by_bank(spark, rows, locations, **options):
    result = daily_by_bank(visits(spark, *rows), atms(spark, *locations), DayWindow(DAY), **options)
    return {(str(r.transaction_dt), r.bank): (r.total_withdrawls, r.total_deposits) for r in result.collect()}


def test_tags_split_and_others_count_in_neither(spark):
    rows = [("2024-01-20", 1, 1, tag, 5) for tag in ("withdrawl", "deposit", "inquiry", "Withdrawl", None)]
    assert by_bank(spark, rows, [(1, "n")]) == {("2024-01-20", "n"): (5, 5)}


def test_only_deposits_leave_withdrawals_null(spark):
    rows = [("2024-01-20", 1, 1, "deposit", 5)]
    assert by_bank(spark, rows, [(1, "n")]) == {("2024-01-20", "n"): (None, 5)}
    assert by_bank(spark, rows, [(1, "n")], literal=True) == {("2024-01-20", "n"): (None, None)}


def test_literal_reports_withdrawals_twice(spark):
    rows = [("2024-01-20", 1, 1, "withdrawl", 7), ("2024-01-20", 1, 1, "deposit", 5)]
    assert by_bank(spark, rows, [(1, "n")], literal=True) == {("2024-01-20", "n"): (7, 7)}


def test_unknown_and_missing_atm(spark):
    rows = [("2024-01-20", 9, 1, "withdrawl", 7), ("2024-01-20", None, 1, "withdrawl", 1), ("2024-01-20", 1, 1, "deposit", 2)]
    assert by_bank(spark, rows, [(1, None)]) == {("2024-01-20", "UNKNOWN"): (8, 2)}


def test_atm_of_two_banks_counts_for_both(spark):
    rows = [("2024-01-20", 1, 1, "withdrawl", 7)]
    assert by_bank(spark, rows, [(1, "n"), (1, "s"), (1, "s")]) == {
        ("2024-01-20", "n"): (7, None),
        ("2024-01-20", "s"): (7, None),
    }


def test_window_edges(spark):
    days = ("2024-01-16", "2024-01-17", "2024-01-20", "2024-01-21")
    result = by_bank(spark, [(d, 1, 1, "withdrawl", 1) for d in days], [(1, "n")])
    assert {day for day, _ in result} == {"2024-01-17", "2024-01-20"}


def test_two_years_do_not_share_a_month_unless_literal(spark):
    rows = visits(spark, ("2023-03-05", 1, 1, "withdrawl", 1), ("2024-03-05", 1, 1, "deposit", 2))
    window = MonthWindow.resolve("202405", 24)

    def months(literal):
        result = monthly_by_customer(rows, window, literal)
        return {(r.transaction_month, r.customer_id): (r.total_withdrawls, r.total_deposits) for r in result.collect()}

    assert months(False) == {(202303, 1): (1, None), (202403, 1): (None, 2)}
    assert months(True) == {(3, 1): (1, 1)}
