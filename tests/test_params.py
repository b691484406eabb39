import datetime as dt

import pytest
from pyspark.sql import functions as F

from tellerline.params import DayWindow, JobConfig, MonthWindow, Stamp, TriggerMode, today_in
from tellerline.plans.monthly import month_key, window_months
from tellerline.session import scratch_dir

D = dt.date


def kept(spark, days, window):
    rows = spark.createDataFrame([(d,) for d in days], "d date").where(window.contains(F.col("d")))
    return sorted(r.d for r in rows.collect())


def test_day_window_includes_both_ends(spark):
    window = DayWindow.resolve("20240120")
    edges = [D(2024, 1, 16), D(2024, 1, 17), D(2024, 1, 20), D(2024, 1, 21)]
    assert kept(spark, edges, window) == [D(2024, 1, 17), D(2024, 1, 20)]


@pytest.mark.parametrize("text", ["", "CURRENT_DATE"])
def test_day_window_defaults_to_today(text):
    window = DayWindow.resolve(text, today=D(2024, 3, 1))
    assert (window.first, window.anchor) == (D(2024, 2, 27), D(2024, 3, 1))


@pytest.mark.parametrize("text", ["2024012", "202401200", "2024-1-2", "20241301", "today"])
def test_day_window_rejects_other_text(text):
    with pytest.raises(ValueError):
        DayWindow.resolve(text)


def test_month_window_excludes_the_anchor_month(spark):
    days = [D(2023, 11, 30), D(2023, 12, 1), D(2023, 12, 31), D(2024, 1, 1)]
    assert kept(spark, days, MonthWindow.resolve("202401")) == [D(2023, 12, 1), D(2023, 12, 31)]
    assert kept(spark, days, MonthWindow.resolve("202401", 0)) == []


def test_month_window_last_month_is_relative_to_today():
    window = MonthWindow.resolve("LAST_MONTH", today=D(2024, 3, 31))
    assert (window.first, window.end) == (D(2024, 2, 1), D(2024, 3, 1))


def test_month_window_equals_the_year_month_comparison(spark):
    """The date range must keep what comparing ``yyyyMM`` numbers keeps."""
    day = F.date_add(F.lit("2022-11-15").cast("date"), F.col("id").cast("int"))
    number = F.date_format("d", "yyyyMM").cast("int")
    differing = []
    for anchor in (D(2023, 1, 1), D(2023, 3, 31), D(2024, 2, 29), D(2024, 12, 31)):
        for months in (0, 1, 2, 13):
            low, high = (F.add_months(F.lit(anchor), -n) for n in (months, 1))
            compared = number.between(F.date_format(low, "yyyyMM").cast("int"), F.date_format(high, "yyyyMM").cast("int"))
            differing.append(F.count_if(compared != MonthWindow(anchor, months).contains(F.col("d"))))
    counts = spark.range(0, 800).select(day.alias("d")).agg(*differing).first()
    assert set(counts) == {0}


def test_window_months_lists_the_partitions():
    window = MonthWindow.resolve("202402", 4)
    assert window_months(window) == [202310, 202311, 202312, 202401]
    assert window_months(window, literal=True) == [1, 10, 11, 12]
    assert window_months(MonthWindow.resolve("202402", 0)) == []


def test_month_key(spark):
    row = spark.sql("SELECT DATE '2024-03-05' AS d").select(month_key(F.col("d")), month_key(F.col("d"), True)).first()
    assert tuple(row) == (202403, 3)


def test_trigger_modes():
    assert TriggerMode("Batch").options == {"availableNow": True}
    assert TriggerMode("Streaming").options == {"processingTime": "15 seconds"}
    with pytest.raises(ValueError):
        TriggerMode("Hourly")


def test_stamp_is_one_instant(spark):
    stamp = Stamp.at(dt.datetime(2024, 1, 5, 23, 30, 0, 123456))
    row = spark.range(1).select(stamp.ts.cast("string").alias("ts"), stamp.day.alias("day")).first()
    assert (row.ts, row.day) == ("2024-01-05 23:30:00.123456", D(2024, 1, 5))


def test_config_defaults():
    config = JobConfig.under("/data")
    assert config.max_files_per_trigger == 20
    assert config.layer_root("silver") == "/data/silver"
    assert config.trigger_mode is TriggerMode.BATCH


class _Session:
    """Just what ``scratch_dir`` asks of a session."""

    def __init__(self, master, settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = settings


def test_scratch_goes_to_the_shared_folder():
    shared = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/"})
    assert scratch_dir(shared, "x").startswith("hdfs:///shared/x-")
    for master in ("local[2]", "yarn"):
        unset = _Session(master, {"spark.sql.warehouse.dir": "/house"})
        assert scratch_dir(unset, "x").startswith("/house/_scratch/x-")
        assert scratch_dir(unset, "x") != scratch_dir(unset, "x")


def test_today_is_that_of_the_zone():
    east, west = today_in("Pacific/Kiritimati"), today_in("Pacific/Pago_Pago")
    assert (east - west).days == 1
    assert DayWindow.resolve(zone="Pacific/Kiritimati").anchor in (east, today_in("Pacific/Kiritimati"))
    assert MonthWindow.resolve(zone="Pacific/Pago_Pago").anchor in (west, today_in("Pacific/Pago_Pago"))

