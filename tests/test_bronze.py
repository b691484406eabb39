import datetime as dt
import time

import pytest
from helpers import config, ingest, location, stage, table_rows, visit
from pyspark.sql import functions as F

from tellerline import schemas
from tellerline.params import TriggerMode
from tellerline.sources import history, read_staged, read_table
from tellerline.sources.tables import read_physical
from tellerline.streaming.bronze import bronze_spec, progress, quarantine_path, rescued_spec
from tellerline.streaming.metrics import COUNTS, stream_metrics

BROKEN = ["{broken", '{"atm_id":"oops"}']


def test_unknown_folder(spark, root):
    with pytest.raises(ValueError, match="atm_moods"):
        read_staged(spark, root, "atm_moods")


def test_rows_keep_their_declared_types(spark, root):
    cfg = config(root)
    stage(cfg, "atm_visits", "1", [{**visit(1, time="23:30:00"), "undeclared": 1}])
    ingest(spark, cfg, "atm_visits")
    row = read_table(spark, cfg, schemas.BRONZE_VISITS).first()
    assert (row.visit_id, row.date, row.transaction_ts) == (1, dt.date(2024, 1, 5), dt.datetime(2024, 1, 5, 23, 30))
    assert row._ingest_file.endswith("1.json") and row._ingest_ts is not None
    assert "undeclared" not in row


def test_malformed_lines_are_null_rows(spark, root):
    cfg = config(root)
    stage(cfg, "atm_locations", "1", [*BROKEN, location(1), {"atm_id": 2}])
    ingest(spark, cfg, "atm_locations")
    assert table_rows(spark, cfg, schemas.BRONZE_LOCATIONS, "atm_id") == {(1,): 1, (2,): 1, (None,): 2}


def test_quarantine_splits_malformed_lines_off(spark, root):
    cfg = config(root)
    stage(cfg, "atm_locations", "1", [*BROKEN, location(1)])
    for _ in range(2):
        ingest(spark, cfg, "atm_locations", quarantine=True)
    assert table_rows(spark, cfg, schemas.BRONZE_LOCATIONS, "atm_id") == {(1,): 1}
    rejected = spark.read.parquet(quarantine_path(cfg, "atm_locations")).select("_corrupt_record").collect()
    assert sorted(r[0] for r in rejected) == sorted(BROKEN)


def test_files_are_read_once_and_in_limited_batches(spark, root):
    cfg = config(root, max_files_per_trigger=2)
    for i in range(5):
        stage(cfg, "atm_visits", str(i), [visit(i)])
    (query,) = ingest(spark, cfg, "atm_visits")
    assert sum(1 for p in query.recentProgress if p["numInputRows"]) == 3
    assert progress(query)["last_progress"] is not None
    ingest(spark, cfg, "atm_visits")
    assert table_rows(spark, cfg, schemas.BRONZE_VISITS, "visit_id") == {(i,): 1 for i in range(5)}
    log = history(spark, cfg, schemas.BRONZE_VISITS).select("operation", "batch_id", "inserted").collect()
    assert [tuple(r) for r in log] == [("append", 2, 5)]


def test_streaming_mode_polls_until_the_timeout(spark, root):
    cfg = config(root, trigger_mode=TriggerMode.STREAMING)
    stage(cfg, "atm_visits", "1", [visit(1)])
    (query,) = ingest(spark, cfg, "atm_visits", timeout=3)
    try:
        assert query.isActive
        query.processAllAvailable()
    finally:
        query.stop()
    assert table_rows(spark, cfg, schemas.BRONZE_VISITS, "visit_id") == {(1,): 1}


def test_bronze_table_of_another_name(spark, root):
    cfg = config(root)
    stage(cfg, "atm_visits", "1", [visit(1)])
    ingest(spark, cfg, "atm_visits", table="visits_raw")
    assert table_rows(spark, cfg, bronze_spec("atm_visits", "visits_raw"), "visit_id") == {(1,): 1}
    assert table_rows(spark, cfg, schemas.BRONZE_VISITS) == {}


def _rescued(spark, cfg, folder):
    rows = read_physical(spark, cfg, rescued_spec(bronze_spec(folder)))
    return rows.withColumn("kept", F.to_json("_rescued"))


def test_rescue_keeps_undeclared_and_wrongly_typed_fields(spark, root):
    cfg = config(root)
    lines = [
        visit(1),
        {**visit(2), "amount": "12 USD", "channel": {"app": [1, None]}},
        {**visit(3), "amount": 12.5, "fraud_report": 7, "customer_id": None},
        '{"visit_id": 4, "date": "2024-01-05", "x": 1, "x": 2}',
        "",
        "[1]",
        "{broken",
    ]
    stage(cfg, "atm_visits", "1", lines)
    ingest(spark, cfg, "atm_visits", rescue=True)
    found = {(r.visit_id, r.amount, r.fraud_report, r.kept) for r in _rescued(spark, cfg, "atm_visits").collect()}
    assert found == {
        (1, 10, "N", None),
        (2, None, "N", '{"amount":"12 USD","channel":{"app":[1,null]}}'),
        (3, None, "7", '{"amount":12.5}'),
        (4, None, None, '"{\\"visit_id\\": 4, \\"date\\": \\"2024-01-05\\", \\"x\\": 1, \\"x\\": 2}"'),
        (None, None, None, '"[1]"'),
        (None, None, None, '"{broken"'),
    }
    assert table_rows(spark, cfg, schemas.BRONZE_VISITS, "visit_id") == {(1,): 1, (2,): 1, (3,): 1, (4,): 1, (None,): 2}


def test_rescue_looks_into_structs_and_leaves_malformed_lines_to_quarantine(spark, root):
    cfg = config(root)
    place = {"city": "c", "state": "s", "zip": "z", "country": "n"}
    lines = [location(1), location(2, city_state_zip=place), location(3, city_state_zip="flat"), location(4, city_state_zip=None), *BROKEN]
    stage(cfg, "atm_locations", "1", lines)
    ingest(spark, cfg, "atm_locations", rescue=True, quarantine=True)
    found = {(r.atm_id, r.city_state_zip and r.city_state_zip.city, r.kept) for r in _rescued(spark, cfg, "atm_locations").collect()}
    assert found == {
        (1, "c", None),
        (2, "c", '{"city_state_zip":{"city":"c","country":"n","state":"s","zip":"z"}}'),
        (3, None, '{"city_state_zip":"flat"}'),
        (4, None, None),
        (None, None, '{"atm_id":"oops"}'),
    }
    rejected = spark.read.parquet(quarantine_path(cfg, "atm_locations")).select("_corrupt_record").collect()
    assert [r[0] for r in rejected] == ["{broken"]


def test_rescue_may_start_later(spark, root):
    cfg = config(root)
    stage(cfg, "atm_locations", "1", [{**location(1), "new": 1}])
    ingest(spark, cfg, "atm_locations")
    stage(cfg, "atm_locations", "2", [{**location(2), "new": 2}])
    ingest(spark, cfg, "atm_locations", rescue=True)
    assert {(r.atm_id, r.kept) for r in _rescued(spark, cfg, "atm_locations").collect()} == {(1, None), (2, '{"new":2}')}


@pytest.mark.parametrize("quarantine", [False, True])
def test_measured_run_counts_its_rows_and_leaves_no_listener(spark, root, quarantine):
    cfg = config(root)
    stage(cfg, "atm_visits", "1", [visit(1), visit(None), "{broken", visit(2, day="2024-01-02")])
    before = spark._jsparkSession.streams().listListeners()
    ingest(spark, cfg, "atm_visits", measure=True, late_before=dt.date(2024, 1, 4), quarantine=quarantine)
    stage(cfg, "atm_visits", "2", [visit(3)])
    ingest(spark, cfg, "atm_visits", measure=True, quarantine=quarantine)
    rows = stream_metrics(spark, cfg, schemas.BRONZE_VISITS).orderBy("batch_id").select(*COUNTS).collect()
    assert [tuple(r) for r in rows] == [(4, 1, 1, 1), (1, 0, 0, 0)]
    assert len(spark._jsparkSession.streams().listListeners()) == len(before)


def test_streaming_mode_measures_and_its_listeners_go(spark, root):
    cfg = config(root, trigger_mode=TriggerMode.STREAMING, poll_seconds=1)
    stage(cfg, "atm_visits", "1", [visit(1), visit(None)])
    before = len(spark._jsparkSession.streams().listListeners())
    (query,) = ingest(spark, cfg, "atm_visits", measure=True)
    query.processAllAvailable()
    query.stop()
    deadline = time.monotonic() + 30
    while len(spark._jsparkSession.streams().listListeners()) > before and time.monotonic() < deadline:
        time.sleep(0.2)
    assert len(spark._jsparkSession.streams().listListeners()) == before
    assert [tuple(r) for r in stream_metrics(spark, cfg, schemas.BRONZE_VISITS).select(*COUNTS).collect()] == [(2, 1, 0, 0)]
