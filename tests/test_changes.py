"""Change rows, summaries kept up from them, state in front of a merge, and two outputs of one reading."""

import datetime as dt
import glob
import os
from collections import Counter

import pytest
from helpers import DAY1, DAY2, DAY3, config, customer, ingest, location, stage, table_rows, visit
from pyspark.sql import functions as F

from tellerline import schemas
from tellerline.params import DayWindow, TriggerMode
from tellerline.plans import incremental, run_daily, run_daily_incremental
from tellerline.sources import create_layer_tables, history, publish, read_table
from tellerline.sources.tables import read_physical
from tellerline.streaming import run_customers, run_locations, run_visits
from tellerline.streaming.bronze import quarantine_path

VISITS, CUSTOMERS, LOCATIONS, DAILY = schemas.SILVER_VISITS, schemas.SILVER_CUSTOMERS, schemas.SILVER_LOCATIONS, schemas.GOLD_DAILY
TOTALS = ("transaction_dt", "bank", "total_withdrawls", "total_deposits")


def load(spark, cfg, name, visits, locations, day):
    for folder, rows in (("atm_visits", visits), ("atm_locations", locations)):
        if rows:
            stage(cfg, folder, name, rows)
            ingest(spark, cfg, folder)
    run_visits(spark, cfg, day)
    run_locations(spark, cfg, day)


def physical(spark, cfg, spec):
    return Counter(tuple(r) for r in read_physical(spark, cfg, spec).collect())


def test_replayed_changes_give_the_table(spark, root):
    """From nothing on, after every kind of merge."""
    cfg = config(root, change_rows=True)
    stage(cfg, "atm_visits", "1", [visit(1), visit(2), visit(None)])
    stage(cfg, "atm_locations", "1", [location(1), location(2)])
    stage(cfg, "atm_customers", "1", [customer(1), customer(2)])
    # Older than what is merged first, so it takes that one's place.
    stage(cfg, "atm_visits", "0", [visit(1, amount=99)])
    for file, when in (("0", 1), ("1", 2)):
        os.utime(f"{cfg.stage_root}/atm_visits/{file}.json", (1_600_000_000 + when,) * 2)
    os.rename(f"{cfg.stage_root}/atm_visits/0.json", f"{root}/0.json")
    specs = {VISITS: run_visits, LOCATIONS: run_locations, CUSTOMERS: run_customers}

    def merged(day):
        ingest(spark, cfg, *(s.name for s in specs))
        for spec, run in specs.items():
            run(spark, cfg, day)
        run_daily(spark, cfg, DayWindow.resolve("20240108"), day)

    merged(DAY1)
    os.rename(f"{root}/0.json", f"{cfg.stage_root}/atm_visits/0.json")
    stage(cfg, "atm_locations", "2", [location(1, bank="south"), location(3)])
    stage(cfg, "atm_customers", "2", [customer(1, "amy"), customer(3)])
    merged(DAY2)
    for spec in (*specs, DAILY):
        changes = read_physical(spark, cfg, schemas.changes_of(spec)).collect()
        replayed = Counter()
        for r in changes:
            replayed[tuple(r)[:-2]] += 1 if r[schemas.CHANGE_COLUMN] == schemas.AFTER else -1
        assert +replayed == physical(spark, cfg, spec) and not -replayed, spec.name
        assert any(r[schemas.CHANGE_COLUMN] == schemas.BEFORE for r in changes), spec.name


def test_summaries_follow_late_and_replaced_visits_and_moved_banks(spark, root):
    """Equal to summing all days anew: NULL totals, vanished groups and unknown banks included."""
    cfg = config(root, change_rows=True)
    steps = (
        ([visit(1), visit(2, atm=2), visit(3, day="2024-01-06", tag="deposit"), visit(4, day="2023-06-01", tag="other")], [location(1)]),
        # Long before any window; a NULL amount; an unknown ATM.
        ([visit(5, day="2020-02-02", amount=7), visit(6, day="2020-02-02", amount=None, atm=9), visit(7, amount=-10)], []),
        ([], [location(2, bank="south"), location(1, bank="east")]),
        ([], []),
    )
    for n, (visits, places) in enumerate(steps):
        day = (DAY1, DAY2, DAY3, DAY3)[n]
        load(spark, cfg, str(n), visits, places, day)
        counts = run_daily_incremental(spark, cfg, day)
        other = config(f"{root}/whole{n}", silver_root=cfg.silver_root)
        run_daily(spark, other, DayWindow(dt.date(2024, 1, 31), 1500), day)
        assert table_rows(spark, cfg, DAILY, *TOTALS) == table_rows(spark, other, DAILY, *TOTALS), n
    assert counts == {}
    # Rows taken out count back; a total whose last amount goes is NULL again.
    kept = read_physical(spark, cfg, VISITS).where("visit_id <> 5")
    changed = read_physical(spark, cfg, VISITS).where("visit_id = 5")
    stamp = incremental.Stamp.at(DAY3)
    publish.publish(spark, cfg, VISITS, [(dt.date(2020, 2, 2),)], kept.where("transaction_dt = '2020-02-02'"), None, publish.change_rows(cfg, VISITS, stamp, changed, None))
    run_daily_incremental(spark, cfg, DAY3)
    day = {r: n for r, n in table_rows(spark, cfg, DAILY, *TOTALS).items() if r[0] == dt.date(2020, 2, 2)}
    assert day == {(dt.date(2020, 2, 2), "UNKNOWN", None, None): 1}


def test_a_batch_of_changes_is_added_once(spark, root, monkeypatch):
    """The driver is lost after the sums and before the totals; the batch comes again."""
    cfg = config(root, change_rows=True)
    load(spark, cfg, "1", [visit(1), visit(2, day="2024-01-06")], [location(1)], DAY1)
    real = incremental.store_totals
    monkeypatch.setattr(incremental, "store_totals", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        run_daily_incremental(spark, cfg, DAY1)
    monkeypatch.setattr(incremental, "store_totals", real)
    run_daily_incremental(spark, cfg, DAY2)
    assert table_rows(spark, cfg, DAILY, "total_withdrawls") == {(10,): 2}
    assert table_rows(spark, cfg, schemas.DAILY_BY_ATM, "visits") == {(1,): 2}
    with pytest.raises(ValueError, match="change_rows"):
        run_daily_incremental(spark, config(root), DAY2)


def test_visits_that_come_again_do_not_reach_the_merge(spark, root):
    cfg = config(root)
    for name, rows in (("1", [visit(1), visit(2), visit(None)]), ("2", [visit(1, amount=5), visit(3), visit(None)])):
        stage(cfg, "atm_visits", name, rows)
        ingest(spark, cfg, "atm_visits")
        run_visits(spark, cfg, DAY1, once_in="1 hour")
    assert table_rows(spark, cfg, VISITS, "visit_id", "amount") == {(1, 10): 1, (2, 10): 1, (3, 10): 1, (None, 10): 2}
    merged = [r.input_rows for r in history(spark, cfg, VISITS).collect() if r.input_rows]
    assert sorted(merged) == [2, 3]
    # Delivered long after: the state has let go of it, the merge has not.
    stage(cfg, "atm_visits", "3", [visit(9)])
    os.utime(f"{cfg.stage_root}/atm_visits/3.json", (1_800_000_000,) * 2)
    ingest(spark, cfg, "atm_visits")
    run_visits(spark, cfg, DAY2, once_in="1 hour")
    stage(cfg, "atm_visits", "4", [visit(2, amount=7)])
    os.utime(f"{cfg.stage_root}/atm_visits/4.json", (1_800_000_001,) * 2)
    ingest(spark, cfg, "atm_visits")
    run_visits(spark, cfg, DAY3, once_in="1 hour")
    assert table_rows(spark, cfg, VISITS, "visit_id", "amount")[2, 10] == 1
    assert sum(table_rows(spark, cfg, VISITS).values()) == 6


def forget_last_commit(cfg):
    """The last micro-batch of every stage-to-bronze query comes again."""
    for folder in glob.glob(f"{cfg.checkpoint_root}/stage-bronze/*/commits"):
        names = [f for f in os.listdir(folder) if f.isdigit()]
        last = max(names, key=int)
        for file in (last, f".{last}.crc"):
            if os.path.exists(f"{folder}/{file}"):
                os.remove(f"{folder}/{file}")


def test_quarantine_reads_each_line_once_and_stores_each_batch_once(spark, root):
    cfg = config(root)
    stage(cfg, "atm_locations", "1", ["{broken", location(1), location(2)])
    (query,) = ingest(spark, cfg, "atm_locations", quarantine=True)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3
    forget_last_commit(cfg)
    ingest(spark, cfg, "atm_locations", quarantine=True)
    assert table_rows(spark, cfg, schemas.BRONZE_LOCATIONS, "atm_id") == {(1,): 1, (2,): 1}
    assert spark.read.parquet(quarantine_path(cfg, "atm_locations")).count() == 1
    run_locations(spark, cfg, DAY1)
    assert table_rows(spark, cfg, LOCATIONS, "atm_id") == {(1,): 1, (2,): 1}
    with pytest.raises(ValueError, match="quarantine"):
        ingest(spark, cfg, "atm_locations")
    other = config(f"{root}/other")
    stage(other, "atm_locations", "1", [location(1)])
    ingest(spark, other, "atm_locations")
    with pytest.raises(ValueError, match="quarantine"):
        ingest(spark, other, "atm_locations", quarantine=True)


def test_a_polling_run_shows_new_dates_to_the_catalog_and_leaves_no_listener(spark, root):
    cfg = config(root, trigger_mode=TriggerMode.STREAMING, bronze_schema="bpoll")
    create_layer_tables(spark, cfg, "bronze")
    stage(cfg, "atm_visits", "1", [visit(1), visit(2, day="2024-01-06")])
    before = len(spark.streams._jsqm.listListeners())
    (query,) = ingest(spark, cfg, "atm_visits")
    try:
        query.processAllAvailable()
        deadline = dt.datetime.now() + dt.timedelta(seconds=20)
        while spark.table("bpoll.atm_visits").count() < 2 and dt.datetime.now() < deadline:
            query.awaitTermination(1)
        assert spark.table("bpoll.atm_visits").select(F.sum("visit_id")).first()[0] == 3
    finally:
        query.stop()
    deadline = dt.datetime.now() + dt.timedelta(seconds=20)
    while len(spark.streams._jsqm.listListeners()) > before and dt.datetime.now() < deadline:
        spark.range(1).count()
    assert len(spark.streams._jsqm.listListeners()) == before
    assert read_table(spark, cfg, schemas.BRONZE_VISITS).count() == 2
