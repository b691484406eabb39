"""Bitmaps that tell on which dates a visit may be stored."""

import datetime as dt
import random

from helpers import DAY1, DAY2, config, ingest, stage, table_rows, visit
from pyspark.sql import functions as F

from tellerline import schemas
from tellerline.operators import groups_that_may_hold, key_fragments
from tellerline.sources import files
from tellerline.sources.tables import read_physical, table_path
from tellerline.streaming import run_visits, silver

VISITS, KEYS = schemas.SILVER_VISITS, schemas.VISIT_KEYS


def test_few_of_many_groups_are_named_and_none_is_missed(spark):
    """100 old keys, two to a group, scattered over 1,000 groups of 300 keys."""
    rng = random.Random(1)
    rows = spark.range(300_000).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int").alias("g"))
    rows = rows.unionByName(spark.createDataFrame([(None, 5), (7, None)], "id long, g int"))
    fragments = key_fragments(rows, "id", "g").persist()
    old = spark.createDataFrame([(k,) for k in [*rng.sample(range(300_000), 4), 7, None]], "id long")
    exact = {r.g for r in rows.join(old, "id").select("g").distinct().collect()}
    found = {r.g for r in groups_that_may_hold(fragments, old, "id", "g").collect()}
    assert exact <= found and None in found
    assert len(found) < len(exact) + 1000 * 5 * 0.06
    absent = spark.range(10**9, 10**9 + 3)
    assert groups_that_may_hold(fragments, absent, "id", "g").count() < 200
    assert groups_that_may_hold(fragments, old.where("id is null"), "id", "g").count() == 0
    assert groups_that_may_hold(fragments.where("false"), old, "id", "g").count() == 0
    bits = fragments.agg(F.sum("words" if False else F.lit(64))).first()[0]
    assert bits < 300_000 * 24


def test_fragments_of_different_sizes_stand_side_by_side(spark):
    parts = [spark.range(a, b).select("id", F.lit(1).alias("g")) for a, b in ((0, 1), (1, 50), (50, 5000))]
    fragments = None
    for p in parts:
        own = key_fragments(p, "id", "g")
        fragments = own if fragments is None else fragments.unionByName(own)
    for k in (0, 1, 49, 50, 4999):
        assert groups_that_may_hold(fragments, spark.range(k, k + 1), "id", "g").count() == 1


def probed(monkeypatch):
    seen = []
    real = silver._dates_to_probe
    monkeypatch.setattr(silver, "_dates_to_probe", lambda *a: seen.append(real(*a)) or seen[-1])
    return seen


def test_a_batch_reads_the_dates_of_its_keys_only(spark, root, monkeypatch):
    """Visits that come again under other dates are found where they are stored; the other dates are not read."""
    cfg = config(root)
    days = [str(dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(40)]
    stage(cfg, "atm_visits", "1", [visit(100 * i + k, day=d) for i, d in enumerate(days) for k in range(5)])
    ingest(spark, cfg, "atm_visits")
    run_visits(spark, cfg, DAY1)
    before = table_rows(spark, cfg, VISITS)
    seen = probed(monkeypatch)
    stage(cfg, "atm_visits", "2", [visit(304, day="2024-03-01"), visit(2001, day="2024-03-01"), visit(9999, day="2024-03-01"), visit(None)])
    ingest(spark, cfg, "atm_visits")
    run_visits(spark, cfg, DAY2)
    after = table_rows(spark, cfg, VISITS)
    assert {r[0] for r in after - before} == {9999, None} and not before - after
    (dates,) = seen
    assert {days[3], days[20]} <= set(dates) and len(dates) < 8


def test_a_table_without_bitmaps_gets_them(spark, root, monkeypatch):
    cfg = config(root)
    stage(cfg, "atm_visits", "1", [visit(i, day=f"2024-01-{i + 1:02}") for i in range(20)])
    ingest(spark, cfg, "atm_visits")
    run_visits(spark, cfg, DAY1)
    files.remove_dir(spark, table_path(cfg, KEYS))
    seen = probed(monkeypatch)
    stage(cfg, "atm_visits", "2", [visit(3, day="2024-02-01"), visit(77)])
    ingest(spark, cfg, "atm_visits")
    run_visits(spark, cfg, DAY2)
    assert sum(table_rows(spark, cfg, VISITS).values()) == 21
    assert "2024-01-04" in seen[0] and len(seen[0]) < 8
    assert read_physical(spark, cfg, KEYS).count() >= 21
