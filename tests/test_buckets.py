"""Buckets that grow: where keys lie, and tables before and after splits."""

import glob
import os

import pytest
from helpers import DAY1, DAY2, DAY3, config, customer, ingest, location, stage, table_rows
from pyspark.sql import functions as F

from tellerline import schemas
from tellerline.functions.columns import key_bucket
from tellerline.sources import recover, split_buckets
from tellerline.sources.buckets import ancestors, bucket_column, split_of
from tellerline.sources.publish import prepare, publish
from tellerline.sources.tables import partition_in, read_physical
from tellerline.streaming import run_customers, run_locations

CUSTOMERS, LOCATIONS = schemas.SILVER_CUSTOMERS, schemas.SILVER_LOCATIONS


def test_unsplit_tables_keep_their_buckets(spark):
    keys = spark.range(500).union(spark.range(1).select(F.lit(None).cast("long"))).withColumnRenamed("id", "k")
    assert keys.where(bucket_column(["k"], 7) != key_bucket(["k"], 7)).count() == 0


def test_a_split_moves_the_keys_of_one_bucket_to_its_two(spark):
    keys = spark.range(3000).withColumnRenamed("id", "k")
    split = []
    for bucket, children in ((1, (4, 7)), (4, (10, 13)), (0, (3, 6)), (13, (28, 31))):
        old, new = bucket_column(["k"], 3, split), bucket_column(["k"], 3, [*split, bucket])
        split.append(bucket)
        moves = {(r[0], r[1]) for r in keys.select(old, new).distinct().collect()}
        assert {m for m in moves if m[0] != m[1]} == {(bucket, c) for c in children}
        assert all(next(ancestors(c, 3)) == bucket for c in children)
    assert list(ancestors(31, 3)) == [13, 4, 1] and list(ancestors(2, 3)) == list(ancestors(-1, 3)) == []


def _files(cfg, spec):
    path = f"{cfg.silver_root}/{spec.name}/"
    return {f[len(path) :] for f in glob.glob(f"{path}**/part-*", recursive=True)}


def _load(spark, cfg, days):
    for n, (as_of, rows) in enumerate(days):
        stage(cfg, "atm_customers", str(n), rows)
        ingest(spark, cfg, "atm_customers")
        run_customers(spark, cfg, as_of)


def _deliveries():
    first = [customer(i) for i in range(40)] + [customer(None)]
    second = [customer(i, "bea" if i % 2 else "ann") for i in range(20, 60)]
    third = [customer(i, "cat" if i % 3 else "ann") for i in range(60)]
    return [(DAY1, first), (DAY2, second), (DAY3, third)]


def test_customers_are_the_same_with_and_without_splits(spark, tmp_path):
    tables = []
    for name, options in (("plain", {}), ("split", {"split_rows": 5})):
        cfg = config(str(tmp_path / name), key_buckets=2, **options)
        _load(spark, cfg, _deliveries())
        rows = table_rows(spark, cfg, CUSTOMERS, "customer_id", "first_name", "current", "effective_date", "end_date")
        tables.append((rows, split_of(spark, cfg, CUSTOMERS)))
    (plain, none), (split, some) = tables
    assert plain == split and not none and len(some) > 8
    sizes = read_physical(spark, cfg, CUSTOMERS).where("current and key_bucket >= 0").groupBy("key_bucket").count()
    assert max(r["count"] for r in sizes.collect()) <= 5


def test_late_delivery_finds_repeats_that_were_noted_before_a_split(spark, tmp_path):
    """Versions a, a, then between them a late b: the repeat parts them, split or not."""
    tables = []
    for name in ("plain", "split"):
        cfg = config(str(tmp_path / name), key_buckets=1)
        rows = [[customer(i, first) for i in range(20)] for first in ("ann", "bea", "ann")]
        for n in range(3):
            stage(cfg, "atm_customers", str(n), rows[n])
        late = f"{cfg.stage_root}/atm_customers/1.json"
        aside, stamp = f"{tmp_path}/{name}.json", os.stat(late).st_mtime
        os.rename(late, aside)
        ingest(spark, cfg, "atm_customers")
        run_customers(spark, cfg, DAY1)
        if name == "split":
            assert split_buckets(spark, cfg, CUSTOMERS, 4)
        os.rename(aside, late)
        os.utime(late, (stamp, stamp))
        ingest(spark, cfg, "atm_customers")
        run_customers(spark, cfg, DAY2)
        tables.append(table_rows(spark, cfg, CUSTOMERS, "customer_id", "first_name", "current", "effective_date", "end_date"))
    assert tables[0] == tables[1]
    assert {r[1:3] for r in tables[0]} == {("ann", False), ("bea", False), ("ann", True)}


def test_only_split_buckets_are_rewritten(spark, root):
    cfg = config(root, key_buckets=8)
    stage(cfg, "atm_locations", "1", [location(i) for i in range(60)] + [location(None)])
    ingest(spark, cfg, "atm_locations")
    run_locations(spark, cfg, DAY1)
    rows, before = table_rows(spark, cfg, LOCATIONS), _files(cfg, LOCATIONS)
    sizes = {r[0]: r[1] for r in read_physical(spark, cfg, LOCATIONS).groupBy("key_bucket").count().collect()}
    most = max(n for b, n in sizes.items() if b >= 0)
    split = split_buckets(spark, cfg, LOCATIONS, most - 1)
    assert {b for b in split if b < 8} == {b for b, n in sizes.items() if n == most and b >= 0}
    gone = {f.split("/")[0] for f in before - _files(cfg, LOCATIONS)}
    assert gone == {f"key_bucket={b}" for b in split if b < 8}
    assert table_rows(spark, cfg, LOCATIONS) == rows
    assert split_buckets(spark, cfg, LOCATIONS, most - 1) == []
    stage(cfg, "atm_locations", "2", [location(i, "south") for i in range(60)])
    ingest(spark, cfg, "atm_locations")
    run_locations(spark, cfg, DAY2)
    assert table_rows(spark, cfg, LOCATIONS, "atm_id", "bank") == {**{(i, "south"): 1 for i in range(60)}, (None, "north"): 1}


def test_a_split_whose_driver_is_lost_is_finished_by_the_next_run(spark, root, monkeypatch):
    cfg = config(root, key_buckets=1)
    stage(cfg, "atm_locations", "1", [location(i) for i in range(30)])
    ingest(spark, cfg, "atm_locations")
    run_locations(spark, cfg, DAY1)

    def lost(*args):
        prepare(*args)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr("tellerline.sources.buckets.publish", lost)
        split_buckets(spark, cfg, LOCATIONS, 20)
    assert split_of(spark, cfg, LOCATIONS) == []
    recover(spark, cfg, LOCATIONS)
    assert split_of(spark, cfg, LOCATIONS) == [0]
    assert table_rows(spark, cfg, LOCATIONS, "atm_id") == {(i,): 1 for i in range(30)}


def test_thousands_of_partitions_are_tested_at_once(spark):
    values = [(flag, bucket) for bucket in range(4000) for flag in (True, False)]
    rows = spark.range(5000).selectExpr("id % 2 = 0 AS current", "CAST(id AS INT) AS key_bucket")
    rows = rows.unionByName(spark.createDataFrame([(True, None), (None, 1)], "current boolean, key_bucket int"))
    inside = partition_in(CUSTOMERS, values)
    assert rows.where(inside).count() == 4000 and rows.where(~inside).count() == 1002
    assert rows.where(partition_in(CUSTOMERS, [(True, None), (True, 2), (None, 1)])).count() == 3


def test_a_bucket_that_is_split_many_times_is_moved_once(spark, root, monkeypatch):
    cfg, published = config(root, key_buckets=1), []
    stage(cfg, "atm_locations", "1", [location(i) for i in range(200)])
    ingest(spark, cfg, "atm_locations")
    run_locations(spark, cfg, DAY1)
    with monkeypatch.context() as patch:
        patch.setattr("tellerline.sources.buckets.publish", lambda *args: published.append(publish(*args)))
        split = split_buckets(spark, cfg, LOCATIONS, 10)
    assert published == [200] and len(split) > 15 and sorted(split_of(spark, cfg, LOCATIONS)) == sorted(split)
    assert table_rows(spark, cfg, LOCATIONS, "atm_id") == {(i,): 1 for i in range(200)}
    stored = read_physical(spark, cfg, LOCATIONS)
    assert stored.where(bucket_column(["atm_id"], 1, split) != F.col("key_bucket")).count() == 0
    assert max(r["count"] for r in stored.groupBy("key_bucket").count().collect()) <= 10
