"""Late deliveries of customers, spliced into stored versions, against the chain of all deliveries."""

import datetime as dt
import os
import random

import pytest
from helpers import config
from pyspark.sql import functions as F

from tellerline import schemas
from tellerline.operators import spliced
from tellerline.params import Stamp
from tellerline.sources.tables import read_physical, read_table
from tellerline.streaming import silver

CUSTOMERS, REPEATS = schemas.SILVER_CUSTOMERS, schemas.CUSTOMER_REPEATS
NAMES = ("ann", "bea", None)


def batch(spark, deliveries):
    """Bronze rows from (customer, delivery number, first name)."""
    lines = [(c, 1, "checking", name, "lee", None, 1, dt.datetime(2024, 1, 1, 0, at), f"f{at}") for c, at, name in deliveries]
    return spark.createDataFrame(lines, schemas.BRONZE_CUSTOMERS.schema)


def chain(deliveries):
    """{customer: [(delivery, name)]} of the deliveries that differ from the one before."""
    out = {}
    for c, at, name in sorted(deliveries, key=lambda d: d[:2]):
        versions, last = out.setdefault(c, ([], []))
        if not last or last[-1] != name:
            versions.append((at, name))
        last.append(name)
    return {c: versions for c, (versions, _) in out.items()}


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_arrival_gives_the_chain_of_all_deliveries(spark, root, seed):
    """Batches hold deliveries in any order, some again; bronze is never there to be read."""
    rng = random.Random(seed)
    cfg = config(root)
    every = [(c, at, rng.choice(NAMES)) for c in range(6) for at in rng.sample(range(14), 9)]
    waiting = every[:]
    rng.shuffle(waiting)
    day = dt.datetime(2024, 2, 1, 6)
    merged = []
    while waiting:
        n = rng.randint(6, 24)
        now, waiting = waiting[:n], waiting[n:]
        again = rng.sample(merged, min(len(merged), 3))
        day += dt.timedelta(days=1)
        silver.apply_customers(spark, cfg, batch(spark, now + [d for d in again if d[:2] not in {x[:2] for x in now}]), Stamp.at(day))
        merged += now
    assert not os.path.exists(f"{cfg.bronze_root}/atm_customers")
    found = {}
    rows = read_physical(spark, cfg, CUSTOMERS).orderBy("customer_id", "_ingest_ts").collect()
    for r in rows:
        found.setdefault(r.customer_id, []).append(r)
    expected = chain(every)
    assert {c: [r.first_name for r in v] for c, v in found.items()} == {c: [name for _, name in v] for c, v in expected.items()}
    for c, versions in found.items():
        assert [r.current for r in versions] == [False] * (len(versions) - 1) + [True]
        assert [r.end_date for r in versions] == [r.effective_date for r in versions[1:]] + [None]
        assert all(r.effective_date <= (r.end_date or dt.date.max) for r in versions)
        for r, (first, _), upto in zip(versions, expected[c], [*(at for at, _ in expected[c][1:]), 99]):
            # A version counts from a delivery of its own stretch: the first that is known.
            assert first <= int(r._ingest_file[1:]) < upto


def test_stored_versions_do_not_go_when_bronze_does(spark, root):
    cfg = config(root)
    for day, (at, name) in enumerate([(1, "ann"), (3, "bea"), (2, "cid")], 1):
        silver.apply_customers(spark, cfg, batch(spark, [(1, at, name)]), Stamp.at(dt.datetime(2024, 2, day, 6)))
    d = dt.date
    rows = read_table(spark, cfg, CUSTOMERS).select("first_name", "effective_date", "end_date").collect()
    assert sorted(map(tuple, rows), key=str) == [
        ("ann", d(2024, 2, 1), d(2024, 2, 2)),
        ("bea", d(2024, 2, 2), None),
        ("cid", d(2024, 2, 2), d(2024, 2, 2)),
    ]


def test_repeats_are_noted_beside_and_open_rows_left_alone(spark, root):
    cfg = config(root)
    silver.apply_customers(spark, cfg, batch(spark, [(c, 1, "ann") for c in range(5)]), Stamp.at(dt.datetime(2024, 2, 1)))
    before = {r.f for r in read_physical(spark, cfg, CUSTOMERS).select(F.input_file_name().alias("f")).collect()}
    silver.apply_customers(spark, cfg, batch(spark, [(c, 4, "ann") for c in range(5)]), Stamp.at(dt.datetime(2024, 2, 2)))
    after = {r.f for r in read_physical(spark, cfg, CUSTOMERS).select(F.input_file_name().alias("f")).collect()}
    assert before == after
    assert sorted((r.customer_id, r._ingest_file) for r in read_physical(spark, cfg, REPEATS).collect()) == [(c, "f4") for c in range(5)]
    # Between a version and its repeat: both sides of it are versions.
    silver.apply_customers(spark, cfg, batch(spark, [(2, 3, "bea")]), Stamp.at(dt.datetime(2024, 2, 3)))
    rows = read_physical(spark, cfg, CUSTOMERS).where("customer_id = 2").orderBy("_ingest_ts").collect()
    assert [(r.first_name, r._ingest_file, r.current) for r in rows] == [("ann", "f1", False), ("bea", "f3", False), ("ann", "f4", True)]


def test_a_known_delivery_counts_once(spark):
    schema = "k long, at int, v string"
    versions = spark.createDataFrame([(1, 1, "a"), (1, 5, "b")], schema)
    repeats = spark.createDataFrame([(1, 3), (1, 3), (1, 5), (2, 1)], "k long, at int")
    new = spark.createDataFrame([(1, 1, "a"), (1, 3, "a"), (1, 2, "c"), (3, 1, None)], schema)
    rows = spliced(versions, repeats, new, "k", ["at"], ["v"]).where("chain_new").select("k", "at", "v").collect()
    assert sorted(map(tuple, rows)) == [(1, 1, "a"), (1, 2, "c"), (1, 3, "a"), (1, 5, "b"), (3, 1, None)]
