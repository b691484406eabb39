import datetime as dt
import glob
import json
import os
import random
from collections import Counter

import pytest
from helpers import DAY1, DAY2, DAY3, config, customer, ingest, location, stage, table_rows, visit
from pyspark.sql import functions as F

from tellerline import schemas
from tellerline.functions.columns import key_bucket
from tellerline.operators import conform, in_intervals, key_intervals, scd2_apply
from tellerline.params import Stamp, TriggerMode
from tellerline.sources import history, read_table
from tellerline.sources.tables import checkpoint_dir, ensure_buckets, read_physical
from tellerline.streaming import prepare_locations, run_customers, run_locations, run_visits, silver

VISITS, CUSTOMERS, LOCATIONS = schemas.SILVER_VISITS, schemas.SILVER_CUSTOMERS, schemas.SILVER_LOCATIONS
VERSION = ("customer_id", "first_name", "current", "effective_date", "end_date")
D1, D2, D3 = (d.date() for d in (DAY1, DAY2, DAY3))


def test_visits_are_dated_and_inserted_once(spark, root):
    cfg = config(root)
    stage(cfg, "atm_visits", "1", [visit(1, time="23:30:00"), visit(2), visit(2)])
    ingest(spark, cfg, "atm_visits")
    run_visits(spark, cfg, DAY1)
    stage(cfg, "atm_visits", "2", [visit(2, amount=99), visit(3)])
    ingest(spark, cfg, "atm_visits")
    run_visits(spark, cfg, DAY2)
    day = dt.date(2024, 1, 5)
    assert table_rows(spark, cfg, VISITS, "visit_id", "amount", "transaction_dt", "load_ts") == {
        (1, 10, day, DAY1): 1,
        (2, 10, day, DAY1): 1,
        (3, 10, day, DAY2): 1,
    }
    assert read_table(spark, cfg, VISITS).columns == VISITS.schema.names


LIMITS = ((20, 1000), (3, 1))


def stage_uneven(cfg):
    """A large delivery first, small ones after it; keys and tracked values recur, some deliveries change nothing."""
    rng = random.Random(5)
    for i, size in enumerate((3000, 1, 4, 2)):
        keys = range(size) if size > 50 else [1, *(rng.choice((2, 3, 7000 + i)) for _ in range(size - 1))]
        name = rng.choice(("ann", "bea"))
        stage(cfg, "atm_customers", str(i), [customer(k, ("ann", "bea", "ann", name)[i]) for k in keys])
        stage(cfg, "atm_locations", str(i), [location(k, bank=f"bank {i}") for k in keys])
        # The same visit comes back with other amounts, now and then under another date.
        days = [f"2024-01-{5 + rng.randrange(2):02d}" for _ in keys]
        stage(cfg, "atm_visits", str(i), [visit(k, day=d, amount=i) for k, d in zip(keys, days)])


def test_tables_do_not_depend_on_batch_limits(spark, tmp_path):
    """However staged and bronze files are cut into batches, the tables come out the same."""
    results = []
    for staged, bronze in LIMITS:
        root = str(tmp_path / f"{staged}-{bronze}")
        cfg = config(root, max_files_per_trigger=staged, max_bronze_files_per_trigger=bronze)
        stage_uneven(cfg)
        ingest(spark, cfg, "atm_visits", "atm_locations", "atm_customers")
        for run in (run_visits, run_locations, run_customers):
            run(spark, cfg, DAY1)
        results.append([table_rows(spark, cfg, s) for s in (VISITS, LOCATIONS, CUSTOMERS)])
    for other in results[1:]:
        assert [left - right for left, right in zip(results[0], other)] == [Counter()] * 3
        assert [right - left for left, right in zip(results[0], other)] == [Counter()] * 3
    by_key = Counter()
    for row, n in results[0][2].items():
        by_key[row[0]] += n
    assert by_key[1] >= 3


def bronze_batch(spark, spec, rows, minute):
    """Rows of one delivery, as bronze holds them."""
    when = dt.datetime(2024, 1, 1, 0, minute)
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "line string")
    parsed = lines.select(F.from_json("line", spec.schema).alias("r")).select("r.*")
    return parsed.withColumns({"_ingest_ts": F.lit(when).cast("timestamp"), "_ingest_file": F.lit(f"f{minute}")})


def test_deliveries_out_of_order(spark, root):
    """Merged last to first, as if each had overtaken the one before; a replay of one changes nothing."""
    cfg = config(root)
    bronze = schemas.BRONZE_CUSTOMERS
    versions = ("ann", "bea", "bea", "ann")
    batches = [bronze_batch(spark, bronze, [customer(1, name), customer(2, "same")], m) for m, name in enumerate(versions)]
    for batch in batches:
        batch.write.mode("append").parquet(f"{root}/bronze/atm_customers")
    for batch in [*batches[::-1], batches[1]]:
        silver.apply_customers(spark, cfg, batch, Stamp.at(DAY1))
    assert table_rows(spark, cfg, CUSTOMERS, "customer_id", "first_name", "current") == {
        (1, "ann", False): 1,
        (1, "bea", False): 1,
        (1, "ann", True): 1,
        (2, "same", True): 1,
    }
    for m in (2, 0, 1):
        rows = bronze_batch(spark, schemas.BRONZE_LOCATIONS, [location(1, bank=f"b{m}")], m)
        silver.apply_locations(spark, cfg, rows, Stamp.at(DAY1))
        rows = bronze_batch(spark, schemas.BRONZE_VISITS, [visit(1, amount=m, day=f"2024-01-0{m + 1}")], m)
        silver.apply_visits(spark, cfg, rows, Stamp.at(DAY1))
    assert table_rows(spark, cfg, LOCATIONS, "bank") == {("b2",): 1}
    assert table_rows(spark, cfg, VISITS, "amount", "transaction_dt") == {(0, dt.date(2024, 1, 1)): 1}


def test_locations_are_flattened_and_overwritten(spark, root):
    cfg = config(root)
    stage(cfg, "atm_locations", "1", [location(1), location(2), {"atm_id": 3, "bank": "x"}])
    ingest(spark, cfg, "atm_locations")
    run_locations(spark, cfg, DAY1)
    stage(cfg, "atm_locations", "2", [location(2, bank="south"), location(4), location(4, bank="late")])
    ingest(spark, cfg, "atm_locations")
    run_locations(spark, cfg, DAY2)
    assert table_rows(spark, cfg, LOCATIONS, "atm_id", "city", "zip", "bank", "load_ts") == {
        (1, "c", "z", "north", D1): 1,
        (2, "c", "z", "south", D2): 1,
        (3, None, None, "x", D1): 1,
        (4, "c", "z", "north", D2): 1,
    }
    log = history(spark, cfg, LOCATIONS).select("inserted", "updated").collect()
    assert [tuple(r) for r in log] == [(1, 1), (3, 0)]


def test_location_load_date_is_a_date(spark):
    nested = spark.createDataFrame([], schemas.BRONZE_LOCATIONS.schema)
    flat = conform(prepare_locations(nested, Stamp.at(DAY1)), LOCATIONS.schema)
    assert dict(flat.dtypes)["load_ts"] == "date"


def run_three_deliveries(spark, cfg, **options):
    deliveries = (
        (DAY1, [customer(1), customer(2), customer(None, "nobody")]),
        (DAY2, [customer(1, "amy"), customer(2, checking_savings="savings")]),
        (DAY3, [customer(1, "ada"), customer(3)]),
    )
    for day, rows in deliveries:
        stage(cfg, "atm_customers", str(day.day), rows)
        ingest(spark, cfg, "atm_customers")
        run_customers(spark, cfg, day, **options)


def test_customers_keep_their_history(spark, root):
    cfg = config(root)
    run_three_deliveries(spark, cfg)
    assert table_rows(spark, cfg, CUSTOMERS, *VERSION) == {
        (1, "ann", False, D1, D2): 1,
        (1, "amy", False, D2, D3): 1,
        (1, "ada", True, D3, None): 1,
        (2, "ann", True, D1, None): 1,
        (3, "ann", True, D3, None): 1,
        (None, "nobody", True, D1, None): 1,
    }
    log = [tuple(r) for r in history(spark, cfg, CUSTOMERS).select("batch_id", "inserted", "closed").collect()]
    assert log == [(2, 2, 1), (1, 1, 1), (0, 3, 0)]


def test_first_version_from_the_since_date(spark, root):
    cfg = config(root)
    run_three_deliveries(spark, cfg, first_effective="customer_since_date")
    since = dt.date(2019, 5, 5)
    rows = table_rows(spark, cfg, CUSTOMERS, *VERSION)
    assert rows[(1, "ann", False, since, D2)] == rows[(1, "ada", True, D3, None)] == rows[(3, "ann", True, since, None)] == 1


def test_null_to_value_is_missed_only_when_literal(spark, tmp_path):
    for literal, versions in ((False, 2), (True, 1)):
        cfg = config(str(tmp_path / str(literal)))
        for day, preferred in ((DAY1, None), (DAY2, 1)):
            stage(cfg, "atm_customers", str(day.day), [customer(1, preferred=preferred)])
            ingest(spark, cfg, "atm_customers")
            run_customers(spark, cfg, day, literal=literal)
        assert sum(table_rows(spark, cfg, CUSTOMERS).values()) == versions


def test_all_versions_of_a_batch_are_chained(spark, root):
    cfg = config(root)
    for i, name in enumerate(("ann", "bea", "bea", "ann")):
        stage(cfg, "atm_customers", str(i), [customer(1, name)])
    ingest(spark, cfg, "atm_customers")
    run_customers(spark, cfg, DAY1)
    assert table_rows(spark, cfg, CUSTOMERS, *VERSION) == {
        (1, "ann", False, D1, D1): 1,
        (1, "bea", False, D1, D1): 1,
        (1, "ann", True, D1, None): 1,
    }


def test_a_small_batch_does_not_shuffle_the_stored_rows(spark, root, monkeypatch):
    """What is probed is scanned and filtered; only the buckets that change are laid out anew."""
    cfg = config(root)
    stage(cfg, "atm_locations", "1", [location(i) for i in range(40)])
    ingest(spark, cfg, "atm_locations")
    run_locations(spark, cfg, DAY1)
    seen = []

    def published(spark_, cfg_, spec, touched, replacing, adding=None, also=()):
        seen.append((set(touched), replacing.count()))

    monkeypatch.setattr(silver, "publish", published)
    tallies = []
    tally = silver._tally
    monkeypatch.setattr(silver, "_tally", lambda df, *a: tallies.append(df._jdf.queryExecution().executedPlan().toString()) or tally(df, *a))
    batch = bronze_batch(spark, schemas.BRONZE_LOCATIONS, [location(7, bank="new")], 1)
    batch = batch.withColumn("_ingest_ts", F.current_timestamp())
    silver.apply_locations(spark, cfg, batch, Stamp.at(DAY2))
    bucket = spark.range(7, 8).withColumnRenamed("id", "atm_id").select(key_bucket(["atm_id"], 4)).first()[0]
    assert [t for t, _ in seen] == [{(bucket,)}] and seen[0][1] < 40
    (plan,) = tallies
    probe = plan[plan.index("LeftSemi") - 200 : plan.index("FileScan parquet")]
    assert "BroadcastHashJoin" in probe and "Exchange hashpartitioning" not in probe[probe.index("LeftSemi") :], plan


def test_an_outlier_does_not_widen_the_probe(spark, root):
    """Stored files between a batch's ordinary ids and one stray id are not read."""
    keys = spark.createDataFrame([(k,) for k in [*range(100, 200), 10**12]], "visit_id long")
    found = key_intervals(keys, "visit_id")
    assert len(found) <= 64 and all(low <= high for low, high in found)
    path = f"{root}/files"
    for start in (0, 150, 10**6, 10**9, 10**12 - 5):
        spark.range(start, start + 10).withColumnRenamed("id", "visit_id").coalesce(1).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    kept = stored.where(in_intervals(F.col("visit_id"), found))
    assert sorted(r[0] for r in kept.collect()) == [*range(150, 160), 10**12]
    names = stored.select("visit_id", F.input_file_name().alias("f")).groupBy("f").agg(F.min("visit_id"), F.max("visit_id")).collect()
    hit = [1 for _, low, high in names if any(a <= high and low <= b for a, b in found)]
    assert len(hit) == 2


def test_only_touched_buckets_are_rewritten(spark, root):
    cfg = config(root)
    stage(cfg, "atm_customers", "1", [customer(i) for i in range(20)])
    ingest(spark, cfg, "atm_customers")
    run_customers(spark, cfg, DAY1)

    def files():
        current = read_physical(spark, cfg, CUSTOMERS).where("current")
        pairs = current.select("key_bucket", F.input_file_name().alias("file")).distinct()
        return {r.key_bucket: r.file for r in pairs.collect()}

    before = files()
    stage(cfg, "atm_customers", "2", [customer(7, "new"), customer(8)])
    ingest(spark, cfg, "atm_customers")
    run_customers(spark, cfg, DAY2)
    bucket = spark.range(7, 8).withColumnRenamed("id", "customer_id").select(key_bucket(["customer_id"], 4)).first()[0]
    after = files()
    assert {b for b in before if before[b] != after[b]} == {bucket}


def test_history_merge_reads_open_rows_of_touched_buckets_only(spark, root):
    cfg = config(root)
    run_three_deliveries(spark, cfg)
    physical = read_physical(spark, cfg, CUSTOMERS)
    opened = physical.where(F.col("key_bucket").isin([1])).where("current")
    batch = opened.drop("current", "effective_date", "end_date")
    merged = scd2_apply(
        opened, batch, "customer_id", schemas.TRACKED_CUSTOMER_COLUMNS, F.current_date(), history_complete=True
    )
    scans = merged._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]
    filters = [scan.split("], PushedFilters")[0] for scan in scans]
    assert filters and all("current" in f and "key_bucket" in f for f in filters)


def replay_last_batch(cfg, source, target):
    """Forget that the last micro-batch was committed."""
    path = checkpoint_dir(cfg, "bronze-silver", f"bronze.{source}", f"silver.{target}")
    commits = [f for f in glob.glob(f"{path}/commits/*") if os.path.basename(f).isdigit()]
    last = max(commits, key=lambda f: int(os.path.basename(f)))
    os.remove(last)
    crc = os.path.join(os.path.dirname(last), f".{os.path.basename(last)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def test_replayed_batches_change_nothing(spark, root):
    cfg = config(root)
    stage(cfg, "atm_visits", "1", [visit(1), visit(2)])
    stage(cfg, "atm_locations", "1", [location(1)])
    for folder, rows in (("1", [customer(1), customer(2)]), ("2", [customer(1, "amy"), customer(3)])):
        stage(cfg, "atm_customers", folder, rows)
        ingest(spark, cfg, "atm_visits", "atm_locations", "atm_customers")
        for run in (run_visits, run_locations, run_customers):
            run(spark, cfg, DAY1)
    specs = (VISITS, LOCATIONS, CUSTOMERS)
    before = [table_rows(spark, cfg, s) for s in specs]
    for spec, run in zip(specs, (run_visits, run_locations, run_customers)):
        replay_last_batch(cfg, spec.name, spec.name)
        query = run(spark, cfg, DAY1)
        assert query.lastProgress["numInputRows"] > 0
    assert [table_rows(spark, cfg, s) for s in specs] == before


def test_other_number_of_buckets_is_refused(spark, root):
    for cfg in (config(root), config(root)):
        ensure_buckets(spark, cfg, LOCATIONS)
    with pytest.raises(ValueError, match="key buckets"):
        ensure_buckets(spark, config(root, key_buckets=5), LOCATIONS)
    assert read_table(spark, cfg, LOCATIONS).count() == 0


def test_other_time_zone_is_refused(spark, root):
    with pytest.raises(ValueError, match="time zone"):
        run_visits(spark, config(root, time_zone="Asia/Tokyo"), DAY1)


def test_merges_stream_side_by_side(spark, root):
    """Streaming mode: all merges poll at the same time, each on its own table."""
    cfg = config(root)
    folders = ("atm_visits", "atm_locations", "atm_customers")
    for folder, row in zip(folders, (visit(1), location(1), customer(1))):
        stage(cfg, folder, "1", [row])
    ingest(spark, cfg, *folders)
    polling = config(root, trigger_mode=TriggerMode.STREAMING)
    merges = [run(spark, polling, DAY1) for run in (run_visits, run_locations, run_customers)]
    try:
        for query in merges:
            query.processAllAvailable()
    finally:
        for query in merges:
            query.stop()
    for spec in (VISITS, LOCATIONS, CUSTOMERS):
        assert sum(table_rows(spark, cfg, spec).values()) == 1
        assert history(spark, cfg, spec).count() == 1
