"""Type-2 history against hand-made rows and against a real SQL MERGE."""

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tellerline.operators import changed_current, scd2_apply, scd2_staged

STORED = (
    "id long, a long, b long, other long, since date, current boolean, effective_date date, end_date date, "
    "load_ts string, update_ts string"
)
BATCH = "id long, a long, b long, other long, since date, load_ts string, update_ts string"
TRACKED = ["a", "b"]
TODAY = "2024-02-01"


def stored(spark, data):
    """(id, a, b, other, current) with fixed dates."""
    full = [
        (i, a, b, o, None, cur, "2024-01-01", None if cur else "2024-01-15", "s", "s") for i, a, b, o, cur in data
    ]
    return _typed(spark, full, STORED)


def batch(spark, data, since=None):
    return _typed(spark, [(i, a, b, o, since, "n", "n") for i, a, b, o in data], BATCH)


def _typed(spark, data, ddl):
    loose = ddl.replace(" date", " string").replace("end_string", "end_date").replace("effective_string", "effective_date")
    df = spark.createDataFrame(data, loose)
    for c in ("since", "effective_date", "end_date"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("date"))
    return df


def apply(target, updates, **options):
    return scd2_apply(target, updates, "id", TRACKED, F.lit(TODAY).cast("date"), **options)


def brief(df):
    """(id, a, current, effective, end, update_ts) per version."""
    cols = df.select("id", "a", "current", F.col("effective_date").cast("string"), F.col("end_date").cast("string"), "update_ts")
    return Counter(tuple(r) for r in cols.collect())


def test_new_changed_and_unchanged(spark):
    target = stored(spark, [(1, 10, 0, 0, True), (2, 20, 0, 0, True), (4, 40, 0, 0, True)])
    updates = batch(spark, [(1, 10, 0, 0), (2, 21, 0, 0), (3, 30, 0, 0)])
    result = apply(target, updates)
    assert brief(result) == Counter(
        [
            (1, 10, True, "2024-01-01", None, "s"),
            (2, 20, False, "2024-01-01", TODAY, "n"),
            (2, 21, True, TODAY, None, "n"),
            (3, 30, True, TODAY, None, "n"),
            (4, 40, True, "2024-01-01", None, "s"),
        ]
    )
    assert brief(apply(result, updates)) == brief(result)


def test_null_to_value_is_a_change_unless_literal(spark):
    target = stored(spark, [(1, None, 0, 0, True)])
    updates = batch(spark, [(1, 1, 0, 0)])
    assert apply(target, updates).count() == 2
    assert brief(apply(target, updates, null_safe=False)) == brief(target)
    # NULL OR TRUE is TRUE: another column's change still counts.
    assert apply(target, batch(spark, [(1, 1, 9, 0)]), null_safe=False).count() == 2


def test_untracked_change_is_ignored(spark):
    target = stored(spark, [(1, 10, 0, 7, True)])
    assert brief(apply(target, batch(spark, [(1, 10, 0, 8)]))) == brief(target)


def test_first_version_can_start_at_a_batch_date(spark):
    target = stored(spark, [(1, 10, 0, 0, True)])
    updates = batch(spark, [(1, 11, 0, 0), (2, 20, 0, 0), (None, 30, 0, 0)], since="2019-05-05")
    starts = {r.a: str(r.effective_date) for r in apply(target, updates, first_effective="since").collect() if r.current}
    assert starts == {11: TODAY, 20: "2019-05-05", 30: "2019-05-05"}


def test_key_known_from_closed_versions_only_is_not_new(spark):
    target = stored(spark, [(1, 10, 0, 0, False)])
    updates = batch(spark, [(1, 11, 0, 0)])
    assert brief(apply(target, updates)) == brief(target)


def test_null_keys_are_inserted_each_time(spark):
    target = stored(spark, [(None, 1, 0, 0, True)])
    updates = batch(spark, [(None, 1, 0, 0)])
    assert apply(target, updates).count() == 2


def test_history_complete_gives_the_same_result(spark):
    data = [(1, 9, 0, 0, False), (1, 10, 0, 0, True), (2, 20, 0, 0, True)]
    updates = batch(spark, [(1, 11, 0, 0), (2, 20, 0, 0), (3, 1, 0, 0)])
    target = stored(spark, data)
    assert brief(apply(target, updates, history_complete=True)) == brief(apply(target, updates))


def test_staged_rows(spark):
    target = stored(spark, [(1, 10, 0, 0, True), (2, 20, 0, 0, True), (2, 19, 0, 0, False)])
    updates = batch(spark, [(1, 10, 0, 0), (2, 21, 0, 0), (3, 30, 0, 0)])
    assert [r.id for r in changed_current(target, updates, "id", TRACKED).collect()] == [2]
    staged = scd2_staged(target, updates, "id", TRACKED)
    assert Counter((r.merge_key, r.id) for r in staged.collect()) == Counter([(1, 1), (2, 2), (3, 3), (None, 2)])


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("null_safe", [True, False])
def test_equals_sql_merge(spark, seed, null_safe):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, 1, 2])
    target = [(i, value(), value(), 0, True) for i in rng.sample(range(60), 30)]
    target += [(i, value(), value(), 0, False) for i in rng.choices(range(70), k=30)] + [(None, 1, 1, 0, True)]
    updates = [(i, value(), value(), 1) for i in rng.sample(range(70), 35)] + [(None, 2, 2, 1)]
    t, u = stored(spark, target), batch(spark, updates)

    con = duckdb.connect()
    columns = "id BIGINT, a BIGINT, b BIGINT, other BIGINT, since DATE"
    con.execute(
        f'CREATE TABLE t ({columns}, "current" BOOLEAN, effective_date DATE, end_date DATE, load_ts VARCHAR, update_ts VARCHAR)'
    )
    con.execute(f"CREATE TABLE u ({columns}, load_ts VARCHAR, update_ts VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?,?,?,?,?,?,?,?,?,?)", [tuple(r) for r in t.collect()])
    con.executemany("INSERT INTO u VALUES (?,?,?,?,?,?,?)", [tuple(r) for r in u.collect()])
    test = "IS DISTINCT FROM" if null_safe else "<>"
    differs = f"(t.a {test} s.a OR t.b {test} s.b)"
    con.execute(f"""
        MERGE INTO t USING (
          SELECT id AS merge_key, * FROM u
          UNION ALL SELECT NULL, s.* FROM u s JOIN t ON s.id = t.id WHERE t."current" AND {differs}
        ) s ON t.id = s.merge_key
        WHEN MATCHED AND t."current" AND {differs}
          THEN UPDATE SET "current" = FALSE, end_date = DATE '{TODAY}', update_ts = s.update_ts
        WHEN NOT MATCHED THEN INSERT VALUES
          (s.id, s.a, s.b, s.other, s.since, TRUE, DATE '{TODAY}', NULL, s.load_ts, s.update_ts)""")
    expected = Counter(con.execute("SELECT * FROM t").fetchall())
    result = apply(t, u, null_safe=null_safe)
    assert Counter(tuple(r) for r in result.select(*t.columns).collect()) == expected
