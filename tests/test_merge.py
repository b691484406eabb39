"""Merge operators against hand-made rows and against a real SQL MERGE."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tellerline.operators import (
    conform,
    dedupe_earliest,
    dedupe_latest,
    insert_if_absent,
    matching_rows,
    upsert_if_changed,
    upsert_latest,
)
from tellerline.operators.conform import assert_schema
from tellerline.schemas import SILVER_VISITS

KV = "k long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "old"), (None, "old")], KV)
    updates = spark.createDataFrame([(1, "new"), (2, "new"), (None, "new")], KV)
    assert rows(insert_if_absent(target, updates, ["k"])) == rows(
        spark.createDataFrame([(2, "new"), (None, "new")], KV)
    )


def test_insert_if_absent_twice_adds_only_null_keys(spark):
    target = spark.createDataFrame([], KV)
    updates = spark.createDataFrame([(1, "a"), (None, "b")], KV)
    once = target.unionByName(insert_if_absent(target, updates, ["k"]))
    assert rows(insert_if_absent(once, updates, ["k"])) == [(None, "b")]


def test_probing_first_gives_the_same_rows(spark):
    target = spark.createDataFrame([(i, "t") for i in range(0, 60, 2)], KV)
    updates = spark.createDataFrame([(i, "u") for i in range(0, 60, 3)], KV)
    held = matching_rows(target, updates, ["k"])
    assert rows(insert_if_absent(held, updates, ["k"])) == rows(insert_if_absent(target, updates, ["k"]))


def test_upsert_latest(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], KV)
    updates = spark.createDataFrame([(2, None), (3, "new"), (None, "new")], KV)
    result = upsert_latest(target, updates, ["k"], labelled=True)
    assert {tuple(r) for r in result.collect()} == {
        (1, "old", "keep"),
        (2, None, "update"),
        (3, "new", "insert"),
        (None, "old", "keep"),
        (None, "new", "insert"),
    }


SUMMARY = "k long, w long, d long, create_ts string, update_ts string"


def test_upsert_if_changed(spark):
    target = spark.createDataFrame(
        [(1, 10, None, "c", "c"), (2, 10, 20, "c", "c"), (3, 1, 1, "c", "c"), (None, 5, 5, "c", "c")], SUMMARY
    )
    updates = spark.createDataFrame(
        [(1, 10, None, "n", "n"), (2, 11, 20, "n", "n"), (4, 1, 1, "n", "n"), (None, 5, 5, "n", "n")], SUMMARY
    )
    result = upsert_if_changed(target, updates, ["k"], ["w", "d"], nullable_keys=["k"])
    assert {tuple(r) for r in result.collect()} == {
        (1, 10, None, "c", "c"),
        (2, 11, 20, "c", "n"),
        (3, 1, 1, "c", "c"),
        (4, 1, 1, "n", "n"),
        (None, 5, 5, "c", "c"),
    }
    assert rows(upsert_if_changed(result, updates, ["k"], ["w", "d"], nullable_keys=["k"])) == rows(result)


def test_upsert_if_changed_inserts_null_keys_unless_declared(spark):
    rows_in = spark.createDataFrame([(None, 5, 5, "c", "c")], SUMMARY)
    assert upsert_if_changed(rows_in, rows_in, ["k"], ["w", "d"]).count() == 2


def test_grouped_batch_is_not_shuffled_again(spark):
    """A summary grouped by the keys is joined with the partitioning it has."""
    sums = "sum(v) AS w", "sum(v) AS d", "max('u') AS create_ts", "max('u') AS update_ts"
    updates = spark.range(1000).selectExpr("id % 50 AS k", "id AS v").groupBy("k").agg(*map(F.expr, sums))
    target = spark.range(1000).selectExpr("id AS k", "id AS w", "id AS d", "'t' AS create_ts", "'t' AS update_ts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert_if_changed(target, updates, ["k"], ["w", "d"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_upsert_if_changed_literal_duplicates_unchanged_rows(spark):
    target = spark.createDataFrame([(1, 10, None, "c", "c"), (2, 10, 20, "c", "c")], SUMMARY)
    updates = spark.createDataFrame([(1, 10, None, "n", "n"), (2, 11, 20, "n", "n")], SUMMARY)
    result = upsert_if_changed(target, updates, ["k"], ["w", "d"], literal=True)
    assert {tuple(r) for r in result.collect()} == {
        (1, 10, None, "c", "c"),
        (1, 10, None, "n", "n"),
        (2, 11, 20, "c", "n"),
    }


def test_dedupe_keeps_one_row_per_key(spark):
    data = [(1, "a", 1), (1, "b", 2), (1, "c", 2), (2, "a", 5), (None, "x", 1), (None, "x", 1)]
    df = spark.createDataFrame(data, "k long, v string, o int")
    assert rows(dedupe_latest(df, ["k"], ["o"])) == rows(
        spark.createDataFrame([(1, "c", 2), (2, "a", 5), (None, "x", 1), (None, "x", 1)], df.schema)
    )
    assert (1, "a", 1) in rows(dedupe_earliest(df, ["k"], ["o"]))


def test_dedupe_sends_at_most_one_row_per_key_and_task(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id AS o", "CAST(id AS STRING) AS v")
    plan = dedupe_latest(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("Final"), plan.index("Partial")
    assert final < plan.index("Exchange") < partial


def test_conform(spark):
    df = spark.sql("SELECT 1 AS extra, CAST(2 AS INT) AS v, 'x' AS k")
    declared = spark.createDataFrame([], "k string, v long").schema
    result = conform(df, declared)
    assert_schema(result, declared)
    assert rows(result) == [("x", 2)]
    with pytest.raises(ValueError, match="missing"):
        conform(df.drop("k"), declared)
    with pytest.raises(ValueError, match="mismatch"):
        assert_schema(df, SILVER_VISITS.schema)


# --- differential: random tables, DuckDB's MERGE as the judge ----------------


def _table(rng, size, keys, null_keys=0):
    picked = rng.sample(range(keys), size)
    value = lambda: rng.choice([None, 1, 2, 3])
    data = [(k, value(), value(), f"{k}-{rng.random():.3f}", "s") for k in picked]
    return data + [(None, value(), value(), f"null-{i}", "s") for i in range(null_keys)]


def _merge(target, updates, statement):
    con = duckdb.connect()
    for name, data in (("t", target), ("u", updates)):
        con.execute(f"CREATE TABLE {name} (k BIGINT, w BIGINT, d BIGINT, create_ts VARCHAR, update_ts VARCHAR)")
        if data:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?, ?, ?)", data)
    con.execute(statement)
    return sorted(con.execute("SELECT * FROM t").fetchall(), key=repr)


INSERT_ALL = "WHEN NOT MATCHED THEN INSERT VALUES (u.k, u.w, u.d, u.create_ts, u.update_ts)"
SET_ALL = "UPDATE SET w = u.w, d = u.d, create_ts = u.create_ts, update_ts = u.update_ts"
SET_TOTALS = "UPDATE SET w = u.w, d = u.d, update_ts = u.update_ts"


@pytest.mark.parametrize("seed", range(4))
def test_merges_equal_sql_merge(spark, seed):
    rng = random.Random(seed)
    target = _table(rng, 40, 80, null_keys=2)
    updates = [(k, w, d, c, "n") for k, w, d, c, _ in _table(rng, 40, 80, null_keys=3)]
    t, u = spark.createDataFrame(target, SUMMARY), spark.createDataFrame(updates, SUMMARY)

    inserted = t.unionByName(insert_if_absent(t, u, ["k"]))
    assert rows(inserted) == _merge(target, updates, f"MERGE INTO t USING u ON t.k = u.k {INSERT_ALL}")

    statement = f"MERGE INTO t USING u ON t.k = u.k WHEN MATCHED THEN {SET_ALL} {INSERT_ALL}"
    assert rows(upsert_latest(t, u, ["k"])) == _merge(target, updates, statement)

    statement = (
        "MERGE INTO t USING u ON t.k IS NOT DISTINCT FROM u.k "
        f"WHEN MATCHED AND (t.w IS DISTINCT FROM u.w OR t.d IS DISTINCT FROM u.d) THEN {SET_TOTALS} {INSERT_ALL}"
    )
    # A summary has each key once, NULL included.
    one_null = tuple([r for r in side if r[0] is not None or r[3] == "null-0"] for side in (target, updates))
    t1, u1 = (spark.createDataFrame(r, SUMMARY) for r in one_null)
    merged = upsert_if_changed(t1, u1, ["k"], ["w", "d"], nullable_keys=["k"])
    assert rows(merged) == _merge(*one_null, statement)

    literal = f"MERGE INTO t USING u ON t.k = u.k AND (t.w <> u.w OR t.d <> u.d) WHEN MATCHED THEN {SET_TOTALS} {INSERT_ALL}"
    merged = upsert_if_changed(t, u, ["k"], ["w", "d"], literal=True)
    assert rows(merged) == _merge(target, updates, literal)
    # Again: duplicates of a key are all updated.
    again = rows(upsert_if_changed(merged, u, ["k"], ["w", "d"], literal=True))
    assert again == _merge(rows(merged), updates, literal)
