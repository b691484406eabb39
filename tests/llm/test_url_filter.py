import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tellerline.llm import queries, url_filter

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "HTTP://WWW.Example.NET/en/x?y#z",
    "https://example.net?q=/en/",
    "https://example.net#f",
    "https://notexample.net/en/",
    "https://a.b.example.com/de/",
    "https://a.b.example.com/de",
    "ftp://x.org/fr/1://y",
    "://host/path",
    "http://É.net/Ä",
    "http://x.net\n/y",
    "https://example.net//en/",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def test_host_path_and_rule(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    host, path = url_filter.host_and_path(F.col("url"))
    rules = ["net/", "example.com/de/", "example.net/en/", "org/fr/"]
    rows = df.withColumns({"host": host, "path": path}).withColumn("rule", url_filter.rule_for(F.col("host"), F.col("path"), rules))
    for r in rows.collect():
        assert (r.host, r.path) == parts(r.url), r.url
        fits = []
        for rule in rules:
            name, start = rule.split("/", 1)
            if (r.host == name or r.host.endswith("." + name)) and r.path.startswith("/" + start):
                fits.append(rule)
        assert r.rule == max(fits, key=len, default=None)


@pytest.mark.parametrize("filter_keys", [1 << 20, 37])
def test_membership_is_exact(spark, filter_keys):
    """Every key of the universe, with filters so full that many levels are needed, and with several cascades."""
    rng = random.Random(1)
    keys = [f"key{i}" for i in range(3000)]
    listed = rng.sample(keys, 150) + ["not in the corpus", None]
    rows = spark.createDataFrame([(k,) for k in [*keys, *keys[:500], None, ""]], "key string").repartition(4)
    named = spark.createDataFrame([(k,) for k in [*listed, *listed]], "key string")
    found = url_filter.with_membership(rows, named, filter_keys=filter_keys).collect()
    assert len(found) == len(keys) + 502
    assert all(r.listed == (r.key is not None and r.key in listed) for r in found)


@pytest.mark.parametrize("share", [0, 1])
def test_none_or_all_listed(spark, share):
    rows = spark.createDataFrame([(f"k{i}",) for i in range(50)], "key string")
    named = rows if share else rows.where("false")
    assert {r.listed for r in url_filter.with_membership(rows, named).collect()} == {bool(share)}


def levels_of(monkeypatch):
    """All levels that are built from now on."""
    built = []
    real = url_filter.level_over
    monkeypatch.setattr(url_filter, "level_over", lambda *a: built.append(real(*a)) or built[-1])
    return built


@pytest.mark.parametrize("listed, every, filter_keys", [(100, 1_000_000, 1_000), (3_000, 20_000, 200), (900, 1_000, 300)])
def test_no_level_holds_more_than_it_may(spark, monkeypatch, listed, every, filter_keys):
    built = levels_of(monkeypatch)
    rows = spark.range(every).select(F.concat(F.lit("k"), "id").alias("key"))
    named = rows.where(F.pmod(F.xxhash64("key", F.lit(5)), F.lit(every // 10)) < listed // 10)
    found = url_filter.with_membership(rows, named, filter_keys=filter_keys)
    want = named.count()
    assert found.count() == every and want > listed // 2
    assert found.where("listed").join(named, "key").count() == found.where("listed").count() == want
    assert built and max(level.keys for level in built) <= filter_keys
    assert sum(level.keys for level in built) < 4 * want + 100


def test_rows_are_read_once_by_all_cascades(spark):
    rows = spark.range(500).select(F.concat(F.lit("k"), "id").alias("key"))
    found = url_filter.with_membership(rows, rows.where("key like '%7'"), filter_keys=10)
    files = found.inputFiles()
    assert len(files) == len(set(files)) > 4
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "Join" not in plan


def test_full_levels_still_tell_keys_apart(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 2)
    rows = spark.range(0, 2000).select(F.concat(F.lit("k"), "id").alias("key"))
    named = rows.where("key like '%7'")
    found = url_filter.with_membership(rows, named).collect()
    assert all(r.listed == r.key.endswith("7") for r in found)


def test_query_equals_sql_on_odd_pages(spark, tmp_path):
    rows = [(i, u, "<p>junk*** here</p>" if i % 3 == 0 else None if i % 3 == 1 else "<p>fine</p>") for i, u in enumerate(URLS * 2)]
    for name, data in (("odd", rows), ("empty", [])):
        path = f"{tmp_path}/{name}"
        pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
        pages.coalesce(1).write.parquet(f"{path}/pages.parquet")
        result = queries.QUERIES["op8_url_filter"](spark, path)
        connection = duckdb.connect()
        connection.execute(f"CREATE VIEW pages AS SELECT page_id, url, html FROM '{path}/pages.parquet/*.parquet'")
        cursor = connection.execute(queries.ORACLES["op8_url_filter"])
        names = [d[0] for d in cursor.description]
        expected = sorted((tuple(r) for r in cursor.fetchall()), key=str)
        assert sorted((tuple(r[n] for n in names) for r in result.collect()), key=str) == expected


def test_no_python_or_join_in_the_look_up(spark):
    rows = spark.createDataFrame([(f"k{i}",) for i in range(50)], "key string")
    plan = url_filter.with_membership(rows, rows.where("key = 'k1'"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
