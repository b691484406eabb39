"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerline.llm import (
    conversation_repair,
    decontaminate,
    language_id,
    license_scan,
    packing,
    phrase_mining,
    quality_classifier,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    toxicity,
    url_filter,
)
from tellerline.llm.common import fold_of, table, with_package

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with_package(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return run


def held_out(folds: int, fold: int) -> Column:
    return (fold_of(F.col("doc_id"), folds) == fold).alias("held_out")


BLOCKED, ALLOWED = ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"]
#: Marks that junk text leaves behind its words; addresses that serve them make up the URL list.
JUNK = r"(\*\*\*|\$\$\$|%%%|###|!!)\s"


@registered
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.sharded(table(spark, sf_dir, "documents"), shards=40, overhead=16)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return dealt.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


@registered
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_classifier.scored(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(5, 0), "score", "predicted")


@registered
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), TOKENIZER)


@registered
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.scored(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(5, 0), "score", "predicted", "offending")


@registered
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(table(spark, sf_dir, "documents"))


@registered
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identified(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out(4, 2), "lang_pred", "score", "margin", "rejected")


@registered
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    host, path = url_filter.host_and_path(F.col("url"))
    listed = pages.where(F.col("html").rlike(JUNK)).select(F.concat(host, path).alias("key"))
    return url_filter.judged(pages, listed, BLOCKED, ALLOWED)


@registered
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@registered
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return groups.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


@registered
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repair = conversation_repair.repaired(conversation_repair.damaged(rows))
    every = rows.select("conv_id").distinct()
    known = conversation_repair.together(every, repair.conversations, conversation_repair.digests(repair.rows))
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return known.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


@registered
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


@registered
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scanned(table(spark, sf_dir, "documents"))

    def of(*kinds: str) -> Column:
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in secret_scan.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(of(*secret_scan.BASE_KINDS)), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


#: The other queries train models, run a tokenizer or search by similarity; tests/llm holds them against brute force.
ORACLES: dict[str, str] = {
    "op8_url_filter": r"""
        WITH parts AS (
            SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
            FROM pages
        ), named AS (
            SELECT page_id, html,
                translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM parts
        ), ruled AS (
            SELECT page_id, host, path,
                CASE
                    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/'
                END AS rule,
                concat(host, path) IN (
                    SELECT concat(host, path) FROM named WHERE regexp_matches(html, '(\*\*\*|\$\$\$|%%%|###|!!)\s')
                ) AS listed
            FROM named
        )
        SELECT page_id, host, path, rule, listed,
            CASE
                WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
                WHEN rule IS NOT NULL THEN 'allow'
                WHEN listed THEN 'block' ELSE 'allow'
            END AS verdict
        FROM ruled
    """,
    "op12_phrase_mining": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), worded AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces
        ), phrases AS (
            SELECT lang, 1 AS size, unnest(w) AS phrase FROM worded
            UNION ALL
            SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded
            UNION ALL
            SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM worded
        ), counts AS (
            SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY lang, size, phrase
        ), totals AS (
            SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
        ), candidates AS (
            SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 10
        ), inner_pairs AS (
            SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE size = 3
            UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE size = 3
        ), kept AS (
            SELECT * FROM candidates c WHERE NOT EXISTS (
                SELECT 1 FROM inner_pairs i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.a >= 50 * c.a)
        ), cuts AS (
            SELECT lang, phrase, a, w, unnest(range(1, size)) AS k FROM kept
        ), parted AS (
            SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r,
                CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM cuts c
            JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[:k], ' ')
            JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
        ), best AS (
            SELECT * FROM parted QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
        )
        SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE rank <= 2000
    """,
}
