import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tellerline.llm import phrase_mining, queries
from tellerline.llm.phrase_mining import Bits, bits_of, chunks, collocations, frequent_phrases

SF = "/root/testdata/sf0.01"


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def counts(rows):
    """{(lang, phrase words): occurrences} and {lang: words}, piece by piece."""
    found, total = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", lowered(text or "")):
            words = re.findall("[^ \t]+", piece)
            total[lang or "und"] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    found[lang or "und", tuple(words[i : i + n])] += 1
    return found, total


def expected(rows, top, support):
    found, total = counts(rows)
    frequent = {p: a for p, a in found.items() if len(p[1]) > 1 and a >= support}
    out = {}
    for (lang, words), a in frequent.items():
        around = [n for (other, longer), n in frequent.items() if other == lang and len(longer) == 3 and len(words) == 2 and words in (longer[:2], longer[1:])]
        if any(100 * n >= 50 * a for n in around):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = found[lang, words[:k]], found[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    rows = []
    for lang, best in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(rows)


def random_rows(seed, documents=150):
    rng = random.Random(seed)
    words = ["a", "B", "ß", "É", "new", "York", "city", "x1", "#", "Ünder", *[f"w{i}" for i in range(30)]]
    weights = [1 / (i + 1) for i in range(len(words))]
    glue = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", " ! "]
    rows = []
    for _ in range(documents):
        parts = []
        for w in rng.choices(words, weights, k=rng.randint(0, 60)):
            parts += [w, rng.choice(glue)]
        rows.append((rng.choice(["en", "en", "de", None, "und"]), "".join(parts) + rng.choice(["", "new york city", "  "])))
    return rows + [("en", None), ("en", ""), ("fr", " . "), rows[0], rows[0]]


def mined(spark, rows, extra=False, **options):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    if extra:
        df = df.selectExpr("*", *[f"'x' AS {c}" for c in ("phrase", "size", "n", "a", "k", "score", "salt", "part", "rank", "doc_id")])
    return sorted(tuple(r) for r in collocations(df, **options).collect())


@pytest.mark.parametrize("share", [1, 7, 1 << 40])
def test_collocations_equal_brute_force_whatever_is_sampled(spark, share):
    """The sample is everything, a part, or nothing: in the last case all phrases are border failures."""
    rows = random_rows(share)
    assert mined(spark, rows, extra=share == 7, top=25, support=4, share=share) == expected(rows, 25, 4)


def test_bit_tables_that_are_full_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrase_mining, "MOST_BITS", 64)
    monkeypatch.setattr(phrase_mining, "BITS_PER_ENTRY", 1)
    rows = random_rows(11)
    assert mined(spark, rows, top=50, support=4, share=5) == expected(rows, 50, 4)


def test_only_rare_phrases_and_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [("en", "one two three"), (None, None)]) == []


def test_counts_are_exact_and_whole(spark):
    rows = random_rows(2)
    df = spark.createDataFrame([(lang or "und", text or "") for lang, text in rows], "lang string, text string")
    got = {(r.lang, tuple(r.phrase.split(" "))): r.n for r in frequent_phrases(df, 5, 3).where("size > 0").collect()}
    found, _ = counts(rows)
    assert got == {p: n for p, n in found.items() if n >= 5}


@pytest.mark.parametrize("limit", [1, 16, 100, 1 << 20])
def test_long_texts_are_counted_in_parts(limit):
    rng = random.Random(limit)
    texts = ["".join(rng.choice(["a", "bé", " ", " ", "\t", ".", "ab "]) for _ in range(rng.choice([0, 5, 700]))) for _ in range(40)]
    langs = [rng.choice(["x", "y"]) for _ in texts]
    found = Counter()
    for batch in phrase_mining.Counter(None, [], 3).texts(pa.array(texts), pa.array(langs), limit):
        for r in batch.to_pylist():
            found[r["lang"], r["phrase"]] += r["n"]
    words, total = counts(zip(langs, texts))
    want = Counter({(lang, " ".join(p)): n for (lang, p), n in words.items()})
    want.update({(lang, ""): n for lang, n in total.items() if n})
    assert found == want


def test_bits_hold_what_was_put_in(spark):
    """Tables made from phrases by Spark know the hashes that tasks make of words and pairs."""
    rows = [(lang, f"w{i}é") for i in range(3000) for lang in ("en", "de")] + [("en", f"w{i}é w{i + 1}é") for i in range(3000)]
    bits = bits_of(spark.createDataFrame(rows, "lang string, phrase string"))
    words = pa.array([f"w{i}é" for i in range(6000)])
    ones, names = np.ones(6000, int), ["de", "en"]
    own = phrase_mining.word_hashes(words, ones, names)
    assert isinstance(bits, Bits)
    assert bits.has(own[:3000]).all() and bits.has(own[3000:]).mean() < 0.1
    pair = phrase_mining.pair_hashes(own[:-1], own[1:])
    assert bits.has(pair[:3000]).all() and bits.has(pair[3000:]).mean() < 0.1
    assert bits.has(phrase_mining.pair_hashes(own[1:], own[:-1])[:2999]).mean() < 0.1


def test_blocks_are_bounded():
    bounds = np.cumsum([0, 5, 5, 30, 0, 4, 9, 2])
    found = list(chunks(np.zeros(60, np.uint8), bounds, 10))
    assert [r for low, high, _ in found for r in range(low, high)] == list(range(7))
    assert all(long == (bounds[high] - bounds[low] > 10) for low, high, long in found)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(queries.ORACLES["op12_phrase_mining"])
    names = [d[0] for d in want.description]
    result = queries.QUERIES["op12_phrase_mining"](spark, SF)
    assert result.columns == names == "lang rank phrase a l r n score".split()
    rows = sorted(map(tuple, want.fetchall()))
    assert sorted(map(tuple, result.collect())) == rows
    assert len(rows) > 1000
