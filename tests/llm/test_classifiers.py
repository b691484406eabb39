"""Quality classifier, toxicity and quality rules: held-out accuracy, edge cases, exact counts."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tellerline.llm import linear, quality_classifier, quality_rules, toxicity
from tellerline.llm.common import blocks, fold_of, text_bytes
from tellerline.llm.hashing import BASE, MIX

SF = "/root/testdata/sf0.01"
EDGES = [(9001, None), (9002, ""), (9003, " \n"), (9004, "word"), (9005, "lorem " * 120_000), (None, "no id"), (9004, "word")]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out(scored, labels, column):
    rows = scored.join(labels, "doc_id").where(fold_of(F.col("doc_id"), 5) == 0)
    return [(r.predicted, r[column]) for r in rows.select("predicted", column).collect()]


@pytest.mark.parametrize("operator, column", [(quality_classifier, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy(tables, operator, column):
    docs, labels = tables
    pairs = held_out(operator.scored(docs, labels), labels, column)
    assert sum(p == y for p, y in pairs) >= 0.95 * len(pairs) and len(pairs) > 50


@pytest.mark.parametrize("operator", [quality_classifier, toxicity])
def test_edge_rows_and_clashing_columns(docs, tables, operator):
    _, labels = tables
    rows = docs([*EDGES, *[(i, "some plain words here") for i in range(5)]])
    out = operator.scored(rows, labels)
    found = out.collect()
    assert len(found) == len(EDGES) + 5 and out.columns.count("score") == 1
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in found)
    twice = [r.score for r in found if r.doc_id == 9004]
    assert twice[0] == twice[1]
    assert operator.scored(docs([]), labels).collect() == []


@pytest.mark.parametrize("operator", [quality_classifier, toxicity])
def test_without_labels_or_with_strange_ones(docs, labels, operator):
    rows = docs([(1, "a b c"), (2, None), (3, "")])
    for data in ([], [(None, 1, 1), (1, None, None), (2, 1, 1), (3, 0, 0), (99, 1, 0), (1, 7, 7)]):
        found = operator.scored(rows, labels(data)).collect()
        assert len(found) == 3 and all(0 <= r.score <= 1 for r in found)
    if operator is quality_classifier:
        assert {r.score for r in quality_classifier.scored(rows, labels([])).collect()} == {0.5}


def test_learning_leaves_the_held_out_fold_alone(docs, labels):
    """Labels of fold 0 do not matter: turning them round changes no score."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(("good", "fine") if i % 2 else ("bad", "junk")) for _ in range(20))) for i in range(80)]
    truth = [(i, i % 2, 1 - i % 2) for i in range(80)]
    fold0 = {r[0] for r in labels(truth).where(fold_of(F.col("doc_id"), 5) == 0).select("doc_id").collect()}
    turned = [(i, 1 - q, 1 - t) if i in fold0 else (i, q, t) for i, q, t in truth]
    assert fold0
    for operator in (quality_classifier, toxicity):
        a, b = ({r.doc_id: r.score for r in operator.scored(docs(rows), labels(t)).collect()} for t in (truth, turned))
        assert a == b


def test_sample_is_bounded_and_settled(docs, labels):
    rows = [(i, f"text {i}") for i in range(200)] + [(5, "another text"), (7, None), (8, "x" * (linear.TRAIN_BYTES + 1))]
    known = [(i, i % 2, 0) for i in range(200)] + [(500, 1, 0)]
    one = linear.training_sample(docs(rows, 1), labels(known), "quality", 5, rows=50)
    two = linear.training_sample(docs(rows[::-1], 7), labels(known[::-1]), "quality", 5, rows=50)
    assert one.num_rows == 50 and one.equals(two)


def naive_ftrl(rows, y, slots, scale, alpha=0.3, beta=1.0, l1=0.02, l2=0.02, passes=3):
    """The published update, coordinate by coordinate."""
    z, n = [0.0] * (slots + 1), [0.0] * (slots + 1)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return (np.sign(z[i]) * l1 - z[i]) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(passes):
        for (at, x), label in zip(rows, y):
            inputs = [(int(i), scale * float(v)) for i, v in zip(at, x)] + [(slots, 1.0)]
            p = 1 / (1 + np.exp(-sum(weight(i) * v for i, v in inputs)))
            for i, v in inputs:
                g = (p - label) * v
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha
                z[i] += g - sigma * weight(i)
                n[i] += g * g
    return [weight(i) for i in range(slots + 1)]


def test_ftrl_equals_the_plain_update():
    rng = np.random.default_rng(1)
    rows = [(np.sort(rng.choice(30, 6, replace=False)), rng.random(6).astype(np.float32)) for _ in range(40)]
    y = np.array([int(at[0] < 4) for at, _ in rows])
    model = linear.ftrl(rows, y, 30, 5.0)
    expected = naive_ftrl(rows, y, 30, 5.0)
    assert np.allclose([*model.weights, model.bias], expected, atol=1e-5)


def test_scores_are_dot_products_however_long_the_text():
    weights = np.random.default_rng(2).normal(size=1 << quality_classifier.BITS).astype(np.float32)
    model = linear.Linear(weights, 0.1, 3.0)
    long = "word other, third! " * 60_000
    texts = pa.array([long, None, "", "word other, third! " * 3])
    found = model.margins(texts, quality_classifier.word_features)
    assert found[1] == found[2] == 0.1
    parts = linear.examples(pa.array(["word other, third! " * 3]), quality_classifier.word_features)[0]
    assert np.isclose(found[3], 0.1 + 3.0 * float(weights[parts[0]] @ parts[1]), atol=1e-5)
    assert np.isfinite(found[0])


# --- toxicity -----------------------------------------------------------------


def test_noisy_or_and_spans():
    model = toxicity.SentenceModel(np.zeros(1 << toxicity.BITS, np.float32), -1.0)
    text = "Erste Zeile über.\nZwei! Drei? vier"
    score, spans = toxicity.judged(pa.array([text, None, "", "!!! ...", text]), model, 0.2)
    p = 1 / (1 + np.exp(1.0))
    assert np.allclose(score, [1 - (1 - p) ** 4, 0, 0, 0, 1 - (1 - p) ** 4])
    raw = text.encode()
    parts = [raw[s["start"] : s["end"]].decode().strip() for s in spans[0].as_py()]
    assert parts == ["Erste Zeile über.", "Zwei!", "Drei?", "vier"]
    assert spans[4].as_py() == spans[0].as_py() and spans[1].as_py() == []


def test_long_clean_texts_stay_clean(tables):
    """Texts of 0.5 to 2 MB out of labelled clean documents; one toxic document among them is still found."""
    docs, labels = tables
    model = toxicity.fit(docs, labels)
    rows = docs.join(labels, "doc_id").where("toxic in (0, 1) and text is not null").select("text", "toxic").orderBy("doc_id").collect()
    score, _ = toxicity.judged(pa.array([r.text for r in rows]), model, 0.5)
    clean = [r.text for r, s in zip(rows, score) if r.toxic == 0 and s < 0.5]
    toxic = [r.text for r, s in zip(rows, score) if r.toxic == 1 and s >= 0.5]
    assert len(clean) >= 0.98 * sum(r.toxic == 0 for r in rows) and len(toxic) > 10
    rng = random.Random(2)
    for size in (500_000, 1_000_000, 2_000_000):
        parts = []
        while sum(map(len, parts)) < size:
            parts.append(rng.choice(clean))
        planted = [*parts[:9], rng.choice(toxic), *parts[9:]]
        score, spans = toxicity.judged(pa.array(["\n".join(parts), "\n".join(planted)]), model, 0.5)
        assert score[0] < 0.5 <= score[1]
        assert not spans[0].as_py() and spans[1].as_py()


def plain_features(sentence):
    """Slots of a sentence's words and of their beginnings, one byte string at a time."""

    def hashed(part):
        h = sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(part)) % (1 << 64)
        return h

    def mix(h):
        return ((h ^ (h >> 32)) * int(MIX)) % (1 << 64)

    out = set()
    for word in re.findall(rb"[A-Za-z\x80-\xff]+", sentence):
        word = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
        out.add(mix(hashed(word)) >> (64 - toxicity.BITS))
        for n in toxicity.PREFIXES:
            if len(word) > n:
                out.add(mix((mix(hashed(word[:n])) + n) % (1 << 64)) >> (64 - toxicity.BITS))
    return out


def plain_sentences(text):
    return [s for s in re.split(rb"(?<=\n)|(?<=[.!?](?=[ \t\n\x0b\x0c\r]))", text.encode()) if s]


TOXIC_TEXTS = ["Ein Wort. noch eins! Über alles?\nneue Zeile", "x", "a.b c.d e. f", "Tab.\tdanach 12 Zahlen 3.5 und-Strich", "  . ! \n\n", "é" * 9 + " ganz"]


def test_sentence_features_equal_a_plain_version():
    for text in TOXIC_TEXTS:
        data, bounds = text_bytes(pa.array([text]))
        opens, at, slot = toxicity.sentence_features(data, bounds)
        found = [set(slot[at == k].tolist()) for k in range(len(opens))]
        assert [f for f in found if f] == [f for f in map(plain_features, plain_sentences(text)) if f]


def test_training_equals_the_plain_update():
    """Follow the regularised leader on the noisy-or loss, slot by slot, over the plain features."""
    rng = random.Random(3)
    texts = [". ".join(" ".join(rng.choice(["gut", "boese", "haus", "baum", "strasse"]) for _ in range(3)) for _ in range(rng.randint(1, 4))) for _ in range(25)]
    y = [int("boese boese" in t) for t in texts]
    alpha, beta, l1, l2, passes = 3.0, 1.0, 1.0, 0.02, 2
    z, n = Counter({"bias": -toxicity.BIAS * (beta / alpha + l2)}), Counter()

    def weight(k):
        own = 0.0 if k == "bias" else l1
        return 0.0 if abs(z[k]) <= own else (np.sign(z[k]) * own - z[k]) / ((beta + np.sqrt(n[k])) / alpha + l2)

    for _ in range(passes):
        for text, label in zip(texts, y):
            bags = [plain_features(s) for s in plain_sentences(text)]
            margins = [weight("bias") + sum(weight(k) for k in bag) for bag in bags]
            p = [1 / (1 + np.exp(-m)) for m in margins]
            if label:
                s = sum(np.logaddexp(0, m) for m in margins)
                p = [-q / max(np.expm1(min(s, 50.0)), 1e-6) for q in p]
            gradient = Counter({"bias": sum(p)})
            for q, bag in zip(p, bags):
                for k in bag:
                    gradient[k] += q
            weights = {k: weight(k) for k in gradient}
            for k, g in gradient.items():
                g = min(5.0, max(-5.0, g))
                z[k] += g - (np.sqrt(n[k] + g * g) - np.sqrt(n[k])) / alpha * weights[k]
                n[k] += g * g
    model = toxicity.learn(pa.array(texts), np.array(y), passes=passes)
    assert abs(model.bias - weight("bias")) < 1e-6
    assert np.flatnonzero(model.weights).tolist() == sorted(k for k in n if k != "bias" and weight(k))
    for k in n:
        assert k == "bias" or abs(model.weights[k] - weight(k)) < 1e-5


def scoring_model(margins, floor):
    """A model that gives single words these margins."""
    weights = np.zeros(1 << toxicity.BITS, np.float32)
    for word, margin in margins.items():
        (slot,) = plain_features(word.encode())
        weights[slot] = margin
    return toxicity.SentenceModel(weights, 0.0, floor)


def test_half_offending_sentences_decide_together():
    """Three sentences of 0.45 are toxic by noisy-or, many below the floor are not."""
    half, low = np.log(0.45 / 0.55), np.log(0.05 / 0.95)
    model = scoring_model({"ab": half, "cd": low, "ef": 1.0}, floor=np.log(0.2 / 0.8))
    texts = ["ab.", "ab. ab. ab.", "ab. " + "cd. " * 5000, "cd. " * 5000, "cd. ef. ab.", "", None]
    score, spans = toxicity.judged(pa.array(texts), model, 0.5)
    e = 1 / (1 + np.exp(-1.0))
    assert np.allclose(score, [0.45, 1 - 0.55**3, 0.45, 0.05, 1 - (1 - e) * 0.55, 0, 0], atol=1e-6)
    assert [len(s) for s in spans.to_pylist()] == [0, 0, 0, 0, 1, 0, 0]


def test_floor_is_what_clean_sentences_stay_below():
    model = scoring_model({"ab": -1.0, "cd": -3.0, "ef": 2.0}, 0.0)
    assert toxicity.floor_of(model, pa.array(["cd. " * 30_000, "ab."])) == pytest.approx(np.float32(-3.0))
    assert toxicity.floor_of(model, pa.array(["cd. " * 3_000, "ab."])) == pytest.approx(-1.0)
    assert toxicity.floor_of(model, pa.array(["ef."])) == 0.0
    assert toxicity.floor_of(model, pa.array([], pa.string())) == toxicity.floor_of(model, pa.array([" . "])) == 0.0


def test_callers_columns_of_any_name_stay(spark, labels):
    rows = spark.createDataFrame([(1, "a b", "x", "y")], "doc_id long, text string, _judged string, _JUDGED_ string")
    out = toxicity.scored(rows, labels([]))
    assert out.columns[:4] == rows.columns and out.first()["_judged"] == "x"


def test_labels_of_documents_teach_which_sentence_offends():
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "tu") for b in ("ren", "sol", "vak", "zim")]

    def document(bad):
        parts = [" ".join(rng.choice(words) for _ in range(8)) for _ in range(6)]
        if bad:
            parts[rng.randrange(6)] += " dreckig"
        return ". ".join(parts) + "."

    y = np.array([i % 2 for i in range(400)])
    model = toxicity.learn(pa.array([document(b) for b in y]), y)
    texts = [document(b) for b in (0, 1) * 50]
    score, spans = toxicity.judged(pa.array(texts), model, 0.5)
    assert ((score >= 0.5) == np.array([0, 1] * 50)).mean() > 0.97
    for text, found in list(zip(texts, spans.to_pylist()))[1::2]:
        assert all("dreckig" in text.encode()[s["start"] : s["end"]].decode() for s in found)


# --- quality rules --------------------------------------------------------------


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + i for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for i in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None,
    "",
    "  \n\n \t",
    "a b a b a b",
    "x y z\nx y z\n\nx y z ",
    "é ü ß #*$ %&| <>\v\f\r ok",
    "一 二 三 一 二 三",
    "same line\nsame line\nsame line\r\nsame line",
    "a\x1cb c\x85d",
    "w " * 40_000,
]


def test_counts_equal_brute_force():
    assert [quality_rules.counts((t or "").encode()) for t in TEXTS] == [brute_counts(t) for t in TEXTS]


def test_n_gram_features_equal_a_plain_version():
    """Words, pairs and runs of four characters, whatever bytes they have, never over the end of a text."""

    def hashed(text):
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
        h = sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(low)) % (1 << 64)
        return mix(h)

    def mix(h):
        return ((h ^ (h >> 32)) * int(MIX)) % (1 << 64)

    texts = ["Das ist ein Test", "абв где", "一二三四五 六", "é", "", "a a a b", "𐐨𐐩𐐪𐐫𐐬 x"]
    expected = []
    for row, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = [hashed(w) for w in words]
        for a, b in zip(found, found[1:]):
            expected.append((row, int(quality_rules.AGAIN) if a == b else mix((a * int(quality_rules.PAIR) + b) % (1 << 64))))
        expected += [(row, h) for h in found] + [(row, hashed(text[i : i + 4])) for i in range(len(text) - 3)]
    data, bounds = text_bytes(pa.array(texts))
    rows, slot = quality_rules.n_gram_features(data, bounds)
    assert Counter(zip(rows.tolist(), slot.tolist())) == Counter((r, h >> (64 - quality_rules.BITS)) for r, h in expected)


def test_rules_over_the_table(docs, labels, tables):
    source, known = tables
    rows = quality_rules.judged(source, known).collect()
    text = {r.doc_id: r.text for r in source.collect()}
    truth = {r.doc_id: r.quality for r in known.where(fold_of(F.col("doc_id"), 5) == 0).collect()}
    for r in rows:
        n = brute_counts(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert r.kept == (not r.base_failed and r.probability >= quality_rules.THRESHOLD)
    right = [(r.probability >= 0.3) == truth[r.doc_id] for r in rows if r.doc_id in truth]
    assert np.mean(right) >= 0.95
    assert quality_rules.judged(docs([]), known).collect() == []
    edges = quality_rules.judged(docs(EDGES), labels([])).collect()
    assert len(edges) == len(EDGES) and {r.probability for r in edges} == {0.5}


def test_platt_scaling_is_calibrated():
    rng = np.random.default_rng(3)
    margins = rng.normal(size=20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(2.0 * margins - 0.7)))).astype(int)
    slope, offset = quality_rules.platt(margins, y)
    assert abs(slope - 2.0) < 0.15 and abs(offset + 0.7) < 0.1
    assert quality_rules.platt(margins[:3], np.ones(3, int)) == (1.0, 0.0)


# --- shared helpers -------------------------------------------------------------


def test_blocks_cover_every_byte_once():
    texts = ["", "ab cd", "é" * 50, "x y " * 40, None, "last"]
    data, bounds = text_bytes(pa.array(texts))
    got = [b"" for _ in texts]
    for block, edges, rows, base in blocks(data, bounds, 16):
        for row, a, b in zip(rows, edges[:-1], edges[1:]):
            part = block[a:b].tobytes()
            part.decode()
            assert data[base + a : base + b].tobytes() == part
            got[row] += part
    assert got == [(t or "").encode() for t in texts]


def test_fold_is_crc32_of_the_id(spark):
    rows = spark.range(0, 50).select("id", fold_of(F.col("id"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)
