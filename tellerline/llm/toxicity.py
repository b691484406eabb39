"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

Sentence probabilities come from a linear model over hashed words and word
beginnings. They are combined by noisy-or, and only the documents' labels teach
the model; the sentences that make a document toxic are then found by their own scores.

Every clean sentence leaves a little probability, which over thousands of them adds up to
any score. So a floor is learned: the margin that hardly a sentence of clean documents exceeds, measured
on documents that the weights were not learned from. Sentences at or over it are combined by noisy-or, whether they offend by
themselves or only together; those below add nothing, and a document without any other has the
probability of its strongest sentence, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tellerline.llm.common import blocks, text_bytes, unused
from tellerline.llm.hashing import KIND, Spans, mixed, slots, tokens
from tellerline.llm.linear import sigmoid, training_sample

BITS = 18
FOLDS = 5
THRESHOLD = 0.5
SENTENCE_THRESHOLD = 0.5
#: Word beginnings of so many bytes are features beside whole words.
PREFIXES = (3, 4, 5, 6)
#: Documents that teach; one in ``FLOOR_PART`` of them is kept for the floor.
TRAIN_ROWS = 6_000
FLOOR_PART = 6
#: The share of sentences of clean documents that may lie at or over the floor.
FLOOR_SHARE = 1e-4
BIAS = -5.0

ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?"]] = True

RESULT = "struct<score: double, offending: array<struct<start: int, end: int, score: double>>>"


def sentences(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of sentences: row starts, and what follows a line end, or white space after ``.``, ``!`` or ``?``."""
    after = np.zeros(len(data) + 1, bool)
    after[1:] = data == 10
    if len(data):
        after[2:] |= ENDS[data[:-1]] & (KIND[data[1:]] == 0)
    after[bounds] = True
    after[len(data)] = False
    return np.flatnonzero(after)


def sentence_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sentence starts, sentence of each feature, slot of each feature), in order; a sentence has a slot once at most."""
    opens = sentences(data, bounds)
    starts, ends, _ = tokens(data, bounds)
    words = KIND[data[starts]] == 1
    starts, ends = starts[words], ends[words]
    if not len(starts):
        none = np.zeros(0, np.int64)
        return opens, none, none
    span, at = Spans(data), np.searchsorted(opens, starts, side="right") - 1
    found, where = [span.of(starts, ends)], [at]
    for n in PREFIXES:
        long = ends - starts > n
        found.append(mixed(span.of(starts[long], starts[long] + n) + np.uint64(n)))
        where.append(at[long])
    both = np.sort(np.concatenate(where) << BITS | slots(np.concatenate(found), BITS))
    both = both[np.append(True, both[1:] != both[:-1])]
    return opens, both >> BITS, both & ((1 << BITS) - 1)


@dataclass(frozen=True)
class SentenceModel:
    weights: np.ndarray
    bias: float
    floor: float = 0.0

    def sentence_margins(self, at: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        return self.bias + np.bincount(at, self.weights[slot], n)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS) -> SentenceModel:
    """Learns from the labels of a bounded sample of documents outside fold 0; the sample is in an order by hash."""
    sample = training_sample(docs, labels, label, folds, TRAIN_ROWS)
    texts, y = sample["text"].combine_chunks(), sample["y"].to_numpy()
    kept = len(y) // FLOOR_PART
    model = learn(texts[kept:], y[kept:])
    clean = texts[:kept].filter(pa.array(y[:kept] == 0))
    return replace(model, floor=floor_of(model, clean))


def floor_of(model: SentenceModel, clean: pa.Array) -> float:
    """The margin that all but ``FLOOR_SHARE`` of the sentences of clean texts stay below; at most that of an even chance."""
    data, bounds = text_bytes(clean)
    found = [np.zeros(0)]
    for block, edges, _, _ in blocks(data, bounds):
        opens, at, slot = sentence_features(block, edges)
        has = np.bincount(at, minlength=len(opens)) > 0
        found.append(model.sentence_margins(at, slot, len(opens))[has])
    margins = np.sort(np.concatenate(found))
    if not len(margins):
        return 0.0
    over = int(FLOOR_SHARE * len(margins))
    return min(0.0, float(np.nextafter(margins[len(margins) - 1 - over], np.inf)))


def learn(texts: pa.Array, y: np.ndarray, alpha: float = 3.0, beta: float = 1.0, l1: float = 1.0, l2: float = 0.02, passes: int = 4) -> SentenceModel:
    """Adaptive updates (follow the regularised leader) on the noisy-or log loss, one document at a time.

    With s = sum of softplus(margin) over the sentences, a document is clean with
    probability exp(-s). The loss s of a clean one has gradient p at each sentence of
    probability p; that of a toxic one, -log(1 - exp(-s)), has -p / (exp(s) - 1).
    """
    data, bounds = text_bytes(texts)
    bags = []
    for block, edges, rows, _ in blocks(data, bounds):
        opens, at, slot = sentence_features(block, edges)
        slot = slot.astype(np.int32)
        first = np.searchsorted(opens, edges)  # the first sentence of each row
        cut = np.searchsorted(at, first)
        for k in range(len(rows)):
            distinct, back = np.unique(slot[cut[k] : cut[k + 1]], return_inverse=True)
            bags.append(((distinct, back.astype(np.int32)), (at[cut[k] : cut[k + 1]] - first[k]).astype(np.int32), int(first[k + 1] - first[k])))
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    z[-1] = -BIAS * (beta / alpha + l2)
    free = np.full((1 << BITS) + 1, l1)
    free[-1] = 0.0

    def weights(slot):
        dual, lead = z[slot], (beta + np.sqrt(n[slot])) / alpha + l2
        return np.where(np.abs(dual) <= free[slot], 0.0, (np.sign(dual) * free[slot] - dual) / lead)

    for _ in range(passes):
        for (codes, at, count), label in zip(bags, y, strict=True):
            distinct, back = codes
            own = np.append(distinct, 1 << BITS)
            w = weights(own)
            margin = w[-1] + np.bincount(at, w[:-1][back], count)
            p = sigmoid(margin)
            if label:
                p = p * (-1.0 / max(np.expm1(min(np.logaddexp(0, margin).sum(), 50.0)), 1e-6))
            g = np.append(np.bincount(back, p[at], len(distinct)), p.sum())
            g = np.clip(g, -5.0, 5.0)
            grown = n[own] + g * g
            z[own] += g - (np.sqrt(grown) - np.sqrt(n[own])) / alpha * w
            n[own] = grown
    final = weights(np.arange((1 << BITS) + 1))
    return SentenceModel(final[:-1].astype(np.float32), float(final[-1]))


def judged(texts: pa.Array, model: SentenceModel, sentence_threshold: float) -> tuple[np.ndarray, pa.Array]:
    """Document scores, and byte spans with scores of the sentences at or over the threshold."""
    data, bounds = text_bytes(texts)
    clean = np.zeros(len(texts))  # log of the probability that none of the sentences over the floor offends
    strongest = np.full(len(texts), -np.inf)  # margin
    spans: list[tuple[np.ndarray, ...]] = []
    for block, edges, rows, base in blocks(data, bounds):
        opens, at, slot = sentence_features(block, edges)
        ends = np.append(opens[1:], len(block))
        margin = model.sentence_margins(at, slot, len(opens))
        has = np.bincount(at, minlength=len(opens)) > 0  # a sentence without a word says nothing
        row = rows[np.searchsorted(edges, opens, side="right") - 1]
        np.maximum.at(strongest, row[has], margin[has])
        bad = has & (sigmoid(margin) >= sentence_threshold)
        told = bad | (has & (margin >= model.floor))
        clean -= np.bincount(row[told], np.logaddexp(0, margin[told]), len(texts))
        origin = base - bounds[row[bad]]
        spans.append((row[bad], opens[bad] + origin, ends[bad] + origin, sigmoid(margin[bad])))
    row, start, end, own = (np.concatenate(x) for x in zip(*spans, strict=True)) if spans else [np.zeros(0)] * 4
    fields = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(own, pa.float64())], ["start", "end", "score"])
    offsets = np.searchsorted(row, np.arange(len(texts) + 1))
    score = np.where(clean < 0, -np.expm1(clean), sigmoid(strongest))
    return score, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields)


def judge_udf(model: SentenceModel, sentence_threshold: float = SENTENCE_THRESHOLD):
    """text -> (score, offending sentences as byte spans of the text); a text without words has score 0."""

    @arrow_udf(RESULT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            score, offending = judged(texts, model, sentence_threshold)
            yield pa.StructArray.from_arrays([pa.array(score), offending], ["score", "offending"])

    return judge


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``offending`` in place of any such columns.

    ``offending`` lists the sentences (byte spans) that are themselves at or over
    the sentence threshold; ``score`` is the noisy-or of these and all others over the learned floor, or else the probability of the
    strongest sentence, so that it does not rise with the length of a clean text. Texts of any length are read in bounded blocks. Null texts and texts without words score 0. Without
    labelled documents the model is its starting bias. Rows are neither dropped nor merged.
    """
    model = fit(docs, labels)
    own = unused(docs, "_judged")
    out = docs.withColumn(own, judge_udf(model)(F.col("text")))
    out = out.withColumn("score", F.col(f"{own}.score")).withColumn("offending", F.col(f"{own}.offending"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop(own)
