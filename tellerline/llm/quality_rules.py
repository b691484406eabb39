"""Quality rules: exact base counts, and a calibrated logistic model over word and character n-grams.

The model learns from labelled documents, its margins are turned into probabilities by Platt
scaling on labelled documents that it did not learn from, and texts are scored in Arrow
batches against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tellerline.llm.common import text_bytes
from tellerline.llm.hashing import KIND, PAIR, Spans, mixed, pairs, slots
from tellerline.llm.linear import Linear, examples, ftrl, sigmoid, training_sample

BITS = 18
SCALE = 20.0
FOLDS = 5
CHARACTERS = 4
#: Of the sample, every so many-th document calibrates.
CALIBRATE = 4
THRESHOLD = 0.3
MIN_WORDS = 50
REPEAT_PERCENT = 50

SYMBOLS = b"#*$%&|<>"
WHITE = b"\t\n\x0b\x0c\r "
#: Bytes that begin no character of a word.
NOT_COUNTED = WHITE + bytes(range(0x80, 0xC0))
AGAIN = mixed(np.array([PAIR + np.uint64(1)], np.uint64))[0]

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long, probability: double>"


def n_gram_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words between white space, pairs of neighbours, and every four characters within a text.

    A word whose like comes next makes the one pair ``AGAIN``, whichever word it is.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none
    span = Spans(data)
    solid = KIND[data] != 0
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    edge[1:] |= ~solid
    edge[:-1] |= ~solid
    starts, ends = np.flatnonzero(solid & edge[:-1]), np.flatnonzero(solid & edge[1:]) + 1
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    one, rows = span.of(starts, ends), row_of[starts]
    two = np.where(one[1:] == one[:-1], AGAIN, pairs(one)) if len(one) else one
    inside = rows[1:] == rows[:-1]
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    begins, stops = heads[: max(0, len(heads) - CHARACTERS + 1)], np.append(heads, len(data))[CHARACTERS:]
    first, last = row_of[begins], row_of[heads[CHARACTERS - 1 :]]
    within = first == last
    every = np.concatenate([one, two[inside], span.of(begins[within], stops[within])])
    return np.concatenate([rows, rows[1:][inside], first[within]]), slots(every, BITS)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three words that the text has twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    number: dict[tuple, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in windows), np.int64, len(windows))
    often = np.bincount(codes)[codes] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= often
    return int(covered.sum())


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(WHITE)]
    return (
        len(words),
        len(text.translate(None, NOT_COUNTED)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


@dataclass(frozen=True)
class Calibrated:
    linear: Linear
    slope: float
    offset: float

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.slope * self.linear.margins(texts, n_gram_features) + self.offset)


def platt(margins: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the sigmoid that fits ``y`` best, by Newton steps on targets kept off 0 and 1."""
    ones = int(y.sum())
    if not 0 < ones < len(y):
        return 1.0, 0.0
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    x = np.stack([margins, np.ones(len(y))], axis=1)
    fit = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ fit)
        curve = x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (p - target))
        fit = fit - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(fit[0]), float(fit[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS) -> Calibrated:
    """Learns from a bounded sample outside fold 0; every ``CALIBRATE``-th document of it only calibrates."""
    sample = training_sample(docs, labels, label, folds)
    texts, y = sample["text"].combine_chunks(), sample["y"].to_numpy()
    apart = np.arange(len(y)) % CALIBRATE == CALIBRATE - 1
    linear = ftrl(examples(texts.filter(pa.array(~apart)), n_gram_features), y[~apart], 1 << BITS, SCALE)
    slope, offset = platt(linear.margins(texts.filter(pa.array(apart)), n_gram_features), y[apart])
    return Calibrated(linear, slope, offset)


def judge_udf(model: Calibrated):
    @arrow_udf(RESULT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, bounds = text_bytes(texts)
            found = [counts(data[s:e].tobytes()) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            columns = np.array(found, np.int64).reshape(-1, 5).T
            yield pa.StructArray.from_arrays([*map(pa.array, columns), pa.array(model.probabilities(texts))], [*COUNTS, "probability"])

    return judge


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: ``doc_id``, the five counts, ``base_failed``, ``probability``, ``kept``.

    Texts are scored whole, in bounded blocks; n-grams do not run over the ends of those. Null and empty texts have no words and so fail the base rules. Without labels every
    probability is one half, which passes. Equal rows are judged alike, and no row is dropped; columns of
    ``docs`` besides ``doc_id`` and ``text`` are not read.
    """
    out = docs.select("doc_id", judge_udf(fit(docs, labels))(F.col("text")).alias("j")).select("doc_id", "j.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    kept = (~failed & (F.col("probability") >= threshold)).alias("kept")
    return out.select("doc_id", *COUNTS, failed.alias("base_failed"), kept, "probability")
