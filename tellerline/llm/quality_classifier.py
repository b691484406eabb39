"""Quality classifier: hashed word n-gram logistic regression, trained with FTRL updates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tellerline.llm.hashing import PAIR, Spans, mixed, pairs, slots, tokens
from tellerline.llm.linear import Linear, examples, ftrl, sigmoid, training_sample

BITS = 18
SCALE = 20.0
FOLDS = 5
THRESHOLD = 0.3
#: Stands for any word that follows itself.
AGAIN = mixed(np.array([PAIR], np.uint64))[0]


def word_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Single words and pairs of neighbours; runs of other signs than letters and digits are words of their own.

    A word whose like is the next or the one after that makes the one pair ``AGAIN``, whichever word it is.
    """
    starts, ends, rows = tokens(data, bounds)
    if not len(starts):
        return rows, rows
    one = Spans(data).of(starts, ends)
    again = one[1:] == one[:-1]
    again[:-1] |= one[2:] == one[:-2]
    two = np.where(again, AGAIN, pairs(one))
    inside = rows[1:] == rows[:-1]
    return np.concatenate([rows, rows[1:][inside]]), slots(np.concatenate([one, two[inside]]), BITS)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS) -> Linear:
    """Learns from a bounded sample of labelled documents outside fold 0 (see ``training_sample``)."""
    sample = training_sample(docs, labels, label, folds)
    texts = sample["text"].combine_chunks()
    return ftrl(examples(texts, word_features), sample["y"].to_numpy(), 1 << BITS, SCALE)


def score_udf(model: Linear):
    """text -> probability of label 1; null and empty texts get that of the bias alone."""

    @arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(sigmoid(model.margins(texts, word_features)))

    return scores


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` in place of any such columns.

    The whole text is scored and nothing else. Without labelled documents all scores
    are one half. Rows are neither dropped nor merged, whatever their ids.
    """
    model = fit(docs, labels)
    out = docs.withColumn("score", score_udf(model)(F.col("text")))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
