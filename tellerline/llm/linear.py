"""Logistic models over hashed features: FTRL training, sparse scoring, bounded training samples."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerline.llm.common import blocks, fold_of, text_bytes

#: Bounds of what a classifier learns from; scoring has no bound.
TRAIN_ROWS = 6_000
TRAIN_BYTES = 1 << 16

#: (bytes, bounds) of a block -> (position of the row in the block, slot) of each feature it has, repeats included.
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x, np.float64)))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, rows: int = TRAIN_ROWS) -> pa.Table:
    """At most ``rows`` labelled texts (``text``, ``y``), the same whatever order the tables are read in.

    Those of smallest id hash among documents whose id is outside fold 0 of
    ``folds``, whose label is 0 or 1 and whose text has 1 to ``TRAIN_BYTES`` bytes. Of
    several texts of an id the smallest counts; null ids, texts and labels teach nothing.
    """
    order = F.xxhash64("doc_id")
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("y in (0, 1)").distinct()
    known = known.where(F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), folds) != 0))
    chosen = known.join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(order, "doc_id", "y").limit(rows)
    texts = docs.select("doc_id", "text").where(F.octet_length("text").between(1, TRAIN_BYTES))
    found = texts.join(chosen, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return found.select(order.alias("_order"), "doc_id", "y", "text").toArrow().sort_by([(c, "ascending") for c in ("_order", "doc_id", "y")])


@dataclass(frozen=True)
class Linear:
    """Weights of ``2 ** bits`` slots and a bias; a text's features count by their share of the text."""

    weights: np.ndarray
    bias: float
    scale: float

    def margins(self, texts: pa.Array, features: Features) -> np.ndarray:
        """bias + scale * (mean weight of the text's features); the bias for a text without any."""
        data, bounds = text_bytes(texts)
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for block, edges, rows, _ in blocks(data, bounds):
            at, slot = features(block, edges)
            np.add.at(total, rows, np.bincount(at, self.weights[slot], len(rows)))
            np.add.at(count, rows, np.bincount(at, minlength=len(rows)))
        return self.bias + self.scale * total / np.maximum(count, 1)


def examples(texts: pa.Array, features: Features) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct slots and their shares. For training texts, which fit in one block each."""
    data, bounds = text_bytes(texts)
    out = []
    for block, edges, rows, _ in blocks(data, bounds):
        at, slot = features(block, edges)
        order = np.argsort(at, kind="stable")
        parts = np.split(slot[order], np.cumsum(np.bincount(at, minlength=len(rows)))[:-1])
        for part in parts:
            distinct, n = np.unique(part, return_counts=True)
            out.append((distinct.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    return out


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    y: np.ndarray,
    slots: int,
    scale: float,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.02,
    passes: int = 3,
) -> Linear:
    """Logistic regression by follow-the-regularised-leader-proximal updates, one example at a time.

    Without examples all weights are 0 and every score is one half.
    """
    z, n = np.zeros(slots + 1), np.zeros(slots + 1)

    def weights(at):
        dual = z[at]
        lead = (beta + np.sqrt(n[at])) / alpha + l2
        return np.where(np.abs(dual) <= l1, 0.0, (np.sign(dual) * l1 - dual) / lead)

    inputs = [(np.append(at, np.int32(slots)), np.append(np.float32(scale) * x, np.float32(1))) for at, x in rows]
    for _ in range(passes):
        for (at, x), label in zip(inputs, y, strict=True):
            w = weights(at)
            g = (sigmoid(w @ x) - label) * x
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    final = weights(np.arange(slots + 1))
    return Linear(final[:-1].astype(np.float32), float(final[-1]), scale)
