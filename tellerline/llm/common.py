"""Helpers shared by the operators: durable results, folds, gapless numbers, Arrow text access."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, also if it is not installed."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *known])


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Only where that is unset, as in tests, a folder of the session's warehouse stands in.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/_shared").rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(folds)


def numbered(df: DataFrame, groups: list[str], order: list[str], name: str, cells: int | Column = 1024) -> DataFrame:
    """Adds ``name``: gapless numbers from 0 within each group of ``groups``.

    A group may hold any share of the rows: its rows are dealt to ``cells`` cells by
    a hash of ``order`` (a column may give each group a number of its own), numbered there, and raised by the sizes of the cells before.
    Rows equal in ``order`` share a cell and are numbered in any order. ``df`` is read
    twice and should be durable or cheap. No group may be null in ``groups``.
    """
    celled = df.withColumn("_cell", F.pmod(F.xxhash64(*order), cells if isinstance(cells, Column) else F.lit(cells)))
    sizes = celled.groupBy(*groups, "_cell").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*groups, "_cell", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*groups, "_cell").orderBy(*order)
    ranked = celled.withColumn("_rank", F.row_number().over(within) - 1)
    joined = ranked.join(starts, [*groups, "_cell"])
    return joined.withColumn(name, (F.col("_start") + F.col("_rank")).cast("long")).drop("_cell", "_start", "_rank")


# --- Arrow text columns -------------------------------------------------------


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string array's UTF-8 bytes and row bounds, without copies; null rows are empty."""
    wide = pa.types.is_large_string(array.type)
    bounds = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    bounds = bounds[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    if array.null_count:
        # A null slot may span bytes in a foreign writer's array; take those out.
        valid = np.asarray(array.is_valid())
        if np.any(np.diff(bounds)[~valid]):
            return text_bytes(array.fill_null(""))
    return data, bounds


#: Bytes of white space: tab to carriage return, and the blank.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


#: Bytes of a block, about.
BLOCK = 1 << 19


def pieces(data: np.ndarray, bounds: np.ndarray, limit: int, overlap: int = 0) -> Iterator[tuple[int, int, int]]:
    """(row, start, end) for each row; rows over ``limit`` bytes come in pieces cut after white space.

    Each further piece of a row begins at least ``overlap`` bytes before the last one's end.
    """
    for row in range(len(bounds) - 1):
        start, end = int(bounds[row]), int(bounds[row + 1])
        while end - start > limit:
            blanks = np.flatnonzero(SPACES[data[start + 2 * overlap : start + limit]])
            if len(blanks):
                cut = start + 2 * overlap + int(blanks[-1]) + 1
            else:  # one word longer than the limit
                cut = character(data, start + limit)
            yield row, start, cut
            start = character(data, cut - overlap)
        yield row, start, end


def character(data: np.ndarray, at: int) -> int:
    """The first byte of the character that the byte ``at`` belongs to."""
    while at > 0 and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def blocks(data: np.ndarray, bounds: np.ndarray, limit: int = BLOCK, overlap: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Runs of rows as (bytes, bounds, rows, place of the first byte in ``data``), of about ``limit`` bytes each.

    Memory that works on a block is bounded however long a text is: a row longer
    than ``limit`` appears in several blocks.
    """
    rows: list[int] = []
    edges: list[int] = []
    for row, start, end in pieces(data, bounds, limit, overlap):
        if rows and (end - edges[0] > limit or start != edges[-1]):
            yield data[edges[0] : edges[-1]], np.asarray(edges) - edges[0], np.asarray(rows), edges[0]
            rows, edges = [], []
        if not rows:
            edges = [start]
        rows.append(row)
        edges.append(end)
    if rows:
        yield data[edges[0] : edges[-1]], np.asarray(edges) - edges[0], np.asarray(rows), edges[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all items of spans, one span after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
