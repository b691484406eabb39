"""Packing into fixed windows by minimum bin slack over the multiset of piece lengths.

Documents become token ids and are cut at whole windows; what remains of each is
shorter than a window. How the remainders fill windows depends only on how many
there are of each length, and that table has fewer rows than a window has tokens,
however many documents there are. Subset-sum dynamic programming over it (the sums
that are reachable are the bits of one integer) picks lengths that fill a window
closest, and the pattern is used as often as the counts allow. Pieces then take
their places by their number within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerline.llm.common import durable, numbered
from tellerline.llm.word_bpe import Encoder

WINDOW = 2048
END = 1
PIECES = "doc_id long, start long, length int, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """Every document's ids and the end id, cut into pieces of ``window`` ids and a remainder."""
    last = np.array([end], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        for batch in batches:
            columns: tuple[list, ...] = ([], [], [], [], [])
            for row, found in enumerate(encoder.encode(batch["text"])):
                ids = np.append(found, last).astype("<u4")
                for at in range(0, len(ids), window):
                    part = ids[at : at + window]
                    for column, value in zip(columns, (row, at, len(part), zlib.crc32(part), len(ids)), strict=True):
                        column.append(value)
            rows, *rest = columns
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, t in zip(rest, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


# --- minimum bin slack ----------------------------------------------------------


def fullest(counts: dict[int, int], window: int) -> dict[int, int]:
    """The lengths, with numbers, that fill ``window`` best, the longest length among them.

    ``reached`` has bit s if some of the lengths so far sum to s. Numbers of a length
    enter in powers of two, so each length takes a few shifts; walking the steps
    backwards from the best sum gives the numbers.
    """
    longest = max(counts)
    room = window - longest
    everything = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length in sorted(counts, reverse=True):
        most = min(counts[length] - (length == longest), room // length)
        share = 1
        while most > 0:
            n = min(share, most)
            steps.append((length, n, reached))
            reached |= (reached << (length * n)) & everything
            most, share = most - n, share * 2
        if reached >> room & 1:
            break
    left, chosen = reached.bit_length() - 1, {longest: 1}
    for length, n, before in reversed(steps):
        if not before >> left & 1:
            chosen[length] = chosen.get(length, 0) + n
            left -= length * n
    return chosen


@dataclass(frozen=True)
class Plan:
    """Places of pieces by (length, number within the length); at most a few rows per length and pattern."""

    length: np.ndarray
    first: np.ndarray  # the first number this row is for
    each: np.ndarray  # pieces of this length in one sequence
    sequence: np.ndarray  # the first sequence of the pattern
    offset: np.ndarray  # of the first such piece in a sequence

    def places(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = np.int64(1) << 44
        at = np.searchsorted(self.length * top + self.first, length * top + number, side="right") - 1
        past = number - self.first[at]
        return self.sequence[at] + past // self.each[at], self.offset[at] + past % self.each[at] * length


def plan(counts: dict[int, int], window: int = WINDOW) -> Plan:
    """Patterns until no piece is left. Each uses up at least one length, so there are fewer than ``window``."""
    counts = {length: n for length, n in counts.items() if n}
    used = dict.fromkeys(counts, 0)
    rows, sequence = [], 0
    while counts:
        pattern = fullest(counts, window)
        times = min(counts[length] // n for length, n in pattern.items())
        offset = 0
        for length, n in sorted(pattern.items(), reverse=True):
            rows.append((length, used[length], n, sequence, offset))
            offset += length * n
            used[length] += n * times
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        sequence += times
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Plan(*columns)


PACKED = PIECES + ", sequence_id long, offset long"


def packed(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    The pieces of a sequence lie gapless from offset 0 and hold at most ``window``
    ids; each id of each document, its end id included, lies in one piece. Null
    and empty texts have the end id alone. Equal rows and ids are packed separately; an
    empty table gives no rows. The driver sees one count per length.
    """
    cut = durable(pieces(docs, tokenizer_path, window, end))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = plan(counts, window)
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch[c].to_numpy().astype(np.int64) for c in ("length", "_number"))
            sequence, offset = chosen.places(length, number)
            kept = [batch["doc_id"], batch["start"], pa.array(length, pa.int64()), batch["ids_crc32"], batch["doc_tokens"]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    # A length may have any share of the pieces, as full windows have where texts are long. It is numbered
    # in cells, as many as each then has rows: neither a cell nor their list grows with the corpus as such.
    cells = F.array(*[F.lit(max(1, isqrt(counts.get(k, 0)))) for k in range(window + 1)])
    return numbered(cut, ["length"], order, "_number", F.get(cells, F.col("length"))).mapInArrow(place, PACKED.replace("length int", "length long"))
