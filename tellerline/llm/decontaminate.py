"""Benchmark decontamination by the q-gram lemma and banded alignment.

Benchmark items are compared by windows of their characters. A passage that
equals a window but for ``k`` edits shares at least ``length + 1 - q (k + 1)`` q-grams
with it, on diagonals (place in the document less place in the window) that are at
most ``k`` apart. So shared q-grams are counted in overlapping bands of diagonals,
bands that reach the bound are kept, and an alignment restricted to the band
decides. The filter loses no passage within the edit budget.

The items are a stated query set: they are taken in blocks of bounded size, and every
document passes every block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tellerline.llm.common import blocks, ragged, text_bytes

#: Characters of a window and between two windows' starts, and edits per character.
WINDOW = 96
STRIDE = 32
RATE = 0.1
Q = 8
#: Characters of items in one block.
BLOCK_CHARS = 1 << 20
FILTER_BITS = 21
OUTSIDE = np.uint32(0xFFFFFFFF)

MULTIPLIER = 0x9E3779B97F4A7C15


def folded(code: int) -> int:
    """A character without its case, white space of any kind as a blank; every character stays one.

    That is the lower case of the upper case, so that both forms of sigma are one too;
    where a case has several characters (sharp s, dotted capital I) the first of the lower case.
    """
    char = chr(code)
    if char.isspace():
        return 32
    upper = char.upper()
    return ord((upper if len(upper) == 1 else char).lower()[0])


#: By code point; none beyond these has a case or is white space.
FOLD = np.array([code if 0xD800 <= code < 0xE000 else folded(code) for code in range(1 << 17)], np.uint32)


def characters(data: np.ndarray) -> np.ndarray:
    chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    return np.where(chars < len(FOLD), FOLD[np.minimum(chars, len(FOLD) - 1)], chars)


def q_grams(chars: np.ndarray) -> np.ndarray:
    """A hash of the 8 characters from each place that has as many."""
    if len(chars) < Q:
        return np.zeros(0, np.uint64)
    hashes, factor = chars.astype(np.uint64), MULTIPLIER
    for step in (1, 2, 4):
        hashes = hashes[:-step] * np.uint64(factor) + hashes[step:]
        factor = factor * factor % (1 << 64) | 1
    return (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Probes:
    """The windows of a block of items, with their q-grams in hash order."""

    ids: list  # of items
    item: np.ndarray  # of each window
    chars: np.ndarray  # of all windows
    start: np.ndarray  # of each window in chars
    length: np.ndarray
    budget: np.ndarray  # edits
    least: np.ndarray  # shared q-grams
    grams: np.ndarray  # distinct hashes
    first: np.ndarray  # each hash's first entry below, and the end
    window: np.ndarray  # entries: window and place in it
    place: np.ndarray
    seen: np.ndarray  # by leading bits: whether any q-gram has them


def probes(items: list[tuple[object, str]], window: int = WINDOW, stride: int = STRIDE, rate: float = RATE) -> Probes:
    """Items of fewer than ``Q`` characters have no window: they are too short to tell."""
    item, parts = [], []
    for k, (_, text) in enumerate(items):
        chars = characters(np.frombuffer(text.strip().encode(), np.uint8))
        if len(chars) < Q:
            continue
        last = max(0, len(chars) - window)
        for at in [*range(0, last, stride), last]:
            item.append(k)
            parts.append(chars[at : at + window])
    length = np.array([len(p) for p in parts], np.int64)
    budget = np.minimum((rate * length).astype(np.int64), (length + 1) // Q - 1)
    hashes = [q_grams(p) for p in parts]
    sizes = np.array([len(h) for h in hashes], np.int64)
    every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    order = np.argsort(every, kind="stable")
    grams, first = np.unique(every[order], return_index=True)
    seen = np.zeros(1 << FILTER_BITS, bool)
    seen[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return Probes(
        ids=[i for i, _ in items],
        item=np.array(item, np.int64),
        chars=np.concatenate(parts) if parts else np.zeros(0, np.uint32),
        start=np.cumsum(length) - length,
        length=length,
        budget=budget,
        least=length + 1 - Q * (budget + 1),
        grams=grams,
        first=np.append(first, len(every)),
        window=np.repeat(np.arange(len(parts)), sizes)[order],
        place=ragged(np.zeros(len(parts), np.int64), sizes)[order],
        seen=seen,
    )


def bands(chars: np.ndarray, edges: np.ndarray, p: Probes) -> tuple[np.ndarray, np.ndarray]:
    """(window, lowest diagonal) of every band of a block that shares enough q-grams with a window."""
    hashes = q_grams(chars)
    at = np.flatnonzero(p.seen[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    which = np.minimum(np.searchsorted(p.grams, hashes[at]), len(p.grams) - 1)
    same = p.grams[which] == hashes[at]
    at, which = at[same], which[same]
    row = np.searchsorted(edges, at, side="right")
    whole = at + Q <= edges[row]  # within one text
    at, which = at[whole], which[whole]
    n = p.first[which + 1] - p.first[which]
    entry = ragged(p.first[which], n)
    window = p.window[entry]
    diagonal = np.repeat(at, n) - p.place[entry] + WINDOW_ROOM
    # Band b of a window holds diagonals from b w to (b + 2) w, w over its budget.
    wide = p.budget[window] + 1
    band = diagonal // wide
    key = np.concatenate([window << 40 | band, window << 40 | (band - 1)])
    key.sort()
    opens = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(opens, len(key)))
    key = key[opens]
    window = key >> 40
    enough = count >= p.least[window]
    window, band = window[enough], (key & ((1 << 40) - 1))[enough]
    return window, band * (p.budget[window] + 1) - WINDOW_ROOM


#: Keeps diagonals over 0.
WINDOW_ROOM = 1 << 20


def aligned(chars: np.ndarray, edges: np.ndarray, window: np.ndarray, low: np.ndarray, p: Probes) -> tuple[np.ndarray, ...]:
    """(row, window, start, end, edits) of bands whose best alignment of the window is within its budget.

    A row of the table per window character, a column per diagonal of the band and the
    budget on either side; all bands of one window length are worked on together.
    """
    found = []
    for length in np.unique(p.length[window]):
        for some in np.array_split(own := np.flatnonzero(p.length[window] == length), 1 + len(own) // 4096):
            w, budget = window[some], int(p.budget[window[some[0]]])
            width = 2 * (budget + 1) + 2 * budget
            origin = low[some] - budget
            # The text that the band's middle lies in.
            middle = np.clip(low[some] + budget + length // 2, 0, max(0, len(chars) - 1))
            row = np.searchsorted(edges, middle, side="right") - 1
            left, right = edges[row], edges[row + 1]
            at = origin[:, None] + np.arange(length + width)[None, :]
            inside = (at >= left[:, None]) & (at < right[:, None])
            text = np.where(inside, chars[np.clip(at, 0, len(chars) - 1)], OUTSIDE)
            pattern = p.chars[p.start[w][:, None] + np.arange(length)[None, :]]
            step = np.arange(width, dtype=np.int32)[None, :]
            cost = np.zeros((len(some), width), np.int32)
            begin = np.broadcast_to(step, cost.shape).copy()  # the diagonal where the best way began
            for k in range(length):
                straight = cost + (text[:, k : k + width] != pattern[:, k : k + 1])
                skipped = np.concatenate([cost[:, 1:] + 1, np.full((len(some), 1), 1 << 20, np.int32)], axis=1)
                best = np.where(skipped < straight, skipped, straight)
                came = np.where(skipped < straight, np.concatenate([begin[:, 1:], begin[:, -1:]], axis=1), begin)
                # Extra document characters: along the row, at one edit each. The begin goes with the cost.
                both = (best - step).astype(np.int64) << 20 | came
                both = np.minimum.accumulate(both, axis=1)
                cost, begin = (both >> 20).astype(np.int32) + step, (both & 0xFFFFF).astype(np.int32)
            end = np.argmin(cost, axis=1)
            pick = np.arange(len(some))
            edits = cost[pick, end]
            good = edits <= budget
            starts = origin + begin[pick, end]
            found.append([x[good] for x in (row, w, starts - left, origin + end + length - left, edits)])
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def leaks(texts: pa.Array, p: Probes) -> dict[str, np.ndarray]:
    """One entry per text and item that share a passage: row, item (place in ``p.ids``), span in characters, edits, windows."""
    data, bounds = text_bytes(texts)
    rows, items, spans, edits = [], [], [], []
    if len(p.grams):
        for block, edges, where, base in blocks(data, bounds, overlap=8 * WINDOW):
            leads = np.append(0, np.cumsum((block & 0xC0) != 0x80))
            chars, ends = characters(block), leads[edges]
            window, low = bands(chars, ends, p)
            row, w, start, end, n = aligned(chars, ends, window, low, p)
            # Characters of the row before this piece of it.
            begins = zip(where.tolist(), (base + edges[:-1]).tolist(), strict=True)
            first = np.array([np.count_nonzero((data[bounds[r] : s] & 0xC0) != 0x80) for r, s in begins], np.int64)
            rows.append(where[row])
            items.append(p.item[w])
            spans.append(np.stack([start + first[row], end + first[row], w]))
            edits.append(n)
    if not rows:
        none = np.zeros(0, np.int64)
        return dict(row=none, item=none, start=none, end=none, edits=none, windows=none)
    row, item, span, n = np.concatenate(rows), np.concatenate(items), np.concatenate(spans, axis=1), np.concatenate(edits)
    key = row * (len(p.ids) + 1) + item
    order = np.argsort(key, kind="stable")
    opens = np.flatnonzero(np.append(True, np.diff(key[order]) != 0)) if len(key) else np.zeros(0, np.int64)
    low = lambda x: np.minimum.reduceat(x[order], opens) if len(opens) else x[:0]
    distinct = np.unique(np.stack([key, span[2]]), axis=1)[0] if len(key) else key
    return dict(
        row=row[order][opens],
        item=item[order][opens],
        start=low(span[0]),
        end=-low(-span[1]),
        edits=low(n),
        windows=np.unique(distinct, return_counts=True)[1],
    )


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of at most ``limit`` characters (a longer item alone); null texts are left out."""
    block, held = [], 0
    rows = benchmark.select("item_id", "text").where(F.col("text").isNotNull()).orderBy("item_id", "text")
    for item, text in rows.toLocalIterator():
        if block and held + len(text) > limit:
            yield block
            block, held = [], 0
        block.append((item, text))
        held += len(text)
    if block:
        yield block


FOUND = "doc_id long, item_id long, start long, end long, edits long, windows long"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item with a passage in common: ``doc_id, item_id, start, end, edits, windows``.

    A passage counts if it holds a window of an item (``WINDOW`` characters, every
    ``STRIDE`` of the item; a shorter item whole) with at most ``RATE`` edits per character, case
    and kinds of white space apart in any script. So any stretch of ``WINDOW + STRIDE`` characters is
    found. ``start`` and ``end`` are the outermost characters of the matches in the document,
    ``edits`` the fewest of a window. Null and empty texts match nothing; equal rows and equal items are
    each reported; without items or documents there are no rows.
    """
    found = docs.sparkSession.createDataFrame([], FOUND)
    for block in item_blocks(benchmark):

        def run(batches: Iterator[pa.RecordBatch], p: Probes = probes(block)) -> Iterator[pa.RecordBatch]:
            ids = pa.array(p.ids, pa.int64())
            for batch in batches:
                hit = leaks(batch["text"], p)
                rest = [pa.array(hit[c], pa.int64()) for c in ("start", "end", "edits", "windows")]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(hit["row"])), ids.take(pa.array(hit["item"])), *rest], ["doc_id", "item_id", "start", "end", "edits", "windows"])

        found = found.union(docs.select("doc_id", "text").mapInArrow(run, FOUND))
    return found


def leaks_udf(p: Probes):
    """text -> whether it shares a passage with an item of the block."""

    @arrow_udf("boolean")
    def leaking(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            hit = np.zeros(len(texts), bool)
            hit[leaks(texts, p)["row"]] = True
            yield pa.array(hit)

    return leaking


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that ``contaminated`` would report; other rows and all columns stay as they are."""
    for block in item_blocks(benchmark):
        docs = docs.where(~leaks_udf(probes(block))(F.col("text")))
    return docs
