"""Token ids of whole texts, by word: ids are remembered, and unknown words are merged many at a time.

Written for vocabularies that drop white space, lower-case, part letters, single
digits and other signs, and merge bytes within such a part; texts are then the
sum of their words. Ids are those of the ``tokenizers`` library, which handles every
word beyond the plain Latin ones itself, and whole texts under any other vocabulary
or with a word over 512 KB.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tellerline.llm.common import BLOCK, SPACES, blocks, ragged, text_bytes
from tellerline.llm.hashing import KIND, Spans

#: Words whose ids are remembered (a power of two), and ids that are held for them.
MEMORY_BITS = 20
STORE = 1 << 23
#: Longer words are left to the library.
LONGEST = 64
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "split": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
}
NONE = np.int64(1) << 62

#: Bytes that no plain word has. Plain are ASCII signs but for the apostrophe, and Latin-1 letters (which begin with C3).
FOREIGN = np.zeros(256, bool)
FOREIGN[:33] = FOREIGN[127] = FOREIGN[39] = FOREIGN[0xC2] = FOREIGN[0xC4:] = True


def byte_chars() -> list[str]:
    """The character that byte-level vocabularies write for each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Merges:
    """Rank and result of pairs of ids; several hash tables, each for the pairs that met another in the one before."""

    def __init__(self, pairs: np.ndarray, results: np.ndarray):
        keys = pairs[:, 0] << 20 | pairs[:, 1]
        values = np.arange(len(keys), dtype=np.int64) << 20 | results
        self.tables = []
        bits, factor = 18, 0x9E3779B97F4A7C15
        while len(keys):
            at = self._slot(keys, factor, bits)
            _, first = np.unique(at, return_index=True)
            known, held = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE)
            known[at[first]], held[at[first]] = keys[first], values[first]
            self.tables.append((factor, bits, known, held))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]
            bits, factor = 14, (factor * 0xD1342543DE82EF95 + 2) % (1 << 64) | 1

    @staticmethod
    def _slot(keys: np.ndarray, factor: int, bits: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(factor)) >> np.uint64(64 - bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 20 | result, or NONE."""
        keys = left << 20 | right
        out = np.full(len(keys), NONE)
        for factor, bits, known, held in self.tables:
            at = self._slot(keys, factor, bits)
            out = np.where(known[at] == keys, held[at], out)
        return out


class Encoder:
    """Ids of texts, without special tokens added."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        split = (parts[0].get("pattern") or {}).get("Regex")
        model = spec["model"]
        self.by_word = spec.get("normalizer") == RULES["normalizer"] and split == RULES["split"] and model.get("end_of_word_suffix") == "</w>"
        if self.by_word:
            vocab, chars = model["vocab"], byte_chars()
            self.inner = np.array([vocab[c] for c in chars], np.int64)
            self.last = np.array([vocab[c + "</w>"] for c in chars], np.int64)
            pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
            ids = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int64)
            self.merges = Merges(ids[:, :2], ids[:, 2])
            self.store = np.zeros(STORE, np.uint32)
            self._forget()

    # A word is remembered at the place its hash names, until another word takes that place.
    # It is recognised by its hash, its length and its first eight bytes.

    def _forget(self) -> None:
        self.hashes, self.heads = np.zeros(1 << MEMORY_BITS, np.uint64), np.zeros(1 << MEMORY_BITS, np.uint64)
        self.at, self.size = np.zeros(1 << MEMORY_BITS, np.int32), np.zeros(1 << MEMORY_BITS, np.int32)
        self.used = 0

    def _merged(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of plain words: in each part, again and again, the pair of lowest rank, leftmost first."""
        data = data.copy()
        accented = np.flatnonzero(data == 0xC3) + 1
        data[accented[data[accented] < 0x9F]] += 32
        data[(data >= 65) & (data <= 90)] += 32
        kinds = KIND[data]
        opens = np.ones(len(data), bool)
        opens[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == 2)
        opens[edges[:-1]] = True
        starts = np.flatnonzero(opens)
        n = len(data)
        ends = np.append(starts[1:], n)
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[starts] = -1
        # What the pair at each place costs: its rank, then the place.
        rank, result = np.full(n, NONE), np.zeros(n, np.int64)

        def price(at: np.ndarray) -> None:
            found = self.merges.find(symbol[at], symbol[after[at]])
            rank[at] = np.where(found == NONE, NONE, (found >> 20) << 32 | at)
            result[at] = found & 0xFFFFF

        price(np.flatnonzero(after >= 0))
        low = np.minimum.reduceat(rank, starts)
        part = np.flatnonzero(low < NONE)
        low = low[part]
        while len(part):
            at = low & 0xFFFFFFFF
            gone = after[at]
            symbol[at] = result[at]
            follows = after[gone]
            after[at] = follows
            more = follows >= 0
            before[follows[more]] = at[more]
            symbol[gone], rank[gone], rank[at] = -1, NONE, NONE
            previous = before[at]
            price(np.concatenate([at[more], previous[previous >= 0]]))
            sizes = ends[part] - starts[part]
            low = np.minimum.reduceat(rank[ragged(starts[part], sizes)], np.cumsum(sizes) - sizes)
            part, low = part[low < NONE], low[low < NONE]
        kept = symbol >= 0
        counts = np.add.reduceat(kept, edges[:-1], dtype=np.int64)
        return symbol[kept].astype(np.uint32), counts

    def _by_library(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = [data[a:b].tobytes().decode() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        return np.concatenate(found), np.array([len(f) for f in found], np.int64)

    def _block(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, number of ids of each word, start of each word; no word crosses one of ``bounds``."""
        solid = ~SPACES[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        edge[1:] |= ~solid
        edge[:-1] |= ~solid
        starts, ends = np.flatnonzero(solid & edge[:-1]), np.flatnonzero(solid & edge[1:]) + 1
        if not len(starts):
            return np.zeros(0, np.uint32), starts, starts
        lengths = ends - starts
        hashes = Spans(data, lower=False).of(starts, ends)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        eight = np.lib.stride_tricks.as_strided(padded, (len(data), 8), (1, 1))[starts]
        heads = np.ascontiguousarray(eight).view("<u8").ravel()
        heads = heads & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (np.uint64(8) - np.minimum(lengths, 8).astype(np.uint64))))
        heads = heads ^ (lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        place = (hashes >> np.uint64(64 - MEMORY_BITS)).astype(np.int64)
        known = (self.hashes[place] == hashes) & (self.heads[place] == heads) & (self.size[place] > 0)
        at, size = self.at[place].astype(np.int64), self.size[place].astype(np.int64)
        new = np.flatnonzero(~known)
        if len(new):
            order = new[np.lexsort((heads[new], hashes[new]))]
            first = np.append(True, (hashes[order][1:] != hashes[order][:-1]) | (heads[order][1:] != heads[order][:-1]))
            which, word = np.cumsum(first) - 1, order[first]
            got_at, got_size = self._learn(data, starts[word], lengths[word])
            at[order], size[order] = got_at[which], got_size[which]
            self.hashes[place[word]], self.heads[place[word]] = hashes[word], heads[word]
            self.at[place[word]], self.size[place[word]] = got_at, got_size
        return self.store[ragged(at, size)], size, starts

    def _learn(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the store the ids of these words are now, and how many."""
        bytes_of = data[ragged(starts, lengths)]
        edges = np.append(0, np.cumsum(lengths))
        foreign = FOREIGN[bytes_of]
        foreign[1:] |= (bytes_of[:-1] == 0xC3) & ((bytes_of[1:] == 0x97) | (bytes_of[1:] == 0xB7))
        foreign[1:] |= (bytes_of[:-1] == 60) & (bytes_of[1:] == 124)  # may begin a special token
        plain = ~np.logical_or.reduceat(foreign, edges[:-1]) & (lengths <= LONGEST)
        at, size = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        for way, own in ((self._merged, np.flatnonzero(plain)), (self._by_library, np.flatnonzero(~plain))):
            if len(own):
                ids, counts = way(bytes_of[ragged(edges[own], lengths[own])], np.append(0, np.cumsum(lengths[own])))
                self.store[self.used : self.used + len(ids)] = ids
                at[own], size[own] = self.used + np.cumsum(counts) - counts, counts
                self.used += len(ids)
        return at, size

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text in turn; none for null and blank texts."""
        if not self.by_word:
            for text in texts:
                yield np.array(self.tokenizer.encode(text.as_py() or "", add_special_tokens=False).ids, np.uint32)
            return
        data, bounds = text_bytes(texts)
        at = 0
        for row in [*self._unparted(data, bounds), len(texts)]:
            if row > at:
                yield from self._by_block(data, bounds[at : row + 1])
            if row < len(texts):
                yield self._by_library(data, bounds[row : row + 2])[0]
            at = row + 1

    @staticmethod
    def _unparted(data: np.ndarray, bounds: np.ndarray) -> list[int]:
        """Rows with a word so long that blocks would cut it; the library gets them whole."""
        out = []
        for row in np.flatnonzero(np.diff(bounds) >= BLOCK).tolist():
            blanks = np.flatnonzero(SPACES[data[bounds[row] : bounds[row + 1]]])
            words = np.diff(np.concatenate([[-1], blanks, [bounds[row + 1] - bounds[row]]])) - 1
            if words.max() >= BLOCK:
                out.append(row)
        return out

    def _by_block(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        parts, current = [], 0
        for block, edges, rows, _ in blocks(data, bounds):
            if self.used > STORE // 2:
                self._forget()
            ids, size, starts = self._block(block, edges)
            cuts = np.append(0, np.cumsum(size))[np.searchsorted(starts, edges)]
            for row, a, b in zip(rows.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if row != current:
                    yield parts[0] if len(parts) == 1 else np.concatenate(parts)
                    parts, current = [], row
                parts.append(ids[a:b])
        if parts:
            yield parts[0] if len(parts) == 1 else np.concatenate(parts)
