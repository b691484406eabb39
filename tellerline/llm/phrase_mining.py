"""Phrase collocations by Toivonen's mining: a sample proposes, full passes decide.

A share of the documents proposes words and pairs of words that may be frequent. One pass over all
documents then counts the proposals and their negative border exactly: every word, every pair of
proposed words and every triple whose pairs are proposed. A frequent phrase that was not proposed is a border failure: longer phrases
around it were not counted. Failures join the proposals, and a further pass counts what they add to the border, until
nothing is added; with phrases of three words at most three passes are made. Sets of proposals are given to tasks as bit tables of bounded size.
A bit that is set by chance only makes a phrase be counted that need not have been, so counts and results are exact at any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from tellerline.llm.common import durable, text_bytes
from tellerline.llm.hashing import Spans, mixed, pairs as paired

#: Occurrences that make a phrase a candidate, and words of the longest phrase.
SUPPORT = 10
WORDS = 3
#: One in so many documents proposes phrases, those that occur there at least so often.
SAMPLE_SHARE, SAMPLE_SUPPORT = 16, 2
#: Bits of a table per entry, and of the largest table (8 MB): beyond its size tables only admit more.
BITS_PER_ENTRY, MOST_BITS = 32, 1 << 26
#: Bytes of text that a task works on at once.
BLOCK = 1 << 21
#: Parts over which a frequent word is dealt when candidates look up its count.
SALTS = 16
UNKNOWN = "und"

#: What a byte is: 0 blank, 1 end of a piece, 2 part of a word.
KIND = np.full(256, 2, np.uint8)
KIND[[9, 32]] = 0
KIND[[*b".,;:!?\n\x0b\x0c\r"]] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

COUNTS = "lang string, phrase string, n long"


# --- proposals ------------------------------------------------------------------


@dataclass(frozen=True)
class Bits:
    """A set of (lang, phrase) by one bit of their hash; may hold more than was put in, never less."""

    words: np.ndarray

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & np.uint64(64 * len(self.words) - 1)
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def word_hashes(words: pa.Array, lang: np.ndarray, names: list[str]) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.uint64)
    data, bounds = text_bytes(words)
    seeds = np.array([xxhash.xxh64_intdigest(n) for n in names], np.uint64)
    return mixed(Spans(data[: bounds[-1]], lower=False).of(bounds[:-1], bounds[1:]) ^ seeds[lang])


def phrase_hashes(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Of phrases of one or two words and their languages: what tasks make of the words where they count."""
    for lang, phrase in batches:
        coded, words = lang.dictionary_encode(), pc.split_pattern(phrase, " ")
        first = np.asarray(words.offsets)[:-1]
        row = np.repeat(np.arange(len(phrase)), np.diff(np.asarray(words.offsets)))
        own = word_hashes(words.flatten(), coded.indices.to_numpy()[row], coded.dictionary.to_pylist())
        hashes = own[first]
        two = np.flatnonzero(np.diff(np.asarray(words.offsets)) == 2)
        hashes[two] = pair_hashes(own[first[two]], own[first[two] + 1])
        yield pa.array(hashes.view(np.int64))


def pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return paired(np.stack([a, b], axis=1).ravel())[::2] if len(a) else a


def bits_of(phrases: DataFrame) -> Bits:
    """The table of ``phrases(lang, phrase)``; the driver is sent its words that are not 0, at most 8 MB of them."""
    entries = max(1, phrases.count())
    bits = min(MOST_BITS, max(1 << 12, 1 << (entries * BITS_PER_ENTRY - 1).bit_length()))
    place = arrow_udf(phrase_hashes, "long")("lang", "phrase").bitwiseAND(F.lit(bits - 1).cast("long"))
    placed = phrases.select(place.alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    found = placed.groupBy(F.shiftright("place", 6).alias("at")).agg(F.bit_or(bit).alias("word")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[found["at"].to_numpy()] = found["word"].to_numpy().view(np.uint64)
    return Bits(words)


@dataclass(frozen=True)
class Proposals:
    """Words and pairs around which longer phrases are counted."""

    words: Bits
    pairs: Bits


# --- counting -------------------------------------------------------------------


def chunks(data: np.ndarray, bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int, bool]]:
    """(first row, end row, long): runs of rows of at most ``limit`` bytes, and each longer row by itself."""
    first = 0
    for row in range(len(bounds) - 1):
        if bounds[row + 1] - bounds[row] > limit:
            if first < row:
                yield first, row, False
            yield row, row + 1, True
            first = row + 1
        elif bounds[row + 1] - bounds[first] > limit:
            yield first, row, False
            first = row
    if first < len(bounds) - 1:
        yield first, len(bounds) - 1, False


def word_end(data: np.ndarray, at: int, end: int) -> int:
    """The first place from ``at`` on that is not within a word."""
    while at < end:
        outside = np.flatnonzero(KIND[data[at : at + BLOCK]][: end - at] != 2)
        if len(outside):
            return at + int(outside[0])
        at = min(end, at + BLOCK)
    return end


def joined(words: pa.Array, *places: np.ndarray) -> pa.Array:
    """Phrases of the words at some places."""
    return pc.binary_join_element_wise(*(words.take(pa.array(p)) for p in places), " ")


def compact(keys: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, place of each key among them); keys are at least 0 and under ``below``."""
    if below > 4 * len(keys) + (1 << 20):
        return np.unique(keys, return_inverse=True)
    there = np.zeros(below, bool)
    there[keys] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[keys]


class Counter:
    """Counts phrases of blocks: all words and, around proposals, longer phrases; what ``earlier`` passes counted not again."""

    def __init__(self, now: Proposals | None, earlier: list[Proposals], words: int):
        """Without proposals every phrase of up to ``words`` words is counted."""
        self.now, self.earlier, self.words = now, earlier, words

    def block(self, data: np.ndarray, edges: np.ndarray, langs: np.ndarray, names: list[str], fresh_from: int = 0) -> tuple[np.ndarray, Iterator[pa.RecordBatch]]:
        """(starts of words, counts). A phrase counts if its last word starts at ``fresh_from`` or later."""
        kinds = KIND[data]
        cut = np.empty(len(data) + 1, bool)
        cut[0] = cut[-1] = True
        np.not_equal(kinds[1:], kinds[:-1], out=cut[1:-1])
        cut[edges] = True
        at = np.flatnonzero(cut)
        solid = kinds[at[:-1]] == 2 if len(data) else np.zeros(0, bool)
        starts, ends = at[:-1][solid], at[1:][solid]
        return starts, self._counts(data, kinds, edges, langs, names, fresh_from, starts, ends) if len(starts) else iter(())

    def _counts(self, data, kinds, edges, langs, names, fresh_from, starts, ends) -> Iterator[pa.RecordBatch]:
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
        text = LOWER[data[kinds == 2]]
        coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(text)).dictionary_encode()
        row = np.searchsorted(edges, starts, side="right") - 1
        piece = np.cumsum(kinds == 1, dtype=np.int32)[starts]
        follows = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
        fresh = starts >= fresh_from
        vocabulary = len(coded.dictionary)
        distinct, word = compact(langs[row] * vocabulary + coded.indices.to_numpy(), len(names) * vocabulary)
        lang, own = distinct // vocabulary, coded.dictionary.take(pa.array(distinct % vocabulary))
        if not self.earlier:
            yield self._rows(lang, own, np.bincount(word, fresh, len(distinct)), names)
            yield self._rows(np.arange(len(names)), pa.array([""] * len(names)), np.bincount(langs[row], fresh, len(names)), names)
        del row, coded, text, offsets, piece, starts, ends, kinds, data

        # Pairs, as positions of their first words.
        first = np.flatnonzero(follows)
        before: list[np.ndarray] = []
        if self.now is not None:
            hashes = word_hashes(own, lang, names)
            proposed = self.now.words.has(hashes)
            before = [p.words.has(hashes) for p in self.earlier]
            first = first[proposed[word[first]] & proposed[word[first + 1]]]
        if not len(first):
            return
        pairs, pair = np.unique(word[first] * len(distinct) + word[first + 1], return_inverse=True)
        a, b = pairs // len(distinct), pairs % len(distinct)
        old = [w[a] & w[b] for w in before]
        n = np.bincount(pair, fresh[first + 1], len(pairs))
        for known in old:
            n[known] = 0
        some = np.flatnonzero(n)
        yield self._rows(lang[a[some]], joined(own, a[some], b[some]), n[some], names)
        if self.words < 3:
            return

        # Triples, as pairs that follow each other by one word.
        at = np.flatnonzero(first[1:] == first[:-1] + 1)
        if self.now is not None:
            hashes = pair_hashes(hashes[a], hashes[b])
            proposed = self.now.pairs.has(hashes)
            old = [k & p.pairs.has(hashes) for k, p in zip(old, self.earlier, strict=True)]
            at = at[proposed[pair[at]] & proposed[pair[at + 1]]]
        if not len(at):
            return
        triples, triple = np.unique(pair[at] * len(pairs) + pair[at + 1], return_inverse=True)
        x, y = triples // len(pairs), triples % len(pairs)
        n = np.bincount(triple, fresh[first[at] + 2], len(triples))
        for known in old:
            n[known[x] & known[y]] = 0
        some = np.flatnonzero(n)
        x, y = x[some], y[some]
        yield self._rows(lang[a[x]], joined(own, a[x], b[x], b[y]), n[some], names)

    @staticmethod
    def _rows(lang: np.ndarray, phrase: pa.Array, n: np.ndarray, names: list[str]) -> pa.RecordBatch:
        some = np.flatnonzero(n)
        columns = [
            pa.array(names, pa.string()).take(pa.array(lang[some])),
            phrase.take(pa.array(some)),
            pa.array(n[some].astype(np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])

    def texts(self, texts: pa.Array, lang: pa.Array, limit: int = BLOCK) -> Iterator[pa.RecordBatch]:
        data, bounds = text_bytes(texts)
        coded = lang.dictionary_encode()
        codes, every = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        for low, high, long in chunks(data, bounds, limit):
            used, langs = np.unique(codes[low:high], return_inverse=True)
            names = [every[k] for k in used]
            if not long:
                edges = bounds[low : high + 1] - bounds[low]
                yield from self.block(data[bounds[low] : bounds[high]], edges, langs, names)[1]
                continue
            at = fresh = int(bounds[low])
            while fresh < bounds[high]:
                # Parts end outside of words and begin with the last two words of the part before.
                end = word_end(data, min(fresh + limit, int(bounds[high])), int(bounds[high]))
                starts, counts = self.block(data[at:end], np.array([0, end - at]), langs, names, fresh - at)
                yield from counts
                at, fresh = (at + int(starts[-2:][0]) if len(starts) else end), end


def counted(docs: DataFrame, counter: Counter, support: int) -> DataFrame:
    """Phrases of ``docs(lang, text)`` that the counter counts and that occur ``support`` times; size 0 has a language's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lang = batch["text"], batch["lang"]
            del batch  # or it would be held while the next one is read
            yield from counter.texts(texts, lang)
            del texts, lang

    sums = docs.select("lang", "text").mapInArrow(run, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    kept = sums.where((F.col("phrase") == "") | (F.col("n") >= support))
    blanks = F.length("phrase") - F.length(F.translate("phrase", " ", ""))
    return durable(kept.select("lang", F.when(F.col("phrase") == "", 0).otherwise(blanks + 1).alias("size"), "phrase", "n"))


def frequent_phrases(docs: DataFrame, support: int = SUPPORT, share: int = SAMPLE_SHARE, sample_support: int = SAMPLE_SUPPORT) -> DataFrame:
    """``lang, size, phrase, n``: all phrases of one to three words that occur ``support`` times, with their exact counts.

    ``docs`` has ``lang`` (not null) and ``text``. Size 0 has the number of words of each language. Whatever the sample proposes,
    the result is the same; it only decides how much is left to further passes.
    """
    sample = docs.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(share)) == 0)
    proposed = counted(sample, Counter(None, [], 2), sample_support).select("lang", "size", "phrase")
    found: DataFrame | None = None
    passes: list[Proposals] = []
    while True:
        now = Proposals(*(bits_of(proposed.where(F.col("size") == k).select("lang", "phrase")) for k in (1, 2)))
        fresh = counted(docs, Counter(now, passes, WORDS), support)
        found = fresh if found is None else found.unionByName(fresh)
        passes.append(now)
        known = found.where(F.col("size").between(1, WORDS - 1)).select("lang", "size", "phrase")
        failures = durable(known.join(proposed, ["lang", "size", "phrase"], "left_anti"))
        if failures.isEmpty():
            return found
        proposed = proposed.unionByName(failures)


# --- collocations ---------------------------------------------------------------


def _first_words(k: int) -> Column:
    return F.substring_index("phrase", " ", k)


def collocations(docs: DataFrame, top: int = 2000, support: int = SUPPORT, share: int = SAMPLE_SHARE) -> DataFrame:
    """Each language's best phrases of two and three words: ``lang, rank, phrase, a, l, r, n, score``.

    ``docs`` has ``text`` and ``lang``; null texts are empty, null languages ``und``. ASCII capitals count as small letters, pieces end
    at ``.,;:!?`` and line ends, words are parted by blanks and tabs, and phrases lie within a piece. ``a`` is the phrase's count, ``n`` the
    language's words. A phrase cut after its first words has score ``floor(1000000 a a / (l r))`` with the counts of both parts; the
    cut of the least score counts, of equal ones the first. A phrase that lies in a longer candidate with at least half its count is
    dropped. Ties in rank go by ``a`` and then by the phrase's bytes. Texts are read whole, however long, in bounded blocks; equal rows
    count each; a table without words gives no rows; other columns are not read.
    """
    own = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    every = frequent_phrases(own, support, share)
    candidates = every.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"))

    inner = F.array(_first_words(2), F.substring_index("phrase", " ", -2))
    longer = candidates.where("size = 3").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    candidates = candidates.join(longer, ["lang", "phrase"], "left").where("longer is null or 100 * longer < 50 * a")

    parted = candidates.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    words = F.split("phrase", " ")
    parted = parted.withColumn("left", F.array_join(F.slice(words, F.lit(1), F.col("k")), " "))
    parted = parted.withColumn("right", F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " "))
    # A frequent word is part of very many candidates: it is dealt over several tasks.
    share_of = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    spread = F.sequence(F.lit(0), F.when(F.col("size") == 1, SALTS - 1).otherwise(0))
    parts = every.where(f"size between 1 and {WORDS - 1}").select("lang", F.col("phrase").alias("part"), F.col("n").alias("found"), F.explode(spread).alias("salt"))
    for side, words_there, name in (("left", F.col("k"), "l"), ("right", F.col("size") - F.col("k"), "r")):
        salted = parted.withColumn("salt", F.when(words_there == 1, share_of).otherwise(0)).withColumnRenamed(side, "part")
        parted = salted.join(parts, ["lang", "part", "salt"]).withColumnRenamed("found", name).drop("part", "salt")

    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    top_of, under = F.lit(1_000_000).cast("decimal(7,0)") * (exact["a"] * exact["a"]).cast("decimal(31,0)"), exact["l"] * exact["r"]
    scored = parted.withColumns({"_over": top_of, "_under": under}).withColumn("score", F.expr("_over div _under"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = every.where("size = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").alias("score"))
