"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``2 r`` bits have a common variant, which
differs from either in at most ``r`` bits; and two fingerprints that have such a
variant in common differ in at most ``2 r`` bits. So every fingerprint emits all
its variants within half the radius, variants are brought together, and what
collides is linked.

A fingerprint has 2,081 variants at ``r = 2``. They are shuffled in a factored
form: variants are dealt by their leading bits, so a fingerprint is sent once to
each value that its variants' leading bits take (37 for 8 bits), with the number of
flips that are left for the other bits; the variants of that value are written out
where they meet. Values that gather too many variants are dealt anew by their next
bits, as often as needed, so that no group grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tellerline.llm.common import durable, text_bytes
from tellerline.llm.components import components

SEED = 42
BITS = 64
STEP_BITS = 8
#: Variants that one group may write out at once.
GROUP_VARIANTS = 3_000_000
#: Tasks over which the fingerprints of one group are dealt.
SALTS = 16
#: Variants looked up at once.
CHUNK = 1 << 18
#: Shingles hashed at once; a longer text is hashed in several rounds.
ROUND = 1 << 16


def fingerprint_of(text: bytes, shingle: int) -> int:
    """The unsigned fingerprint of one text's UTF-8 bytes; 0 without a word."""
    words = b" ".join(text.lower().split())
    if not words:
        return 0
    blanks = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts, ends = np.concatenate([[0], blanks + 1]), np.concatenate([blanks, [len(words)]])
    if len(starts) < shingle:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(starts) - shingle + 1], ends[shingle - 1 :]
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(starts)
    for at in range(0, n, ROUND):
        spans = zip(starts[at : at + ROUND].tolist(), ends[at : at + ROUND].tolist(), strict=True)
        hashes = np.array([digest(words[s:e], SEED) for s, e in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprint_udf(shingle: int):
    """text -> fingerprint as a signed long; a null text has no word."""

    @arrow_udf("long")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, bounds = text_bytes(texts)
            found = [fingerprint_of(data[s:e].tobytes(), shingle) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    return fingerprints


# --- links --------------------------------------------------------------------


def weight_of(left: int, rest: int) -> int:
    """Variants with at most ``left`` flips among ``rest`` bits."""
    return sum(comb(rest, k) for k in range(left + 1))


@lru_cache
def masks(left: int, rest: int) -> np.ndarray:
    """All masks of at most ``left`` of the ``rest`` lowest bits."""
    found = [sum(1 << b for b in chosen) for k in range(left + 1) for chosen in combinations(range(rest), k)]
    return np.array(found, np.uint64)


def dealt(rows: DataFrame, depth: int, radius: int) -> DataFrame:
    """Rows (fp, left, prefix) with the next bits' values: those before ``depth + STEP_BITS``."""
    shift = BITS - depth - STEP_BITS
    flips = [(int(m), int(m).bit_count()) for m in masks(radius, STEP_BITS).tolist()]
    choices = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(k).alias("flips")) for m, k in flips])
    out = rows.withColumn("choice", F.explode(F.filter(choices, lambda c: c["flips"] <= F.col("left"))))
    own = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << STEP_BITS) - 1).cast("long"))
    value = own.bitwiseXOR(F.col("choice.mask"))
    prefix = F.shiftleft("prefix", STEP_BITS).bitwiseOR(value)
    return out.select("fp", (F.col("left") - F.col("choice.flips")).alias("left"), prefix.alias("prefix"))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links node -> smallest node of its component, over the links of one group."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def folded(values: np.ndarray) -> np.ndarray:
    """20 bits of each value."""
    return ((values ^ (values >> np.uint64(23)) ^ (values >> np.uint64(44))) & np.uint64((1 << 20) - 1)).astype(np.int64)


def collide(fps: np.ndarray, left: np.ndarray, rest: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between the fingerprints of one group that have a variant in common."""
    open_bits = np.uint64((1 << rest) - 1)  # the group's prefix is common to its variants
    parts = [(fps[left == flips], masks(flips, rest)) for flips in range(radius + 1)]
    variants = np.concatenate([((own & open_bits)[:, None] ^ spread[None, :]).ravel() for own, spread in parts])
    ordered = np.sort(variants)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    del ordered
    if not len(shared):
        return shared, shared
    marked = np.zeros(1 << 20, bool)
    marked[folded(shared)] = True
    near = np.concatenate([at + np.flatnonzero(marked[folded(variants[at : at + CHUNK])]) for at in range(0, len(variants), CHUNK)])
    variants = variants[near]
    ends = np.cumsum([len(own) * len(spread) for own, spread in parts])
    owners = np.empty(len(near), np.uint64)
    for (own, spread), end in zip(parts, ends, strict=True):
        mine = (near < end) & (near >= end - len(own) * len(spread))
        owners[mine] = own[(near[mine] - (end - len(own) * len(spread))) // len(spread)]
    at = np.minimum(np.searchsorted(shared, variants), len(shared) - 1)
    hit = shared[at] == variants
    at, owners = at[hit], owners[hit]
    first = np.full(len(shared), np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(first, at, owners)
    links = np.unique(np.stack([owners, first[at]]), axis=1)
    a, b = links[0], links[1]
    keep = (a != b) & (np.bitwise_count(a ^ b) <= 2 * radius)
    return forest(a[keep], b[keep])


LINKS = "a long, b long"


def links(fps: DataFrame, distance: int) -> DataFrame:
    """``a``, ``b``: enough links within ``distance`` bits to connect all of ``fps(fp)`` that are connected.

    ``fps`` holds distinct signed longs. Of the fingerprints at one variant, all of
    which lie within the distance of each other, each is linked to the smallest; no
    pairs of a crowd are written. Every written link is verified by its bits.
    """
    radius = distance // 2

    def leaf(depth: int):
        def run(group: pa.Table) -> pa.Table:
            left = group["left"].to_numpy()
            own = group["fp"].to_numpy().view(np.uint64)
            a, b = collide(own, left, BITS - depth, radius)
            return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

        return run

    rows = fps.select("fp", F.lit(radius).alias("left"), F.lit(0).cast("long").alias("prefix"))
    found, depth = None, 0
    while True:
        rows, depth = dealt(rows, depth, radius), depth + STEP_BITS
        if depth == BITS:  # the prefix is the variant itself: link without gathering it
            first = rows.groupBy("prefix").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
            part, hot = rows.join(first, "prefix").where("fp <> b").select(F.col("fp").alias("a"), "b"), None
        else:
            weights = [F.when(F.col("left") == k, F.lit(weight_of(k, BITS - depth))) for k in range(radius + 1)]
            sizes = rows.groupBy("prefix").agg(F.sum(F.coalesce(*weights)).alias("n"), F.count(F.lit(1)).alias("rows"))
            # Where one fingerprint is alone nothing can collide.
            sizes = durable(sizes.where("rows > 1"))
            calm, hot = (sizes.where(test).select("prefix") for test in (F.col("n") <= GROUP_VARIANTS, F.col("n") > GROUP_VARIANTS))
            part = rows.join(calm, "prefix", "left_semi").groupBy("prefix").applyInArrow(leaf(depth), LINKS)
        found = part if found is None else found.union(part)
        if hot is None or hot.isEmpty():
            return found.distinct()
        rows = rows.join(hot, "prefix", "left_semi")


def grouped(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, fp, text_hash`` of every row, and ``fp, root, component_id`` of every distinct fingerprint."""
    if distance % 2:
        raise ValueError("the distance is twice the variants' radius, so it is even")
    own = docs.select("doc_id", fingerprint_udf(shingle)(F.col("text")).alias("fp"), F.xxhash64("text").alias("text_hash"))
    own = durable(own)
    firsts = durable(own.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(firsts.select("fp"), distance))
    roots = roots.withColumnRenamed("node", "fp")
    linked, single = firsts.join(roots, "fp"), firsts.join(roots, "fp", "left_anti")
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    # A group may hold any share of the fingerprints: its one row meets them in several tasks.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = linked.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int"))
    joined = salted.join(smallest.select("*", salts), ["root", "salt"]).select("fp", "root", "component_id")
    return own, joined.union(single.select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id")))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """Per document: ``doc_id``, ``fp`` (signed long), ``root`` (long, one per group) and ``component_id``.

    Groups are connected components of "fingerprints differ in at most ``distance``
    bits"; ``component_id`` is the smallest doc_id of the group. Shingles are of
    ``shingle`` words, ASCII letters in lower case, repeats included; fewer words make
    one shingle of them all. Null, empty and blank texts have fingerprint 0 and are
    linked like any other. Equal rows stay separate rows with equal results; a null
    doc_id is kept and is never the smallest unless all ids of its group are null.
    Other columns of ``docs`` are not read.
    """
    own, groups = grouped(docs, shingle, distance)
    return own.join(groups, "fp").select("doc_id", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row left of each group of ``near_duplicates``: one that has the group's smallest id.

    Of several rows with that id the one of the smallest fingerprint and text hash stays;
    of rows with the same id and text any one. A group without ids keeps one row. Ids and hashes
    alone are grouped; texts move once, to be joined with what stays.
    """
    own, groups = grouped(docs, shingle, distance)
    ranked = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "text_hash")
    chosen = own.join(groups, "fp").groupBy("root").agg(F.min(ranked).alias("kept"))
    lowest = F.lit(-(1 << 63)).cast("long")
    stays = chosen.select(F.coalesce("kept.doc_id", lowest).alias("_id"), F.col("kept.text_hash").alias("_hash"))
    keyed = docs.withColumn("_id", F.coalesce("doc_id", lowest)).withColumn("_hash", F.xxhash64("text"))
    left = keyed.join(stays, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    return left.select(*docs.columns)


def hex_of(fp):
    """Sixteen lower-case hex digits of a long."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
