"""Language identification by compression with per-language dictionaries.

A text is compressed once with each language's dictionary of raw text; the language
whose dictionary makes it smallest is chosen, and the choice is marked as rejected
when the next one comes close. Long texts are compressed by blocks, so that all
of a text speaks and not only its beginning, and memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from tellerline.llm.common import blocks, fold_of, text_bytes, unused

FOLDS, HELD_OUT = 4, 2
#: What is learned from: texts per language, bytes of a text, bytes of a dictionary.
TRAIN_TEXTS = 400
CELLS = 64
TRAIN_BYTES = 1 << 14
DICTIONARY_BYTES = 1 << 18
#: Languages that can be told apart: dictionaries of 64 MB in all, which every task holds.
LANGUAGES = 256
#: Bytes that are compressed at once: few, so that the dictionary matters more than the text before.
BLOCK = 1 << 11
LEVEL = 3
#: The least gain over the second-best size, as a share of the best, that is not narrow.
MARGIN = 0.02
UNKNOWN = "und"

RESULT = "struct<lang: string, score: double, margin: double, rejected: boolean>"


#: ASCII letters in lower case, the bytes of other characters as they are, and a blank for all else.
LETTERS = bytes((b | 32) if 65 <= b <= 90 or 97 <= b <= 122 else b if b >= 128 else 32 for b in range(256))


def folded(text: str) -> bytes:
    """The words in lower case, without ASCII digits and signs."""
    return b" ".join(text.lower().encode().translate(LETTERS).split())


@dataclass(frozen=True)
class Languages:
    """Names in order of how many documents taught them, and their dictionaries."""

    names: list[str]
    dictionaries: list[bytes]

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for raw in self.dictionaries:
            words = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(dict_data=words, write_checksum=False, write_content_size=False, write_dict_id=False))
        return out


def fit(docs: DataFrame) -> Languages:
    """Dictionaries of bounded samples: per language the texts of smallest id hash outside the held-out fold.

    Each language's texts are joined, in that order, up to the dictionary's size. Null
    or empty texts, null ids and languages and texts over ``TRAIN_BYTES`` teach nothing. Of several
    texts of an id and language the smallest counts. More than ``LANGUAGES`` languages are refused.
    """
    taught = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    rows = docs.select("doc_id", "text", "lang").where(taught & F.octet_length("text").between(1, TRAIN_BYTES))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn; is lang a language?")
    # First within cells, so that no task sees more than a bounded part of a language; ids alone are moved.
    ranked = rows.select("lang", "doc_id", F.xxhash64("doc_id").alias("place")).withColumn("cell", F.pmod("place", F.lit(CELLS)))
    for groups in (("lang", "cell"), ("lang",)):
        along = Window.partitionBy(*groups).orderBy("place", "doc_id")
        ranked = ranked.withColumn("n", F.row_number().over(along)).where(F.col("n") <= TRAIN_TEXTS)
    chosen = ranked.groupBy("lang", "doc_id").agg(F.min("n").alias("n"))
    # No more rows than that are chosen; said so, Spark knows them to be few and leaves the texts where they are.
    chosen = chosen.limit(TRAIN_TEXTS * max(1, len(counts)))
    texts = rows.join(chosen, ["lang", "doc_id"]).groupBy("lang", "n").agg(F.min("text").alias("text"))
    sample: dict[str, list[tuple[int, str]]] = {}
    for row in texts.toLocalIterator():
        sample.setdefault(row["lang"], []).append((row["n"], row["text"]))
    names = sorted(sample, key=lambda name: (-counts[name], name))
    return Languages(names, [b"\n".join(folded(t) for _, t in sorted(sample[n]))[:DICTIONARY_BYTES] for n in names])


def sizes(texts: pa.Array, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Compressed bytes of each text (a row) with each dictionary (a column)."""
    data, bounds = text_bytes(texts)
    total = np.zeros((len(texts), len(compressors)), np.int64)
    for block, edges, rows, _ in blocks(data, bounds, BLOCK):
        for row, start, end in zip(rows.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if end > start:
                raw = folded(block[start:end].tobytes().decode())
                total[row] += np.array([len(c.compress(raw)) for c in compressors], np.int64)
    return total


def judged(texts: pa.Array, languages: Languages, compressors: list[zstandard.ZstdCompressor], margin: float) -> pa.StructArray:
    known = sizes(texts, compressors)
    names, scores, margins, rejected = [], [], [], []
    for text, own in zip(texts, known, strict=True):
        if not languages.names or text.as_py() is None or not any(map(str.isalpha, text.as_py())):
            names.append(UNKNOWN)
            scores.append(0.0)
            margins.append(0.0)
            rejected.append(True)
            continue
        best = int(np.argmin(own))  # the first, and so the more common, of equals
        others = np.delete(own, best)
        gain = float((others.min() - own[best]) / own[best]) if len(others) else 1.0
        names.append(languages.names[best])
        scores.append(float(1 / np.exp2(np.maximum(own[best] - own, -1000)).sum()))
        margins.append(gain)
        rejected.append(gain < margin)
    kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip((names, scores, margins, rejected), kinds, strict=True)], ["lang", "score", "margin", "rejected"])


def judge_udf(languages: Languages, margin: float = MARGIN):
    @arrow_udf(RESULT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compressors = languages.compressors()
        for texts in batches:
            yield judged(texts, languages, compressors, margin)

    return judge


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``lang_pred, score, margin, rejected`` in place of any such columns.

    ``lang_pred`` is the language of the smallest size, the more common one of equals, and
    ``und`` for texts that are null or have no letter, or if no language was learned (score 0 then, and
    rejected). ``score`` weighs languages by 2 to the power of bytes saved; ``rejected`` marks narrow margins.
    """
    own = unused(docs, "_judged")
    out = docs.withColumn(own, judge_udf(fit(docs))(F.col("text")))
    out = out.withColumn("lang_pred", F.col(f"{own}.lang"))
    for name in ("score", "margin", "rejected"):
        out = out.withColumn(name, F.col(f"{own}.{name}"))
    return out.drop(own)
