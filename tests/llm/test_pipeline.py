"""The corpus pipeline and the registered queries, over whole driver tables."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from tellerline.llm import queries, quality_classifier, toxicity
from tellerline.llm.common import DOCUMENT_COLUMNS
from test_simhash import classes, fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_are_those_of_the_contract():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "decontamination", "packing"]
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert [f"op{n}_" for n in range(1, 14)] == sorted({q.split("_")[0] + "_" for q in queries.QUERIES}, key=lambda q: int(q[2:-1]))


def expected_kept(spark):
    """The filtering stages one after another, each on what the one before kept, by brute force where the rule is fixed."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    items = [r.text.strip() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = docs
    for operator, good in ((quality_classifier, 1), (toxicity, 0)):
        passed = {r.doc_id for r in operator.scored(kept, labels).collect() if r.predicted == good}
        kept = kept.where(kept.doc_id.isin(list(passed)))
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    group = classes([fingerprint(t) for _, t in rows], 4)
    first = {g: k for k, g in reversed(list(enumerate(group)))}
    rows = [rows[k] for k in sorted(first.values())]
    return [(i, t) for i, t in rows if not any(x in t for x in items)]


def test_pipeline_equals_its_stages_by_brute_force(spark):
    pieces = corpus_pipeline.run(spark, SF).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for i, text in expected_kept(spark):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 2048):
            part = np.array(ids[at : at + 2048], "<u4")
            expected[i, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces) == expected


@pytest.mark.parametrize("stage", [f for name, f in corpus_pipeline.STAGES])
def test_stages_take_empty_odd_and_extra(spark, docs, stage):
    rows = [(1, None), (2, ""), (3, "a b c d e f"), (3, "a b c d e f"), (None, "x"), (5, "long " * 40_000)]
    for data in (rows, []):
        out = stage(spark, docs(data), SF)
        found = out.collect()
        if stage is not corpus_pipeline.pack:
            assert out.columns == list(DOCUMENT_COLUMNS)
            assert len(found) <= len(data)
        else:
            assert len({(r.sequence_id, r.offset) for r in found}) == len(found)


OWN = {
    "op1_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op2_quality_classifier": "doc_id held_out score predicted",
    "op3_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op4_toxicity": "doc_id held_out score predicted",
    "op5_license_scan": "doc_id license",
    "op6_decontamination": "doc_id item_id",
    "op7_language_id": "doc_id held_out lang_pred score",
    "op8_url_filter": "page_id host path rule verdict",
    "op9_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10_simhash": "doc_id fingerprint component_id",
    "op11_conversation_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op12_phrase_mining": "lang rank phrase a l r n score",
    "op13_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
}


@pytest.mark.parametrize("name", OWN)
def test_query_has_its_columns_and_a_row_per_document(spark, name):
    result = queries.QUERIES[name](spark, SF)
    wanted = OWN[name].split()
    assert result.columns[: len(wanted)] == wanted
    rows = result.collect()
    if name == "op11_conversation_repair":
        assert len(rows) == spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    elif name not in ("op3_packing", "op5_license_scan", "op6_decontamination", "op12_phrase_mining"):
        table = "pages" if name == "op8_url_filter" else "documents"
        assert len(rows) == spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert rows
