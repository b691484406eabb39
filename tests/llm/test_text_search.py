"""Decontamination, license scan and language ID."""

import random
import textwrap
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tellerline.llm import decontaminate, language_id, license_scan
from tellerline.llm.common import fold_of

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcdeéß")
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, rng.choice("abcé"))
    return "".join(out)


def folded(text):
    return "".join(c.lower() if c.isascii() else c for c in text).translate({c: " " for c in (9, 10, 11, 12, 13)})


def window_matches(text, window, budget):
    """Whether the window aligns somewhere in the text within the budget: the whole table, no bands."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(window, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row) <= budget


def brute(texts, items, window=24, stride=8, rate=0.1):
    out = set()
    for row, text in enumerate(texts):
        for k, (_, item) in enumerate(items):
            item = folded(item.strip())
            if len(item) < decontaminate.Q:
                continue
            last = max(0, len(item) - window)
            for at in {*range(0, last, stride), last}:
                part = item[at : at + window]
                budget = min(int(rate * len(part)), (len(part) + 1) // decontaminate.Q - 1)
                if window_matches(folded(text or ""), part, budget):
                    out.add((row, k))
                    break
    return out


def test_no_passage_within_the_budget_is_lost_and_none_beyond_is_found(monkeypatch):
    """Against the full alignment table, with edits around the budget and passages at either end of a text."""
    monkeypatch.setattr(decontaminate, "WINDOW", 24)
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abdeinorst") for _ in range(rng.randrange(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(4, 9)))) for i in range(8)] + [(90, "short"), (91, "tiny one"), (92, "  ")]
    texts = [None, ""]
    for k in range(60):
        _, item = items[k % 8]
        at = rng.randrange(max(1, len(item) - 26))
        part = edited(rng, item[at : at + rng.choice((24, 30, 60))], rng.randrange(6))
        before, after = " ".join(word() for _ in range(rng.randrange(6))), " ".join(word() for _ in range(rng.randrange(6)))
        texts.append(before + part.upper() + "\n" + after)
    p = decontaminate.probes(items, window=24, stride=8)
    found = decontaminate.leaks(pa.array(texts), p)
    assert set(zip(found["row"].tolist(), found["item"].tolist())) == brute(texts, items)


def test_planted_passages(docs, spark, items):
    rng = random.Random(3)
    benchmark = spark.createDataFrame([*items, (900, None), (901, "tiny"), (None, "x" * 200), (0, items[0][1])], "item_id long, text string")
    clean = [(i, " ".join(rng.choice(("plain", "words", "only", "here")) for _ in range(200))) for i in range(20)]
    planted = [(100 + k, "some text before " + edited(rng, t.strip(), len(t) // 14) + " and after") for k, (_, t) in enumerate(items[:20])]
    long = (300, "é " * 300_000 + items[5][1] + " x" * 300_000 + items[7][1])
    rows = [*clean, *planted, long, (400, None), (401, ""), (None, items[2][1]), (100, planted[0][1])]
    found = decontaminate.contaminated(docs(rows), benchmark).collect()
    assert {r.doc_id for r in found} == {*range(100, 120), 300, None}
    assert {r.item_id for r in found if r.doc_id == 300} == {items[5][0], items[7][0]}
    spans = {r.item_id: (r.start, r.end) for r in found if r.doc_id == 300}
    for item, (start, end) in spans.items():
        assert folded(long[1][start:end]).strip() in folded(dict(items)[item])
    assert sum(r.doc_id == 100 for r in found) == 2 * sum(r.doc_id == 100 for r in found) // 2 >= 2
    left = decontaminate.without_leaks(docs(rows), benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [*range(20), 400, 401]
    assert "shard" in left.columns


def test_items_in_blocks_and_empty_tables(docs, spark, items, monkeypatch):
    rows = [(k, t) for k, (_, t) in enumerate(items)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = decontaminate.contaminated(docs(rows), benchmark).collect()
    blocks = list(decontaminate.item_blocks(benchmark, 1000))
    assert len(blocks) > 3 and sorted(i for b in blocks for i, _ in b) == sorted(i for i, _ in items)
    monkeypatch.setattr(decontaminate, "item_blocks", lambda b: iter(blocks))
    assert sorted(map(tuple, whole)) == sorted(map(tuple, decontaminate.contaminated(docs(rows), benchmark).collect()))
    monkeypatch.undo()
    none = benchmark.where("false")
    assert decontaminate.contaminated(docs(rows), none).collect() == []
    assert decontaminate.without_leaks(docs(rows), none).count() == len(rows)
    assert decontaminate.contaminated(docs([]), benchmark).collect() == []


def lowered(text):
    """Lower case as ``str`` has it, both forms of sigma alike; white space a blank."""
    return "".join(" " if c.isspace() else c for c in text.lower()).replace("ς", "σ")


@pytest.mark.parametrize("letters", ["éüñöàçøaest", "абвгдежзик", "αβγδελμσς", "𐐨𐐩𐐪𐐫𐐬𐐭"])
def test_case_is_folded_in_every_script(monkeypatch, letters):
    monkeypatch.setattr(decontaminate, "WINDOW", 24)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randrange(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(5, 9)))) for i in range(6)]
    texts = []
    for k in range(30):
        part = edited(rng, items[k % 6][1], rng.randrange(6))
        texts.append(word() + " " + (part.upper(), part.title(), part)[k % 3].replace(" ", "\u00a0") + "\u3000" + word().upper())
    texts = [t.replace("SS", "ß") for t in texts]  # the one letter whose capitals are two
    found = decontaminate.leaks(pa.array(texts), decontaminate.probes(items, window=24, stride=8))
    expected = brute([lowered(t) for t in texts], [(i, lowered(t)) for i, t in items])
    assert set(zip(found["row"].tolist(), found["item"].tolist())) == expected and len(expected) >= 15


def test_every_case_of_a_character_is_one():
    fold = decontaminate.folded
    for code in [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]:
        char = chr(code)
        assert code < 1 << 17 or (char == char.lower() == char.upper() and not char.isspace())
        assert all(len(other) > 1 or fold(ord(other)) == fold(code) for other in (char.lower(), char.upper()))


def test_items_in_capitals_are_found(docs, spark, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs([(k, "Before. " + t.upper() + " After.") for k, (_, t) in enumerate(items)]), benchmark)
    pairs = {(r.doc_id, r.item_id): r.edits for r in found.collect()}
    assert all(pairs.get((k, i)) == 0 for k, (i, t) in enumerate(items) if "ß" not in t)
    assert all((k, i) in pairs for k, (i, _) in enumerate(items))


# --- licenses -------------------------------------------------------------------


def test_licenses_are_told_apart(docs):
    rows = [
        (1, "text\nLicensed under the Apache License, Version 2.0.\nmore"),
        (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, "This work is licensed under the GNU General Public License, version 2."),
        (4, "Licensed under CC BY-NC 4.0. and Released under the MIT License."),
        (5, "Licensed under CC BY 4.0."),
        (6, "Licensed under the Apache License, Version 3.0."),
        (7, "the license of this song is unclear, and copyright is a word"),
        (8, "THIS WORK IS  licensed under a GNU general public license; version 3"),
        (9, None),
        (10, ""),
        (11, "no cue"),
        (12, "x " * 30_000 + "Released under the MIT License." + " y" * 30_000),
        (13, "This work is not licensed under the GNU General Public License, version 3."),
        (1, "text\nLicensed under the Apache License, Version 2.0.\nmore"),
    ]
    found = license_scan.scanned(docs(rows)).collect()
    got = sorted((r.doc_id, r.license) for r in found)
    assert got == [
        (1, "apache-2.0"),
        (1, "apache-2.0"),
        (2, "gpl-3.0"),
        (3, "gpl-2.0"),
        (4, "cc-by-nc-4.0"),
        (4, "mit"),
        (5, "cc-by-4.0"),
        (8, "gpl-3.0"),
        (12, "mit"),
    ]
    text = dict(rows)
    for r in found:
        assert text[r.doc_id][r.start : r.end].lower().split()[-1].rstrip(".") in text[r.doc_id].lower()
        assert r.saved > 0
    assert next(r.differences for r in found if r.doc_id == 8) == ["-the", "+a"]
    assert license_scan.scanned(docs([])).collect() == []


def test_every_license_line_of_the_table(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    lines = {
        "apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "mit": "Released under the MIT License.",
        "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    }
    expected = sorted(
        (r.doc_id, name) for r in source.collect() for name, line in lines.items() for own in r.text.split("\n") if line in own
    )
    assert sorted((r.doc_id, r.license) for r in license_scan.scanned(source).collect()) == expected and expected


def test_every_license_of_a_long_line_is_found(docs):
    """Four notices and more in prose without line ends, near-twins among them."""
    rng = random.Random(9)
    names = list(license_scan.TEMPLATES)
    rows, expected = [], []
    for k in range(40):
        chosen = rng.sample(names, 4 + k % 5)
        parts = []
        for name in chosen:
            parts += [" ".join("".join(rng.choice("abdeinorst") for _ in range(rng.randrange(2, 8))) for _ in range(12)) + "."]
            parts += [license_scan.TEMPLATES[name][0]]
        rows.append((k, " ".join(parts)))
        expected += [(k, name) for name in chosen]
    found = {(r.doc_id, r.license) for r in license_scan.scanned(docs(rows)).collect()}
    assert found == set(expected)


def wrapped(rng, text, mark, width):
    return "\n".join(f"{mark}{line}" for line in textwrap.wrap(text, width))


@pytest.mark.parametrize("mark", ["", " * ", "// ", "# ", "    ", "dnl ", "REM "])
def test_notices_that_wrap_over_lines(docs, mark):
    """Every template at every customary width, twice in a text, with lines before and after."""
    rng = random.Random(13)
    rows, expected = [], []
    for name, texts in license_scan.TEMPLATES.items():
        for text in texts:
            for width in (24, 40, 60, 72):
                notice = wrapped(rng, text, mark, width)
                k = len(rows)
                rows.append((k, f"{mark}Copyright someone.\n{notice}\n{mark}Other words of the text.\n" + "plain words\n" * 60 + notice))
                expected += [(k, name)] * 2
    found = license_scan.scanned(docs(rows)).collect()
    assert sorted((r.doc_id, r.license) for r in found) == sorted(expected)
    text = dict(rows)
    assert all(r.differences == [] and r.saved > 0 for r in found)
    for r in found:
        words = license_scan.WORD.findall(license_scan.WORD_MARK.sub("", text[r.doc_id][r.start : r.end]).lower())
        assert words == license_scan.WORD.findall(license_scan.TEMPLATES[r.license][r.template].lower())


def test_customary_headers(docs):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the"
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions\n# are met:"
    gpl = " * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version."
    two = gpl.replace("3", "2")
    rows = [(1, mit), (2, bsd), (3, gpl), (4, two), (5, "x\n" * 4000 + mit + "\n" + bsd + "\ny" * 4000)]
    found = license_scan.scanned(docs(rows)).collect()
    assert sorted((r.doc_id, r.license) for r in found) == [(1, "mit"), (2, "bsd"), (3, "gpl-3.0"), (5, "bsd"), (5, "mit")]


def fewest_differences(template, window):
    """Words left out and added, by the longest common subsequence; the whole table."""
    row = [(j, [f"+{w}" for w in window[:j]]) for j in range(len(window) + 1)]
    for i, a in enumerate(template, 1):
        new = [(i, [f"-{w}" for w in template[:i]])]
        for j, b in enumerate(window, 1):
            if a == b:
                new.append(row[j - 1])
            else:
                new.append(min((row[j][0] + 1, [*row[j][1], f"-{a}"]), (new[j - 1][0] + 1, [*new[j - 1][1], f"+{b}"]), key=lambda x: x[0]))
        row = new
    return row[-1][1]


def named_by_brute_force(text, known):
    """Licenses of which some template fits some window of the text's words, every window tried."""
    words = [w.lower() for w in license_scan.WORD.findall(text)]
    out = set()
    for t in known.templates:
        n, k = len(t.words), t.slack
        for first in range(len(words)):
            for last in range(first + max(1, n - k), min(len(words), first + n + k) + 1):
                window = words[first:last]
                if window[0] not in t.words or window[-1] not in t.words or sum(w in window for w in t.words) < n - k:
                    continue
                if license_scan.confirmed(t, fewest_differences(t.words, window)):
                    out.add(t.license)
    return out


def test_licenses_equal_brute_force_over_all_windows():
    """Short templates with up to more changes than they may have, in prose of the templates' own words and others."""
    known = license_scan.licenses()
    short = [t for t in known.templates if len(t.words) <= 16]
    rng = random.Random(21)
    prose = [*sorted({w for t in short for w in t.words if w not in license_scan.TELLING and w.isalpha()}), "tree", "river", "stone", "cloud"]
    only = license_scan.Licenses(short, known.plain)
    agreed = 0
    for k in range(120):
        t = short[k % len(short)]
        words = list(t.words)
        for _ in range(rng.randrange(t.slack + 2)):
            at = rng.randrange(len(words))
            kind = rng.randrange(3)
            if kind == 0:
                words[at] = rng.choice(prose)
            elif kind == 1:
                del words[at]
            else:
                words.insert(at, rng.choice(prose))
        parts = [*(rng.choice(prose) for _ in range(rng.randrange(12))), *words, *(rng.choice(prose) for _ in range(rng.randrange(12)))]
        text = " ".join(parts)
        found = {name for name, *_ in license_scan.scan_text(text, only)}
        assert found == named_by_brute_force(text, only), text
        agreed += bool(found)
    assert 40 < agreed < 120


def test_wordings_without_any_cue(docs):
    """One changed word, also where it opens the passage; whole licenses; identifiers, which must be whole."""
    bsd = license_scan.TEMPLATES["bsd"][0].replace("Redistribution and use", "Redistributions and use")
    mit = license_scan.TEMPLATES["mit"][1].replace("is hereby", "is thereby")
    whole = "\n\n".join(license_scan.TEMPLATES["isc"])
    rows = [
        (1, bsd),
        (2, mit),
        (3, "// SPDX-License-Identifier: Apache-2.0"),
        (4, "SPDX-License-Identifier: MIT-0\nSPDX-License-Identifier: (GPL-2.0-only OR x)"),
        (5, whole),
        (6, "This work is licensed under a Creative Commons Attribution 4.0 International License."),
        (7, "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
        (8, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
        (9, "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ]
    found = license_scan.scanned(docs(rows)).collect()
    assert sorted((r.doc_id, r.license) for r in found) == [
        (1, "bsd"), (2, "mit"), (3, "apache-2.0"), (4, "gpl-2.0-only"), (5, "isc"), (5, "isc"), (6, "cc-by-4.0"), (8, "mpl-2.0"), (9, "lgpl-2.1"),
    ]
    assert {r.doc_id: r.template for r in found}[3] == -1
    assert next(r.differences for r in found if r.doc_id == 1) == ["-redistribution"]


def test_blocks_of_words_overlap_and_cover():
    text = " ".join(f"w{i}x" for i in range(1000))
    words = license_scan.WORD.findall(text)
    got = list(license_scan.blocks(text, 40, 15))
    assert [w for _, _, w in got] == [words[first : first + 40] for first, _, _ in got]
    assert {first + k for first, _, w in got for k in range(len(w))} == set(range(len(words)))
    assert all(b[0] - a[0] == 25 for a, b in zip(got, got[1:]))
    assert list(license_scan.blocks("", 40, 15)) == []


def test_a_text_of_100_mb_is_scanned_in_bounded_memory(tmp_path):
    """In a process of its own, whose largest size is then known."""
    import subprocess
    import sys

    program = f"""
import resource, sys
sys.path.insert(0, {str(Path(license_scan.__file__).parents[2])!r})
from tellerline.llm import license_scan
known = license_scan.licenses()
text = "some words here, and more of them. " * 2_900_000
text = text[:50_000_000] + license_scan.TEMPLATES["mit"][0] + text[50_000_000:]
found = license_scan.scan_text(text, known)
print(len(text), [f[0] for f in found], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    out = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, check=True, timeout=600).stdout
    size, names, peak = out.split(" ", 1)[0], out.split("[")[1].split("]")[0], int(out.split()[-1])
    assert int(size) > 100_000_000 and names == "'mit'" and peak < 500


# --- languages ------------------------------------------------------------------


def test_held_out_languages(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language_id.identified(source).where(fold_of(F.col("doc_id"), 4) == 2).collect()
    right = [r.lang_pred == r.lang for r in rows]
    assert len(rows) > 150 and np.mean(right) >= 0.95
    sure = [r.lang_pred == r.lang for r in rows if not r.rejected]
    assert np.mean(sure) >= np.mean(right) and all(0 <= r.score <= 1 for r in rows)


def test_language_edges(docs):
    de, en = "der hund und die katze sind nicht hier gewesen ", "the dog and the cat have not been here "
    rng = random.Random(1)
    mixed = lambda text, n: " ".join(rng.choice(text.split()) for _ in range(n))
    known = [(i, mixed(de if i % 2 else en, 60), "de" if i % 2 else "en") for i in range(40)]
    odd = [(900, None, "en"), (901, "", None), (902, "123 --- 456", None), (903, de, None), (904, mixed(en, 100_000), None), (None, de, None)]
    found = language_id.identified(docs([*known, *odd]))
    assert found.columns.count("score") == 1
    pred = {r.doc_id: r for r in found.collect()}
    assert [pred[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and pred[900].score == 0.0
    assert pred[903].lang_pred == pred[None].lang_pred == "de" and pred[904].lang_pred == "en"
    assert language_id.identified(docs([])).collect() == []
    unlearned = language_id.identified(docs([(1, "some text", None)])).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in unlearned] == [("und", 0.0, True)]


def test_sizes_are_those_of_the_compressor():
    import zstandard

    languages = language_id.Languages(["a", "b"], [b"the dog and the cat " * 9, b"der hund und die katze " * 9])
    text = "Der Hund, und die Katze!"
    found = language_id.sizes(pa.array([text, None]), languages.compressors())
    for k, raw in enumerate(languages.dictionaries):
        words = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=language_id.LEVEL)
        plain = zstandard.ZstdCompressor(dict_data=words, write_content_size=False, write_dict_id=False)
        assert found[0, k] == len(plain.compress(b"der hund und die katze"))
    assert found[1].tolist() == [0, 0] and found[0].argmin() == 1


def test_too_many_languages_are_refused(docs, monkeypatch):
    monkeypatch.setattr(language_id, "LANGUAGES", 3)
    rows = docs([(i, "some words of a text", f"l{i % 5}") for i in range(60)])
    with pytest.raises(ValueError, match="languages"):
        language_id.identified(rows)
