import hashlib
import random
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from tellerline.llm import conversation_repair, queries
from tellerline.llm.conversation_repair import END, INITIALS, matrix, symbol, vectors, walk

SF = "/root/testdata/sf0.01"
sys.setrecursionlimit(20_000)
SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


# --- brute force: every edit of every row, by recursion over (row, last role written) ------


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        k = zlib.crc32(key.encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else "".join(c for c in text if c not in ".!?") if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def fits(written):
    """Whether ``s?(ua)+`` or nothing can still come of these initials."""
    body = written[1:] if written[:1] == "s" else written
    return all(c == "ua"[k % 2] for k, c in enumerate(body))


def best(rows, wrong):
    n = len(rows)

    def moves(i, last):
        """(edit, next row, cost, role written or None) from a row with the initials' last letter ('' at the start)."""
        for role in ("user", "assistant"):
            yield "I", i, 3, role
        if i < n:
            _, role, _ = rows[i]
            yield "D", i + 1, 4, None
            if wrong[i] not in ("blank", "duplicate"):
                more = 3 if wrong[i] == "truncated" else 0
                yield "K", i + 1, more, role
                for new in ("user", "assistant"):
                    yield "R", i + 1, 3 + more, new

    def step(last, role):
        c = role[:1]
        ok = (c == "s" and last == "") or (c == "u" and last in ("", "s", "a")) or (c == "a" and last == "u")
        return c if ok else None

    @lru_cache(None)
    def solve(i, last, room):
        """(cost, audit, repaired) with at most ``room`` rows inserted before the next row is used."""
        found = []
        if i == n and last in ("", "a"):
            found.append((0, "", ()))
        for edit, j, cost, role in moves(i, last):
            if edit == "I" and not room:
                continue
            now = last if role is None else step(last, role)
            if now is None:
                continue
            rest = solve(j, now, room - 1 if edit == "I" else 3)
            if rest is None:
                continue
            line = () if role is None else ((role, "" if edit == "I" else rows[i][2]),)
            found.append((cost + rest[0], edit + rest[1], line + rest[2]))
        return min(found) if found else None

    return solve(0, "", 3)


def expected(rows):
    """Per conversation all columns of the query."""
    groups = defaultdict(list)
    for conv, turn, role, text in damaged(rows):
        groups[conv].append((turn, role, text))
    out = {}
    for conv in {r[0] for r in rows}:
        own = groups[conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        wrong = faults(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        cost, audit, lines = best(tuple(own), tuple(wrong))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        counts = [wrong.count(k) for k in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return out


def query(spark, rows, spacing=None, extra=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        df = df.selectExpr("*", *[f"'x' AS {c}" for c in ("id", "digest", "blank", "first", "audit", "cost", "initial", "tie", "place")])
    repair = conversation_repair.repaired(conversation_repair.damaged(df), spacing)
    known = conversation_repair.together(repair.conversations, conversation_repair.digests(repair.rows))
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    empty = hashlib.sha256(b"").hexdigest()
    found = {r.conv_id: tuple(r[n] for n in names[:-1]) + (r.repaired_sha256 or empty,) for r in known.collect()}
    zeros = (0, 0, 0, 0, 0, 0, "", empty)
    return {conv: found.get(conv, zeros) for conv in {r[0] for r in rows}}


ROLES = ("system", "user", "assistant", "tool", "", "useless", None)
TEXTS = ("", " \t", "One.", "two", "Three!", "é?  ", "no end ", None)


def random_rows(rng, conversations, most):
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, most)):
            at = None if rng.random() < 0.1 else rng.choice([turn, turn, turn, turn + 1, 2 * turn])
            rows.append((conv if conv else None, at, rng.choice(ROLES[:3] if rng.random() < 0.7 else ROLES), rng.choice(TEXTS)))
    return rows


@pytest.mark.parametrize("spacing", [None, 2, 1000])
def test_random_conversations_equal_brute_force(spark, spacing):
    rows = random_rows(random.Random(spacing), 60, 9)
    assert query(spark, rows, spacing) == expected(rows)


def test_repeated_rows_and_one_long_conversation(spark):
    rng = random.Random(3)
    rows = [(7, t // 3, rng.choice(ROLES[:3]), f"{rng.randint(0, 40)}{rng.choice('.!x')}") for t in range(300)]
    rows += [(7, None, "user", "same.")] * 50 + [(8, 1, "user", "long " * 40_000 + ".")]
    assert query(spark, rows, 5, extra=True) == expected(rows)


def test_empty_table(spark):
    assert query(spark, []) == {}


def test_repaired_rows_are_whole_and_in_order(spark):
    rows = [(1, 5, "assistant", "b."), (1, 2, "system", "s."), (1, 9, "user", "no end"), (2, 1, "user", "")]
    repair = conversation_repair.repaired(spark.createDataFrame(rows, SCHEMA))
    found = sorted(tuple(r) for r in repair.rows.collect())
    assert found == [(1, 0, "K", "system", "s."), (1, 1, "I", "user", ""), (1, 2, "K", "assistant", "b.")]
    assert {r.conv_id: r.audit for r in repair.conversations.collect()} == {1: "KIKD", 2: "D"}


def test_blocks_join_to_the_whole(monkeypatch):
    """Vectors over checkpoints, matrices and walks by blocks give what one pass gives."""
    rng = random.Random(5)
    for _ in range(200):
        marks = "".join(symbol(rng.randrange(4), rng.randrange(3)) for _ in range(rng.randint(1, 30)))
        cuts = sorted(rng.sample(range(1, len(marks) + 1), min(3, len(marks))))
        blocks = [marks[a:b] for a, b in zip([0, *cuts], [*cuts, len(marks)]) if b > a]
        ends, costs = [], END
        for block in reversed(blocks):
            ends.insert(0, costs)
            own = matrix(block)
            costs = tuple(min(own[4 * q + r] + costs[r] for r in range(4)) for q in range(4))
        first, base = vectors(marks, END)[0]
        assert costs == tuple(c + base for c in first)
        audit, spent, state = "", 0, 0
        for k, (block, end) in enumerate(zip(blocks, ends)):
            part, cost, state = walk(block, end, state, k == len(blocks) - 1)
            audit, spent = audit + part, spent + cost
        assert (audit, spent) == walk(marks, END, 0, True)[:2]
        assert spent == costs[0]


def test_query_equals_brute_force_over_its_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = queries.QUERIES["op11_conversation_repair"](spark, SF)
    assert result.columns == "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    assert {r.conv_id: tuple(r)[1:] for r in result.collect()} == expected(rows)
    assert INITIALS == "sua"
