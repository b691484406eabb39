"""Conversation structure repair by square-root checkpointed dynamic programming.

The cheapest edits that give a conversation the roles ``(s?(ua)+)?`` follow from
backward state costs: the least cost of all that comes from a row on, for each state
of the roles written so far. Vectors of these costs are kept only at checkpoints, the ends of blocks of
about the square root of the table's rows. Walking forward, a block's own vectors are computed
again from its checkpoint, and at every place the ASCII-least edit that keeps to the least cost is taken.

A conversation may hold any share of the rows. Rows are numbered by a range sort without their texts, so a long
conversation lies in many blocks. What a block costs between any two states is a 4 x 4 matrix; the checkpoints
follow from a conversation's matrices, and the states in which its blocks begin from where each block's walk ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import inf, isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tellerline.llm.common import durable

#: States by what was written last, and initials of roles; any other initial is 3.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
INITIALS = "sua"
#: The state after a row of each initial; None where the roles do not allow it.
AFTER = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))
#: The state after an inserted row or a row with a new role: the only one that the roles allow.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}

DELETE, INSERT, KEEP, REROLE = "DIKR"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
#: What is wrong with a row, as far as its edits are concerned.
FINE, TRUNCATED, UNWANTED = range(3)
#: White space.
BLANKS = " \t\n\x0b\x0c\r"

Vector = tuple[float, ...]


def symbol(initial: int, fault: int) -> str:
    return chr(ord("a") + 3 * initial + fault)


def closed(costs: Vector) -> Vector:
    """With up to two rows inserted; more never help."""
    return tuple(min(costs[q], INSERT_COST + costs[NEXT[q]], 2 * INSERT_COST + costs[NEXT[NEXT[q]]]) for q in STATES)


#: Costs behind the last row.
END = closed((0, inf, inf, 0))


@lru_cache(maxsize=1 << 16)
def _before(mark: str, costs: Vector) -> tuple[Vector, float]:
    """Costs before a row from those behind it, less their smallest, and that."""
    initial, fault = divmod(ord(mark) - ord("a"), 3)
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    out = []
    for q in STATES:
        best = DELETE_COST + costs[q]
        if fault != UNWANTED:
            kept = AFTER[q][initial]
            best = min(best, REROLE_COST + extra + costs[NEXT[q]], inf if kept is None else extra + costs[kept])
        out.append(best)
    own = closed(tuple(out))
    least = min(own)
    return tuple(c - least for c in own), least


def vectors(marks: str, end: Vector) -> list[tuple[Vector, float]]:
    """Costs before each row of a block and behind it, as (costs less a base, base)."""
    least = min(end)
    out = [(tuple(c - least for c in end), least)]
    for mark in reversed(marks):
        costs, base = out[-1]
        own, more = _before(mark, costs)
        out.append((own, base + more))
    return out[::-1]


def matrix(marks: str) -> list[float]:
    """The least costs from each state before a block (rows) to each behind it (columns)."""
    columns = []
    for r in STATES:
        costs, base = (tuple(0 if q == r else inf for q in STATES), 0.0)
        for mark in reversed(marks):
            costs, more = _before(mark, costs)
            base += more
        columns.append([c + base for c in costs])
    return [columns[r][q] for q in STATES for r in STATES]


def walk(marks: str, end: Vector, state: int, last: bool) -> tuple[str, int, int]:
    """(audit, cost, state behind) of a block entered in a state; the last block ends with what is still to be inserted."""
    costs = vectors(marks, end)
    out, spent = [], 0
    for i, mark in enumerate(marks):
        (here, base), (behind, other) = costs[i], costs[i + 1]
        initial, fault = divmod(ord(mark) - ord("a"), 3)
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        while True:
            left = here[state] + base
            if left == DELETE_COST + behind[state] + other:
                out.append(DELETE)
                spent += DELETE_COST
                break
            if left == INSERT_COST + here[NEXT[state]] + base:
                out.append(INSERT)
                spent += INSERT_COST
                state = NEXT[state]
                continue
            kept = AFTER[state][initial]
            if kept is not None and left == extra + behind[kept] + other:
                out.append(KEEP)
                spent += extra
                state = kept
            else:
                out.append(REROLE)
                spent += REROLE_COST + extra
                state = NEXT[state]
            break
    while last and END[state]:
        out.append(INSERT)
        spent += INSERT_COST
        state = NEXT[state]
    return "".join(out), spent, state


def illegal_pairs(marks: str) -> int:
    legal = ((0, 1), (1, 2), (2, 1))
    initials = [(ord(m) - ord("a")) // 3 for m in marks]
    return sum(pair not in legal for pair in zip(initials, initials[1:]))


# --- the same, for columns ------------------------------------------------------


def _udf(kind: str, function: Callable) -> Callable[..., Column]:
    """A function of Python values as a function of columns, in Arrow batches."""
    target = to_arrow_type(StructType.fromDDL(f"value {kind}")["value"].dataType)

    @arrow_udf(kind)
    def over(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            yield pa.array([function(*row.values()) for row in rows.to_pylist()], target)

    return lambda *columns: over(F.struct(*columns))


def _ends(chain: list[dict]) -> list[dict]:
    """The checkpoint behind each block of a conversation, from its blocks' matrices in order."""
    out, costs = [], END
    for part in reversed(chain):
        out.append({"first": part["first"], "end": list(costs)})
        costs = tuple(min(part["value"][4 * q + r] + costs[r] for r in STATES) for q in STATES)
    return out


def _exits(marks: str, end: list[float]) -> list[int]:
    return [walk(marks, tuple(end), q, last=False)[2] for q in STATES]


def _entries(chain: list[dict]) -> list[dict]:
    """The state in which each block of a conversation begins."""
    out, state = [], START
    for part in chain:
        out.append({"first": part["first"], "entry": state})
        state = part["value"][state]
    return out


def _walk(marks: str, end: list[float], entry: int, last: bool) -> dict:
    audit, cost, _ = walk(marks, tuple(end), entry, last)
    return {"audit": audit, "cost": cost, "illegal": illegal_pairs(marks)}


def _along(blocks: DataFrame, value: Column, function: Callable, kind: str) -> DataFrame:
    """What ``function`` makes of the values of a conversation's blocks in order: a row per block."""
    part = F.struct("first", value.alias("value"))
    chain = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("chain"))
    found = _udf(f"array<struct<first: long, {kind}>>", function)
    return chain.select(F.inline(found("chain")))


# --- conversations --------------------------------------------------------------


@dataclass(frozen=True)
class Repair:
    """``conversations``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``, one row for each that has rows.

    ``rows``: ``conv_id, place, edit, role, text``, the repaired conversations. Those of one lie in one
    partition in the order of ``place``, which is gapless from 0; deleted rows are not among them.
    """

    conversations: DataFrame
    rows: DataFrame


def _narrow(rows: DataFrame) -> DataFrame:
    bare = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    number = F.coalesce(*[F.when(initial == c, F.lit(k)) for k, c in enumerate(INITIALS)], F.lit(3))
    return rows.select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        number.alias("initial"),
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.monotonically_increasing_id().alias("tie"),
    )


ORDER = ("conv_id", "turn", "role", "digest")


def _marked(rows: DataFrame) -> DataFrame:
    """Every row's number ``id`` in the order of all conversations, without its text, and its first fault."""
    # Equal rows part by their places in the input, so no range is too large to be cut.
    sorted_rows = rows.repartitionByRange(*ORDER, "tie").sortWithinPartitions(*ORDER, "tie").drop("tie")
    numbered = durable(sorted_rows.withColumn("id", F.monotonically_increasing_id()))
    firsts = numbered.where("not blank").groupBy("conv_id", "role", "digest").agg(F.min("id").alias("id"))
    marked = numbered.join(firsts.select("id", F.lit(True).alias("is_first")), "id", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("is_first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    return durable(marked.select("id", *ORDER, "initial", fault.alias("fault")))


def _walked(marked: DataFrame, spacing: int) -> DataFrame:
    """Blocks with their audits: ``conv_id, first`` (the id of its first row)``, audit, cost, illegal`` and that row's sort columns."""
    kind = F.when(F.col("fault").isin("blank", "duplicate"), UNWANTED).when(F.col("fault") == "truncated", TRUNCATED).otherwise(FINE)
    mark = F.chr(F.lit(ord("a")) + F.col("initial") * 3 + kind)
    block = F.expr(f"id div {spacing}")
    gathered = F.sort_array(F.collect_list(F.struct("id", mark.alias("mark"))))
    first_row = F.min(F.struct("id", "turn", "role", "digest"))
    blocks = marked.groupBy("conv_id", block.alias("block")).agg(
        F.array_join(F.transform(gathered, lambda x: x["mark"]), "").alias("marks"), first_row.alias("row")
    )
    along = Window.partitionBy("conv_id").orderBy("row.id")
    blocks = blocks.select(
        "conv_id",
        F.col("row.id").alias("first"),
        "row.turn",
        "row.role",
        "row.digest",
        "marks",
        F.lag(F.right("marks", F.lit(1))).over(along).alias("before"),
        F.lead("row.id").over(along).isNull().alias("last"),
        F.lag("row.id").over(along).isNull().alias("opens"),
    )
    blocks = durable(blocks)
    end = F.array(*[F.lit(float(c)) for c in END])
    alone = blocks.where("opens and last").withColumns({"end": end, "entry": F.lit(START)})
    long = blocks.where("not (opens and last)")
    costs = long.withColumn("value", _udf("array<double>", matrix)("marks"))
    ends = _along(costs, F.col("value"), _ends, "end: array<double>")
    known = durable(long.join(ends, "first"))
    exits = known.withColumn("value", _udf("array<int>", _exits)("marks", "end"))
    entered = known.join(_along(exits, F.col("value"), _entries, "entry: int"), "first")
    ready = alone.unionByName(entered)
    done = ready.withColumn("done", _udf("struct<audit: string, cost: long, illegal: long>", _walk)("marks", "end", "entry", "last"))
    meets = F.concat("before", F.left("marks", F.lit(1)))
    legal = [symbol(a, x) + symbol(b, y) for a, b in ((0, 1), (1, 2), (2, 1)) for x in range(3) for y in range(3)]
    apart = F.when(F.col("before").isNotNull() & ~meets.isin(legal), 1).otherwise(0)
    return durable(done.select("conv_id", "first", "turn", "role", "digest", "done.audit", "done.cost", (F.col("done.illegal") + apart).alias("illegal")))


def _write(schema: pa.Schema) -> Callable:
    """Sorted rows, each block's audit before them, to repaired rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: object = None
        state, place, edits, at = START, 0, "", 0
        out: list[tuple] = []
        size = 0

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place, size
            out.append((conv, place, edit, role, text))
            place, size = place + 1, size + len(text) + len(role)

        def inserts() -> None:
            nonlocal at, state
            while at < len(edits) and edits[at] == INSERT:
                state, at = NEXT[state], at + 1
                put(INSERT, ROLES[state], "")

        def flushed() -> pa.RecordBatch:
            nonlocal out, size
            rows, out, size = out, [], 0
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        started = False
        for batch in batches:
            columns = (batch[c] for c in ("conv_id", "audit", "role", "text"))
            for row in zip(*columns, strict=True):
                own, audit = row[0].as_py(), row[1].as_py()
                if not started or own != conv:
                    inserts()
                    started, conv, state, place, edits, at = True, own, START, 0, "", 0
                if audit is not None:
                    edits, at = edits[at:] + audit, 0
                    continue
                inserts()
                edit, at = edits[at], at + 1
                if edit == KEEP:
                    role = row[2].as_py()
                    state = AFTER[state][INITIALS.find(role[:1])]
                    put(KEEP, role, row[3].as_py())
                elif edit == REROLE:
                    state = NEXT[state]
                    put(REROLE, ROLES[state], row[3].as_py())
                if len(out) >= 10_000 or size > 1 << 24:
                    yield flushed()
        inserts()
        yield flushed()

    return run


def repaired(rows: DataFrame, spacing: int | None = None) -> Repair:
    """The cheapest edits of every conversation of ``rows(conv_id, turn, role, text)``, and the rows that they leave.

    Rows count by turn, null turns first; rows of one turn by role and then by a digest of their text. Null
    roles and texts are one space, a null ``conv_id`` is a conversation of its own. A row is blank, else a duplicate (role and
    text occurred before in its conversation), else truncated (it does not end in ``.``, ``!`` or ``?``), else fine. Equal rows are
    separate rows, all but the first of them duplicates. An empty table has no conversations; other columns are not read. Texts may
    be long: only their digests are sorted, and each text moves once, with its conversation's rows in order.
    ``spacing`` is the number of rows between checkpoints, the square root of the number of all rows unless it is given.
    """
    own = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    marked = _marked(_narrow(own))
    spacing = spacing or max(2, isqrt(marked.count()))
    walked = _walked(marked, spacing)

    kinds = [F.count(F.when(F.col("fault") == k, 1)).alias(k) for k in ("blank", "duplicate", "truncated")]
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = marked.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *kinds)
    parts = F.sort_array(F.collect_list(F.struct("first", "audit")))
    audits = walked.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), F.array_join(F.transform(parts, lambda x: x["audit"]), "").alias("audit")
    )
    conversations = together(counts, audits)

    texts = own.withColumn("digest", F.unhex(F.sha2("text", 256)))
    both = texts.unionByName(walked.select("conv_id", "turn", "role", "digest", "audit", "first"), allowMissingColumns=True)
    streamed = both.repartition("conv_id").sortWithinPartitions(*ORDER, F.col("audit").isNull(), "first")
    schema = StructType([rows.schema["conv_id"]]).add("place", "long").add("edit", "string").add("role", "string").add("text", "string")
    written = streamed.select("conv_id", "audit", "role", "text").mapInArrow(_write(to_arrow_schema(schema)), schema)
    return Repair(conversations, written)


def together(*tables: DataFrame) -> DataFrame:
    """Tables with at most one row for each ``conv_id``, null among them, side by side."""
    every = tables[0]
    for other in tables[1:]:
        every = every.unionByName(other, allowMissingColumns=True)
    return every.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in every.columns if c != "conv_id"])


def digests(rows: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of the rows of a :class:`Repair`, each as ``role:text``, joined by line ends.

    A conversation's digest takes its rows one after another, as SHA-256 does, and holds none of them.
    """
    schema = StructType([rows.schema["conv_id"]]).add("repaired_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        conv, digest = None, None
        done: list[tuple] = []
        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for row in zip(*(batch[c] for c in ("conv_id", "place", "role", "text")), strict=True):
                own, place, role, text = (v.as_py() for v in row)
                if place == 0:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest = own, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield _pairs(done, kind)
            done = []
        if digest is not None:
            yield _pairs([(conv, digest.hexdigest())], kind)

    return rows.select("conv_id", "place", "role", "text").mapInArrow(run, schema)


def _pairs(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    ids, values = zip(*done, strict=True) if done else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(values, pa.string())], ["conv_id", "repaired_sha256"])


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults by a hash of conversation and turn: dropped, emptied, cut short, repeated or given the role ``user``."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    own = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.crc32(key) % 20).alias("hash"),
    ).where("hash <> 0")
    text = F.when(F.col("hash") == 1, "").when(F.col("hash") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("hash") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    role = F.when(F.col("hash") == 4, "user").otherwise(F.col("role"))
    return own.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")
