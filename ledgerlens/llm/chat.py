"""Chat formatting: minimum-cost role repair, then rendering.

A legal conversation is an optional system turn, then user and assistant in
turn, the assistant last. Each row of a conversation may be kept, relabelled,
merged into the turn before it, or preceded by inserted empty turns; dynamic
programming over the states of that automaton finds the choice of least cost,
and of equal costs that with fewer turns.

One step of the programme is a 4 x 4 matrix over (min, +), and so is any run of
rows, so a conversation need not be in one task: its rows are cut into chunks by
position, every chunk is reduced to its matrix, the matrices of a conversation
(16 numbers for some hundred rows) give the states at the cuts, and every chunk
then finds its own part of the best path. The weight of a matrix also counts
turns, which numbers the turns of each chunk. Texts are shuffled once.

The result has one row for each piece of a turn, so a turn that many rows merge
into never has to fit in one place: the pieces' ``rendered`` texts in order of
(seq, row_no) are the conversation.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import cut

ROLES = ("system", "user", "assistant")
START = 0
STATES = range(4)  # the start, then "last turn was" each role
#: From each state the roles that may follow, as states.
LEGAL = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
KEEP, MERGE_SAME, MERGE_OTHER, RELABEL, RELABEL_UNKNOWN, MERGE_UNKNOWN, INSERT = 0, 1, 4, 3, 1, 1, 2
#: A weight is cost * COST + number of turns.
COST = 1 << 40
NONE = 1 << 61
BLOCK, LIMIT = 512, 4096


def _steps() -> list[list[list[tuple]]]:
    """[role code][state][next state] -> (weight, inserted roles, action, role); code 0 is an unknown role."""
    table = []
    for code in range(4):
        rows = [[(NONE, (), "", 0)] * 4 for _ in STATES]
        for s in STATES:
            options = []
            if s:
                cost = MERGE_UNKNOWN if not code else MERGE_SAME if code == s else MERGE_OTHER
                options.append((s, cost * COST, (), "merge", s))
            paths = [((), s)]
            for _ in range(3):
                for inserted, at in paths:
                    for role in LEGAL[at]:
                        action = "keep" if role == code else "relabel"
                        cost = KEEP if role == code else RELABEL if code else RELABEL_UNKNOWN
                        turns = len(inserted) + 1
                        options.append((role, (cost + INSERT * len(inserted)) * COST + turns, inserted, action, role))
                paths = [((*i, r), r) for i, at in paths for r in LEGAL[at]]
            for to, weight, *what in options:
                if weight < rows[s][to][0]:
                    rows[s][to] = (weight, *what)
        table.append(rows)
    return table


STEP = _steps()
#: What closes a conversation in each state: weight and inserted roles.
CLOSE = [(0, ()), (2 * INSERT * COST + 2, (2, 3)), (INSERT * COST + 1, (3,)), (0, ())]


def times(a: tuple, b: tuple) -> tuple:
    """Product of two matrices over (min, +), as 16-tuples."""
    return tuple(min(NONE, min(a[4 * i + k] + b[4 * k + j] for k in STATES)) for i in STATES for j in STATES)


ONE = tuple(0 if i == j else NONE for i in STATES for j in STATES)
_SINGLE = [tuple(STEP[c][i][j][0] for i in STATES for j in STATES) for c in range(4)]


@lru_cache(20_000)
def matrix(codes: bytes) -> tuple:
    """The matrix of a run of role codes."""
    if len(codes) < 2:
        return _SINGLE[codes[0]] if codes else ONE
    half = len(codes) // 2
    return times(matrix(codes[:half]), matrix(codes[half:]))


@lru_cache(20_000)
def path(codes: bytes, first: int, last: int) -> tuple:
    """The best states after each row of a run that leads from ``first`` to ``last``; ties take the smallest state."""
    after = [[NONE] * 4 for _ in range(len(codes) + 1)]
    after[-1][last] = 0
    for k in range(len(codes) - 1, -1, -1):
        step, then = STEP[codes[k]], after[k + 1]
        after[k] = [min(step[s][t][0] + then[t] for t in STATES) for s in STATES]
    out, s = [], first
    for k, c in enumerate(codes):
        s = min(STATES, key=lambda t: (STEP[c][s][t][0] + after[k + 1][t], t))
        out.append(s)
    return tuple(out)


def cuts(matrices: list[tuple]) -> list[tuple[int, int, int]]:
    """(first state, last state, turns before) of each chunk of a conversation on the best path to a closed end."""
    after = [c[0] for c in CLOSE]
    ahead = []
    for m in reversed(matrices):
        ahead.append(after)
        after = [min(NONE, min(m[4 * s + t] + after[t] for t in STATES)) for s in STATES]
    out, s, turns = [], START, 0
    for m, then in zip(matrices, reversed(ahead)):
        t = min(STATES, key=lambda t: (m[4 * s + t] + then[t], t))
        out.append((s, t, turns))
        turns += m[4 * s + t] % COST
        s = t
    return out


_KEY = ["conv_id", "block", "chunk_turn", "chunk_role", "chunk_hash"]
_ORDER = ["turn", "role", "hash", "text"]


def chunked(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The distinct rows with the columns of the chunk they fall in and their role code."""
    rows = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("block", F.shiftright("turn", BLOCK.bit_length() - 1))
    heavy = rows.groupBy("conv_id", "block").count().where(F.col("count") > LIMIT).select(
        F.col("conv_id").alias("hc"), F.col("block").alias("hb"), F.lit(True).alias("heavy"))
    rows = rows.join(heavy, F.col("conv_id").eqNullSafe(F.col("hc")) & F.col("block").eqNullSafe(F.col("hb")), "left")
    # A block with many rows for few turns is cut along its order: turn, role, hash of the text.
    own = lambda c: F.when(F.col("heavy"), c)
    code = F.coalesce(*[F.when(F.lower(F.trim("role")) == r, i) for i, r in enumerate(ROLES, 1)], F.lit(0))
    return rows.select("conv_id", "block", own(F.col("turn")).alias("chunk_turn"), own(F.col("role")).alias("chunk_role"),
                       own(F.shiftright("hash", 52)).alias("chunk_hash"), *_ORDER, code.cast("int").alias("code"))


def _runs(batches, width: int):
    """Consecutive rows (as tuples) of equal leading ``width`` columns."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for key, own in groupby(rows, key=lambda r: r[:width]):
        yield key, own


def _batches(rows, schema: pa.Schema, size: int = 2000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _clean(text: str) -> str:
    return text.replace("<|", "< |")


def _pieces(codes: bytes, rows: list[tuple], first: int, last: int, turns: int, before: int, final: bool):
    """Output rows of a chunk; ``rows`` are (turn, text), ``turns`` and ``before`` the turns and rows ahead of it."""
    s, seq, at = first, turns - 1, before
    out = []

    def open_turn(role, turn, action, text):
        nonlocal seq
        seq += 1
        mark = f"<|{ROLES[role - 1]}|>\n" if seq == 0 else f"<|end|>\n<|{ROLES[role - 1]}|>\n"
        out.append([seq, at, ROLES[role - 1], turn, action, mark + _clean(text)])

    for code, t, (turn, text) in zip(codes, path(codes, first, last), rows):
        _, inserted, action, role = STEP[code][s][t]
        for r in inserted:
            open_turn(r, None, "insert", "")
        if action == "merge":
            out.append([seq, at, ROLES[s - 1], turn, "merge", "\n\n" + _clean(text)])
        else:
            open_turn(role, turn, action, text)
        s, at = t, at + 1
    if final:
        for r in CLOSE[s][1]:
            open_turn(r, None, "insert", "")
        out[-1][5] += "<|end|>\n"
    return out


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, seq, row_no, role, source_turn, action, rendered): the repaired conversations, piece by piece.

    Rows are taken in order of turn (null first), role (null first), hash of the
    text and text; ``row_no`` is that order, of an insertion that of the row it
    precedes. ``action`` is keep, relabel, merge or insert; ``seq`` numbers a
    conversation's turns from 0. Rows
    equal in all four columns are one row; a null text is the empty text; a role
    other than system, user, assistant (case and outer spaces aside) is unknown
    and takes any role; rows of null conv_id are one conversation. ``<|`` in a
    text is rendered as ``< |``. An empty table gives no rows; other columns are
    not read.
    """
    kind = conversations.schema[conv_col].dataType
    arrow = pa.int64() if kind.simpleString() == "bigint" else pa.int32() if kind.simpleString() == "int" else pa.string()
    rows = cut(chunked(conversations, conv_col, turn_col, role_col, text_col), "chat-rows")
    key = f"conv_id {kind.simpleString()}, block long, chunk_turn long, chunk_role string, chunk_hash long"
    fields = [pa.field("conv_id", arrow), pa.field("block", pa.int64()), pa.field("chunk_turn", pa.int64()),
              pa.field("chunk_role", pa.string()), pa.field("chunk_hash", pa.int64())]
    summary = pa.schema([*fields, pa.field("matrix", pa.list_(pa.int64())), pa.field("n", pa.int64())])

    def reduce_chunks(batches):
        runs = ((k, bytes(r[5] for r in own)) for k, own in _runs(batches, 5))
        yield from _batches(((*k, list(matrix(codes)), len(codes)) for k, codes in runs), summary)
    matrices = (rows.select(*_KEY, "code", "turn", "role", "hash", "text").repartition(*_KEY)
                .sortWithinPartitions(*_KEY, *_ORDER).select(*_KEY, "code")
                .mapInArrow(reduce_chunks, key + ", matrix array<long>, n long"))
    placed = pa.schema([*fields, *(pa.field(n, pa.int64()) for n in ("first", "last", "turns", "before")),
                        pa.field("final", pa.bool_())])

    def place(batches):
        def out():
            for _, own in _runs(batches, 1):
                own = list(own)
                found = cuts([tuple(r[5]) for r in own])
                before = 0
                for i, (r, c) in enumerate(zip(own, found)):
                    yield (*r[:5], *c, before, i == len(own) - 1)
                    before += r[6]
        yield from _batches(out(), placed)
    states = cut(matrices.repartition("conv_id").sortWithinPartitions(*_KEY)
                 .mapInArrow(place, key + ", first long, last long, turns long, before long, final boolean"), "chat-cuts")
    # Each chunk's states go ahead of its rows, in the same shuffle.
    none = lambda names: [F.lit(None).cast("long").alias(n) for n in names]
    nothing = {"turn": "long", "role": "string", "hash": "long", "text": "string", "code": "int"}
    ahead = states.select(*_KEY, *[F.lit(None).cast(t).alias(n) for n, t in nothing.items()],
                          "first", "last", "turns", "before", "final", F.lit(0).alias("kind"))
    body = rows.select(*_KEY, *_ORDER, "code", *none(("first", "last", "turns", "before")),
                       F.lit(None).cast("boolean").alias("final"), F.lit(1).alias("kind"))
    result = pa.schema([pa.field("conv_id", arrow), pa.field("seq", pa.int64()), pa.field("row_no", pa.int64()),
                        pa.field("role", pa.string()), pa.field("source_turn", pa.int64()),
                        pa.field("action", pa.string()), pa.field("rendered", pa.string())])

    def write(batches):
        def out():
            for k, own in _runs(batches, 5):
                head, *body_rows = own
                codes = bytes(r[10] for r in body_rows)
                for piece in _pieces(codes, [(r[11], r[12]) for r in body_rows], *head[5:10]):
                    yield (k[0], *piece)
        yield from _batches(out(), result)
    return (ahead.unionByName(body).repartition(*_KEY).sortWithinPartitions(*_KEY, "kind", *_ORDER)
            .select(*_KEY, "first", "last", "turns", "before", "final", "code", "turn", "text")
            .mapInArrow(write, f"conv_id {kind.simpleString()}, seq long, row_no long, role string, source_turn long, "
                               "action string, rendered string"))
