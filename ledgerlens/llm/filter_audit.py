"""Interaction audit of five document filters by the Hart-Mas-Colell potential.

Every document is reduced to the set of filters it fails. In the removal game of
a part, a coalition of filters is worth the documents that it removes together,
those that fail at least one of them. The 32 worths come from one histogram of
failure sets; the potential of a coalition is defined by those of the coalitions
one filter smaller, ``P(S) = (v(S) + sum of P(S - i)) / |S|``, and a filter's
Shapley value is ``P(all) - P(all but it)``. The potentials are kept as the
integers ``|S|! P(S)``. What a filter removes at a step of an order is the
difference of the worths with and without it, and every other count of a step
is such a difference too.

Texts are read in one pass without a shuffle. What is shuffled is one row of
about 60 bytes a document: to the place of its text's least id and to its
label. Histograms are combined map-side, so parts and failure sets may be as
uneven as they like.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import cut, raw

FILTERS = "ABCDE"
_UPPER = bytes(range(65, 91))
_CONTINUATION = bytes(range(128, 192))
_SPACES = frozenset(b" \t\n\v\f\r")
_PIECE = 1 << 20


def _word_counts(text: bytes) -> tuple[int, int]:
    """(words, distinct words); a long text is split a piece at a time, so only its distinct words are held."""
    if len(text) <= _PIECE:
        words = text.split()
        return len(words), len(set(words))
    seen: set[bytes] = set()
    n = at = 0
    while at < len(text):
        end = min(len(text), at + _PIECE)
        while end < len(text) and text[end] not in _SPACES:
            end += 1
        words = text[at:end].split()
        seen.update(words)
        n, at = n + len(words), end
    return n, len(seen)


def own_failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails; E needs the other texts."""
    words, distinct = _word_counts(text)
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text.translate(None, _CONTINUATION))
    fails = (words < 100, 100 * distinct < 80 * words, 100 * upper > 10 * points, any(c in text for c in b"#$%&*|"))
    return sum(1 << i for i, bad in enumerate(fails) if bad)


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, fails), one row per row of ``docs``; bit i of ``fails`` is filter i of ``FILTERS``.

    Null texts read as empty, null parts as the empty string. A document fails E
    if its text stands at a smaller id anywhere in the table; a null id is
    smaller than none and larger than none, and of rows that repeat an id none is smaller.
    """
    def run(batches):
        for batch in batches:
            texts = raw(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([own_failures(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                ["doc_id", "part", "own", "digest"])
    kind = docs.schema[id_col].dataType.simpleString()
    rows = cut(docs.select(F.col(id_col).alias("doc_id"),
                           F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                           F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, part string, own int, digest binary"), "filter-failures")
    # a text's least id is found map-side and joined by text and id together, so a text of very many rows is no hot key
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first")).withColumnRenamed("digest", "of")
    own = (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("first"))
    later = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(first, own, "left").select(
        "doc_id", "part", F.col("own").bitwiseOR(F.when(later, 16).otherwise(0)).alias("fails"))


def histogram(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality",
              toxic_col: str = "toxic") -> DataFrame:
    """(part, fails, docs, good, toxic): documents of each failure set, and those of them labelled good or toxic.

    An id with several label rows counts as good if one of them says so, and as toxic likewise.
    """
    mark = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    marks = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id"))
             .agg(mark(good_col).alias("good"), mark(toxic_col).alias("toxic")))
    return failed.join(marks, "doc_id", "left").groupBy("part", "fails").agg(
        F.count("*").alias("docs"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def worths(counts: np.ndarray) -> np.ndarray:
    """Documents that each of the 32 coalitions removes, from the counts of the 32 failure sets."""
    masks = np.arange(1 << len(FILTERS))
    return np.array([counts[(masks & s) != 0].sum() for s in masks], np.int64)


def potentials(worth: np.ndarray) -> np.ndarray:
    """``|S|! P(S)`` of each coalition, smaller ones first."""
    out = np.zeros_like(worth)
    for s in sorted(range(1, len(worth)), key=int.bit_count):
        parts = [s & ~(1 << i) for i in range(len(FILTERS)) if s >> i & 1]
        out[s] = factorial(len(parts) - 1) * worth[s] + sum(out[q] for q in parts)
    return out


def _steps(part: str, counts: np.ndarray) -> list[tuple]:
    """The rows of one part from its (32, 3) histogram."""
    removed, good, toxic = (worths(counts[:, k]) for k in range(3))
    total, n = int(counts[:, 0].sum()), len(FILTERS)
    everyone = (1 << n) - 1
    potential = potentials(removed)
    rows = []
    for order in permutations(range(n)):
        before = 0
        for step, i in enumerate(order):
            bit, after = 1 << i, before | 1 << i
            here = int(removed[after] - removed[before])
            rows.append((part, "".join(FILTERS[k] for k in order), step + 1, total - int(removed[after]), here,
                         int(removed[bit]) - here, int(removed[everyone] - removed[everyone & ~bit]),
                         int(good[after] - good[before]), int(toxic[after] - toxic[before]),
                         int(potential[everyone] - n * potential[everyone & ~bit])))
            before = after
    return rows


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """Counts of every step of every order of the filters, for each part.

    Columns part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley (over all orders, so 120 times the value).
    Rows of zeros are there too; an empty table has no part and so no rows.
    Other columns are not read. See ``failures`` and ``histogram`` for nulls,
    empty texts and repeated rows.
    """
    cells = histogram(failures(docs, id_col, text_col, part_col), labels, id_col)
    # at most 32 rows a part meet here
    games = cells.groupBy("part").agg(F.collect_list(F.struct("fails", "docs", "good", "toxic")).alias("cells"))
    names = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
             "shapley")

    def run(batches):
        for batch in batches:
            for part, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.zeros((1 << len(FILTERS), 3), np.int64)
                for c in found:
                    counts[c["fails"]] = c["docs"], c["good"], c["toxic"]
                columns = list(zip(*_steps(part, counts)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()),
                     pa.array(columns[2], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[3:]]], list(names))
    return games.mapInArrow(run, "part string, filter_order string, step int, kept long, removed long, redundant long, "
                                 "unique_fails long, good_lost long, toxic_lost long, shapley long")


def oracle_sql() -> str:
    """The same counts in DuckDB SQL: every failure set walks every order."""
    letters = "(VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16))"
    picks = ", ".join(f"l{i}.c AS c{i}, l{i}.b AS b{i}" for i in range(1, 6))
    differ = " AND ".join(f"l{i}.c <> l{j}.c" for i in range(1, 6) for j in range(i + 1, 6))
    steps = "\nUNION ALL ".join(
        f"SELECT filter_order, {i} AS step, b{i} AS bit, {' + '.join(f'b{j}' for j in range(1, i)) or '0'} AS before FROM o"
        for i in range(1, 6))
    return f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
m AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic
      FROM labels GROUP BY doc_id),
f AS (SELECT part, CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
        + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
        + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
        + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS fails,
        coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM w LEFT JOIN m USING (doc_id)),
h AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT * FROM {letters} AS x(c, b)),
o AS (SELECT c1 || c2 || c3 || c4 || c5 AS filter_order, * FROM (SELECT {picks} FROM l l1, l l2, l l3, l l4, l l5
      WHERE {differ})),
s AS ({steps}),
r AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN fails & before > 0 AND fails & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN fails = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM h, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""
