"""Benchmark passages in documents by pigeonhole edit matching.

A test item of n characters may be met with up to ``k = floor(rate * n)``
edits. Cut into k + 1 pieces, at least one piece of it then stands in the text
unchanged. All pieces of a block of items go into one Aho-Corasick machine that
runs over each whole text once; every hit fixes a window around it, windows of
an item that overlap are joined, and Myers' bit-parallel distance decides
within the window. Text and items are compared in lower case with white space
runs as one space.

Documents are never shuffled. Items travel to the tasks in blocks of bounded
size; a larger benchmark takes more passes, not more memory.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import raw

#: Items of fewer characters are no evidence that a document holds them on purpose.
LEAST_CHARS = 24
BLOCK_CHARS = 4 << 20


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def myers(pattern: str, text: str, limit: int) -> tuple[int, int] | None:
    """(distance, end) of the best match of ``pattern`` in ``text`` within ``limit`` edits.

    The smallest distance, and of equal ones the first end; None if all exceed
    the limit. ``pattern`` must not be empty.
    """
    m = len(pattern)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        masks[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, None
    for end, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score <= limit and (best is None or score < best[0]):
            best = score, end
            if not score:
                break
    return best


class Matcher:
    """The pieces of a block of items in one Aho-Corasick machine."""

    def __init__(self, items: list[tuple], rate: float):
        self.items = []
        where = defaultdict(list)
        for key, text in items:
            text = normal(text)
            if not text:
                continue
            budget = int(rate * len(text))
            number = len(self.items)
            self.items.append((key, text, budget))
            bounds = [len(text) * i // (budget + 1) for i in range(budget + 2)]
            for a, b in zip(bounds, bounds[1:]):
                where[text[a:b]].append((number, a))
        self.machine = ahocorasick.Automaton()
        for piece, places in where.items():
            self.machine.add_word(piece, (len(piece), places))
        if where:
            self.machine.make_automaton()

    def find(self, text: str) -> list[tuple]:
        """(item key, distance, start, end) of each item in a normalised text; best place each."""
        if not self.items:
            return []
        windows = defaultdict(list)
        for last, (size, places) in self.machine.iter(text):
            for number, offset in places:
                _, item, budget = self.items[number]
                begin = last + 1 - size - offset
                windows[number].append((max(0, begin - budget), begin + len(item) + budget))
        out = []
        for number, found in windows.items():
            key, item, budget = self.items[number]
            best = None
            for a, b in _joined(found):
                hit = myers(item, text[a:b], budget)
                if hit and (best is None or hit[0] < best[0]):
                    best = hit[0], a, a + hit[1]
                if best and not best[0]:
                    break
            if best:
                distance, low, end = best
                # the start: the same match read backwards from its end
                back = myers(item[::-1], text[max(low, end - len(item) - budget):end][::-1], distance)
                out.append((key, distance, end - (back[1] if back else len(item)), end))
        return out


def _joined(ranges: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    ranges.sort()
    a, b = ranges[0]
    for c, d in ranges[1:]:
        if c > b:
            yield a, b
            a, b = c, d
        else:
            b = max(b, d)
    yield a, b


def short_items(benchmark: DataFrame, least_chars: int = LEAST_CHARS, item_col: str = "item_id",
                item_text_col: str = "text") -> DataFrame:
    """The rows of ``benchmark`` whose lower-cased, single-spaced text is not blank and has under ``least_chars`` characters."""
    def run(batches):
        for batch in batches:
            sizes = [len(normal(t.decode())) for t in raw(batch.column(item_text_col))]
            yield batch.filter(pa.array([0 < n < least_chars for n in sizes], pa.bool_()))
    return benchmark.select(item_col, item_text_col).mapInArrow(run, benchmark.select(item_col, item_text_col).schema)


def blocks(benchmark: DataFrame, item_col: str, text_col: str, chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The items in blocks of about ``chars`` characters; null and blank texts are left out."""
    rows = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    held, size = [], 0
    for row in rows.where("text is not null").distinct().toLocalIterator():
        held.append((row.item_id, row.text))
        size += len(row.text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_items(docs: DataFrame, benchmark: DataFrame, rate: float = 0.05, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, start, end): each item found in each row of ``docs``.

    One row per document row and item, for its place of least distance (the
    first such); ``start`` and ``end`` are character offsets in the lower-cased
    text with single spaces. Null and empty texts and items match nothing. Rows
    that repeat in ``docs`` give repeated results; items equal in id and text
    count once. Other columns are not read.
    """
    kinds = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, distance int, start int, end int"
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    arrow = pa.int64() if kinds[1].simpleString() == "bigint" else None
    out = None
    for block in blocks(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                rows, hits = [], []
                for i, text in enumerate(raw(batch.column(1))):
                    for hit in matcher.find(normal(text.decode())):
                        rows.append(i)
                        hits.append(hit)
                if hits:
                    key, distance, start, end = zip(*hits)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows)), pa.array(key, arrow), pa.array(distance, pa.int32()),
                         pa.array(start, pa.int32()), pa.array(end, pa.int32())],
                        ["doc_id", "item_id", "distance", "start", "end"])
        part = plain.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = 0.05, text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", least_chars: int = 0) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose text holds no item within its edit budget.

    An item of under ``least_chars`` characters, such as a single common word, is
    no evidence and removes nothing; ``short_items`` reports those. By default every item counts.
    """
    for block in blocks(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast([x for x in block if len(normal(x[1])) >= least_chars])

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, rate)
            for batch in batches:
                texts = raw(batch.column(text_col))
                yield batch.filter(pa.array([not matcher.find(normal(t.decode())) for t in texts], pa.bool_()))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
