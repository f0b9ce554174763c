"""SimHash near-duplicate documents by multi-index hashing.

Every fingerprint is cut into segments; of two fingerprints at ``max_bits`` or
fewer, some segment differs by at most one bit. So each fingerprint is stored
under its segment values and looked up under the Hamming ball of radius one
around them. A ball is enumerated upwards only (bits that are 0 are set): of two
segments that differ in one bit exactly one reaches the other that way. Matches
are verified on the complete distance, and the links are closed to components.

Only (doc_id, fingerprint) rows are shuffled, never texts. Exact copies share
one fingerprint row; a hot segment value is split into cells.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.cells import BOTH, PROBE, bucket_edges
from ledgerlens.llm.common import cut, free_name, raw, spans
from ledgerlens.llm.components import components
from ledgerlens.llm.simhash import majority

SEED = 42


def shingle_hashes(text: bytes, width: int) -> list[int]:
    """XXH64 of every ``width``-word shingle (fewer words: of the whole sequence)."""
    words = text.lower().split()
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-width])]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:])]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) for each row; a null or wordless text has fingerprint 0."""
    def run(batches):
        for batch in batches:
            texts = raw(batch.column(2))
            for s, e in spans([len(t) for t in texts], 1 << 20):
                lists = [shingle_hashes(t, width) for t in texts[s:e]]
                counts = np.fromiter(map(len, lists), np.int64, len(lists))
                flat = np.fromiter((h for x in lists for h in x), np.uint64, int(counts.sum()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[s:e], batch.column(1)[s:e], pa.array(majority(flat, counts).view(np.int64))],
                    ["doc_id", "text_hash", "fp"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, text_hash long, fp long")


def _upwards(key: Column, width: int) -> Column:
    """The keys that differ from ``key`` in one bit of its segment, which is set."""
    bits = F.array(*[F.lit(1 << b) for b in range(width)])
    return F.transform(F.filter(bits, lambda b: key.bitwiseAND(b) == 0), lambda b: key.bitwiseOR(b))


def links(fps: DataFrame, max_bits: int = 3, cell_rows: int = 4096) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of ``fps(fp)`` at max_bits or fewer."""
    segments = max(2, max_bits // 2 + 1)
    bounds = [64 * i // segments for i in range(segments + 1)]
    widths = [hi - lo for lo, hi in zip(bounds, bounds[1:])]
    keys = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << w) - 1)) + F.lit(i << 40)
            for i, (lo, w) in enumerate(zip(bounds, widths))]
    stored = fps.select("fp", F.explode(F.array(*keys)).alias("key")).withColumn("role", F.lit(BOTH))
    asked = fps.select("fp", F.explode(F.concat(*map(_upwards, keys, widths))).alias("key")).withColumn(
        "role", F.lit(PROBE))
    # A bucket's load is what is stored or looked up under its key. Only keys
    # with many stored rows can make a heavy one, so few rows are summed here.
    busy = stored.groupBy("key").count().where(F.col("count") >= max(2, cell_rows // 64))
    segment = F.shiftright("key", 40)
    ball = F.coalesce(*[F.when(segment == i, _upwards(F.col("key"), w)) for i, w in enumerate(widths)])
    heavy = (busy.select("count", F.explode(F.concat(F.array("key"), ball)).alias("key"))
             .groupBy("key").agg(F.sum("count").alias("load")).where(F.col("load") > cell_rows)
             .select("key", F.ceil(F.col("load") / cell_rows).alias("ways")))
    return bucket_edges(stored.unionByName(asked), cut(heavy, "heavy"), max_bits)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id), one row per input row.

    ``component_id`` is the smallest id reachable over links of ``max_bits`` or
    fewer differing bits. Null and empty texts share fingerprint 0 and so one
    component; a null id is never a component's name unless all are null (then
    ``root``, the component's smallest fingerprint, still tells them apart).
    Rows that repeat are copies of one another. Other columns are not read.
    """
    prints = cut(fingerprints(docs, id_col, text_col, width), "fingerprints")
    first = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    edges = links(first.select("fp"), max_bits)
    closed = components(edges)
    named = first.join(closed.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = cut(named.join(smallest, "root").select("fp", "root", "component_id"), "classes")
    return prints.join(by_print, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                         max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest (id, text hash).

    All columns are kept. Of rows equal in id and text one stays.
    """
    found = near_duplicates(docs, id_col, text_col, width, max_bits)
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    best = F.min(F.struct("doc_id", "text_hash", "n")).alias("best")
    keep = cut(rows.groupBy("root").agg(best).select("best.*"), "kept")
    mark, key, digest = (free_name(docs, n) for n in ("text_hash", "kept_id", "kept_hash"))
    rows = docs.withColumn(mark, F.xxhash64(text_col))
    named = lambda t: t.select(F.col("doc_id").alias(key), F.col("text_hash").alias(digest))
    match = F.col(id_col).eqNullSafe(F.col(key)) & (F.col(mark) == F.col(digest))
    stay = rows.join(named(keep), match, "left_semi")
    again = named(keep.where("n > 1"))
    if again.isEmpty():
        return stay.drop(mark)
    return (stay.join(again, match, "left_anti")
            .unionByName(stay.join(again, match, "left_semi").dropDuplicates([id_col, mark])).drop(mark))
