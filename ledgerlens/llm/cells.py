"""Pairs within a Hamming distance inside buckets, without listing all pairs.

Rows ``(key, fp, role)`` that share a key form a bucket. A bucket whose load
passes ``cell_rows`` is cut into chunks; every chunk meets every other in a
cell of its own, so one hot key spreads over many tasks and the comparison
stays complete. A cell compares its fingerprints with vectorised XOR and
popcount, and emits one edge per member to the smallest member it is connected
to: as many rows as members, with the same connected components as all pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BOTH, TABLE, PROBE = 0, 1, 2
#: Buckets of so many rows are compared together, by comparing rows some places apart.
SMALL_RUN = 48
EDGE = "a long, b long"


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]; a label is the smallest index of its set."""
    while len(a):
        ra, rb = label[a], label[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        up = np.arange(len(label))
        np.minimum.at(up, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            jump = up[up]
            if (jump == up).all():
                break
            up = jump
        label = up[label]
    return label


def linked(fps: np.ndarray, table: np.ndarray, probe: np.ndarray, max_bits: int, block: int = 1 << 20):
    """Blocks of (i, j): table member i and probe member j at max_bits or fewer."""
    rows = max(1, block // max(1, len(probe)))
    for s in range(0, len(table), rows):
        part = table[s:s + rows]
        near = np.bitwise_count(fps[part][:, None] ^ fps[probe][None, :]) <= max_bits
        i, j = np.nonzero(near)
        yield part[i], probe[j]


def small_runs(fps, run, role, max_bits, widest):
    """Pairs (i, j) of runs of up to ``widest`` rows, by comparing rows d apart."""
    a, b = [], []
    for d in range(1, widest):
        if d >= len(fps):
            break
        i = np.flatnonzero((run[d:] == run[:-d]) & (role[:-d] != PROBE))
        if not len(i):
            break
        i = i[np.bitwise_count(fps[i] ^ fps[i + d]) <= max_bits]
        a.append(i)
        b.append(i + d)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.empty(0, int), np.empty(0, int))


def _edges(fps: np.ndarray, key: np.ndarray, cell: np.ndarray, role: np.ndarray, max_bits: int):
    n = len(fps)
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, n))
    run = np.repeat(np.arange(len(starts)), sizes)
    label = np.arange(n)
    small = np.flatnonzero((sizes[run] > 1) & (sizes[run] <= SMALL_RUN))
    if len(small):
        i, j = small_runs(fps[small], run[small], role[small], max_bits, SMALL_RUN)
        label = unite(label, small[i], small[j])
    for r in np.flatnonzero(sizes > SMALL_RUN):
        own = np.arange(starts[r], starts[r] + sizes[r])
        table, probe = own[role[own] != PROBE], own[role[own] != TABLE]
        sub = np.arange(len(own))
        for i, j in linked(fps, table, probe, max_bits):
            sub = unite(sub, i - own[0], j - own[0])
        label[own] = own[sub]
    hit = np.flatnonzero(label != np.arange(n))
    return fps[hit], fps[label[hit]]


def _sorted_cells(max_bits: int) -> Callable:
    def run(batches):
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            key, cell = cols[0], cols[1]
            last = len(key) and int(np.flatnonzero(
                (key != key[-1]) | (cell != cell[-1]))[-1:].max(initial=-1)) + 1
            held = [x[last:] for x in cols]
            if last:
                yield from _batch([x[:last] for x in cols], max_bits)
        if held is not None and len(held[0]):
            yield from _batch(held, max_bits)
    return run


def _batch(cols, max_bits):
    key, cell, role, fp = cols
    a, b = _edges(fp.astype(np.int64).view(np.uint64), key, cell, role, max_bits)
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def bucket_edges(rows: DataFrame, heavy: DataFrame, max_bits: int) -> DataFrame:
    """Edges (a, b) that connect fingerprints of a common bucket at max_bits or fewer.

    ``rows(key, fp, role)``: BOTH rows meet all others of their bucket, TABLE
    rows meet PROBE and BOTH rows. ``heavy(key, ways)`` names the buckets to
    be cut into ``ways`` chunks.
    """
    spread = rows.select("key", F.lit(0).cast("long").alias("cell"), "role", "fp")
    if not heavy.isEmpty():
        spread = cut_up(rows, heavy)
    return (spread.repartition("key", "cell").sortWithinPartitions("key", "cell", "role")
            .mapInArrow(_sorted_cells(max_bits), EDGE))


def cut_up(rows: DataFrame, heavy: DataFrame, *more: str) -> DataFrame:
    """(key, cell, role, fp, *more) with the rows of heavy buckets copied to the cells of their chunk."""
    chunk = F.pmod(F.xxhash64("fp", *more), F.col("ways"))
    span = F.sequence(F.lit(0).cast("long"), F.col("ways") - 1)
    one = F.array(F.struct(F.lit(0).cast("long").alias("cell"), F.col("role").cast("int").alias("role")))
    as_probe = F.transform(span, lambda y: F.struct((chunk * F.col("ways") + y).alias("cell"),
                                                    F.lit(PROBE).alias("role")))
    as_table = F.transform(span, lambda x: F.struct((x * F.col("ways") + chunk).alias("cell"),
                                                    F.lit(TABLE).alias("role")))
    placed = (F.when(F.col("ways").isNull(), one)
              .when(F.col("role") == PROBE, as_probe)
              .when(F.col("role") == TABLE, as_table)
              .otherwise(F.concat(as_probe, as_table)))
    return (rows.join(heavy, "key", "left")
            .select("key", "fp", *more, F.explode(placed).alias("p"))
            .select("key", "p.cell", "p.role", "fp", *more))
