"""Codes against a plain version with Python integers, at any chunk size; the Hilbert order itself."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from ledgerlens.llm import vector_codes as V
from ledgerlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
INF, NAN = float("inf"), float("nan")


def plain(rows, parts, entries, rounds, scale):
    """{row number: (codes, error)}, codebooks; rows (id, label, vector or None)."""
    kept = [(i, r) for i, r in enumerate(rows)
            if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    longest = max((len(r[2]) for _, r in kept), default=0)
    dims = -(-longest // parts) * parts
    width = dims // parts
    cut = {}
    for i, r in kept:
        v = [math.floor(scale * np.float64(x)) for x in r[2]] + [0] * (dims - len(r[2]))
        cut[i] = [tuple(v[p * width:(p + 1) * width]) for p in range(parts)]
    first = sorted(kept, key=lambda x: (x[1][0] is None, x[1][0] or 0, x[1][2]))[:entries]
    books = [[cut[i][p] for i, _ in first] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def best(p, v):
        return min((dist(v, e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = defaultdict(list)
            for i, _ in kept:
                members[best(p, cut[i][p])[1]].append(cut[i][p])
            new.append([tuple(sum(c) // len(members[k]) for c in zip(*members[k])) if k in members else e
                        for k, e in enumerate(books[p])])
        books = new
    out = {}
    for i, _ in kept:
        found = [best(p, cut[i][p]) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found))
    return out, books


def drawn(n, dims, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(9)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        rows.append((rng.randrange(3 * n) if i % 7 else None, rng.choice([1, 2, None]),
                     [float(np.float32(x + rng.gauss(0, rng.choice([0, 0.01, 0.3])))) for x in c]))
    return rows


def frame(spark, rows):
    data = [(i, label, v, "clash", 1.0, n) for n, (i, label, v) in enumerate(rows)]
    return spark.createDataFrame(data, "vec_id long, label int, embedding array<float>, code string, error double, "
                                       "label_of_sum int")


@pytest.mark.parametrize("chunk", [64, 1 << 12, V.CHUNK])
def test_equal_to_plain_version(llm, monkeypatch, chunk):
    monkeypatch.setattr(V, "CHUNK", chunk)
    rows = drawn(900, 12, chunk)
    rows += [(5, 1, None), (6, 1, [1.0] * 11 + [NAN]), (7, 2, [INF] + [0.0] * 11), (8, 2, [None] + [0.0] * 11),
             (9, 1, []), (10, None, [1.5, -2.5]), rows[0], rows[0], (None, None, [-0.001] * 12)]
    coded, book = V.encode(frame(llm, rows), parts=4, entries=20)
    want, books = plain(rows, 4, 20, V.ROUNDS, V.SCALE)
    assert [[tuple(e) for e in b] for b in book.tolist()] == books
    got = sorted((r.vec_id is None, r.vec_id or 0, r.label or 0, r.code, r.error) for r in coded.collect())
    assert got == sorted((rows[i][0] is None, rows[i][0] or 0, rows[i][1] or 0, *x) for i, x in want.items())
    total = defaultdict(int)
    for i, (_, error) in want.items():
        total[rows[i][1]] += error
    assert {r.label: r.label_error for r in V.with_label_error(coded).collect()} == dict(total)


def test_few_empty_and_huge(llm):
    coded, book = V.encode(frame(llm, [(1, 1, [0.5] * 16), (2, None, [0.25] * 16)]))
    assert book.shape == (16, 2, 1) and sorted(r.code for r in coded.collect()) == ["00" * 16, "01" * 16]
    coded, book = V.encode(frame(llm, []))
    assert coded.count() == 0 and V.with_label_error(coded).count() == 0 and len(V.codebook_digest(book)) == 64
    coded, _ = V.encode(frame(llm, [(1, 1, []), (2, 1, [])]))
    assert [(r.code, r.error) for r in coded.collect()] == [("00" * 16, 0)] * 2
    with pytest.raises(Exception, match="squared distances pass a long"):
        V.encode(frame(llm, [(1, 1, [1e30] * 16)]))


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3)])
def test_hilbert_neighbours(dims, bits):
    side = 1 << bits
    points = np.stack(np.meshgrid(*[np.arange(side)] * dims), -1).reshape(-1, dims).astype(np.int64)
    # spread to the grid of the curve's own bits, whose cells then hold one point each or none
    keys = V.hilbert_keys(points)
    path = points[np.argsort(keys, kind="stable")]
    assert len(np.unique(keys)) == len(points)
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_hilbert_keys_of_odd_shapes():
    rng = np.random.default_rng(1)
    for dims in (0, 1, 31, 40, 100):
        assert len(V.hilbert_keys(rng.integers(-5000, 5000, (50, dims)))) == 50
    assert len(V.hilbert_keys(np.zeros((0, 4), np.int64))) == 0


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(2)
    book = rng.integers(-300, 300, (64, 4))
    rows = rng.integers(-300, 300, (30_000, 4))
    rows = rows[np.argsort(V.hilbert_keys(rows))]
    starts = np.arange(0, len(rows), V.BLOCK)
    near = V.shortlists(np.minimum.reduceat(rows, starts), np.maximum.reduceat(rows, starts), book)
    full = ((rows[:, None] - book) ** 2).sum(2)
    entry, dist = V.nearest(rows, near, book)
    assert (entry == full.argmin(1)).all() and (dist == full.min(1)).all()
    assert near.mean() < 0.6


def test_registered_query(llm):
    rows = [(r.vec_id, r.label, r.embedding) for r in llm.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, books = plain(rows, 16, 64, 2, 256)
    got = {r.vec_id: r for r in QUERIES["op12_vector_codes"](llm, SF).collect()}
    assert {k: (r.code, r.error) for k, r in got.items()} == {rows[i][0]: x for i, x in want.items()}
    assert {r.codebooks_sha256 for r in got.values()} == {V.codebook_digest(np.array(books))}
