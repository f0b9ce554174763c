"""SimHash near-dedup against all pairs, hot buckets, components, edge rows."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm import near_dedup, simhash
from ledgerlens.llm.components import components

SF = "/root/testdata/sf0.001"


def brute_print(text, width=3):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(prints, max_bits=3):
    """Index of the first fingerprint of each one's component."""
    f = np.array(prints, np.uint64)
    label = list(range(len(f)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i, j in zip(*np.nonzero(np.triu(np.bitwise_count(f[:, None] ^ f[None, :]) <= max_bits, 1))):
        a, b = find(i), find(j)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


def test_documents_match_all_pairs(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in near_dedup.near_duplicates(docs).collect()}
    prints = [brute_print(r.text) for r in rows]
    assert [got[r.doc_id][0] for r in rows] == prints
    assert [got[r.doc_id][1] for r in rows] == [rows[i].doc_id for i in brute_roots(prints)]


@pytest.mark.parametrize("max_bits,cell_rows", [(3, 4096), (3, 8), (0, 4096), (5, 16), (7, 4096)])
def test_links_of_a_dense_group_and_hot_buckets(llm, max_bits, cell_rows):
    rng = random.Random(max_bits)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = {b for b in base}
    for b in base[:3]:  # groups of near copies, many of them sharing a half
        for _ in range(120):
            prints.add(b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(1, 6))))
    prints |= {rng.getrandbits(64) for _ in range(200)}
    prints = sorted(prints)
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    fps = llm.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r.node: r.root for r in components(near_dedup.links(fps, max_bits, cell_rows)).collect()}
    ours, theirs = {}, {}
    for s, k in zip(signed, brute_roots(prints, max_bits)):
        ours.setdefault(roots.get(s, s), set()).add(s)
        theirs.setdefault(k, set()).add(s)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_paths_stars_and_noise(llm):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(300)] + [(1000, k) for k in range(1001, 1400)] + [(5000, 5000)]
    edges += [(rng.randint(2000, 2400), rng.randint(2000, 2400)) for _ in range(250)]
    got = {r.node: r.root for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(301)} == {0} and {got[k] for k in range(1000, 1400)} == {1000}
    assert 5000 not in got
    for a, b in edges:
        assert a == b or got[a] == got[b] <= min(a, b)
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_majority_of_long_lists():
    rng = np.random.default_rng(1)
    counts = np.array([0, 1, 2, 700, 255, 256, 0, 510, 3])
    hashes = rng.integers(0, 1 << 63, counts.sum(), np.uint64) * np.uint64(2) + rng.integers(0, 2, counts.sum(), np.uint64)
    got, at = simhash.majority(hashes, counts), 0
    for n, g in zip(counts, got):
        part = [int(h) for h in hashes[at:at + n]]
        assert int(g) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in part) > n)
        at += n


def test_edge_rows(llm, edge, none):
    got = near_dedup.near_duplicates(edge).collect()
    assert len(got) == edge.count()
    by_id = {r.doc_id: r for r in got if r.doc_id}
    assert {by_id[i].component_id for i in (2, 3, 4)} == {2} and {by_id[i].fp for i in (2, 3, 4)} == {0}
    assert by_id[6].component_id == by_id[7].component_id == 6 and by_id[10].component_id == 8
    kept = near_dedup.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    rows = kept.select("doc_id", "text").collect()
    # the two null rows join the empty ones, where a null id sorts first
    assert sorted(str(r.doc_id) for r in rows) == sorted(["1", "None", "None", "5", "6", "8", "9"])
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.drop_near_duplicates(none).count() == 0


def test_rows_without_an_id_stay_apart(llm):
    docs = llm.createDataFrame([(None, "first text of its own kind here"), (None, "another one that differs a lot"),
                                (None, "another one that differs a lot")], "doc_id long, text string")
    assert near_dedup.drop_near_duplicates(docs).count() == 2
    assert near_dedup.near_duplicates(docs).select(F.max("component_id")).first()[0] is None
