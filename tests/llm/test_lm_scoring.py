"""Unigram base against plain counts, the network against plain loops, gain on held-out texts."""

import copy
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import gru
from ledgerlens.llm import lm_scoring as M

UNITS, SIZE, HIDDEN = 24, 6, 5


def net():
    mass = np.random.default_rng(0).random(UNITS)
    return {k: v.astype(np.float64) for k, v in gru.initial(mass / mass.sum(), SIZE, HIDDEN).items()}


def naive(p, seq, n=HIDDEN):
    sig = lambda x: 1 / (1 + np.exp(-x))
    h, total, prev = np.zeros(n), 0.0, 0
    for w in seq:
        g, a = p["embed"][prev] @ p["wx"] + p["bx"], h @ p["u"]
        z, r = sig(g[:n] + a[:n]), sig(g[n:2 * n] + a[n:2 * n])
        h = (1 - z) * np.tanh(g[2 * n:] + r * a[2 * n:]) + z * h
        c = w // SIZE
        lc = h @ p["wc"] + p["bc"]
        lw = p["wo"][c * SIZE:(c + 1) * SIZE] @ h + p["bo"][c * SIZE:(c + 1) * SIZE]
        total += lc[c] - np.log(np.exp(lc).sum()) + lw[w - c * SIZE] - np.log(np.exp(lw).sum())
        prev = w
    return total


SEQS = [np.random.default_rng(k).integers(0, UNITS, n) for k, n in enumerate((7, 3, 1, 60, 0, 5, 60))]


@pytest.mark.parametrize("step_tokens", [16, 1 << 16])
@pytest.mark.parametrize("small", [True, False])
def test_state_is_carried_through_whole_sequences(step_tokens, small):
    p = net()
    scorer = gru.Scorer({k: v.astype(np.float32) for k, v in p.items()}, SIZE, 0, step_tokens)
    scorer.small = small
    assert np.abs(scorer.score(SEQS) - [naive(p, s) for s in SEQS]).max() < 1e-4
    assert len(scorer.score([])) == 0


def test_gradients():
    p = net()
    segments = [np.concatenate([[0], s]) for s in SEQS if 1 < len(s) < 30]
    moved, state = {k: v.copy() for k, v in p.items()}, {k: np.full_like(v, 1e6) for k, v in p.items()}
    gru.train_segments(moved, state, SIZE, segments, 1.0)
    loss = lambda q: -sum(naive(q, s[1:]) for s in segments)
    for k in p:
        g = (p[k] - moved[k]) * 1e3 * len(segments)
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        up, down = copy.deepcopy(p), copy.deepcopy(p)
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert abs(g[at] - (loss(up) - loss(down)) / 2e-5) < 1e-3 * max(1, abs(g[at])), k


def test_steps_are_kept_as_arrays_of_all_steps():
    p, rng = net(), np.random.default_rng(5)
    n = p["u"].shape[0]
    gates, h = rng.normal(size=(6, 3, 3 * n)), rng.normal(size=(3, n))
    states, z, r, c, own = gru._steps(p, gates, h)
    assert states.shape == (7, 3, n) and all(x.shape == (6, 3, n) and x.flags.c_contiguous for x in (z, r, c, own))
    for t in range(6):
        a = h @ p["u"]
        zt, rt = (1 / (1 + np.exp(-gates[t, :, k * n:(k + 1) * n] - a[:, k * n:(k + 1) * n])) for k in range(2))
        ct = np.tanh(gates[t, :, 2 * n:] + rt * a[:, 2 * n:])
        h = ct + zt * (h - ct)
        for got, want in ((states[t + 1], h), (z[t], zt), (r[t], rt), (c[t], ct), (own[t], a[:, 2 * n:])):
            assert np.abs(got - want).max() < 1e-5


def words(text):
    return (text or "").encode().lower().split() + [b""]


def held_out(i):
    return i is None or zlib.crc32(str(i).encode()) % 10 == 0


def check_base(rows, docs):
    c = Counter(w for i, t in docs if not held_out(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in docs:
        ws = words(t)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want[str(i), held_out(i), len(ws), sum(c[w] > 0 for w in ws), n, round(base, 4)] += 1
    got = Counter((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows)
    assert got == want


def test_base_and_gain(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = M.score(docs).collect()
    check_base(rows, [(r.doc_id, r.text) for r in docs.collect()])
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score < 0 for r in rows)


def test_words_outside_the_head_join_their_counts(llm, monkeypatch):
    monkeypatch.setattr(M, "HEAD", 40)
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check_base(M.score(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_units_make_one_distribution(llm):
    counts = M.count_words(llm.createDataFrame([("a a b c",), ("a d",), ("eee",)], "text string")).cache()
    lex, mass = M.lexicon(counts)
    listed = {w: lex.base[i] for w, i in lex.index.items()}
    assert listed[b"a"] == max(listed.values()) and lex.total == 10 and lex.distinct == 6
    # words with a unit, the end, and each bucket's unseen event
    assert abs(mass.sum() - 1 - (M.BUCKETS - 1) * 0.1 / (10 + 0.1 * 7)) < 1e-9


def test_edge_rows(llm, edge, none):
    rows = M.score(edge).collect()
    check_base(rows, [(r.doc_id, r.text) for r in edge.collect()])
    assert all(math.isfinite(r.score) for r in rows)
    assert M.score(none).count() == 0
    alone = M.score(llm.createDataFrame([(None, "nothing to learn from")], "doc_id long, text string")).first()
    assert alone.train_tokens == 0 and alone.n_known == 0 and alone.n_tokens == 5 and math.isfinite(alone.score)


def test_every_training_token_is_in_one_shard(llm, monkeypatch):
    """Segments, joined, are a text's units; shards hold every segment once, whatever the partitions."""
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 9, n) for n in (1, 255, 256, 257, 511, 512, 513, 5000)]
    for units in texts:
        parts = [x for _, x in M.segments(units, 17)]
        assert np.concatenate([x[1:] for x in parts]).tolist() == units.tolist()
        assert parts[0][0] == 0 and all(b[0] == a[-1] for a, b in zip(parts, parts[1:]))
    monkeypatch.setattr(M, "SHARD_TOKENS", 700)
    rows = [(k, u.astype("<u2").tobytes()) for k, u in enumerate(texts * 3)]
    found = []
    for n in (1, 5):
        df = llm.createDataFrame(rows, "key long, units binary").repartition(n)
        got = M.shards(df, sum(len(u) for u in texts) * 3).collect()
        found.append(sorted((r.turn, r.part, bytes(r.lengths), bytes(r.units)) for r in got))
        assert {r.turn for r in got} == set(range(M.ROUNDS)) and all(len(r.units) < 2 * (700 + 258) for r in got)
    assert found[0] == found[1] and len(found[0]) > M.ROUNDS
    whole = sorted(x.tolist() for r in found[0] for x in M._unshard(r[2], r[3]))
    assert whole == sorted(x.tolist() for k, u in enumerate(texts * 3) for _, x in M.segments(u, k))


def test_scores_do_not_depend_on_partitions(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = ({r.doc_id: r.score for r in M.score(docs.repartition(n)).collect()} for n in (2, 7))
    assert max(abs(a[k] - b[k]) / max(1, abs(a[k])) for k in a) < 1e-4
