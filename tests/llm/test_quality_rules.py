"""Counts against plain Python, estimation against a plain EM, edge rows."""

import math
import random
import re
from collections import Counter

from ledgerlens.llm import quality_rules as Q


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), len(lines))


def corpus():
    rng = random.Random(4)
    out = []
    for i in range(150):
        words = [rng.choice(["aa", "b", "ccc", "é", "d#", "|", "e"]) for _ in range(rng.randint(0, 120))]
        out.append((i, "".join(w + rng.choice([" ", "  ", "\n", "\t", "\x0b", "\r\n"]) for w in words)))
    return out


def test_counts(llm, edge, monkeypatch):
    docs = llm.createDataFrame(corpus(), "doc_id long, text string").unionByName(edge.select("doc_id", "text"))
    want = sorted((str(r.doc_id), counts(r.text)) for r in docs.collect())
    got = sorted((str(r.doc_id), tuple(r[1:])) for r in Q.statistics(docs).collect())
    assert got == want
    monkeypatch.setattr(Q, "_SORT_FROM", 0)  # the path for texts with very many repeats
    assert sorted((str(r.doc_id), tuple(r[1:])) for r in Q.statistics(docs).collect()) == want


def plain_em(patterns, steps):
    width = len(patterns[0]) - 1
    good, bad, prior = [Q.START[0]] * width, [Q.START[1]] * width, Q.START[2]

    def posterior(votes):
        yes = prior * math.prod(g if v == 1 else 1 - g if v == -1 else 1 for v, g in zip(votes, good))
        no = (1 - prior) * math.prod(1 - b if v == 1 else b if v == -1 else 1 for v, b in zip(votes, bad))
        return yes / (yes + no)
    for _ in range(steps):
        w = [(p[:-1], p[-1], posterior(p[:-1])) for p in patterns]
        share = lambda i, hit, of: (sum(of(n, q) for v, n, q in w if v[i] == hit) + 1) / (
            sum(of(n, q) for v, n, q in w if v[i]) + 2)
        new_good = [share(i, 1, lambda n, q: n * q) for i in range(width)]
        new_bad = [share(i, -1, lambda n, q: n * (1 - q)) for i in range(width)]
        prior = (sum(n * q for _, n, q in w) + 1) / (sum(n for _, n, _ in w) + 2)
        good, bad = new_good, new_bad
    return good, bad, prior


def test_estimate(llm):
    rng = random.Random(1)
    rows = [tuple(rng.choice([-1, 0, 1, 1]) for _ in range(4)) + (rng.randint(1, 50),) for _ in range(20)]
    got = Q.estimate(llm.createDataFrame(rows, "a int, b int, c int, d int, n long"), list("abcd"), 6)
    want = plain_em(rows, 6)
    assert all(abs(x - y) < 1e-9 for a, b in zip(got[:2], want[:2]) for x, y in zip(a, b))
    assert abs(got[2] - want[2]) < 1e-9


def test_no_python_in_the_plan(llm):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (Q.statistics(docs), Q.judge(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def test_junk_goes_and_clean_documents_stay(llm):
    docs, labels = (llm.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.judge(docs).withColumnRenamed("quality", "posterior").join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r.kept for r in rows if r.quality == 0) <= 2
    assert sum(not r.kept for r in rows if r.quality == 1) <= 2


def test_edge_rows(edge, none):
    got = Q.judge(edge)
    rows = got.collect()
    assert len(rows) == edge.count() and all(0 <= r.quality <= 1 for r in rows)
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3, 4, 8))
    assert Q.judge(none).count() == 0
