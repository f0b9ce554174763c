"""The audit against walking every order document by document."""

import re
from itertools import permutations

import numpy as np

from ledgerlens.llm import filter_audit as A
from ledgerlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(docs, labels):
    """The rows of the contract; docs (doc_id, text, lang), labels (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    parts = {}
    for d, text, lang in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = ""
        fails += "A" * (len(words) < 100)
        fails += "B" * (100 * len(set(words)) < 80 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
        fails += "D" * bool(re.search("[#$%&*|]", text))
        fails += "E" * any(o is not None and d is not None and o < d and (t or "") == text for o, t, _ in docs)
        parts.setdefault(lang or "", []).append((d, fails))
    rows = {}
    for part, own in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                here = [d for d, fails in own if f in fails and not set(order[:step]) & set(fails)]
                shapley[f] += len(here)
                rows[part, "".join(order), step + 1] = [
                    sum(not set(order[:step + 1]) & set(fails) for _, fails in own), len(here),
                    sum(f in fails and bool(set(order[:step]) & set(fails)) for _, fails in own),
                    sum(fails == f for _, fails in own), sum(d in good for d in here), sum(d in toxic for d in here)]
        for (p, order, step), r in rows.items():
            if p == part:
                r.append(shapley[order[step - 1]])
    return {(*k, *v) for k, v in rows.items()}


def rows_of(df):
    assert df.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                          "toxic_lost", "shapley"]
    return [tuple(r) for r in df.collect()]


def test_equal_to_walking_the_orders(llm):
    long = "word " * 120
    docs = [(1, None, "en"), (2, "", None), (3, long, "en"), (4, long, "de"), (4, long, "de"), (None, long, "de"),
            (2, "", ""), (5, "SHOUT " * 200, "fr"), (6, " ".join(map(str, range(150))), "fr"),
            (7, " ".join(map(str, range(150))) + " #", None), (8, "É ß 漢字 \x85\xa0 | x", "en"), (None, None, None),
            (9, " ".join(f"w{i}" for i in range(400_000)) + "\n" + "y" * 3_000_000, "en"), (3, long + "|", "en")]
    labels = [(1, 1, 0), (1, 0, 1), (3, 1, 1), (4, 0, 1), (None, 1, 1), (5, None, None), (99, 1, 1), (8, 1, 0)]
    df = llm.createDataFrame([(*d, "x", 1, 2, "y") for d in docs],
                             "doc_id long, text string, lang string, part string, fails int, good int, digest string")
    marks = llm.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = rows_of(A.audit(df, marks))
    assert len(got) == 600 * 4 and set(got) == plain(docs, labels)
    assert rows_of(A.audit(df.limit(0), marks)) == []
    none = rows_of(A.audit(df, marks.limit(0)))
    assert {r[:7] for r in none} == {r[:7] for r in got} and all(r[7:9] == (0, 0) for r in none)


def test_registered_query(llm):
    docs = [(r.doc_id, r.text, r.lang) for r in llm.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in llm.read.parquet(f"{SF}/labels.parquet").collect()]
    assert set(rows_of(QUERIES["op13_filter_audit"](llm, SF))) == plain(docs, labels)


def test_potential_gives_the_shapley_values():
    counts = np.random.default_rng(4).integers(0, 1000, 32)
    worth = A.worths(counts)
    potential = A.potentials(worth)
    for i in range(5):
        bit, total = 1 << i, 0
        for order in permutations(range(5)):
            before = sum(1 << k for k in order[:order.index(i)])
            total += worth[before | bit] - worth[before]
        assert potential[31] - 5 * potential[31 & ~bit] == total
    # efficiency: the values add up to what all filters remove together
    assert sum(potential[31] - 5 * potential[31 & ~(1 << i)] for i in range(5)) == 120 * worth[31]


def test_long_texts_are_counted_in_pieces():
    text = (b"a bb a\tccc\n" * 300_000) + b"z" * 2_000_000 + b" end"
    assert A._word_counts(text) == (len(text.split()), len(set(text.split())))
