"""Pigeonhole edit matching against a full dynamic programme."""

import random

from ledgerlens.llm import decontaminate as D


def best_match(item, text):
    """(distance, first end) of item anywhere in text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != t)))
        row = new
    low = min(row)
    return low, row.index(low)


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        chars[at:at + 1] = rng.choice([[], ["q"], [chars[at], "z"]])
    return "".join(chars)


def test_myers():
    rng = random.Random(1)
    for _ in range(300):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
        low, end = best_match(item, text)
        if low < len(item):  # else nothing of the item is there
            assert D.myers(item, text, len(item) - 1) == (low, end)
        assert D.myers(item, text, low - 1) is None


def test_find_items_matches_brute_force(llm):
    rng = random.Random(2)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(200)]
    make = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = {k: make(rng.randint(1, 40)) for k in range(25)}
    docs = {}
    for i in range(60):
        item = items[rng.randrange(25)]
        docs[i] = f"{make(20)} {edited(rng, item, rng.choice([0, 0, 1, 3, 8, 20]))}\n{make(15)}".upper()
    got = D.find_items(llm.createDataFrame(list(docs.items()), "doc_id long, text string"),
                       llm.createDataFrame(list(items.items()), "item_id long, text string"), rate=0.1)
    found = {(r.doc_id, r.item_id): r for r in got.collect()}
    want = {}
    for i, text in docs.items():
        for k, item in items.items():
            low, _ = best_match(D.normal(item), D.normal(text))
            if low <= int(0.1 * len(D.normal(item))):
                want[i, k] = low
    assert {k: r.distance for k, r in found.items()} == want
    for (i, k), r in found.items():
        span = D.normal(docs[i])[r.start:r.end]
        assert best_match(D.normal(items[k]), span)[0] == r.distance


def test_blocks_of_items_add_up(llm, monkeypatch):
    docs = llm.createDataFrame([(1, "xx first passage of the test yy"), (2, "nothing"), (3, "second passage of it")],
                               "doc_id long, text string")
    items = llm.createDataFrame([(1, "first passage of the test"), (2, "second passage of it"), (2, None)],
                                "item_id long, text string")
    whole = D.find_items(docs, items).collect()
    blocks = D.blocks
    monkeypatch.setattr(D, "blocks", lambda *a: blocks(*a, chars=5))
    assert sorted(D.find_items(docs, items).collect()) == sorted(whole) and len(whole) == 2
    assert [r.doc_id for r in D.drop_contaminated(docs, items).collect()] == [2]


def test_edge_rows(llm, edge, none):
    items = llm.createDataFrame([(1, "quick brown fox jumps over"), (2, None), (3, ""), (4, " \n"), (None, "lazy dog"),
                                 (5, "lorem ipsum dolor lorem"), (5, "lorem ipsum dolor lorem")],
                                "item_id long, text string")
    found = sorted((r.doc_id, str(r.item_id), r.distance) for r in D.find_items(edge, items).collect())
    assert found == [(1, "1", 0), (1, "None", 0), (6, "5", 0), (7, "5", 0)]
    kept = D.drop_contaminated(edge, items)
    assert kept.columns == edge.columns and kept.count() == edge.count() - 3
    assert D.find_items(none, items).count() == 0 and D.find_items(edge, items.limit(0)).count() == 0
    assert D.drop_contaminated(edge, items.limit(0)).count() == edge.count()


def test_items_too_short_to_be_evidence(llm):
    docs = llm.createDataFrame([(1, "the cat sat"), (2, "what a passage of some length this is, the end"), (3, "none")],
                               "doc_id long, text string")
    items = llm.createDataFrame([(1, "the"), (2, "A passage  of some length this is"), (3, None), (4, " ")],
                                "item_id long, text string")
    assert [r.doc_id for r in D.drop_contaminated(docs, items, least_chars=D.LEAST_CHARS).orderBy("doc_id").collect()] == [1, 3]
    assert [r.item_id for r in D.short_items(items).collect()] == [1]
    assert [r.doc_id for r in D.drop_contaminated(docs, items).collect()] == [3]
