"""Token counts against a segmentation of each pre-token on its own."""

import tracemalloc

import public_tokenizers
import pytest

from ledgerlens.llm import token_counts as T

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def scores():
    with open(PATH) as f:
        return T.zipf_scores(T.read_ranks(f.read()))


def brute(scores, word):
    data = word.encode()
    best = [(0.0, 0)]
    for d in range(1, len(data) + 1):
        best.append(max((best[i][0] + scores[data[i:d]], best[i][1] - 1) for i in range(d) if data[i:d] in scores))
    return -best[-1][1]


def test_documents(llm, scores):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    trie, seen = T.CountTrie(scores), {}
    got = {r.doc_id: r for r in T.count_tokens(docs, PATH).collect()}
    for r in docs.collect():
        pieces = trie.pieces(r.text)
        for w in pieces:
            if w not in seen:
                seen[w] = brute(scores, w)
        assert (got[r.doc_id].n_pretokens, got[r.doc_id].n_tokens) == (len(pieces), sum(seen[w] for w in pieces))


def test_a_full_trie_counts_alike(scores):
    small = T.CountTrie(scores, max_nodes=30)
    words = [" thing", " things", " thinking", "thistle", " théâtre", "zzzzqq", " thingamajig", "\n\n", " thing"]
    assert [small.insert(w) for w in words * 2] == [brute(scores, w) for w in words * 2]
    assert len(small.best) < 60


def test_shared_prefixes_are_scored_once(scores):
    trie = T.CountTrie(scores)
    trie.insert("prefixes")
    nodes = len(trie.best)
    trie.insert("prefix")
    assert len(trie.best) == nodes and trie.terminal["prefix"] == trie.count[6]


def test_edge_rows(edge, none):
    rows = T.count_tokens(edge, PATH).collect()
    assert len(rows) == edge.count()
    assert all((r.n_pretokens, r.n_tokens) == (0, 0) for r in rows if r.doc_id in (2, 3))
    assert all(r.n_tokens > 0 for r in rows if r.doc_id in (1, 4, 6, 9))
    assert T.count_tokens(none, PATH).count() == 0


def test_a_very_long_word_needs_bounded_memory(scores):
    trie = T.CountTrie(scores, max_nodes=50_000)
    for word in (" thing" * 3, "a" * 1500, "theretofore" * 300):
        assert trie.read(word.encode()) == brute(scores, word) if len(word) < 2000 else trie.insert(word)
    before = len(trie.best)
    tracemalloc.start()
    tokens = trie.insert("the" * 400_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tokens == 400_000 and len(trie.best) == before and peak < 24 << 20
    # a word that does not fit the rest of the trie is counted and not added
    full = T.CountTrie(scores, max_nodes=100)
    assert full.insert("y" * 150) == brute(scores, "y" * 150) and len(full.best) == 1 and not full.terminal
