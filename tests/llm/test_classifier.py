"""Held-out accuracy, features against a plain version, edge rows."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import classifier as C
from ledgerlens.llm.common import remainder

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(llm):
    docs, labels = (llm.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = C.train(docs, labels)
    rows = (C.score(docs, model).join(labels, "doc_id").where(remainder(F.col("doc_id"), 3) == 1).collect())
    assert len(rows) > 80
    right = np.mean([(r.score >= 0.5) == (r.quality == 1) for r in rows])
    assert right >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_that_are_held_out_are_not_learnt(llm):
    docs, labels = (llm.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(remainder(F.col("doc_id"), 3) == 1, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    a, b = C.train(docs, labels, max_train=60), C.train(docs, flipped, max_train=60)
    assert (a.margin == b.margin).all() and a.bias == b.bias


def test_features_are_words_bigrams_and_inner_grams():
    texts = [b"The cat the cat", b"", b"  a\tbb  ", b"xyz xyz xyz"]
    buckets, rows = C.features(texts, 18, (3, 4))
    count = np.bincount(rows, minlength=4)
    # words + bigrams + windows of " the cat the cat " with spaces at the ends only
    def grams(text):
        s = " " + " ".join(text.decode().lower().split()) + " "
        return sum(" " not in s[i + 1:i + n - 1] for n in (3, 4) for i in range(len(s) - n + 1)) if text.split() else 0
    want = [len(t.split()) + max(0, len(t.split()) - 1) + grams(t) for t in texts]
    assert count.tolist() == want
    alone = [sorted(C.features([t], 18, (3, 4))[0].tolist()) for t in texts]
    assert [sorted(buckets[rows == k].tolist()) for k in range(4)] == alone
    # a repeated word is one bigram feature, whatever the word
    twice = lambda w: set(C.features([w + b" " + w], 18, (9,))[0].tolist())
    assert len(twice(b"ab") & twice(b"qrst")) == 1


def test_edge_rows(llm, edge, none):
    labels = llm.createDataFrame([(1, 1), (5, 0), (5, 1), (8, None), (None, 1), (9, 7), (404, 1), (3, 0)],
                                 "doc_id long, quality int")
    model = C.train(edge, labels)
    rows = C.score(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    blank = 1 / (1 + np.exp(-model.bias))
    assert all(abs(r.score - blank) < 1e-9 for r in rows if r.doc_id in (2, 3, 4))
    kept = C.keep_accepted(edge, model, threshold=0.0)
    assert kept.columns == edge.columns and kept.count() == edge.count()
    untaught = C.train(edge, labels.limit(0))
    assert {r.score for r in C.score(edge, untaught).collect()} == {0.5}
    assert C.score(none, model).count() == 0 and C.keep_accepted(none, model).count() == 0
    one_kind = C.train(edge, labels.where("quality = 1"))
    assert all(r.score > 0.5 for r in C.score(edge, one_kind).collect())


def test_a_word_of_many_occurrences_is_learned_as_it_is_scored(llm, monkeypatch):
    seen = []
    monkeypatch.setattr(C, "fit", lambda rows, bits, grams: seen.extend(rows))
    text = "ab " * 140_000 + "cdefg"
    docs = llm.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
    labels = llm.createDataFrame([(i, 1) for i in range(3)], "doc_id long, quality int")
    C.train(docs, labels)
    buckets, _ = C.features([text.encode()], 18, (3, 4))
    counts = np.unique(buckets, return_counts=True)[1]
    assert seen and counts.max() > 65535
    assert all(np.allclose(w, counts / counts.sum()) for _, _, w in seen)


def test_an_id_that_repeats_does_not_fill_the_driver(llm, monkeypatch):
    seen = []
    monkeypatch.setattr(C, "fit", lambda rows, bits, grams: seen.append(list(rows)))
    ids = [i for i in range(1, 30) if zlib.crc32(str(i).encode()) % 3 != 1][:4]
    labels = llm.createDataFrame([(i, i % 2) for i in ids for _ in range(50)], "doc_id long, quality int")
    other = llm.range(20_000).selectExpr(f"element_at(array({','.join(map(str, ids))}), cast(id % 4 + 1 AS int)) AS doc_id",
                                         "concat('text number ', id) AS text")
    C.train(other, labels, max_train=7)
    same = other.withColumn("text", F.concat(F.lit("same text of "), F.col("doc_id").cast("string")))
    C.train(same, labels, max_train=7)
    C.train(other, labels, max_train=7, max_chars=40)
    assert [len(x) for x in seen] == [7, 4, 2]


def test_fit_and_score_equal_plain_loops():
    """Gradient descent and scores, one feature at a time."""
    texts = [b"good words here", b"bad bad noise 123", b"good good here now", b"noise of bad", b"", b"ab"]
    truth = [1, 0, 1, 0, 1, 0]
    bits, grams, dim, epochs, rate = 8, (3,), 3, 4, 0.5
    rows = []
    for y, t in zip(truth, texts):
        buckets, _ = C.features([t], bits, grams)
        keys, n = np.unique(buckets, return_counts=True)
        if len(keys):
            rows.append((y, keys.astype(np.int32), (n / n.sum()).astype(np.float32)))
    model = C.fit(rows, bits, grams, dim, epochs, rate, seed=5)
    rng = np.random.default_rng(5)
    vectors = [[0.0] * dim for _ in range(1 << bits)]
    layer = rng.normal(0, 1, (2, dim)).astype(np.float32).tolist()
    share = sum(y for y, _, _ in rows) / len(rows)
    bias, done = [math.log(1 - share), math.log(share)], 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            y, buckets, weights = rows[k]
            lr = rate * (1 - done / (epochs * len(rows)))
            done += 1
            mean = [sum(float(w) * vectors[b][d] for b, w in zip(buckets, weights)) for d in range(dim)]
            z = [sum(layer[c][d] * mean[d] for d in range(dim)) + bias[c] for c in range(2)]
            e = [math.exp(x - max(z)) for x in z]
            p = [x / sum(e) - (c == y) for c, x in enumerate(e)]
            back = [sum(p[c] * layer[c][d] for c in range(2)) for d in range(dim)]
            for c in range(2):
                bias[c] -= lr * 0.1 * p[c]
                for d in range(dim):
                    layer[c][d] -= lr * p[c] * mean[d]
            scale = lr / sum(float(w) ** 2 for w in weights)
            for b, w in zip(buckets, weights):
                for d in range(dim):
                    vectors[b][d] -= scale * float(w) * back[d]
    for text, got in zip(texts, model.score(texts)):
        buckets, _ = C.features([text], bits, grams)
        mean = [sum(vectors[b][d] for b in buckets) / max(1, len(buckets)) for d in range(dim)]
        z = [sum(layer[c][d] * mean[d] for d in range(dim)) + bias[c] for c in range(2)]
        assert abs(got - 1 / (1 + math.exp(z[0] - z[1]))) < 1e-4, text
