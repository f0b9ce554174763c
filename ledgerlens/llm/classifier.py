"""Quality classifier over learned subword embeddings.

A text is its words, its word bigrams and the character n-grams of each word
(with the word's ends marked), hashed to buckets. Every bucket has a learned vector; the text's
vector is the mean over all its features, and a softmax layer reads the class.
Vectors and layer are learned together by stochastic gradient descent in numpy.

Training uses a bounded sample of labelled texts (``max_train`` of them and
``max_chars`` characters, chosen by hashes), reduced to bucket counts by Spark
tasks. Scoring covers every
whole text, in tasks that get the model as one float per bucket: the softmax of
two classes depends only on the difference of their scores, which is linear in
the bucket vectors. Features are made for megabytes of text at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import cut, lowest, raw, remainder, spans
from ledgerlens.llm.words import hashed_words

_MULT = np.uint32(0x9E3779B1)
_SPACE = 32


def features(texts: list[bytes], bits: int, grams: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, row) of all features of the texts, rows in no particular order."""
    canon = [b" " + b" ".join(t.lower().split()) + b" " for t in texts]
    data = np.frombuffer(b"".join(canon), np.uint8)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(c) for c in canon])
    shift = np.uint32(32 - bits)
    gap = data == _SPACE
    words, starts = hashed_words(data, gap)
    words = ((words ^ (words >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    rows = [owner[starts]]
    buckets = [(words * _MULT) >> shift]
    # Word bigrams, hashed as the difference: a word said twice in a row is one feature, whatever the word.
    pairs = np.flatnonzero(rows[0][1:] == rows[0][:-1]) if len(words) else np.empty(0, int)
    buckets.append((((words[pairs + 1] - words[pairs]) ^ np.uint32(0x5BD1E995)) * _MULT) >> shift)
    rows.append(rows[0][pairs])
    # n-grams: spaces stand for a word's ends, so none may lie within.
    code = data.astype(np.uint32)
    rolled, inner = code, None
    for n in range(2, max(grams) + 1):
        size = len(data) - n + 1
        if size <= 0:
            break
        rolled = rolled[:size] * np.uint32(0x01000193) + code[n - 1:]
        if n > 2:
            within = ~gap[n - 2:n - 2 + size]
            inner = within if inner is None else inner[:size] & within
        if n in grams:
            at = np.flatnonzero(inner) if inner is not None else np.flatnonzero(~(gap[:size] & gap[1:1 + size]))
            h = rolled[at] + np.uint32(n)
            buckets.append(((h ^ (h >> np.uint32(15))) * _MULT) >> shift)
            rows.append(owner[at])
    return np.concatenate(buckets).astype(np.int32), np.concatenate(rows)


@dataclass
class Model:
    """``margin[b]``: what a feature in bucket b adds to the score of class 1 over class 0."""

    bits: int
    grams: tuple[int, ...]
    margin: np.ndarray
    bias: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of class 1; a text without words gets what the bias alone says."""
        out = np.empty(len(texts))
        for s, e in spans([len(t) for t in texts], 1 << 18):
            buckets, rows = features(texts[s:e], self.bits, self.grams)
            total = np.bincount(rows, self.margin[buckets], e - s)
            out[s:e] = total / np.maximum(1, np.bincount(rows, minlength=e - s)) + self.bias
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], bits: int, grams: tuple[int, ...], dim: int = 8,
        epochs: int = 12, rate: float = 0.5, seed: int = 1) -> Model:
    """SGD over (label, buckets, weights summing to 1); one document a step."""
    rng = np.random.default_rng(seed)
    vectors = np.zeros((1 << bits, dim), np.float32)
    layer = rng.normal(0, 1, (2, dim)).astype(np.float32)
    share = np.mean([y for y, _, _ in rows]) if rows else 0.5
    share = np.clip(share, 1e-3, 1 - 1e-3)
    bias = np.log(np.array([1 - share, share])).astype(np.float32)
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            y, buckets, weights = rows[k]
            lr = rate * (1 - done / steps)
            done += 1
            mean = weights @ vectors[buckets]
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ layer
            layer -= lr * p[:, None] * mean
            bias -= np.float32(lr * 0.1) * p
            # a mean moves by the squared weights of its features; scaled so that a step has the same size for all lengths
            vectors[buckets] -= (lr / max(1e-9, float(weights @ weights)) * weights)[:, None] * back
    return Model(bits, grams, (vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", held_out: tuple[int, int] = (3, 1), max_train: int = 2500, bits: int = 18,
          grams: tuple[int, ...] = (3, 4), max_chars: int = 1 << 24) -> Model:
    """The model of at most ``max_train`` labelled texts, those of the smallest hashes.

    Rows whose crc32(id) modulo ``held_out[0]`` is ``held_out[1]`` are never
    used, nor are null labels, null ids or texts. Each label of an id goes with
    each text of the id, once however often the rows repeat: first ``max_train``
    (id, label) pairs are chosen, then as many of their texts, until those hold
    ``max_chars`` characters. So what reaches the driver is bounded in rows and
    bytes. Without rows the model scores 0.5 throughout.
    """
    usable = (labels.select(F.xxhash64(id_col).alias("h"), F.col(id_col).alias("doc_id"),
                            F.col(label_col).cast("int").alias("label"))
              .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
                     & (remainder(F.col("doc_id"), held_out[0]) != held_out[1])).distinct())
    # chosen has at most max_train rows of two numbers: small enough to broadcast, like what is taken from it
    chosen = F.broadcast(lowest(usable, "h", max_train).select("doc_id", "label"))
    plain = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    named = plain.select("doc_id", "text_hash", F.length("text").alias("chars")).join(chosen, "doc_id").select(
        F.xxhash64("doc_id", "label", "text_hash").alias("h"), "doc_id", "label", "text_hash", "chars").distinct()
    found = sorted(map(tuple, lowest(cut(named, "labelled-texts"), "h", max_train).collect()))
    room = np.cumsum([r[4] for r in found]) <= max_chars
    taken = [r[1:4] for r, fits in zip(found, room) if fits] or [r[1:4] for r in found[:1]]
    kind = docs.schema[id_col].dataType.simpleString()
    wanted = F.broadcast(docs.sparkSession.createDataFrame(taken, f"doc_id {kind}, label int, text_hash long"))

    def run(batches):
        done = set()   # at most max_train names; a text that stands again in this task is not made twice
        for batch in batches:
            names = list(zip(*(batch.column(k).to_pylist() for k in (2, 0, 3))))
            new = [i for i, name in enumerate(names) if name not in done and not done.add(name)]
            batch = batch.take(pa.array(new, pa.int64()))
            texts = raw(batch.column(1))
            for s, e in spans([len(t) for t in texts], 1 << 18):
                buckets, rows = features(texts[s:e], bits, grams)
                keys, counts = np.unique(rows.astype(np.int64) << 32 | buckets, return_counts=True)
                bounds = np.searchsorted(keys >> 32, np.arange(e - s + 1))
                low, n = (keys & 0xFFFFFFFF).astype("<i4"), counts.astype("<u4")
                pick = list(zip(bounds, bounds[1:]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[s:e], pa.array([low[a:b].tobytes() for a, b in pick], pa.binary()),
                     pa.array([n[a:b].tobytes() for a, b in pick], pa.binary()), batch.column(2)[s:e],
                     batch.column(3)[s:e]], ["label", "buckets", "counts", "doc_id", "text_hash"])
    made = (plain.join(wanted, ["doc_id", "text_hash"]).select("label", "text", "doc_id", "text_hash").mapInArrow(
        run, f"label int, buckets binary, counts binary, doc_id {kind}, text_hash long")
            .groupBy("doc_id", "label", "text_hash").agg(F.first("buckets").alias("buckets"), F.first("counts").alias("counts"))
            .select("label", "buckets", "counts").collect())
    rows = []
    for r in sorted(map(tuple, made)):
        if len(r[1]):
            n = np.frombuffer(r[2], "<u4").astype(np.float32)
            rows.append((r[0], np.frombuffer(r[1], "<i4"), n / n.sum()))
    return fit(rows, bits, grams)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for each row of ``docs``; null and empty texts get the model's bias as their score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(raw(batch.column(1))))],
                                             ["doc_id", "score"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double")


def keep_accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns kept, that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(shared.value.score(raw(batch.column(text_col))) >= threshold))
    return docs.mapInArrow(run, docs.schema)
