"""Token counts of documents under a unigram vocabulary, shared over a trie.

A pre-token's segmentation is the one of greatest total log-probability of its
pieces. The forward score of a prefix does not depend on what follows, so the
distinct pre-tokens of a worker go into one trie and every node's forward score
is computed once, however many words pass through it. The node where a
pre-token ends stores its token count; a document's count is a sum of look-ups.

Piece probabilities follow Zipf's law over the ranks of the vocabulary file,
``p(rank) = 1 / ((rank + 1) * H)``; nothing is trained. Of equal scores the
segmentation with fewer tokens counts. The file must have all single bytes.
"""

from __future__ import annotations

import base64
import hashlib
import math

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.bpe import PATTERN
from ledgerlens.llm.common import raw, spans

MAX_VOCABULARY = 16 << 20
_MAX_NODES = 700_000
#: Words of more bytes are not put into the trie; of those, so many scores and the longest piece's are held at a time.
_LONG, _WINDOW = 4096, 1 << 16


def read_ranks(text: str) -> dict[bytes, int]:
    """Pieces and ranks of a ranks file: base64 of the piece, a space, its rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in text.splitlines() if line)}


def zipf_scores(ranks: dict[bytes, int]) -> dict[bytes, float]:
    total = math.fsum(1 / (r + 1) for r in ranks.values())
    return {piece: -math.log((r + 1) * total) for piece, r in ranks.items()}


class CountTrie:
    """Nodes are byte prefixes; ``best`` and ``count`` hold a node's forward score and its number of tokens."""

    def __init__(self, scores: dict[bytes, float], max_nodes: int = _MAX_NODES):
        self.scores = scores
        self.max_nodes = max_nodes
        # every end of a piece, with the score if it is a piece itself: a longer end is tried only if a shorter one is known
        self.ends = dict.fromkeys((p[i:] for p in scores for i in range(len(p))), -math.inf) | scores
        self.longest = max(map(len, scores), default=0)
        self.pieces = regex.compile(PATTERN).findall
        self.child: dict[int, int] = {}
        self.best, self.count = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def insert(self, word: str) -> int:
        """The token count of a pre-token, stored at its end; new prefixes get their forward scores.

        A trie without room for the whole word is read on but not added to: the
        pre-tokens met first, so all frequent ones, stay shared, and memory stays
        bounded. A word of more than ``_LONG`` bytes is read by itself.
        """
        data = word.encode()
        if len(data) > _LONG:
            return self.read(data)
        child, known = self.child, self.ends.get
        best, count = [0.0], [0]
        node, open_ = 0, len(self.best) + len(data) <= self.max_nodes
        for d in range(1, len(data) + 1):
            key = node << 8 | data[d - 1]
            node = child.get(key, -1) if node >= 0 else -1
            if node >= 0:
                best.append(self.best[node])
                count.append(self.count[node])
                continue
            top, tokens = -math.inf, 0
            for at in range(d - 1, -1, -1):
                score = known(data[at:d])
                if score is None:
                    break
                total = best[at] + score
                if total > top:
                    top, tokens = total, count[at] + 1
                elif total == top and count[at] + 1 < tokens:
                    tokens = count[at] + 1
            best.append(top)
            count.append(tokens)
            if open_:
                node = child[key] = len(self.best)
                self.best.append(top)
                self.count.append(tokens)
        if open_:
            self.terminal[word] = count[-1]
        return count[-1]

    def read(self, data: bytes) -> int:
        """The token count of a word without the trie, in memory that doesn't grow with the word."""
        known = self.ends.get
        best, count, base = [0.0], [0], 0
        for d in range(1, len(data) + 1):
            top, tokens = -math.inf, 0
            for at in range(d - 1, -1, -1):
                score = known(data[at:d])
                if score is None:
                    break
                total = best[at - base] + score
                if total > top:
                    top, tokens = total, count[at - base] + 1
                elif total == top and count[at - base] + 1 < tokens:
                    tokens = count[at - base] + 1
            best.append(top)
            count.append(tokens)
            if len(best) > _WINDOW + self.longest:
                # no piece reaches further back than the longest one
                old = len(best) - self.longest - 1
                del best[:old], count[:old]
                base += old
        return count[-1]

    def counts(self, text: str) -> tuple[int, int]:
        """(pre-tokens, tokens) of a text."""
        known, insert = self.terminal.get, self.insert
        words = self.pieces(text)
        return len(words), sum([known(w) or insert(w) for w in words])


_TRIES: dict[str, CountTrie] = {}


def trie(spec: str) -> CountTrie:
    """The trie of a ranks file's text, one a worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _TRIES:
        _TRIES.clear()
        _TRIES[key] = CountTrie(zipf_scores(read_ranks(spec)))
    return _TRIES[key]


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) for each row.

    ``vocabulary`` is the path of a ranks file on the driver; its text travels
    with the tasks, at most ``MAX_VOCABULARY`` characters. Null and empty texts
    have none of either; special token strings are plain text. Rows stand
    alone, so repeated rows repeat; other columns are not read.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    if len(spec) > MAX_VOCABULARY:
        raise ValueError(f"the vocabulary file is larger than {MAX_VOCABULARY} characters")
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        own = trie(shared.value)
        for batch in batches:
            texts = raw(batch.column(1))
            for s, e in spans([len(t) for t in texts], 1 << 20):
                found = [own.counts(t.decode()) for t in texts[s:e]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[s:e], pa.array([a for a, _ in found], pa.int64()),
                     pa.array([b for _, b in found], pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_pretokens long, n_tokens long")
