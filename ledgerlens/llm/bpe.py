"""Byte-level BPE by a tokenization automaton.

The automaton reads tokens: from the start state every token string that it
accepts is the BPE encoding of the bytes it spells, and every byte string has
exactly one. It begins as one state with a loop for each byte. Each merge
(u, v) -> w is one gadget, applied in merge order: wherever u could be followed
by v, an arc w leads straight to where v led, and the arc v after u is taken
away. All arcs of a token lead to one state, that of "just read this token", so
a gadget

* makes the state of w a copy of the state of v as it is now,
* gives an arc w to every state that has an arc u now (but for u = v not to the
  state of u itself: of an odd run the pairs are taken from the left),
* removes the arc v from the state of u.

States are kept as what a gadget changed, with a link to what it copied and
the time of the copy: two arrays and one table of removed arcs, as many entries
as merges. ``BpeAutomaton.arc`` resolves one transition over those links and
remembers it. Encoding walks a pre-token over arcs, longest arc first; the path
to any position is unique, so a position that once led nowhere is never tried
again. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import raw, spans

# Fixed value: the pre-token pattern of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NEVER = 1 << 62
_CACHE_ROWS = 180_000
_CACHE_BYTES = 64


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 as itself, other bytes from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class BpeAutomaton:
    """Compiled merges: ``encode`` a pre-token to ids, ``decode`` ids to bytes."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[bytes, bytes]], special: dict[str, int]):
        self.labels = labels
        self.special = special
        ids = {label: i for i, label in labels.items()}
        self.left, self.right, self.born, self.removed, self.arcs = {}, {}, {}, {}, {}
        inert = set()
        for time, (u, v) in enumerate(merges):
            a, b, w = ids[u], ids[v], ids[u + v]
            if w in self.born:
                raise ValueError("two merges make one token; the automaton needs one each")
            if a in inert or b in inert or not self._arc(a, b, time):
                inert.add(w)
            self.left[w], self.right[w], self.born[w] = a, b, time
            self.removed[a, b] = time
        # Tokens on no path (no merge makes them, or none that can apply) label no arc.
        self.tokens = {label: i for label, i in ids.items() if i not in inert and (len(label) == 1 or i in self.born)}
        # the longest token by its first five bytes; anything else begins with a token of up to four
        self.longest = {}
        for label in self.tokens:
            self.longest[label[:5]] = max(self.longest.get(label[:5], 0), len(label))
        self.text = {i: str(i) for i in labels}
        if max([*labels, *special.values()], default=0) >= 1 << 20:
            raise ValueError("a token id of 2^20 or more")

    @classmethod
    def from_json(cls, text: str) -> BpeAutomaton:
        """From a tokenizers file of kind BPE with byte-level pre-tokens."""
        spec = json.loads(text)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"] or pre["add_prefix_space"]:
            raise ValueError("not a plain byte-level BPE vocabulary")
        byte_of = _byte_of()
        spell = lambda s: bytes(byte_of[c] for c in s)
        if any(not t["content"] or any(t.get(flag) for flag in ("lstrip", "rstrip", "single_word"))
               for t in spec["added_tokens"]):
            raise ValueError("an added token that is empty, takes white space with it or matches whole words only")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        labels = {i: spell(s) for s, i in model["vocab"].items() if s not in special}
        merges = [tuple(map(spell, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        return cls(labels, merges, special)

    def _arc(self, state: int, token: int, time: int = _NEVER) -> bool:
        """Whether the state of ``state`` has an arc ``token`` before gadget ``time``."""
        born, removed = self.born, self.removed
        while True:
            if removed.get((state, token), _NEVER) < time:
                return False
            bs, bt = born.get(state, -1), born.get(token, -1)
            if bs < 0 and bt < 0:
                return True
            if bt >= bs:  # the arc was laid where the token's first part had one
                if self.left[token] == self.right[token] == state:
                    return False
                time, token = bt, self.left[token]
            else:  # the state was copied from that of its second part
                time, state = bs, self.right[state]

    def arc(self, state: int, token: int) -> bool:
        key = state << 20 | token
        known = self.arcs.get(key)
        if known is None:
            if len(self.arcs) > 400_000:
                self.arcs.clear()
            known = self.arcs[key] = self._arc(state, token)
        return known

    def encode(self, word: bytes) -> list[int]:
        whole = self.tokens.get(word)
        if whole is not None:
            return [whole]
        tokens, longest, known, n = self.tokens, self.longest, self.arcs, len(word)
        path: list[int] = []
        places = [0]
        sizes = [longest.get(word[:5], 4) + 1]
        dead = set()
        while places[-1] < n:
            at, size = places[-1], sizes[-1] - 1
            while size:
                token = tokens.get(word[at:at + size])
                if token is not None and at + size <= n and at + size not in dead:
                    if not path:
                        break
                    free = known.get(path[-1] << 20 | token)
                    if self.arc(path[-1], token) if free is None else free:
                        break
                size -= 1
            sizes[-1] = size
            if size:
                path.append(token)
                at += size
                places.append(at)
                sizes.append(longest.get(word[at:at + 5], 4) + 1)
            else:
                dead.add(at)
                places.pop()
                sizes.pop()
                path.pop()
        return path

    def decode(self, ids: list[int]) -> bytes:
        labels = self.labels
        return b"".join([labels[i] for i in ids])


class Codec:
    """Whole texts: pre-split, then the automaton, with a bounded memory of pre-tokens."""

    def __init__(self, automaton: BpeAutomaton):
        self.automaton = automaton
        self.pieces = regex.compile(PATTERN).findall
        self.known: dict[str, tuple] = {}
        self.aged: dict[str, tuple] = {}
        names = sorted(automaton.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        self.heads = {name[0] for name in names}   # a text without any of these holds no special token

    def _word(self, word: str) -> tuple:
        """(ids packed as int32, their decimal text, decoded bytes) of one pre-token."""
        out = self.aged.get(word)
        if out is None:
            data = word.encode()
            ids, text = self.automaton.encode(data), self.automaton.text
            out = array("i", ids).tobytes(), ",".join([text[i] for i in ids]), self.automaton.decode(ids)
            if len(data) > _CACHE_BYTES:
                return out
        if len(self.known) >= _CACHE_ROWS:  # what is not asked for again soon is forgotten
            self.aged = dict(self.known)
            self.known.clear()
        self.known[word] = out
        return out

    def words(self, text: str) -> list[tuple]:
        known, special, new = self.known.get, self.automaton.special, self._word
        out = []
        for part in self.cut(text) if any(c in text for c in self.heads) else (text,):
            if part in special:
                out.append((array("i", [special[part]]).tobytes(), str(special[part]), part.encode()))
            else:
                out += [known(w) or new(w) for w in self.pieces(part)]
        return out

    def whole(self, text: str) -> tuple[bytes, str, str]:
        """(packed ids, digest of the ids as text, digest of the decoded text) of a text."""
        words = self.words(text)
        back = b"".join([w[2] for w in words]).decode("utf-8", "replace").encode()
        return (b"".join([w[0] for w in words]), hashlib.sha256(",".join([w[1] for w in words]).encode()).hexdigest(),
                hashlib.sha256(back).hexdigest())


_CODECS: dict[str, Codec] = {}


def codec(spec: str) -> Codec:
    """The codec of a vocabulary file's text, compiled once a worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(BpeAutomaton.from_json(spec))
    return _CODECS[key]


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           tokens: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for each row.

    ``vocabulary`` is the path of a byte-level BPE file on the driver; its text
    (under 2 MB, bounded by ``MAX_VOCABULARY``) travels with the tasks. Special
    tokens written out in a text become their own id. ``decoded_sha256`` is over
    the text decoded from the ids, which equals the input. Null reads as the
    empty text: no tokens and the digest of nothing. Each row stands alone, so
    repeated rows repeat and other columns are not read. With ``tokens`` the
    ids themselves come as an array.
    """
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    if len(spec) > MAX_VOCABULARY:
        raise ValueError(f"the vocabulary file is larger than {MAX_VOCABULARY} characters")
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        own = codec(shared.value)
        for batch in batches:
            texts = raw(batch.column(1))
            for s, e in spans([len(t) for t in texts], 1 << 20):
                found = [own.whole(t.decode()) for t in texts[s:e]]
                ids, digests, decoded = map(list, zip(*found))
                counts = [len(x) // 4 for x in ids]
                cols = [batch.column(0)[s:e], pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                        pa.array(decoded, pa.string())]
                if tokens:
                    flat = np.frombuffer(b"".join(ids), np.int32)
                    bounds = np.cumsum([0, *counts], dtype=np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(cols, names[:len(cols)])
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * tokens
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, schema)


MAX_VOCABULARY = 16 << 20
