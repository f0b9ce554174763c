"""The automaton against the tokenizers library, and the round trip."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as f:
        return bpe.codec(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(own, text):
    return [i for w in own.words(text) for i in np.frombuffer(w[0], np.int32).tolist()]


def test_documents(llm, library):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in bpe.encode(docs, PATH).collect()}
    for r in docs.collect():
        want = library.encode(r.text, add_special_tokens=False).ids
        g = got[r.doc_id]
        assert g.ids == want and g.n_tokens == len(want)
        assert g.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        back = library.decode(want, skip_special_tokens=False)
        assert g.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_random_strings_and_all_code_points(own, library):
    rng = random.Random(1)
    parts = ["a", "b", "er", "th", " ", "  ", "\n", "é", "1", "***", "中", "😀", "'s", "'re", "<|endoftext|>", "\x00",
             "\xa0", "\x85", "\x1c", "aaaa", "=====", "    ", "\t", "the", "tion", "ing"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert ids(own, text) == library.encode(text, add_special_tokens=False).ids, text
    for c in [*range(0x3000), *range(0xE000, 0x11000), 0x1F600, 0x10FFFF]:
        text = f"a{chr(c)}b {chr(c)}{chr(c)} 1"
        assert ids(own, text) == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_long_runs_and_the_bounded_memory(own, library, monkeypatch):
    for text in ("a" * 5000, " " * 3000, "=" * 1001, "ab" * 2000, "é" * 3000):
        assert ids(own, text) == library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(bpe, "_CACHE_ROWS", 3)
    text = "one two three four one five six two one seven"
    for _ in range(3):
        assert ids(own, text) == library.encode(text, add_special_tokens=False).ids


def test_runs_of_one_letter_merge_from_the_left():
    labels = {0: b"a", 1: b"b", 2: b"aa", 3: b"aab", 4: b"aaaa"}
    auto = bpe.BpeAutomaton(labels, [(b"a", b"a"), (b"aa", b"b"), (b"aa", b"aa")], {})

    def naive(word):
        parts = [bytes([c]) for c in word]
        for u, v in [(b"a", b"a"), (b"aa", b"b"), (b"aa", b"aa")]:
            i = 0
            while i < len(parts) - 1:
                if parts[i] == u and parts[i + 1] == v:
                    parts[i:i + 2] = [u + v]
                i += 1
        return parts
    rng = random.Random(2)
    for _ in range(2000):
        word = bytes(rng.choice(b"aaab") for _ in range(rng.randint(1, 14)))
        assert [labels[i] for i in auto.encode(word)] == naive(word), word


def test_edge_rows(edge, none):
    got = bpe.encode(edge, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    rows = {r.doc_id: r for r in got.collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert rows[2].n_tokens == rows[3].n_tokens == 0 and rows[2].ids_sha256 == rows[3].decoded_sha256 == empty
    assert got.count() == edge.count() and 50256 in rows[9].ids
    assert bpe.encode(none, PATH, tokens=False).count() == 0


def test_special_tokens_of_any_spelling():
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    add = lambda content, i, **more: {"id": i, "content": content, "single_word": False, "lstrip": False, "rstrip": False,
                                      "normalized": False, "special": True, **more}
    first = max(max(spec["model"]["vocab"].values()), *(t["id"] for t in spec["added_tokens"])) + 1
    spec["added_tokens"] += [add("[PAD]", first), add("[PAD]]", first + 1), add("é!", first + 2)]
    text = json.dumps(spec)
    own, library = bpe.Codec(bpe.BpeAutomaton.from_json(text)), Tokenizer.from_str(text)
    for t in ("a [PAD] b", "[PAD]]]", "x[PAD][PAD]é!é", "no special", "<|endoftext|>[PAD", ""):
        assert ids(own, t) == library.encode(t, add_special_tokens=False).ids, t
    for flag in ("lstrip", "rstrip", "single_word"):
        spec["added_tokens"][-1] = add("[X]", first + 2, **{flag: True})
        with pytest.raises(ValueError, match="added token"):
            bpe.BpeAutomaton.from_json(json.dumps(spec))
    with pytest.raises(ValueError, match="token id"):
        bpe.BpeAutomaton({0: b"a"}, [], {"[X]": 1 << 20})
