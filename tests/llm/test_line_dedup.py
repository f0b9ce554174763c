"""Fuzzy line dedup against brute force, edit distance, hot classes, edge rows."""

import random

import numpy as np
import pytest

from ledgerlens.llm import line_dedup as L
from ledgerlens.llm.words import mixed


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mix(x):
    return int(mixed(np.array([x], np.uint64))[0])


def plain_prints(form):
    """{kind: (fingerprint, set of block keys)} of a normal form, feature by feature."""
    out = {}
    words = {mix(sum(c * pow(0x100000001B3, i, 1 << 64) for i, c in enumerate(w)) & ((1 << 64) - 1)) >> 24
             for w in form.split(b" ")}
    triples = {mix(form[i] << 16 | form[i + 1] << 8 | form[i + 2]) >> 24 for i in range(len(form) - 2)}
    kinds = [(0, 1, words)]
    if len(form) < L.SHORT_BYTES or len(words) < L.FEW_WORDS:
        kinds.append((1, 2, triples))

    def simhash(features):
        return sum(1 << b for b in range(64) if 2 * sum(mix(f) >> b & 1 for f in features) > len(features))
    for kind, salt, features in kinds:
        place = np.log(max(1, len(features)) / L.SHARE) / np.log(L.STEP)
        keys = set()
        for step in {max(0, int(np.floor(place))), max(0, int(np.floor(place + L.OVERLAP)))}:
            parts = max(2, int(np.rint(L.STEP ** step)))
            for g in range(parts):
                own = [f for f in features if (mix(f) >> 32) % parts == g]
                if len(own) >= L.LEAST:
                    keys.add(mix(simhash(own) ^ mix(g << 32 | parts << 2 | salt)) & ~1 | kind)
        out[kind] = simhash(features), keys
    return out


def candidates(a, b, max_bits):
    return any(k in b and a[k][1] & b[k][1] and (a[k][0] ^ b[k][0]).bit_count() <= max_bits for k in a)


def brute(docs, max_bits=L.MAX_BITS, similarity=0.8, every_pair=False):
    """The texts after removal, by comparing all pairs of lines that are candidates, or all."""
    first = {}
    for i, text in sorted(docs.items()):
        for n, line in enumerate(text.split("\n")):
            form = L.normal_line(line.encode())
            if form:
                first.setdefault(form, (i, n))
    forms = list(first)
    prints = [plain_prints(f) for f in forms]
    label = list(range(len(forms)))
    for i in range(len(forms)):
        for j in range(i + 1, len(forms)):
            a, b = forms[i].decode(), forms[j].decode()
            if (every_pair or candidates(prints[i], prints[j], max_bits)) and label[i] != label[j] and (
                    lev(a, b) <= int((1 - similarity) * max(len(a), len(b)) + 1e-9)):
                old, new = label[j], label[i]
                label = [new if x == old else x for x in label]
    best = {}
    for k, f in enumerate(forms):
        best[label[k]] = min(best.get(label[k], (1 << 60, 0)), first[f])
    stay = set(best.values())
    return {i: "\n".join(x for n, x in enumerate(t.split("\n")) if not L.normal_line(x.encode()) or (i, n) in stay)
            for i, t in docs.items()}


def corpus(seed, docs=60):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(80)]
    bases = [[rng.choice(vocab) for _ in range(rng.randint(1, 60))] for _ in range(25)]
    out = {}
    for i in range(docs):
        lines = []
        for _ in range(rng.randint(1, 8)):
            words = list(rng.choice(bases))
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = rng.choice(vocab)
            line = " ".join(words)
            lines.append(rng.choice([line, line.upper(), line + "!!", " " + line, "", "-----"]))
        out[i] = "\n".join(lines)
    return out


def test_matches_brute_force(llm):
    docs = corpus(1)
    df = llm.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {r.doc_id: r.text for r in L.dedup_lines(df).collect()} == brute(docs)


def test_all_pairs_path(llm):
    docs = corpus(2, 25)
    df = llm.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {r.doc_id: r.text for r in L.dedup_lines(df, exhaustive=True).collect()} == brute(docs, every_pair=True)


def hot(kind):
    """Many near copies of a line, with chains that only some of them link, and unlike lines that share blocks."""
    rng = random.Random(7)
    base = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(40)]
    docs = {}
    for i in range(70):
        words = list(base)
        for _ in range(1 if kind == "copies" else rng.randint(1, 8)):
            words[rng.randrange(len(words))] = "".join(rng.choice("qxyz") for _ in range(6))
        if kind == "unlike" and i % 3 == 0:
            words = words[:20] + ["".join(rng.choice("ijkl") for _ in range(rng.randint(4, 9))) for _ in range(20)]
        docs[i] = " ".join(words)
    return docs | {100: "unlike all the rest of the lines", 101: " ".join(base)}


@pytest.mark.parametrize("kind", ["copies", "chains", "unlike"])
def test_cells_and_pieces_do_not_change_the_result(llm, monkeypatch, kind):
    docs = hot(kind)
    df = llm.createDataFrame(list(docs.items()), "doc_id long, text string")
    want = brute(docs)
    near, verified = L.near_members, L.verified_links
    monkeypatch.setattr(L, "near_members", lambda found, bits: near(found, bits, cell_rows=4))
    monkeypatch.setattr(L, "_REMEMBERED", 3)
    monkeypatch.setattr(L, "_SAMPLE", 1)
    monkeypatch.setattr(L, "SENT_IDS", 0)
    monkeypatch.setattr(L, "verified_links", lambda *a: verified(*a, cell=5))
    assert {r.doc_id: r.text for r in L.dedup_lines(df).collect()} == want


def test_prints_equal_plain_version():
    rng = random.Random(9)
    forms = [L.normal_line(x.encode()) for t in corpus(3, 30).values() for x in t.split("\n")]
    forms = [f for f in dict.fromkeys(forms) if f] + [b"a", b"ab", "é".encode() * 50, b"x y " * 200 + b"end", b"z" * 3000,
                                                       " ".join(str(rng.random()) for _ in range(900)).encode()]
    words, triples, keys = L.line_prints(forms)
    got = [{}, {}]
    for kind, parts in enumerate((words, triples)):
        for at, fp in parts:
            got[kind].update(zip(at.tolist(), fp.tolist()))
    found = [set() for _ in forms]
    for at, key in keys:
        for i, k in zip(at.tolist(), key.tolist()):
            found[i].add(k)
    for i, f in enumerate(forms):
        want = plain_prints(f)
        assert got[0][i] == want[0][0] and found[i] == set().union(*(k for _, k in want.values())), f
        if 1 in want and len(f) > 2:
            assert got[1][i] == want[1][0]
    assert all(len(x) == 0 for x in L.line_prints([]))


def test_recall_on_the_documents(llm):
    """Of the pairs that all pairs of the lines hold by edit similarity, at least nine in ten are candidates."""
    texts = [r.text for r in llm.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 500").collect()]
    forms = sorted({f for t in texts if t for x in t.split("\n") if (f := L.normal_line(x.encode()))}, key=len)
    counts = np.array([np.bincount(np.frombuffer(f, np.uint8), minlength=256) for f in forms], np.int16)
    sizes = np.array([len(f) for f in forms])
    pairs = []
    for i in range(len(forms)):
        # longer or equal lines within the length bound, then the bound by letters: both are necessary
        end = np.searchsorted(sizes, sizes[i] / 0.8 + 2, "right")
        off = counts[i + 1:end] - counts[i]
        apart = np.maximum(np.maximum(off, 0).sum(1), np.maximum(-off, 0).sum(1))
        for j in np.flatnonzero(apart <= 0.2 * sizes[i + 1:end] + 1) + i + 1:
            a, b = set(forms[i].split()), set(forms[j].split())
            # what shares under three words in ten can be similar only if it is short
            if (len(a & b) >= 0.3 * min(len(a), len(b)) or sizes[j] < 60) and L.similar(forms[i].decode(), forms[j].decode(), 0.8):
                pairs.append((i, j))
    prints = {i: plain_prints(forms[i]) for i in {k for p in pairs for k in p}}
    found = sum(candidates(prints[i], prints[j], L.MAX_BITS) for i, j in pairs)
    assert len(pairs) > 50 and found >= 0.9 * len(pairs), (found, len(pairs))


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(400):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 40)))
        b = list(a)
        for _ in range(rng.randint(0, 8)):
            b[rng.randrange(len(b) + 1):rng.randrange(len(b) + 1)] = rng.choice(["", "x", "ab"])
        b = "".join(b)
        want = lev(a, b)
        assert L.edit_distance(a, b) == want
        for limit in range(0, 12, 3):
            assert (L.edit_distance(a, b, limit) <= limit) == (want <= limit)
    vocab = ["a", "bb", "ccc", "dddd", "ee"]
    proved = 0
    for _ in range(2000):
        x = [rng.choice(vocab) for _ in range(rng.randint(0, 12))]
        y = [w if rng.random() < 0.8 else rng.choice([*vocab, "x y", ""]) for w in x]
        a, b = " ".join(x), " ".join(w for w in y if w)
        want = lev(a, b)
        for limit in (0, want - 1, want, want + 3):
            if L.edited_words(a, b, limit):
                proved += 1
                assert want <= limit, (a, b, limit)
    assert proved > 1000
    assert L.similar("", "", 0.8) and not L.similar("", "a", 0.8) and L.similar("abcde", "abcdx", 0.8)


def test_normal_form():
    assert L.normal_line(b"  Hello, World 42!\t") == b"hello world 00"
    assert L.normal_line(b" -- ..") == b"--\x00.." and L.normal_line(b" \t") == b""


def test_edge_rows(llm, edge, none):
    out = L.dedup_lines(edge, lines_col="n_lines", kept_col="n_kept")
    assert out.columns == [*edge.columns, "n_lines", "n_kept"] and out.count() == edge.count()
    rows = {}
    for r in out.collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert rows[2][0].text is None and rows[3][0].text == "" and rows[4][0].text == " \n\t "
    assert rows[6][0].n_kept == 2 and rows[7][0].n_kept == 0 and rows[7][0].text == ""
    # rows equal in id and text are one document; the null id sorts first, so row 10's line is row 8's
    assert [r.text for r in rows[5]] == ["Repeated row."] * 2 and rows[10][0].n_kept == 0
    assert rows[None][0].n_kept == 1 or rows[None][1].n_kept == 1 or rows[None][2].n_kept == 1
    assert L.dedup_lines(none).count() == 0


def test_limits_side_by_side_agree_with_single_distances():
    rng, pairs = random.Random(8), [("", "", 0), ("", "ab", 2), ("", "ab", 1), ("abc", "", 5), ("a" * 200, "b" * 200, 199)]
    for _ in range(900):
        a = [rng.choice("ab cdé漢😀") for _ in range(rng.choice((1, 5, 63, 64, 65, 128, 129, 300, 700)))]
        b = list(a)
        for _ in range(rng.randint(0, len(a) // 3 + 1)):
            k = rng.randint(0, len(b))
            b[k:k + rng.randint(0, 1)] = rng.choices("abx ", k=rng.randint(0, 2))
        a, b = "".join(a), "".join(b)
        d = L.edit_distance(a, b)
        pairs.append((a, b, max(0, d + rng.randint(-2, 2) if rng.random() < 0.7 else rng.randint(0, len(a) + len(b)))))
    want = [L.edit_distance(a, b) <= limit for a, b, limit in pairs]
    assert 0.2 < sum(want) / len(want) < 0.8
    assert L.within_edits(pairs) == want and L.within_edits(pairs[:7]) == want[:7] and L.within_edits([]) == []


def test_forms_of_many_lines_are_those_of_each():
    rng = random.Random(2)
    for _ in range(2000):
        texts = [bytes(rng.choice(b"aB7 \t\r\n\x0b\x0c.,-\x1c\x85\xc3") for _ in range(rng.randint(0, 12))) for _ in range(3)]
        assert L.normal_lines(texts) == [L.normal_line(x) for t in texts for x in t.split(b"\n")]


@pytest.mark.parametrize("sent", [0, 1 << 20])
def test_keys_are_packed_by_parts_and_none_is_lost(llm, monkeypatch, sent):
    """Few rows for many keys, each key in one part; the same partners, whichever way a bucket goes."""
    monkeypatch.setattr(L, "PART_KEYS", 300)
    monkeypatch.setattr(L, "SENT_IDS", sent)
    rng = random.Random(4)
    rows = []
    for k in range(600):
        keys = [2 * rng.randint(0, 200) + kind for kind in (0, 0, 1) if rng.random() < 0.8] + [1000 + 2 * (k % 2)] * (k < 400)
        rows.append((k * 16, rng.choice((0, 7, 1 << 40, -1)), None if all(x % 2 == 0 for x in keys) else rng.choice((5, -2)), keys))
    found = llm.createDataFrame(rows, "k1 long, words long, triples long, keys array<long>").repartition(3)
    parts = found.mapInArrow(L._packed(6, None), "part long, rows binary").collect()
    whole = [(r.part, *x) for r in parts for x in np.frombuffer(bytes(r.rows), "<i8").reshape(-1, 3).tolist()]
    assert len(parts) <= 40 and sorted((key, k1) for _, key, _, k1 in whole) == sorted((key, k1) for k1, _, _, ks in rows for key in ks)
    assert len({(part, key) for part, key, _, _ in whole}) == len({key for _, key, _, _ in whole})
    buckets, want = {}, set()
    for k1, words, triples, keys in rows:
        for key in keys:
            buckets.setdefault(key, set()).add((k1, triples if key % 2 else words))
    for key, own in buckets.items():
        want |= {(key, *x) for x in own for y in own if x[0] != y[0] and ((x[1] ^ y[1]) & L._WHOLE).bit_count() <= 3}
    for cell_rows in (4096, 150):
        assert {tuple(r) for r in L.near_members(found, 3, cell_rows).collect()} == want


def test_lines_that_meet_in_many_buckets_are_verified_once(monkeypatch):
    import pyarrow as pa
    rng = random.Random(6)
    lines = ["".join(rng.choice("abcdef ") for _ in range(60)) for _ in range(4)]
    lines += [x[:-3] + "xyz" for x in lines]
    asked = []
    own = L.allowed_edits
    monkeypatch.setattr(L, "allowed_edits", lambda a, b, s: asked.append((a, b)) or own(a, b, s))
    rows = [(key, 0, 0, L.BOTH, k, -k, 0, x) for key in range(5) for k, x in enumerate(lines) if k != key + 2]
    rows += [(9, 0, 0, L.FIRST, 0, 0, 0, lines[0]), (9, 0, 0, L.BOTH, 3, -3, 0, lines[3]), (9, 0, 0, L.BOTH, 4, -4, 0, lines[4])]
    batch = pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names=list("abcdefgh"))
    for n in (1, 7, 100):
        found = [r for x in L._verify(64, 0.8)([batch.slice(s, n) for s in range(0, len(rows), n)]) for r in x.to_pylist()]
        links = sorted(tuple(sorted((r["a"]["k1"], r["b"]["k1"]))) for r in found if r["b"])
        assert links == [(0, 4), (0, 4), (1, 5), (2, 6), (3, 7)]
        assert [(r["key"], r["a"]["k1"]) for r in found if not r["b"]] == [(9, 3)]
    # of the joined buckets every pair once a run, and the pairs of the cell with a leading line
    assert len(asked) <= 3 * (28 + 3)
