"""Fuzzy line dedup over a whole corpus.

Lines are normalised (A-Z folded, digits as 0, ASCII punctuation as space) and
equal ones become one row, its first place kept. A line's features are its
distinct words, and for short lines or lines of few words its byte triples. The
features are dealt by their hash over blocks of about ``SHARE`` features each, and
every block is the SimHash of its own share: changing one word touches two
blocks at most, so of two lines that differ in k words all but 2k blocks are
equal. That is the pigeonhole join: lines that have an equal block of at least
``LEAST`` features are candidates if their whole SimHashes differ in ``max_bits``
or fewer (half of what unlike lines do). How many blocks a line has follows its
number of features on a scale of steps; near a step it has the blocks of both.

Candidates are verified by edit similarity, ``1 - distance / longer length`` over
the normalised characters, of at least ``similarity``; those that an alignment word by
word does not prove are computed many side by side. Of each connected group,
and of equal lines, the occurrence of the smallest (document id, text hash, line
number) stays; all others go. ``exhaustive=True`` takes all pairs of lines as
candidates instead, in cells, for recall tests and small corpora.

Nothing is closed over candidates: a pair is verified in a bucket that proposes
it, and only verified links reach the components. First the buckets are compared
by fingerprint alone, without texts; rows that have no near partner drop out, and
buckets of the same members become one. The texts of the rest are joined to them
once. A bucket of more than ``CELL`` lines is cut into pieces, each with the bucket's
first line: what is similar to that line is connected by it and needs no other
proof, so a group of n near copies costs about n verifications and rows; only the
lines that are not like it meet the other pieces.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.cells import BOTH, PROBE, SMALL_RUN, TABLE, cut_up, linked, small_runs
from ledgerlens.llm.common import cut, free_name, raw, spans
from ledgerlens.llm.components import components
from ledgerlens.llm.simhash import LANES
from ledgerlens.llm.words import hashed_words, mixed

_FOLD = bytes(32 if chr(b) in string.punctuation else 48 if 48 <= b <= 57 else b | 32 if 65 <= b <= 90 else b
              for b in range(256))
_SAMPLE = 16
#: Features a block, the fewest that a joined block may have, and the ratio of the steps of the number of blocks.
SHARE, LEAST, STEP, OVERLAP = 5, 4, 1.5, 0.35
#: Bits of the whole fingerprints that candidates may differ in.
MAX_BITS = 16
#: Lines of fewer bytes or fewer distinct words have byte triples as features too.
SHORT_BYTES, FEW_WORDS = 80, 10
#: Lines verified together.
CELL = 256
#: Characters of lines whose cells are verified side by side.
_AT_ONCE = 1 << 23
#: Pairs of joined buckets after which no more are joined.
_JOINED = 1 << 13
#: Lines that a task remembers so as not to fingerprint them again.
_REMEMBERED = 1 << 18
#: Keys of a part, on average, and of a packed batch.
PART_KEYS = 1 << 19
#: Rows of candidate ids that are sent to all tasks at most; more are shuffled.
SENT_IDS = 1 << 20
BLANKS = " \t\n\x0b\x0c\r"


def normal_line(line: bytes) -> bytes:
    """The form lines are compared in; empty for a blank line only."""
    return b" ".join(line.translate(_FOLD).split()) or b"\0".join(line.split())


_FOLD_LINES = bytes(10 if b == 10 else 32 if chr(b).isspace() and b < 128 and b not in range(28, 32) else x for b, x in enumerate(_FOLD))


def normal_lines(texts: list[bytes]) -> list[bytes]:
    """``normal_line`` of every line of the texts, one text after the other."""
    whole = b"\n".join(texts)
    data = np.frombuffer(whole.translate(_FOLD_LINES) + b"\n", np.uint8)
    space = data == 32
    # of a run of spaces its last stays, unless a line's end follows
    stays = ~(space[:-1] & (space | (data == 10))[1:])
    forms = data[:-1][stays].tobytes().replace(b"\n ", b"\n").removeprefix(b" ").split(b"\n")
    empty = [k for k, form in enumerate(forms) if not form]
    if empty:
        lines = whole.split(b"\n")
        for k in empty:
            forms[k] = normal_line(lines[k])
    return forms


def _ones(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(groups, 64): how many hashes of each group have bit b; a group holds at most 255 in all but made-up cases."""
    lanes = np.add.reduceat(LANES[hashes.astype("<u8").view(np.uint8).reshape(-1, 8)], first, axis=0)
    return lanes.astype("<u8").view(np.uint8)


def _bits(ones: np.ndarray, size: np.ndarray) -> np.ndarray:
    half = np.minimum(size // 2, np.iinfo(ones.dtype).max).astype(ones.dtype)
    return np.packbits(ones > half[:, None], axis=1, bitorder="little").view("<u8")[:, 0]


def _blocks(line: np.ndarray, features: np.ndarray, lines: int, salt: int):
    """((line, key) rows, (line, fingerprint) of the lines with features) of distinct (line, 40-bit feature) rows."""
    count = np.bincount(line, minlength=lines)
    place = np.log(np.maximum(count, 1) / SHARE) / np.log(STEP)
    low, high = (np.maximum(0, np.floor(place + x)).astype(np.int64) for x in (0, OVERLAP))
    rows, keys, whole = [], [], None
    for step, use in ((low, None), (high, high != low)):
        pick = slice(None) if use is None else use[line]
        own, hashed = line[pick], features[pick]
        if not len(own):
            continue
        parts = np.maximum(2, np.rint(STEP ** step)).astype(np.uint64)
        group = (mixed(hashed) >> np.uint64(32)) % parts[own]
        # a line's features in the order of their blocks; both fit 24 bits, as a span is under a megabyte or one line
        order = np.argsort(own.astype(np.uint64) << np.uint64(24) | group)
        own, hashed, group = own[order], hashed[order], group[order]
        new = np.append(True, (own[1:] != own[:-1]) | (group[1:] != group[:-1]))
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(own)))
        ones = _ones(mixed(hashed), first)
        at, of = own[first], group[first]
        if whole is None:
            starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            kind = np.uint16 if count.max() < 1 << 16 else np.int64
            sums = np.add.reduceat(ones.astype(kind), starts, axis=0, dtype=kind)
            whole = at[starts], _bits(sums, count[at[starts]])
        ok = size >= LEAST
        rows.append(at[ok])
        keys.append(mixed(_bits(ones[ok], size[ok]) ^ mixed(of[ok] << np.uint64(32) | parts[at[ok]] << np.uint64(2)
                                                            | np.uint64(salt))))
    none = np.empty(0, np.int64), np.empty(0, np.uint64)
    return (np.concatenate(rows), np.concatenate(keys)) if rows else none, whole or none


def _distinct(line: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows = np.sort(line.astype(np.uint64) << np.uint64(40) | feature)
    rows = rows[np.append(True, rows[1:] != rows[:-1])] if len(rows) else rows
    return (rows >> np.uint64(40)).astype(np.int64), rows & np.uint64((1 << 40) - 1)


def line_prints(forms: list[bytes]) -> tuple[list, list, list]:
    """For each normal form (none empty) of a span: (words' fingerprint or None, triples' or None, keys of both) as arrays.

    Returned as three parallel lists of (line numbers, values): fingerprints of words, of triples, and keys with
    the kind in their lowest bit.
    """
    words, triples, keys = [], [], []
    for s, e in spans([len(f) + 1 for f in forms], 1 << 18):
        data = np.frombuffer(b"\n".join(forms[s:e]) + b"\n", np.uint8)
        breaks = data == 10
        ends = np.flatnonzero(breaks)
        hashes, starts = hashed_words(data, breaks | (data == 32))
        line, feature = _distinct(np.searchsorted(ends, starts), mixed(hashes) >> np.uint64(24))
        (at, key), (own, fp) = _blocks(line, feature, e - s, 1)
        words.append((own + s, fp))
        keys.append((at + s, key & ~np.uint64(1)))
        size = np.diff(np.append(-1, ends))
        few = (size <= SHORT_BYTES) | (np.bincount(line, minlength=e - s) < FEW_WORDS)
        if few.any():
            pick = np.repeat(few, size)
            wide, breaks = data[pick].astype(np.uint64), breaks[pick]
            of = np.repeat(np.flatnonzero(few), size[few])
            inside = ~(breaks[:-2] | breaks[1:-1] | breaks[2:])
            code = (wide[:-2] << np.uint64(16) | wide[1:-1] << np.uint64(8) | wide[2:])[inside]
            (at, key), (own, fp) = _blocks(*_distinct(of[:-2][inside], mixed(code) >> np.uint64(24)), e - s, 2)
            triples.append((own + s, fp))
            keys.append((at + s, key | np.uint64(1)))
    return words, triples, keys


def edit_distance(a: str, b: str, limit: int | None = None) -> int:
    """Levenshtein distance by Myers' bit vectors, the common ends cut off first; may stop at any number over ``limit``."""
    n = _common(a, b)
    a, b = a[n:], b[n:]
    n = _common(a[::-1], b[::-1])
    a, b = a[:len(a) - n], b[:len(b) - n]
    if len(a) > len(b):
        a, b = b, a
    m = len(a)
    if not m:
        return len(b)
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    # a letter changes the score by one at most
    spare = (len(a) + len(b) if limit is None else limit) + len(b)
    for c in b:
        if score > spare:
            return score
        spare -= 1
        eq = masks.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq
        eq |= down
        more = down | (full & ~(across | up))
        less = up & across
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more = (more << 1 | 1) & full
        less = (less << 1) & full
        up = less | (full & ~(eq | more))
        down = more & eq
    return score


def within_edits(pairs: list[tuple[str, str, int]]) -> list[bool]:
    """Whether the Levenshtein distance of each (a, b, limit) is ``limit`` or less; pairs of like length side by side."""
    out = [False] * len(pairs)
    short: list[tuple[str, str, int, int]] = []
    for k, (a, b, limit) in enumerate(pairs):
        n = _common(a, b)
        a, b = a[n:], b[n:]
        n = _common(a[::-1], b[::-1])
        a, b = sorted((a[:len(a) - n], b[:len(b) - n]), key=len)
        # no more than the longer text's letters change
        limit = min(limit, len(b))
        if a and len(b) - len(a) <= limit:
            short.append((a, b, limit, k))
        else:
            out[k] = len(b) - len(a) <= limit and len(b) <= limit
    short.sort(key=lambda x: (-len(x[1]), x[3]))
    s = 0
    while s < len(short):
        # a band is as wide as its widest, so texts of like length go together
        size, e = len(short[s][1]), s + 1
        while e < len(short) and e - s < _SIDE_BY_SIDE and (3 * len(short[e][1]) > size or size < 64):
            e += 1
        part, s = short[s:e], e
        letters = set().union(*(x[0] for x in part), *(x[1] for x in part))
        if len(part) < _FEWEST or len(letters) * len(part) * len(part[0][1]) > _MASKS:
            found = [edit_distance(a, b, limit) <= limit for a, b, limit, _ in part]
        else:
            found = _side_by_side(part)
        for x, near in zip(part, found):
            out[x[3]] = bool(near)
    return out


#: Most pairs side by side, the fewest that are worth it, bits of all their letters' masks.
_SIDE_BY_SIDE, _FEWEST, _MASKS = 1 << 11, 24, 1 << 28


def _letters(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")


def _side_by_side(pairs: list[tuple]) -> np.ndarray:
    """``within_edits`` of (a, b, limit, ...), a not empty nor longer than b, the longest b first.

    Myers' bit vectors over a band that moves down a letter a step (Hyyro), for all pairs at once, words of 64 bits.
    What leaves the band costs more than any limit, and no score in it is too low.
    """
    m, n, limit = (np.array(x) for x in zip(*[(len(a), len(b), limit) for a, b, limit, *_ in pairs]))
    apart, count, steps = n - m, len(pairs), int(n[0])
    # rows of the band above and below the diagonal that starts in the corner
    above, below = int(((limit + apart) // 2).max()), int(((limit - apart) // 2).max())
    words, front = (above + below) // 64 + 1, -(-above // 64) * 64
    wide, long = (_letters([p[k] for p in pairs]) for k in range(2))
    there = np.zeros(int(max(wide.max(), long.max())) + 1, np.int64)
    there[wide] = there[long] = 1
    kinds, code = int(there.sum()), np.cumsum(there) - 1
    pair, place = _places(m)
    place += front
    masks = np.zeros(((steps + front) // 64 + words + 2, count * kinds), np.uint64)
    np.add.at(masks, (place >> 6, pair * kinds + code[wide]), np.uint64(1) << (place & 63).astype(np.uint64))
    pair, place = _places(n)
    rows = np.zeros((steps, count), np.int32)
    rows[place, pair] = pair * kinds + code[long]
    bit = lambda k: np.uint64(k % 64)
    up, down = np.zeros((words, count), np.uint64), np.zeros((words, count), np.uint64)
    up[above // 64:] = ~np.uint64(0)
    up[above // 64] <<= bit(above)
    one, top, corner = np.uint64(1), np.uint64(63), bit(above)
    equal = np.zeros(count, np.uint64)
    live = np.searchsorted(-n, -np.arange(steps), "left")
    for t, (row, k) in enumerate(zip(rows, live)):
        p, d = up[:, :k], down[:, :k]
        first = t - above + front
        eq = masks[first // 64:first // 64 + words + 1].take(row[:k], axis=1)
        if first % 64:
            high = eq[1:] << bit(64 - first % 64)
            eq = eq[:-1]
            eq >>= bit(first)
            eq |= high
        else:
            eq = eq[:-1]
        same = eq & p
        same += p
        if words > 1:
            over = same < p
            for w in range(1, words):
                same[w] += over[w - 1]
                over[w] |= over[w - 1] & (same[w] == 0)
        same ^= p
        same |= eq
        same |= d
        equal[:k] += same[above // 64] >> corner & one
        more = same | p
        np.invert(more, out=more)
        more |= d
        p &= same
        if words > 1:
            high = same[1:] << top
        same >>= one
        if words > 1:
            same[:-1] |= high
        np.bitwise_and(same, more, out=d)
        same |= more
        np.invert(same, out=same)
        p |= same
    # from the diagonal up to the first text's last letter
    score = n - equal.astype(np.int64)
    for w in range(words):
        low, high = (np.clip(x - 64 * w, 0, 64) for x in (above - apart, above))
        own = _below(high) & ~_below(low)
        score -= np.bitwise_count(up[w] & own).astype(np.int64) - np.bitwise_count(down[w] & own)
    return score <= limit


def _below(bits) -> np.ndarray:
    """The lowest ``bits`` bits, 64 at most."""
    bits = np.asarray(bits).astype(np.uint64)
    return np.where(bits < 64, (np.uint64(1) << (bits & np.uint64(63))) - np.uint64(1), ~np.uint64(0))


def _places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of each letter of texts one after the other."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    return text, np.arange(len(text)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _common(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def edited_words(a: str, b: str, limit: int) -> bool:
    """Whether an alignment word by word, found greedily, turns ``a`` into ``b`` in at most ``limit`` edits.

    True proves the distance; False says nothing.
    """
    x, y = a.split(" "), b.split(" ")
    m, n = len(x), len(y)
    # past the ends stand things that equal nothing
    x += _PAST[0]
    y += _PAST[1]
    i = j = spent = 0
    while True:
        while x[i] == y[j]:
            i += 1
            j += 1
        if i >= m or j >= n:
            break
        for p, q in _SKIPS:
            if x[i + p] == y[j + q]:
                break
        else:
            p = q = 1
        spent += max(sum(map(len, x[i:i + p])) + p, sum(map(len, y[j:j + q])) + q) - (1 if p and q else 0)
        if spent > limit:
            return False
        i, j = i + p, j + q
    return spent + sum(map(len, x[i:m])) + m - i + sum(map(len, y[j:n])) + n - j <= limit


_PAST = [0] * 4, [1] * 4
#: Words left out on either side up to the next equal pair, fewest first.
_SKIPS = sorted(((p, q) for p in range(4) for q in range(4) if p or q), key=lambda s: (s[0] + s[1], abs(s[0] - s[1])))


def allowed_edits(a: str, b: str, similarity: float) -> int:
    """How many edits two lines may differ in; -1 if their lengths alone are too far apart."""
    allowed = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    return allowed if abs(len(a) - len(b)) <= allowed else -1


def similar(a: str, b: str, similarity: float) -> bool:
    allowed = allowed_edits(a, b, similarity)
    return allowed >= 0 and (edited_words(a, b, allowed) or edit_distance(a, b, allowed) <= allowed)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                       F.col(text_col).cast("string").alias("text"))


OCCURRENCE = "text_hash long, line_no int, of int, k1 long, k2 long, line string, words long, triples long, keys array<long>"


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, line_no, of, k1, k2, line, words, triples, keys) of each line with a word.

    of: how many such lines its text has; k1, k2: 128-bit hash of the normal form ``line``; words, triples: fingerprints,
    null where a line has none of the kind; keys: of its blocks, odd for triples.
    Fingerprints and keys are given where a line stands first among the lines that the
    task remembers, so a line of very many places has them about once a task.
    """
    def spread(parts, n):
        """One value a line, null where there is none."""
        values, there = np.zeros(n, np.uint64), np.zeros(n, bool)
        for at, fp in parts:
            values[at], there[at] = fp, True
        return pa.array(values.view(np.int64), mask=~there)

    def listed(parts, n):
        at = np.concatenate([a for a, _ in parts]) if parts else np.empty(0, np.int64)
        key = np.concatenate([k for _, k in parts]) if parts else np.empty(0, np.uint64)
        order = np.argsort(at, kind="stable")
        offsets = np.searchsorted(at[order], np.arange(n + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(key[order].view(np.int64)))

    def run(batches):
        met: set[bytes] = set()
        for batch in batches:
            texts = raw(batch.column(2))
            for s, e in spans([len(t) for t in texts], 1 << 20):
                part = texts[s:e]
                forms = normal_lines(part)
                count = np.array([t.count(b"\n") + 1 for t in part])
                there = np.array([bool(f) for f in forms])
                text, numbers = (x[there] for x in _places(count))
                of = np.bincount(text, minlength=e - s)[text]
                forms = [f for f in forms if f]
                digests = [xxhash.xxh3_128_digest(f) for f in forms]
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                at = pa.array(text + s, pa.int64())
                if len(met) > _REMEMBERED:
                    met.clear()
                new = np.array([k for k, d in enumerate(digests) if d not in met and not met.add(d)], np.int64)
                words, triples, keys = ([(new[own], x) for own, x in part] for part in line_prints([forms[k] for k in new]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(numbers, pa.int32()),
                     pa.array(of, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(forms, pa.binary()).cast(pa.string()),
                     spread(words, len(forms)), spread(triples, len(forms)), listed(keys, len(forms))],
                    ["doc_id", "text_hash", "line_no", "of", "k1", "k2", "line", "words", "triples", "keys"])
    kind = docs.schema[id_col].dataType.simpleString()
    return _keyed(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, {OCCURRENCE}")


def _near_rows(max_bits: int, at_once: int = 1 << 17):
    """Arrow function over (key, fp, k1[, cell, role]) sorted by (key[, cell, role]): rows with a partner in their cell.

    Rows of the same k1 are one line, not partners.
    """
    def run(batches):
        held, size = [], 0
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held.append(cols if len(cols) == 5 else [*cols, *np.zeros((2, batch.num_rows), np.int64)])
            size += batch.num_rows
            if size < at_once:
                continue
            cols = [np.concatenate(x) for x in zip(*held)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[3] != cols[3][-1]))
            last = int(last[-1]) + 1 if len(last) else 0
            if last:
                yield from _partners([x[:last] for x in cols], max_bits)
            held, size = [[x[last:] for x in cols]], len(cols[0]) - last
        if size:
            yield from _partners([np.concatenate(x) for x in zip(*held)], max_bits)
    return run


def _partners(cols: list[np.ndarray], max_bits: int):
    """Rows (key, k1, fp) of whole buckets, (key, fp, k1, cell, role) in their order, that have a partner in their cell."""
    key, fp, k1, cell, role = cols
    new = np.append(True, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1]))
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(key)))
    many = np.repeat(sizes > 1, sizes)
    key, role, k1, run_ = key[many], role[many], k1[many], np.repeat(np.arange(len(starts)), sizes)[many]
    fp = fp[many].astype(np.int64).view(np.uint64)
    hit = np.zeros(len(key), bool)
    sizes = sizes[sizes > 1]
    starts = np.cumsum(sizes) - sizes
    small = np.flatnonzero(np.repeat(sizes <= SMALL_RUN, sizes))
    i, j = small_runs(fp[small], run_[small], role[small], max_bits, SMALL_RUN)
    other = k1[small[i]] != k1[small[j]]
    hit[small[i[other]]] = hit[small[j[other]]] = True
    for r in np.flatnonzero(sizes > SMALL_RUN):
        own = np.arange(starts[r], starts[r] + sizes[r])
        for i, j in linked(fp, own[role[own] != PROBE], own[role[own] != TABLE], max_bits):
            other = k1[i] != k1[j]
            hit[i[other]] = hit[j[other]] = True
    if hit.any():
        yield pa.RecordBatch.from_arrays([pa.array(key[hit]), pa.array(k1[hit]), pa.array(fp[hit].view(np.int64))],
                                         ["key", "k1", "fp"])


def _packed(parts: int, hot: np.ndarray | None):
    """Arrow function: the keys of lines (k1, words, triples, keys), those of ``hot`` (sorted) left out, as rows (part, rows).

    All of a key's lines are in one part; rows: (key, fp, k1) of many lines of the part, as bytes.
    """
    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch.column(3).flatten())
            if size >= PART_KEYS:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    def packed(held):
        table = pa.Table.from_batches(held).combine_chunks()
        k1, words, triples, keys = (table.column(k).combine_chunks() for k in range(4))
        number = lambda x: x.fill_null(0).to_numpy(zero_copy_only=False)
        line = np.repeat(np.arange(len(keys)), number(keys.value_lengths()))
        key = keys.flatten().to_numpy(zero_copy_only=False)
        if hot is not None:
            cold = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] != key
            key, line = key[cold], line[cold]
        rows = np.stack([key, np.where(key & 1, number(triples)[line], number(words)[line]), number(k1)[line]], axis=1)
        part = (key.view(np.uint64) >> np.uint64(16)) % np.uint64(parts)
        order = np.argsort(part)
        ids, first = np.unique(part[order], return_index=True)
        offsets = np.append(first, len(part)).astype(np.int32) * 24
        data = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(rows[order])])
        return pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), data], ["part", "rows"])
    return run


def _near_packed(max_bits: int, at_once: int = 1 << 17):
    """Arrow function over (part, rows) of ``_packed`` sorted by part: rows with a partner in their bucket."""
    def run(batches):
        place, held = None, []
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != place:
                    yield from found(held)
                    place, held = part, []
                held.append(data)
        yield from found(held)

    def found(held):
        if not held:
            return
        rows = np.frombuffer(b"".join(held), "<i8").reshape(-1, 3)
        order = np.argsort(rows[:, 0])
        key = rows[order, 0]
        again = np.append(False, key[1:] == key[:-1])
        # lines alone in their bucket go at once
        many = again | np.append(again[1:], False)
        order, key = order[many], key[many]
        s = 0
        while s < len(key):
            e = int(np.searchsorted(key, key[min(s + at_once, len(key)) - 1], "right"))
            none = np.zeros(e - s, np.int64)
            yield from _partners([key[s:e], rows[order[s:e], 1], rows[order[s:e], 2], none, none], max_bits)
            s = e
    return run


def near_members(found: DataFrame, max_bits: int, cell_rows: int = 4096) -> DataFrame:
    """(key, k1, fp): lines of each bucket that have another line at ``max_bits`` or fewer in it, each once.

    Most buckets are one line, so rows of many keys are packed and go by parts; buckets of very many lines go by cells.
    """
    even = F.col("key").bitwiseAND(F.lit(1)) == 0
    rows = (found.select("k1", "words", "triples", F.explode("keys").alias("key"))
            .select("key", F.when(even, F.col("words")).otherwise(F.col("triples")).alias("fp"), F.lit(BOTH).alias("role"), "k1"))
    # How a hot key is cut does not change the result, so its size may be estimated from some lines.
    heavy = (rows.where(F.pmod("k1", F.lit(_SAMPLE)) == 0).groupBy("key").count()
             .where(F.col("count") * _SAMPLE > cell_rows)
             .select("key", F.ceil(F.col("count") * _SAMPLE / cell_rows).alias("ways")))
    heavy = cut(heavy, "heavy")
    number = heavy.count()
    near = []
    if number:
        some = rows if number > SENT_IDS else rows.join(F.broadcast(heavy.select("key")), "key", "left_semi")
        cells = (cut_up(some, heavy, "k1").select("key", "fp", "k1", "cell", "role")
                 .repartition("key", "cell").sortWithinPartitions("key", "cell", "role"))
        near.append(cells.mapInArrow(_near_rows(max_bits), NEAR))
    if number <= SENT_IDS:
        hot = np.sort(heavy.select("key").toArrow()["key"].to_numpy()) if number else None
        keys = found.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0)).alias("n")).first()["n"]
        parts = (found.where(F.size("keys") > 0).select("k1", "words", "triples", "keys")
                 .mapInArrow(_packed(keys // PART_KEYS + 1, hot), "part long, rows binary"))
        near.append(parts.repartition("part").sortWithinPartitions("part").mapInArrow(_near_packed(max_bits), NEAR))
    near = near[0] if len(near) == 1 else near[0].unionByName(near[1])
    return cut(near.distinct(), "line-buckets")


NEAR = "key long, k1 long, fp long"


def _pieces(members: DataFrame) -> DataFrame:
    """``members(key, k1, fp)`` of the buckets to verify, with (n, first) of their bucket: buckets of the same members stand once."""
    digest = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "k1"))
    buckets = members.groupBy("key").agg(F.count("*").alias("n"), F.min("k1").alias("first"),
                                         digest(1).alias("x1"), digest(2).alias("x2"))
    even = F.col("key").bitwiseAND(F.lit(1)).alias("kind")
    one = buckets.groupBy("n", "x1", "x2", even).agg(F.min("key").alias("key"), F.min("first").alias("first"))
    return members.join(one.select("key", "n", "first"), "key")


def _verify(max_bits: int, similarity: float):
    """Arrow function over rows (key, cell, part, role, k1, k2, fp, line) sorted by (key, cell, role).

    Yields verified links a, b, a forest for each cell, and, where a bucket has
    several pieces, its lines that its first line is not connected to (``key`` set, b null).
    """
    def run(batches):
        held: list[tuple] = []
        cells: list[tuple] = []
        met: dict = {}
        place, size = None, 0
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(8)]):
                if row[:2] != place:
                    met = add(cells, held, met)
                    if size > _AT_ONCE:
                        yield from settled(cells)
                        cells, met, size = [], {}, 0
                    held, place = [], row[:2]
                held.append(row)
                size += len(row[7]) + 64
        add(cells, held, met)
        yield from settled(cells)

    def add(cells, rows, met):
        """Adds (rows, their labels, the pairs to verify) of a cell; a bucket in one piece joins the one before it with its first line.

        So lines that meet in many buckets are verified once. ``met`` and the value: places of the joined buckets' lines.
        """
        n = len(rows)
        if n < 2:
            return met
        if rows[0][3] == BOTH:
            if rows[0][4:6] not in met or len(cells[-1][2]) > _JOINED:
                met = {}
                cells.append(([], [], []))
            lines, label, pairs = cells[-1]
            at = []
            for row in rows:
                k = met.setdefault(row[4:6], len(met))
                if k == len(lines):
                    lines.append(row)
                    label.append(k)
                at.append(k)
            prints = [r[6] & _WHOLE for r in rows]
            seen = set(pairs)
            for i, own in enumerate(prints):
                a = at[i]
                for j in range(i + 1, n):
                    if (own ^ prints[j]).bit_count() <= max_bits:
                        b = at[j]
                        pair = (a, b) if a < b else (b, a)
                        if pair not in seen:
                            seen.add(pair)
                            pairs.append(pair)
            return met
        prints = [r[6] & _WHOLE for r in rows]
        probes = [k for k in range(n) if rows[k][3] == PROBE]
        pairs = []
        for i, row in enumerate(rows):
            if row[3] == PROBE:
                break
            own = prints[i]
            pairs += [(i, j) for j in (probes if row[3] == TABLE else range(i + 1, n))
                      if (own ^ prints[j]).bit_count() <= max_bits]
        cells.append((rows, list(range(n)), pairs))
        return {}

    def settled(cells):
        """Verifies in turns: first the pairs that those before them would not connect if they were all similar.

        Of the others, which are left out where the first ones were, a turn takes more than the one before it.
        """
        links, apart = [], []
        work, turn = [cell for cell in cells if cell[2]], 0
        while work:
            asked, left = [], []
            for rows, label, pairs in work:
                guess, rest, spare = label[:], [], turn * len(rows)
                for i, j in pairs:
                    if label[i] == label[j]:
                        continue
                    if guess[i] == guess[j]:
                        spare -= 1
                        if spare < 0:
                            rest.append((i, j))
                            continue
                    a, b = rows[i][7], rows[j][7]
                    allowed = allowed_edits(a, b, similarity)
                    if allowed < 0:
                        continue
                    if edited_words(a, b, allowed):
                        unite(label, i, j)
                    else:
                        asked.append((label, i, j, (a, b, allowed)))
                    unite(guess, i, j)
                if rest:
                    left.append((rows, label, rest))
            for (label, i, j, _), near in zip(asked, within_edits([x[3] for x in asked])):
                if near:
                    unite(label, i, j)
            work, turn = left, 2 * turn + 1
        for rows, label, _ in cells:
            links += [(rows[k][4:6], rows[x][4:6]) for k, x in enumerate(label) if x != k]
            if rows[0][3] == FIRST:
                apart += [(r[0], r[4:6]) for r, x in zip(rows, label) if x]
        if links or apart:
            yield found(links, apart)

    def unite(label, i, j):
        low, high = sorted((label[i], label[j]))
        if low != high:
            label[:] = [low if x == high else x for x in label]

    def found(links, apart):
        node = lambda ids: pa.StructArray.from_arrays(
            [pa.array([x for x, _ in ids], pa.int64()), pa.array([y for _, y in ids], pa.int64())], ["k1", "k2"])
        linked_to = pa.concat_arrays([node([b for _, b in links]), pa.nulls(len(apart), LINK)])
        key = pa.concat_arrays([pa.nulls(len(links), pa.int64()), pa.array([k for k, _ in apart], pa.int64())])
        return pa.RecordBatch.from_arrays([key, node([a for a, _ in links] + [a for _, a in apart]), linked_to], ["key", "a", "b"])
    return run


_WHOLE = (1 << 64) - 1
FIRST = -1
LINK = pa.struct([("k1", pa.int64()), ("k2", pa.int64())])
LINKS = "key long, a struct<k1:long,k2:long>, b struct<k1:long,k2:long>"


def verified_links(found: DataFrame, max_bits: int, similarity: float, cell: int = CELL) -> DataFrame:
    """Edges (a, b) between line keys (struct k1, k2) whose components are those of all verified links of ``occurrences``."""
    members = cut(_pieces(near_members(found, max_bits)), "line-members")
    ids = cut(members.select(F.col("k1").alias("id")).distinct(), "line-ids")
    # an id is 8 bytes: few enough go to all tasks, more are joined by a shuffle
    few = F.broadcast(ids) if ids.count() <= SENT_IDS else ids
    texts = (found.select("k1", "k2", "line").join(few, F.col("k1") == F.col("id"), "left_semi")
             .groupBy("k1", "k2").agg(F.first("line").alias("line")))
    pieces = F.ceil(F.col("n") / cell)
    rows = cut(members.join(texts, "k1").withColumn("pieces", pieces)
               .withColumn("piece", F.pmod(F.xxhash64("k1", "k2"), "pieces")), "line-texts")
    several = F.col("pieces") > 1
    every = F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)
    leads = several & (F.col("k1") == F.col("first"))
    dealt = (rows.withColumn("cell", F.explode(F.when(leads, every).otherwise(F.array("piece"))))
             .select("key", "cell", "piece", F.when(leads, FIRST).otherwise(BOTH).alias("role"), "k1", "k2", "fp", "line",
                     F.when(several, F.col("key")).otherwise(F.col("first")).alias("by")))
    verify = _verify(max_bits, similarity)
    # buckets in one piece that share their first line share most others, and go together
    links = cut(dealt.repartition("by", "cell").sortWithinPartitions("by", "key", "cell", "role", "k1", "k2").drop("by")
                .mapInArrow(verify, LINKS), "line-links")
    edges = links.where("key IS NULL").select("a", "b")
    apart = links.where("key IS NOT NULL").select("key", "a.k1", "a.k2").distinct()
    if apart.isEmpty():
        return edges
    # lines unlike their bucket's first one meet all other pieces, in cells of a chunk of them and one piece
    sizes = apart.groupBy("key").agg(F.ceil(F.count("*") / cell).alias("chunks"))
    asking = (rows.join(apart, ["key", "k1", "k2"]).join(sizes, "key")
              .withColumn("other", F.explode(every)).where("other <> piece")
              .withColumn("cell", F.col("other") * F.col("chunks") + F.pmod(F.xxhash64("k2", "k1"), "chunks"))
              .withColumn("role", F.lit(PROBE)))
    asked = (rows.join(sizes, "key")
             .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
             .withColumn("cell", F.col("piece") * F.col("chunks") + F.col("chunk")).withColumn("role", F.lit(TABLE)))
    names = ("key", "cell", "piece", "role", "k1", "k2", "fp", "line")
    more = (asking.select(*names).unionByName(asked.select(*names)).repartition("key", "cell")
            .sortWithinPartitions("key", "cell", "role", "k1", "k2").mapInArrow(verify, LINKS))
    return edges.unionByName(more.select("a", "b"))


def exhaustive_links(found: DataFrame, similarity: float, cell: int = CELL) -> DataFrame:
    """Verified links of all pairs of lines, whatever their fingerprints: every chunk of lines meets every other."""
    texts = cut(found.groupBy("k1", "k2").agg(F.first("line").alias("line")), "line-texts")
    chunks = max(1, -(-texts.count() // cell))
    span = F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))
    own = F.pmod(F.xxhash64("k1", "k2"), F.lit(chunks).cast("long"))
    place = lambda i, j, role: F.struct((i * chunks + j).alias("cell"), F.lit(role).alias("role"))
    cells = F.transform(span, lambda y: F.when(y < own, place(y, own, PROBE)).when(y > own, place(own, y, TABLE))
                        .otherwise(place(own, own, BOTH)))
    rows = texts.withColumn("p", F.explode(cells)).select(
        F.lit(0).cast("long").alias("key"), "p.cell", F.lit(0).cast("long").alias("piece"), "p.role", "k1", "k2",
        F.lit(0).cast("long").alias("fp"), "line")
    return (rows.repartition("key", "cell").sortWithinPartitions("key", "cell", "role")
            .mapInArrow(_verify(64, similarity), LINKS).select("a", "b"))


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS,
               similarity: float = 0.8, exhaustive: bool = False) -> DataFrame:
    """(doc_id, text_hash, of, stay, kept) of each document that keeps any of its ``of`` lines with a word.

    stay: how many it keeps; kept: their numbers, null if all stay.
    """
    place = F.struct("doc_id", "text_hash", "line_no", "of")
    found = cut(occurrences(docs, id_col, text_col), "occurrences")
    lines = cut(found.groupBy("k1", "k2").agg(F.min(place).alias("at")).select("k1", "k2", "at.*"), "lines")
    closed = components(exhaustive_links(found, similarity) if exhaustive else verified_links(found, max_bits, similarity))
    member = (closed.select("node.k1", "node.k2", "root").join(lines, ["k1", "k2"])
              .select("root", place.alias("at"), "k1", "k2"))
    member = cut(member, "line-groups")
    # joined by place, of which each stands once, not by the group, which may be large
    best = member.groupBy("root").agg(F.min("at").alias("b")).select(*[F.col(f"b.{c}").alias(f"best_{c}") for c in (
        "doc_id", "text_hash", "line_no")])
    first = (F.col("at.doc_id").eqNullSafe(F.col("best_doc_id")) & (F.col("at.text_hash") == F.col("best_text_hash"))
             & (F.col("at.line_no") == F.col("best_line_no")))
    gone = member.join(best, first, "left_anti").select("k1", "k2")
    by_text = (lines.join(gone, ["k1", "k2"], "left_anti").groupBy("doc_id", "text_hash")
               .agg(F.max("of").alias("of"), F.count("*").cast("int").alias("stay"), F.collect_list("line_no").alias("kept")))
    return by_text.withColumn("kept", F.when(F.col("stay") < F.col("of"), F.col("kept")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS,
                similarity: float = 0.8, lines_col: str | None = None, kept_col: str | None = None,
                exhaustive: bool = False) -> DataFrame:
    """``docs`` with the lines removed that a smaller place has already, all columns and rows kept.

    Lines are parts between ``\\n``; one without a word is no duplicate and
    stays. A null text stays null; a text whose lines are all elsewhere is left
    with its blank lines only. Rows equal in id and text count as one document
    and are rewritten alike. ``lines_col`` and ``kept_col`` name counts to add,
    of lines with a word before and after. A line of so few features that it has no
    block of ``LEAST`` is compared for equality only, unless ``exhaustive``.
    """
    mark, kept, of, stay, part, blank = (free_name(docs, n) for n in ("text_hash", "kept", "of", "stay", "parts", "blanks"))
    found = kept_lines(docs, id_col, text_col, max_bits, similarity, exhaustive).select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), F.col("of").alias("_o"), F.col("stay").alias("_s"),
        F.col("kept").alias("_k"))
    rows = docs.withColumn(mark, F.xxhash64(text_col)).alias("rows")
    match = F.col(f"rows.{id_col}").eqNullSafe(F.col("_d")) & (F.col(f"rows.{mark}") == F.col("_h"))
    joined = rows.join(found, match, "left").select("rows.*", F.col("_o").alias(of), F.col("_s").alias(stay), F.col("_k").alias(kept))
    text = F.col(text_col).cast("string")
    whole = F.coalesce(F.col(of) == F.col(stay), F.lit(False))
    # a text that loses nothing is not even split; the parts are a column, as an expression would be made anew for every line
    split = joined.withColumn(part, F.when(~whole, F.split(text, "\n", -1)))
    split = split.withColumn(blank, F.filter(F.transform(part, lambda line, i: F.when(F.ltrim(line, F.lit(BLANKS)) == "", i)),
                                             lambda i: i.isNotNull()))
    stays = F.coalesce(F.col(kept), F.array().cast("array<int>"))
    # the lines are picked by their sorted numbers, which stays cheap for a text of very many lines
    picked = F.array_join(F.transform(F.array_sort(F.concat(stays, blank)), lambda i: F.get(part, i)), "\n")
    more = {text_col: F.when(whole, text).otherwise(picked)}
    if lines_col:
        more[lines_col] = F.coalesce(F.col(of), F.size(part) - F.size(blank), F.lit(0)).cast("long")
    if kept_col:
        more[kept_col] = F.coalesce(stay, F.lit(0)).cast("long")
    return split.withColumns(more).drop(mark, kept, of, stay, part, blank)
