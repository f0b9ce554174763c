"""Language of whole texts by interpolated Kneser-Ney character models.

A text becomes its folded letters (case folded, marks kept, every run of other
characters one gap). Of each language a model of four letters is estimated:
absolute discounting, interpolated with the model of one letter less, whose counts
are the numbers of different letters that precede a string (continuation
counts), down to a uniform share for letters never seen. All training texts count.

Estimation is joins and aggregates over a table of (language, string, count): four
letters of 16 bits are one long, its history the upper, its suffix the lower
three. The finished log-probabilities and back-off weights are stored by a hash
of the string, sorted, with one column a language. The hash has as few bits as
keep the whole store under ``STORE_BYTES`` however many strings there are; of
strings that meet in one slot the likelier one's value stands. So the broadcast
has a bound that does not grow with the corpus, and nothing is cut off.

A text gets the language of the lowest cross-entropy, in bits a letter. One
fold of the training rows calibrates: a second estimate without them scores
them, from which come the share of right answers at each lead of the best
language over the next (the score, made monotone) and, for each language and
length, the cross-entropy that all but ``REJECT`` of its own texts stay under.
Texts above it are not accepted: their language is probably none of the learned.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import cut, raw, remainder, spans
from ledgerlens.llm.words import mixed

ORDER = 4
GAP = 32
NONE = "und"
#: Bound of the store of one model, and of how many languages one may learn.
STORE_BYTES, MOST_LANGUAGES = 1 << 29, 1000
#: Share of a language's own texts that may be rejected.
REJECT = 0.001
_STRETCH = 1 << 20
_HELD_STRINGS = 1 << 21


@cache
def _folds() -> tuple[np.ndarray, np.ndarray]:
    """(code, is a letter) of every code point; code ``GAP`` is no letter or mark."""
    codes, letter = np.full(0x110000, GAP, np.uint16), np.zeros(0x110000, bool)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha() or unicodedata.category(c)[0] == "M":
            low = ord(c.lower()[0])
            # beyond 16 bits letters share codes; no code is the gap's
            codes[point] = low if low < 1 << 16 else 4096 + low % 61440
            letter[point] = c.isalpha()
    return codes, letter


def _stretches(text: bytes) -> list[bytes]:
    """The text in parts of about a megabyte, cut at white space or else between characters."""
    out, at = [], 0
    while len(text) - at > _STRETCH:
        end = at + _STRETCH
        space = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
        if space > at:
            end = space
        else:
            while text[end] & 0xC0 == 0x80:
                end -= 1
        out.append(text[at:end])
        at = end
    return [*out, text[at:]]


def strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(strings of four letters as uint64, their text, whether each text has a letter).

    Every letter or gap of a text ends one string; before a text's first letter stand gaps.
    """
    codes_of, letter = _folds()
    decoded = [t.decode("utf-8", "replace") + " " for t in texts]
    points = np.frombuffer("".join(decoded).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(texts)), [len(d) for d in decoded])
    has = np.bincount(owner, letter[points], len(texts)) > 0
    codes = codes_of[points]
    # a gap is kept after a letter only; a text's last code is a gap, so the next one starts without
    keep = codes != GAP
    keep[1:] |= codes[:-1] != GAP
    codes, owner = codes[keep].astype(np.uint64), owner[keep]
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.empty(0, int)
    out = codes.copy()
    for back in range(1, ORDER):
        before = np.full(len(codes), GAP, np.uint64)
        before[back:] = codes[:-back]
        for k in range(back):
            at = starts + k
            before[at[at < len(codes)]] = GAP
        out |= before << np.uint64(16 * back)
    return out, owner, has


def _spans(texts: list[bytes]):
    """(texts from, to, strings, owner, has) in bounded pieces; the owner is a text's number, ``has`` is by text."""
    parts, owners = [], []
    for i, t in enumerate(texts):
        for p in _stretches(t):
            parts.append(p)
            owners.append(i)
    at = np.array(owners)
    for s, e in spans([len(p) for p in parts], _STRETCH):
        found, owner, has = strings(parts[s:e])
        yield found, at[s:e][owner], at[s:e][has]


def count_strings(rows: DataFrame, languages: list[str]) -> DataFrame:
    """(m, g, c) of ``rows(lang, calibrates, text)``; m is twice the language's number, plus one if it calibrates."""
    number = {name: i for i, name in enumerate(languages)}

    def run(batches):
        held: dict[int, list] = {}
        size = 0
        for batch in batches:
            models = np.array([2 * number[name] + c for name, c in zip(batch.column(0).to_pylist(),
                                                                       batch.column(1).to_pylist())], np.int64)
            for found, owner, _ in _spans(raw(batch.column(2))):
                of = models[owner]
                for m in np.unique(of):
                    codes, values = pd.factorize(found[of == m])
                    held.setdefault(int(m), []).append((values, np.bincount(codes, minlength=len(values))))
                    size += len(values)
                if size > _HELD_STRINGS:
                    held = {m: [_sum(x)] for m, x in held.items()}
                    size = sum(len(x[0][0]) for x in held.values())
                    if size > _HELD_STRINGS // 2:
                        yield from emit(held)
                        held, size = {}, 0
        yield from emit({m: [_sum(x)] for m, x in held.items()})

    def emit(held):
        for m, [(values, counts)] in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), m, np.int32)),
                                              pa.array(values.view(np.int64)), pa.array(counts)], ["m", "g", "c"])
    return (rows.select("lang", "calibrates", "text").mapInArrow(run, "m int, g long, c long")
            .groupBy("m", "g").agg(F.sum("c").alias("c")))


def _sum(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, values = pd.factorize(np.concatenate([v for v, _ in parts]))
    return values, np.bincount(codes, np.concatenate([c for _, c in parts]), len(values)).astype(np.int64)


def estimate(counts: DataFrame) -> DataFrame:
    """(k, n, weight, g, value) of ``counts(k, g, c)``: log2 probabilities of strings of n letters, and back-off weights.

    ``weight`` rows are of histories: what a letter not seen after them takes its
    shorter probability times. k names the model.
    """
    tables = {ORDER: cut(counts.select("k", "g", "c"), f"letters-{ORDER}")}
    for n in range(ORDER - 1, 0, -1):
        tables[n] = cut(tables[n + 1].groupBy("k", F.col("g").bitwiseAND(F.lit((1 << 16 * n) - 1)).alias("g"))
                        .agg(F.count("*").alias("c")), f"letters-{n}")
    letters = tables[1].agg(F.count_distinct("g").alias("n")).first()["n"] + 1
    out, lower = [], None
    for n in range(1, ORDER + 1):
        once, twice = F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1))
        # the discount n1 / (n1 + 2 n2), kept off its ends where there are few counts; one row a model
        discount = tables[n].groupBy("k").agg(F.greatest(F.lit(0.1), F.least(F.lit(0.9), F.coalesce(
            F.try_divide(once, once + 2 * twice), F.lit(0.5)))).alias("d"))
        rows = tables[n].withColumn("h", F.shiftrightunsigned("g", 16))
        histories = rows.groupBy("k", "h").agg(F.sum("c").alias("whole"), F.count("*").alias("kinds")).join(
            discount, "k").select("k", "h", "whole", "d", (F.col("d") * F.col("kinds") / F.col("whole")).alias("w"))
        rows = rows.join(histories, ["k", "h"])
        if lower is None:
            below = F.lit(1.0 / letters)
        else:
            rows = rows.withColumn("s", F.col("g").bitwiseAND(F.lit((1 << 16 * (n - 1)) - 1))).join(
                lower.select("k", F.col("g").alias("s"), F.col("p").alias("below")), ["k", "s"])
            below = F.col("below")
        lower = cut(rows.select("k", "g", ((F.col("c") - F.col("d")) / F.col("whole") + F.col("w") * below).alias("p")),
                    f"letters-{n}-probabilities")
        out.append(lower.select("k", F.lit(n).alias("n"), F.lit(False).alias("weight"), "g", F.log2("p").alias("value")))
        weight = F.col("w") if n > 1 else F.col("w") / letters
        out.append(histories.select("k", F.lit(n).alias("n"), F.lit(True).alias("weight"), F.col("h").alias("g"),
                                    F.log2(weight).alias("value")))
    return reduce(DataFrame.unionByName, out)


def slot_bits(languages: int) -> int:
    """Bits of a slot: at most 2 * ORDER tables of 2^bits rows, each a slot and a float for every language."""
    return int(np.log2(STORE_BYTES / (2 * ORDER * (4 + 4 * max(1, languages)))))


def _slots(g: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(g.astype(np.uint64) + np.uint64(1)) >> np.uint64(64 - bits)).astype(np.uint32)


@dataclass
class Models:
    """Sorted hash arrays: for n letters, and for the histories of their last, (slots, values (slots, languages))."""

    languages: list[str]
    bits: int
    chance: list[tuple[np.ndarray, np.ndarray]]
    weight: list[tuple[np.ndarray, np.ndarray]]

    def _find(self, table, g: np.ndarray) -> np.ndarray:
        """(strings, languages) values; NaN where a language has not seen the string."""
        keys, values = table
        if not len(keys):
            return np.full((len(g), len(self.languages)), np.nan, np.float32)
        slots = _slots(g, self.bits)
        at = np.minimum(np.searchsorted(keys, slots), len(keys) - 1)
        out = values[at]
        out[keys[at] != slots] = np.nan
        return out

    def log_chances(self, g: np.ndarray) -> np.ndarray:
        """(strings, languages): log2 probability of each string's last letter after the others."""
        low = self._find(self.weight[0], np.zeros(len(g), np.uint64))
        for n in range(1, ORDER + 1):
            own = g & np.uint64((1 << 16 * n) - 1)
            if n > 1:
                low = low + np.nan_to_num(self._find(self.weight[n - 1], own >> np.uint64(16)))
            seen = self._find(self.chance[n - 1], own)
            low = np.where(np.isnan(seen), low, seen)
        return low

    def entropies(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bits a letter (texts, languages), letters and gaps, whether the text has a letter)."""
        total, length = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        letters = np.zeros(len(texts), bool)
        for found, owner, has in _spans(texts):
            letters[has] = True
            if len(found):
                codes, values = pd.factorize(found)
                logs = self.log_chances(values)
                length += np.bincount(owner, minlength=len(texts))
                for k in range(len(self.languages)):
                    total[:, k] -= np.bincount(owner, logs[codes, k], len(texts))
        return total / np.maximum(1, length)[:, None], length, letters


def store(estimates: DataFrame, languages: list[str], model: int) -> Models:
    """The store of one of the two estimates of every language (``k`` is twice its number plus ``model``)."""
    bits, width = slot_bits(len(languages)), len(languages)

    def slots(batches):
        for batch in batches:
            g = batch.column(3).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2),
                                              pa.array(_slots(g, bits).astype(np.int32)), batch.column(4)],
                                             ["k", "n", "weight", "slot", "value"])
    rows = (estimates.where(F.pmod("k", F.lit(2)) == model).select("k", "n", "weight", "g", "value")
            .mapInArrow(slots, "k int, n int, weight boolean, slot int, value double")
            .groupBy("k", "n", "weight", "slot").agg(F.max("value").cast("float").alias("value")).toArrow())
    k, n, weight, slot, value = (rows.column(i).to_numpy() for i in range(5))
    tables = []
    for kind in (False, True):
        for order in range(1, ORDER + 1):
            own = (n == order) & (weight == kind)
            keys, at = np.unique(slot[own], return_inverse=True)
            values = np.full((len(keys), width), np.nan, np.float32)
            values[at, k[own] // 2] = value[own]
            tables.append((keys.astype(np.uint32), values))
    return Models(languages, bits, tables[:ORDER], tables[ORDER:])


def _lead(entropy: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best language, class of the bits by which it leads the next one over the whole text)."""
    best = entropy.argmin(1)
    if entropy.shape[1] < 2:
        return best, np.zeros(len(best), np.int64)
    two = np.partition(entropy, 1, axis=1)
    return best, (4 * np.log2(1 + (two[:, 1] - two[:, 0]) * length)).astype(np.int64)


def _length_class(length: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(1, length)).astype(np.int64)


@dataclass
class Calibration:
    right: np.ndarray    # share of right answers by class of lead
    limit: np.ndarray    # (languages, length classes): bits a letter that its own texts stay under

    def score(self, lead: np.ndarray) -> np.ndarray:
        return self.right[np.minimum(lead, len(self.right) - 1)]

    def accepts(self, best: np.ndarray, length: np.ndarray, entropy: np.ndarray) -> np.ndarray:
        at = np.minimum(_length_class(length), self.limit.shape[1] - 1)
        return entropy <= self.limit[best, at]


def monotone(share: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``share`` (weighted squares), by pooling neighbours."""
    pools: list[list[float]] = []
    for s, w in zip(share, weight):
        pools.append([s, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            s2, w2, n2 = pools.pop()
            s1, w1, n1 = pools.pop()
            pools.append([(s1 * w1 + s2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(n, s) for s, _, n in pools])


LEADS, LENGTHS, ENTROPIES = 160, 40, 640


def calibrate(rows: DataFrame, models: Models) -> Calibration:
    """Reliability and limits from ``rows(lang, text)``, which the models have not learned from."""
    number = {name: i for i, name in enumerate(models.languages)}
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for batch in batches:
            entropy, length, letters = shared.value.entropies(raw(batch.column(1)))
            true = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            best, lead = _lead(entropy, length)
            own = entropy[np.arange(len(true)), true]
            ok = np.flatnonzero(letters)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[ok].astype(np.int32)) for x in (true, best == true, np.minimum(lead, LEADS - 1),
                                                            np.minimum(_length_class(length), LENGTHS - 1),
                                                            np.minimum(16 * own, ENTROPIES - 1))],
                ["lang", "right", "lead", "length", "entropy"])
    seen = cut(rows.select("lang", "text").mapInArrow(run, "lang int, right int, lead int, length int, entropy int")
               .groupBy("lang", "right", "lead", "length", "entropy").agg(F.count("*").alias("n")), "lead-classes")
    n, right = np.zeros(LEADS), np.zeros(LEADS)
    # LEADS rows, and at most LENGTHS * ENTROPIES a language
    for r in seen.groupBy("lead").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("right")).alias("r")).collect():
        n[r["lead"]], right[r["lead"]] = r["n"], r["r"]
    # one made-up text a class, right as often as the lead says if letters were independent
    prior = 1 - 0.5 * 2.0 ** -np.minimum(1000.0, 2.0 ** (np.arange(LEADS) / 4) - 1)
    share = monotone((right + prior) / (n + 1), n + 1)
    limit = np.full((len(models.languages), LENGTHS), np.inf)
    found: dict[tuple[int, int], list] = {}
    for r in seen.groupBy("lang", "length", "entropy").agg(F.sum("n").alias("n")).collect():
        found.setdefault((r["lang"], r["length"]), []).append((r["entropy"], r["n"]))
    for lang in range(len(models.languages)):
        last = np.inf
        for length in range(LENGTHS):
            if (lang, length) in found:
                classes, counts = np.array(sorted(found[lang, length])).T
                enough = np.cumsum(counts) >= (1 - REJECT) * counts.sum()
                # the upper end of the class after the one that holds the share
                last = (classes[np.argmax(enough)] + 2) / 16
            limit[lang, length] = last
    return Calibration(share, limit)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          held_out: tuple[int, int] = (5, 0), fold: int = 1) -> tuple[Models, Calibration]:
    """Models of every language of the training rows, and their calibration.

    Training rows have a text, a language and a crc32(id) modulo
    ``held_out[0]`` other than ``held_out[1]``; those of remainder ``fold``
    calibrate too. Rows that repeat count as often as they stand.
    """
    rest = remainder(F.col(id_col), held_out[0])
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
                       (rest == fold).alias("calibrates"), rest.alias("rest")).where(
        (F.col("rest") != held_out[1]) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in {lang_col}")
    base = cut(count_strings(rows, languages), "letter-counts")
    # model 2i counts all rows of language i, model 2i + 1 those that do not calibrate
    of = F.when(F.col("m") % 2 == 1, F.array(F.col("m") - 1)).otherwise(F.array(F.col("m"), F.col("m") + 1))
    counts = base.select(F.explode(of).alias("k"), "g", "c").groupBy("k", "g").agg(F.sum("c").alias("c"))
    estimates = cut(estimate(counts), "letter-models")
    calibration = calibrate(rows.where("calibrates"), store(estimates, languages, 1))
    return store(estimates, languages, 0), calibration


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             held_out: tuple[int, int] = (5, 0)) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted, bits_per_letter), one row per row of ``docs``.

    ``score`` is the calibrated probability that ``lang_pred`` is right;
    ``accepted`` is false where the text fits none of the learned languages. A
    null, empty or letterless text is ``und`` with score 0 and not accepted, and so is
    every text if nothing can be learned. Equal cross-entropies go to the first
    language by name. A null id counts as held out. A text over a megabyte is
    read in stretches, all of which count. Other columns are not read.
    """
    models, calibration = learn(docs, id_col, text_col, lang_col, held_out)
    shared = docs.sparkSession.sparkContext.broadcast((models, calibration))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        models, calibration = shared.value
        names = np.array([*models.languages, NONE], object)
        for batch in batches:
            size = batch.num_rows
            best, score, accepted = np.full(size, len(names) - 1), np.zeros(size), np.zeros(size, bool)
            bits = np.full(size, np.nan)
            if models.languages:
                entropy, length, letters = models.entropies(raw(batch.column(2)))
                first, lead = _lead(entropy, length)
                own = entropy[np.arange(size), first]
                best[letters], score[letters], bits[letters] = first[letters], calibration.score(lead)[letters], own[letters]
                accepted = letters & calibration.accepts(first, length, own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names[best], pa.string()), pa.array(score),
                 pa.array(accepted), pa.array(bits, mask=np.isnan(bits))],
                ["doc_id", "held_out", "lang_pred", "score", "accepted", "bits_per_letter"])
    return docs.select(F.col(id_col).alias("doc_id"), (remainder(F.col(id_col), held_out[0]) == held_out[1]).alias("held_out"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, accepted boolean, bits_per_letter double")
