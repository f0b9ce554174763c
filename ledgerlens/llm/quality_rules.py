"""Quality rules under weak supervision, in DataFrame operations only.

Six rules vote good, bad or abstain on a document's counts. Rules do not have
to pass together: expectation-maximisation estimates how often each rule votes
good on good documents and bad on bad ones, and a document's posterior
probability of being good decides.

All counts of a document come from its own row by array functions, so texts
are read once and never shuffled. The votes have at most 3^6 patterns; the
corpus is reduced to one row a pattern before any iteration, and every step of
the estimation is one aggregate over those rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import cut

_WORD = r"[^\x20\x09-\x0D]+"
#: From this many comparisons on, repeated windows are found by sorting positions.
_SORT_FROM = 20_000_000
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
ITERATIONS = 20
#: Where the estimation starts: P(votes good | good), P(votes bad | bad), P(good).
START = (0.99, 0.3, 0.8)
SMOOTH = 1.0


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts) for each row; null counts as the empty text, whose counts are all 0.

    ``n_repeat_words`` counts the words within any three-word window that
    stands twice or more in the text; ``n_dup_lines`` the lines with a word
    that equal an earlier line; ``n_lines`` all lines with a word.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    df = df.select("doc_id", "text", F.regexp_extract_all("text", F.lit(_WORD), F.lit(0)).alias("words"),
                   F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    last = F.size("words") - 3
    window = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))
    df = df.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(last >= 0, window).otherwise(F.array().cast("array<bigint>")).alias("windows"))
    rest = [c for c in df.columns if c != "windows"]
    df = df.select(*rest, "windows", F.sort_array("windows").alias("ordered"))
    twice = F.array_distinct(F.filter("ordered", lambda x, i: (i > 0) & (x == F.get("ordered", i - 1))))
    df = df.select(*rest, "windows", twice.alias("twice"))
    positions = F.sequence(F.lit(0), F.size("windows") - 1)
    direct = F.filter(positions, lambda i: F.array_contains("twice", F.get("windows", i)))
    # (hash, position) sorted: a repeated window has its like before or after it
    pairs = F.array_sort(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    same = lambda p, k, x: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
    by_sort = F.get(F.transform(F.array(pairs), lambda p: F.sort_array(F.transform(
        F.filter(p, lambda x, k: same(p, k - 1, x) | same(p, k + 1, x)), lambda x: x["i"]))), 0)
    repeated = (F.when(F.size("twice") == 0, F.array().cast("array<int>"))
                .when(F.size("twice").cast("long") * F.size("windows") > _SORT_FROM, by_sort).otherwise(direct))
    df = df.select(*rest, repeated.alias("repeated"))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total"))
    covered = F.aggregate("repeated", start, lambda a, p: F.struct(
        p.alias("last"), (a["total"] + F.least(F.lit(3), p - a["last"])).cast("long").alias("total")))["total"]
    return df.select(*rest, covered.alias("n_repeat_words")).select("doc_id", *STATS)


def votes() -> list[Column]:
    """Each rule's vote on the counts: 1 good, -1 bad, 0 abstains."""
    n, lines = F.col("n_words"), F.col("n_lines")
    rules = [
        (n >= 80, n < 30),
        (F.col("word_chars").between(3 * n, 12 * n), (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 20 * n)),
        (100 * F.col("n_symbols") <= 2 * n, 100 * F.col("n_symbols") > 10 * n),
        (1000 * F.col("n_symbols") <= 4 * F.col("word_chars"), 1000 * F.col("n_symbols") > 20 * F.col("word_chars")),
        ((lines > 1) & (F.col("n_dup_lines") == 0), 100 * F.col("n_dup_lines") > 30 * lines),
        (100 * F.col("n_repeat_words") <= 10 * n, 100 * F.col("n_repeat_words") > 30 * n),
    ]
    return [F.when(bad, -1).when((n > 0) & good, 1).otherwise(0) for good, bad in rules]


def _posterior(names: list[str], good: list[float], bad: list[float], prior: float) -> Column:
    """P(good | votes); an abstaining rule says nothing."""
    def likelihood(plus, minus):
        return reduce(lambda a, b: a * b, [F.when(F.col(v) == 1, F.lit(p)).when(F.col(v) == -1, F.lit(m)).otherwise(
            F.lit(1.0)) for v, p, m in zip(names, plus, minus)])
    yes = F.lit(prior) * likelihood(good, [1 - x for x in good])
    no = F.lit(1 - prior) * likelihood([1 - x for x in bad], bad)
    return yes / (yes + no)


def estimate(patterns: DataFrame, names: list[str], iterations: int = ITERATIONS) -> tuple:
    """(P(votes good | good), P(votes bad | bad), P(good)) of ``patterns(votes..., n)`` by EM."""
    good, bad, prior = [START[0]] * len(names), [START[1]] * len(names), START[2]
    for _ in range(iterations):
        weighed = patterns.withColumn("in_good", F.col("n") * _posterior(names, good, bad, prior)).withColumn(
            "in_bad", F.col("n") - F.col("in_good"))
        parts = [F.sum("n").alias("all"), F.sum("in_good").alias("good")]
        for v in names:
            parts += [F.sum(F.when(F.col(v) == 1, F.col("in_good")).otherwise(0.0)).alias(f"{v}_hit"),
                      F.sum(F.when(F.col(v) != 0, F.col("in_good")).otherwise(0.0)).alias(f"{v}_on_good"),
                      F.sum(F.when(F.col(v) == -1, F.col("in_bad")).otherwise(0.0)).alias(f"{v}_miss"),
                      F.sum(F.when(F.col(v) != 0, F.col("in_bad")).otherwise(0.0)).alias(f"{v}_on_bad")]
        r = weighed.agg(*parts).first()
        if not r["all"]:
            break
        good = [(r[f"{v}_hit"] + SMOOTH) / (r[f"{v}_on_good"] + 2 * SMOOTH) for v in names]
        bad = [(r[f"{v}_miss"] + SMOOTH) / (r[f"{v}_on_bad"] + 2 * SMOOTH) for v in names]
        prior = (r["good"] + SMOOTH) / (r["all"] + 2 * SMOOTH)
    return good, bad, prior


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, counts, base_failed, quality, kept), one row per row of ``docs``.

    ``quality`` is the posterior probability of a good document. ``base_failed``:
    under 50 words, or over half of the words in repeated windows; such a
    document is not kept whatever the rules say, and the estimation leaves it out. Null and empty texts fail.
    Repeated rows count as often as they stand. Other columns are not read.
    """
    rules = votes()
    names = [f"vote{i}" for i in range(len(rules))]
    counted = cut(statistics(docs, id_col, text_col), "quality-counts").select(
        "doc_id", *STATS, *[v.alias(n) for v, n in zip(rules, names)])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    patterns = cut(counted.where(~failed).groupBy(*names).agg(F.count("*").alias("n")), "vote-patterns")
    quality = _posterior(names, *estimate(patterns, names))
    return counted.select("doc_id", *STATS, failed.alias("base_failed"), quality.alias("quality")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def oracle_sql() -> str:
    """The contract's columns in DuckDB SQL, every EM step a common table expression."""
    rules = [
        ("n_words >= 80", "n_words < 30"),
        ("word_chars BETWEEN 3 * n_words AND 12 * n_words", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
        ("100 * n_symbols <= 2 * n_words", "100 * n_symbols > 10 * n_words"),
        ("1000 * n_symbols <= 4 * word_chars", "1000 * n_symbols > 20 * word_chars"),
        ("n_lines > 1 AND n_dup_lines = 0", "100 * n_dup_lines > 30 * n_lines"),
        ("100 * n_repeat_words <= 10 * n_words", "100 * n_repeat_words > 30 * n_words"),
    ]
    names = [f"vote{i}" for i in range(len(rules))]
    vote = ", ".join(f"CASE WHEN {b} THEN -1 WHEN n_words > 0 AND {g} THEN 1 ELSE 0 END AS {v}"
                     for v, (g, b) in zip(names, rules))

    def posterior(p):
        yes = " * ".join([f"{p}.prior"] + [
            f"(CASE {v} WHEN 1 THEN {p}.g{i} WHEN -1 THEN 1 - {p}.g{i} ELSE 1.0 END)" for i, v in enumerate(names)])
        no = " * ".join([f"(1 - {p}.prior)"] + [
            f"(CASE {v} WHEN -1 THEN {p}.b{i} WHEN 1 THEN 1 - {p}.b{i} ELSE 1.0 END)" for i, v in enumerate(names)])
        return f"({yes}) / ({yes} + {no})"
    s = SMOOTH
    first = ", ".join(f"{START[0]}::DOUBLE AS g{i}, {START[1]}::DOUBLE AS b{i}" for i in range(len(names)))
    steps = [f"p0 AS (SELECT {START[2]}::DOUBLE AS prior, {first})"]
    for k in range(ITERATIONS):
        new = ", ".join(
            f"(sum(CASE WHEN {v} = 1 THEN g ELSE 0 END) + {s}) / (sum(CASE WHEN {v} <> 0 THEN g ELSE 0 END) + {2 * s})"
            f" AS g{i}, (sum(CASE WHEN {v} = -1 THEN n - g ELSE 0 END) + {s}) / "
            f"(sum(CASE WHEN {v} <> 0 THEN n - g ELSE 0 END) + {2 * s}) AS b{i}" for i, v in enumerate(names))
        steps.append(f"p{k + 1} AS MATERIALIZED (SELECT (sum(g) + {s}) / (sum(n) + {2 * s}) AS prior, {new} FROM "
                     f"(SELECT *, n * {posterior(f'p{k}')} AS g FROM patterns, p{k}))")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS word,
             generate_subscripts(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), 1) AS i FROM d),
win AS (SELECT r, i, word, lead(word, 1) OVER o AS word2, lead(word, 2) OVER o AS word3 FROM w
         WINDOW o AS (PARTITION BY r ORDER BY i) QUALIFY word3 IS NOT NULL),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, word, word2, word3) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS t(k) GROUP BY r),
ln AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
dl AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM ln
       WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
ws AS (SELECT r, count(*) AS n, sum(length(word)) AS chars FROM w GROUP BY r),
counted AS (SELECT doc_id, coalesce(ws.n, 0)::BIGINT AS n_words, coalesce(ws.chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines
    FROM d LEFT JOIN ws USING (r) LEFT JOIN cov USING (r) LEFT JOIN dl USING (r)),
voted AS MATERIALIZED (SELECT *, {vote} FROM counted),
patterns AS MATERIALIZED (SELECT {', '.join(names)}, count(*) AS n FROM voted
    WHERE NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) GROUP BY ALL),
{', '.join(steps)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {posterior(f'p{ITERATIONS}')} >= 0.5 AS kept
FROM voted, p{ITERATIONS}
"""
