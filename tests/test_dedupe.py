"""keep_first equals the row_number() definition, including a hot key."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.quality import keep_first
from ledgerlens.sources.contracts import Sort


def _rows(n, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "HOT" if i % 3 == 0 else f"K{rnd.randint(0, n // 4)}"   # a third on one key
        ts = None if rnd.random() < 0.05 else rnd.randint(0, 50)
        rows.append((key, ts, rnd.choice(["a", "b", None]), rnd.random(), i))
    return rows


def test_matches_row_number(spark):
    df = spark.createDataFrame(_rows(3000), "k string, ts long, s string, x double, id long")
    order = (Sort("ts", descending=True), Sort("s"), Sort("x", descending=True), Sort("id"))
    got = sorted(keep_first(df, "k", order).collect())
    w = Window.partitionBy("k").orderBy(F.col("ts").desc_nulls_last(), F.col("s").asc_nulls_first(),
                                        F.col("x").desc_nulls_last(), F.col("id").asc_nulls_first())
    want = sorted(df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn").collect())
    assert got == want


def test_descending_nan_and_strings(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", float("nan"), "y"), ("b", 1.0, "p"), ("b", 1.0, "q")],
                               "k string, v double, s string")
    got = keep_first(df, "k", (Sort("v", descending=True), Sort("s", descending=True)))
    assert sorted((r.k, r.s) for r in got.collect()) == [("a", "y"), ("b", "q")]


def test_tasks_send_one_row_a_key(spark):
    df = spark.createDataFrame(_rows(100), "k string, ts long, s string, x double, id long")
    plan = keep_first(df, "k", (Sort("ts", descending=True),))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
