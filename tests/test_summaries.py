"""Summary semantics: idle dims, orphans, statuses, band totals."""

import datetime as dt

from ledgerlens.operators import summaries
from ledgerlens.sources.contracts import FACT_SCHEMA


def _fact(spark):
    rows = []
    for tid, acct, cust, merch, amount, status, band in [
        ("T1", "A1", "C1", "M1", 10.0, "SUCCESS", "HIGH"),
        ("T2", "A1", "C1", "M1", 20.0, "FAILED", "LOW"),
        ("T3", "A2", "C2", "M2", 5.5, "REVERSED", "MEDIUM"),
        ("T4", "A9", "C1", "M9", 1.0, "SUCCESS", "LOW"),          # unknown account
    ]:
        ts = dt.datetime(2026, 4, 25, 10)
        rows.append((tid, acct, cust, merch, ts, ts.date(), "DEBIT", "UPI", "FUEL", amount, "INR",
                     status, False, band, "b"))
    return spark.createDataFrame(rows, FACT_SCHEMA)


def test_daily_branch_inner_joins(spark):
    accounts = spark.createDataFrame([("A1", "B1"), ("A2", "B9")], "account_id string, branch_id string")
    branches = spark.createDataFrame([("B1", "WEST", "S1", "X")],
                                     "branch_id string, region string, state string, city string")
    out = summaries.daily_branch_summary(_fact(spark), accounts, branches).collect()
    assert [(r.region, r.transaction_count, r.total_amount, r.high_risk_count) for r in out] == \
        [("WEST", 2, 30.0, 1)]   # FAILED included; unknown account and branch left out


def test_customer_risk_keeps_idle(spark):
    customers = spark.createDataFrame(
        [("C1", "RETAIL", "LOW"), ("C2", "RETAIL", "LOW"), ("C3", "IDLE", "LOW")],
        "customer_id string, customer_segment string, customer_risk_band string")
    got = {r.customer_segment: (r.customer_count, r.transaction_count, r.total_transaction_amount)
           for r in summaries.customer_risk_summary(customers, _fact(spark)).collect()}
    assert got == {"RETAIL": (2, 4, 36.5), "IDLE": (1, 0, None)}


def test_merchant_spend_keeps_idle(spark):
    merchants = spark.createDataFrame(
        [("M1", "FUEL", "LOW"), ("M2", "FUEL", "LOW"), ("M3", "IDLE", "LOW")],
        "merchant_id string, merchant_category string, risk_level string")
    got = {r.merchant_category: (r.transaction_count, r.total_amount)
           for r in summaries.merchant_spend_summary(merchants, _fact(spark)).collect()}
    assert got == {"FUEL": (3, 35.5), "IDLE": (0, None)}


def test_money_sum_is_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)] * 1000, "amount double")
    from ledgerlens.functions.money import exact_sum
    assert df.agg(exact_sum("amount").alias("s")).first().s == 600.0


def test_money_loses_no_amount(spark):
    from ledgerlens.functions.money import exact_avg, exact_sum
    total = lambda xs: spark.createDataFrame([(x,) for x in xs], "a double").agg(
        exact_sum("a").alias("s"), exact_avg("a").alias("m")).first()
    assert total([0.004] * 1000).s == 4.0
    assert total([1e17, 0.5]).s == 1e17 + 0.5
    assert total([1e30, 1.0]).s == 1e30 + 1.0
    assert total([float("nan"), 1.0]).s != total([float("nan"), 1.0]).s
    assert total([None, None]).s is None and total([None, 3.0]).m == 3.0


def test_summary_survives_one_absurd_amount(spark):
    import math

    fact = _fact(spark).unionByName(_fact(spark).limit(1).selectExpr(
        *[c for c in FACT_SCHEMA.names if c != "amount"], "double('NaN') AS amount").select(*FACT_SCHEMA.names))
    merchants = spark.createDataFrame([("M1", "FUEL", "LOW"), ("M2", "FOOD", "LOW")],
                                      "merchant_id string, merchant_category string, risk_level string")
    got = {r.merchant_category: r.total_amount for r in summaries.merchant_spend_summary(merchants, fact).collect()}
    assert math.isnan(got["FUEL"]) and got["FOOD"] == 5.5
