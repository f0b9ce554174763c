from pyspark.sql import functions as F

from ledgerlens.operators.curate import curate_accounts, curate_customers


def test_balance_band(spark):
    df = spark.createDataFrame(
        [("A1", 1_000_000.0), ("A2", 100_000.0), ("A3", 99_999.99), ("A4", None), ("A5", -5.0)],
        "account_id string, current_balance double")
    for c in ("customer_id", "branch_id", "account_type", "account_status", "batch_date"):
        df = df.withColumn(c, F.lit("x"))
    df = df.withColumn("open_date", F.lit(None).cast("date"))
    got = {r.account_id: r.balance_band for r in curate_accounts(df).collect()}
    assert got == {"A1": "HIGH", "A2": "MEDIUM", "A3": "LOW", "A4": "LOW", "A5": "LOW"}


def test_kyc_band_and_name(spark):
    df = spark.createDataFrame(
        [("C1", "Ann", None, "REJECTED"), ("C2", None, None, "PENDING"),
         ("C3", "Ann", "Lee", "VERIFIED"), ("C4", "Bo", "X", "other")],
        "customer_id string, first_name string, last_name string, kyc_status string")
    for c in ("city", "state", "customer_segment", "home_branch_id", "batch_date"):
        df = df.withColumn(c, F.lit("x"))
    df = df.withColumn("created_at", F.lit(None).cast("date"))
    got = {r.customer_id: (r.customer_name, r.customer_risk_band)
           for r in curate_customers(df).collect()}
    assert got == {"C1": ("Ann", "HIGH"), "C2": ("", "MEDIUM"), "C3": ("Ann Lee", "LOW"),
                   "C4": ("Bo X", "LOW")}
