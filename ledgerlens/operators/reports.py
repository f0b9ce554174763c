"""Business queries and post-load checks over the fact and the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import HIGH
from ..functions.money import exact_sum, sum_of_partials
from .summaries import _fact_by, account_places


def daily_channel_volume(fact: DataFrame) -> DataFrame:
    """Per date and channel, newest day first, biggest channel first."""
    return (fact.groupBy("transaction_date", "channel")
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 exact_sum("amount").alias("total_amount"))
            .orderBy(F.col("transaction_date").desc(), F.col("total_amount").desc()))


def high_risk_merchants(fact: DataFrame, merchants: DataFrame) -> DataFrame:
    """HIGH-band spend per merchant category and risk level (known merchants only)."""
    per_merchant = _fact_by(fact.filter(F.col("transaction_risk_band") == HIGH), "merchant_id")
    dims = merchants.select("merchant_id", "merchant_category", "risk_level")
    return (per_merchant.join(dims, "merchant_id")
            .groupBy("merchant_category", "risk_level")
            .agg(F.sum("n").cast("long").alias("transaction_count"),
                 sum_of_partials("amt").alias("total_amount"))
            .orderBy(F.col("total_amount").desc()))


def top_branch_regions(fact: DataFrame, accounts: DataFrame, branches: DataFrame,
                       k: int = 20) -> DataFrame:
    """The k branch places with the largest transaction value (ties by place)."""
    return (fact.select("account_id", "amount").join(account_places(accounts, branches), "account_id")
            .groupBy("region", "state", "city")
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 exact_sum("amount").alias("total_amount"))
            .orderBy(F.col("total_amount").desc_nulls_last(), F.col("region").asc_nulls_last(),
                     F.col("state").asc_nulls_last(), F.col("city").asc_nulls_last())
            .limit(k))


def customer_risk_ranked(customer_risk: DataFrame) -> DataFrame:
    """The stored customer risk summary, largest amount first."""
    return (customer_risk.select("customer_segment", "customer_risk_band", "customer_count",
                                 "transaction_count", "total_transaction_amount")
            .orderBy(F.col("total_transaction_amount").desc()))


# --- post-load checks -------------------------------------------------------

def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def check_by_date(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("transaction_date")
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 exact_sum("amount").alias("total_amount"))
            .orderBy(F.col("transaction_date").desc()))


def check_risk_band(fact: DataFrame, count_name: str = "transaction_count") -> DataFrame:
    return fact.groupBy("transaction_risk_band").agg(F.count(F.lit(1)).alias(count_name))


def check_high_risk_success(fact: DataFrame) -> DataFrame:
    return row_count(fact.filter((F.col("transaction_risk_band") == HIGH)
                                 & (F.col("status") == "SUCCESS")), "high_risk_success_txns")


def quality_report(fact: DataFrame, customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """All scalar checks as one (check_name, value) frame, one pass per table."""
    f = fact.agg(F.count(F.lit(1)).alias("fact_transactions"),
                 F.count(F.when((F.col("transaction_risk_band") == HIGH)
                                & (F.col("status") == "SUCCESS"), 1)).alias("high_risk_success"))
    c = row_count(customers, "dim_customers")
    a = row_count(accounts, "dim_accounts")

    def pairs(df: DataFrame) -> DataFrame:
        return df.select(F.explode(F.map_from_arrays(
            F.array(*[F.lit(n) for n in df.columns]),
            F.array(*[F.col(n).cast("long") for n in df.columns]))).alias("check_name", "value"))

    return pairs(f).unionByName(pairs(c)).unionByName(pairs(a))
