"""The four summary tables.

Branch places hang on accounts, so the fact is joined to its account's place
and aggregated once: counts and sums are combined map-side, and AQE broadcasts
the places by their size or splits an account that holds many transactions.
Customers and merchants are the left side of theirs, so there the fact is
reduced to a row for each key before it meets them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import HIGH
from ..functions.money import exact_avg, exact_sum, partial_sums, sum_of_partials


def account_places(accounts: DataFrame, branches: DataFrame) -> DataFrame:
    """account_id -> (region, state, city); accounts with an unknown branch drop out."""
    place = branches.select("branch_id", "region", "state", "city")
    return accounts.select("account_id", "branch_id").join(place, "branch_id").drop("branch_id")


def daily_branch_summary(fact: DataFrame, accounts: DataFrame, branches: DataFrame) -> DataFrame:
    """Per date and branch place: transactions, exact total, HIGH-band count.

    Inner joins: a transaction whose account or branch is unknown is left out.
    """
    rows = fact.select("account_id", "transaction_date", "amount", "transaction_risk_band")
    return (rows.join(account_places(accounts, branches), "account_id")
            .groupBy("transaction_date", "region", "state", "city")
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 exact_sum("amount").alias("total_amount"),
                 F.sum(F.when(F.col("transaction_risk_band") == HIGH, 1).otherwise(0))
                 .cast("long").alias("high_risk_count")))


def _fact_by(fact: DataFrame, key: str) -> DataFrame:
    return (fact.groupBy(key)
            .agg(F.count("transaction_id").alias("n"), *partial_sums("amount", "amt")))


def customer_risk_summary(customers: DataFrame, fact: DataFrame) -> DataFrame:
    """Per segment and KYC band; idle customers count, add 0 transactions and NULL money."""
    joined = (customers.select("customer_id", "customer_segment", "customer_risk_band")
              .join(_fact_by(fact, "customer_id"), "customer_id", "left"))
    return (joined.groupBy("customer_segment", "customer_risk_band")
            .agg(F.count_distinct("customer_id").alias("customer_count"),
                 F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("transaction_count"),
                 sum_of_partials("amt").alias("total_transaction_amount")))


def merchant_spend_summary(merchants: DataFrame, fact: DataFrame) -> DataFrame:
    """Per merchant category and risk level; idle merchants give 0 and NULL."""
    joined = (merchants.select("merchant_id", "merchant_category", "risk_level")
              .join(_fact_by(fact, "merchant_id"), "merchant_id", "left"))
    return (joined.groupBy("merchant_category", "risk_level")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("transaction_count"),
                 sum_of_partials("amt").alias("total_amount")))


def account_balance_snapshot(accounts: DataFrame) -> DataFrame:
    """Per account type, status and balance band: count, exact total and average."""
    return (accounts.groupBy("account_type", "account_status", "balance_band")
            .agg(F.count(F.lit(1)).alias("account_count"),
                 exact_sum("current_balance").alias("total_balance"),
                 exact_avg("current_balance").alias("average_balance")))


SUMMARIES = ("daily_branch_summary", "customer_risk_summary", "merchant_spend_summary",
             "account_balance_snapshot")
