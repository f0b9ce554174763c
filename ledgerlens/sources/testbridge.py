"""Raw banking datasets derived from the driver's TPC-H-style test tables.

The banking feed has no public sample, so each raw dataset is a projection
of a test table (customer -> customers and accounts, supplier -> merchants,
nation -> branches, lineitem x orders -> transactions, orders -> loan
applications). The derivation deliberately injects what real feeds carry and the
test tables lack: NULLs in required and optional columns, duplicate keys, orphan
references and idle dimension rows. The same derivation, written as SQL, is the
prefix of every oracle query (``plans/oracle.py``).
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .contracts import Sort
from .domains import (ACCOUNT_STATUS, CARD_TYPES, CATEGORIES, CHANNELS, FEED_KYC_STATUS, LOAN_TYPES,
                      RISK_LEVELS)

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed value: the batch date the single-batch lake is loaded as.
BATCH_DATE = "2026-04-25"

# Extra raw transaction columns kept only to break dedupe ties.
TXN_TIE_BREAKS = ("l_suppkey", "l_partkey", "amount", "l_quantity", "l_discount", "l_tax",
                  "l_returnflag", "l_linestatus")
TXN_ORDER = (Sort("transaction_ts", descending=True),) + tuple(Sort(c) for c in TXN_TIE_BREAKS)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _padded(prefix: str, key: Column, width: int) -> Column:
    """At least ``width`` digits; a longer key keeps all of its own."""
    digits = key.cast("string")
    # a formatter takes several times as long, so it gets only what is no plain number
    return F.when(key >= 0, F.concat(F.lit(prefix), F.repeat(F.lit("0"), F.lit(width) - F.length(digits)), digits)) \
        .otherwise(F.concat(F.lit(prefix), F.format_string(f"%0{width}d", key)))


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _days_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), days.cast("int"))


def raw_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    return (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(_padded("BR", k, 5).alias("branch_id"),
                    F.concat(F.col("n_name"), F.lit(" Main Branch")).alias("branch_name"),
                    F.when(k == 24, F.lit(None).cast("string"))
                    .otherwise(F.col("n_name")).alias("city"),
                    F.concat(F.lit("ST"), (k % 7).cast("string")).alias("state"),
                    F.col("r_name").alias("region")))


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    risk = (F.when(k % 20 == 19, F.lit(None).cast("string"))
            .otherwise(_pick(RISK_LEVELS, k % 4)))
    merchants = read_table(spark, sf_dir, "supplier").select(
        _padded("M", k, 6).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        _pick(CATEGORIES, k % 8).alias("merchant_category"),
        risk.alias("risk_level"))
    idle = spark.createDataFrame([("M999999", "Idle", "IDLE", "LOW")], merchants.schema)
    return merchants.unionByName(idle)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    kyc = (F.when(k % 50 == 0, F.lit(None).cast("string"))
           .otherwise(_pick(FEED_KYC_STATUS, k % 3)))
    customers = read_table(spark, sf_dir, "customer").select(
        _padded("C", k, 8).alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment")).alias("last_name"),
        F.concat(F.lit("CITY"), (k % 8).cast("string")).alias("city"),
        F.concat(F.lit("ST"), (k % 7).cast("string")).alias("state"),
        kyc.alias("kyc_status"),
        F.col("c_mktsegment").alias("customer_segment"),
        _padded("BR", F.col("c_nationkey"), 5).alias("home_branch_id"),
        _days_after("2016-01-01", k % 3651).alias("created_at"))
    idle = spark.createDataFrame(
        [("C99999999", "Idle", None, "CITY0", "ST0", "VERIFIED", "IDLE", "BR00001",
          datetime.date(2016, 1, 1))], customers.schema)
    return customers.unionByName(idle)


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        _padded("A", k, 9).alias("account_id"),
        _padded("C", k, 8).alias("customer_id"),
        F.when(k % 101 == 0, F.lit(None).cast("string"))
        .otherwise(_padded("BR", (k * 7) % 27, 5)).alias("branch_id"),
        F.col("c_mktsegment").alias("account_type"),
        _pick(ACCOUNT_STATUS, k % 5).alias("account_status"),
        _days_after("2017-01-01", k % 3201).alias("open_date"),
        F.when(k % 67 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("c_acctbal") * 150).alias("current_balance"))


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    # about 70% of accounts hold a card; two neighbouring accounts share a card id
    return (read_table(spark, sf_dir, "customer").filter(k % 10 < 7).select(
        _padded("CARD", k - k % 2, 9).alias("card_id"),
        _padded("A", k, 9).alias("account_id"),
        _pick(CARD_TYPES, k % 3).alias("card_type"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
        .when(k % 3 == 2, "BLOCKED").otherwise("ACTIVE").alias("card_status"),
        _days_after("2017-01-01", k % 3201).alias("issued_date")))


def raw_loan_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = (F.when(F.col("o_orderstatus") == "F", "REJECTED")
              .when(F.col("o_orderstatus") == "O", "APPROVED").otherwise("SUBMITTED"))
    return (read_table(spark, sf_dir, "orders")
            .select(_padded("L", k, 8).alias("application_id"),
                    _padded("C", F.col("o_custkey"), 8).alias("customer_id"),
                    F.col("o_orderdate").cast("date").alias("application_date"),
                    _pick(LOAN_TYPES, k % 4).alias("loan_type"),
                    F.when(k % 29 == 0, F.lit(None).cast("double"))
                    .otherwise(F.col("o_totalprice") * 20).alias("requested_amount"),
                    status.alias("application_status")))


def raw_transactions(spark: SparkSession, sf_dir: str, files: int = 0) -> DataFrame:
    """The transaction feed; dealt by part over ``files`` partitions if given, before numbers become text."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    ok, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    status = (F.when(F.col("o_orderstatus") == "F", "FAILED")
              .when(F.col("o_orderstatus") == "O", "SUCCESS").otherwise("REVERSED"))
    rows = lineitem.join(orders, ok == F.col("o_orderkey"))
    if files:
        rows = rows.repartition(files, "l_partkey")
    return (rows
            .select(F.concat(_padded("T", ok, 10), ln.cast("string")).alias("transaction_id"),
                    _padded("A", F.col("o_custkey"), 9).alias("account_id"),
                    _padded("C", F.col("o_custkey"), 8).alias("customer_id"),
                    _padded("M", F.col("l_suppkey"), 6).alias("merchant_id"),
                    F.col("l_shipdate").cast("timestamp").alias("transaction_ts"),
                    F.when(F.col("l_returnflag") == "R", "CREDIT").otherwise("DEBIT")
                    .alias("transaction_type"),
                    _pick(CHANNELS, ln % 6).alias("channel"),
                    _pick(CATEGORIES, pk % 8).alias("category"),
                    F.when(pk % 97 == 0, F.lit(None).cast("double"))
                    .otherwise(F.col("l_extendedprice") * 2).alias("amount"),
                    F.lit("INR").alias("currency"),
                    status.alias("status"),
                    F.when(ok % 11 == 0, F.lit(None).cast("boolean"))
                    .otherwise((ok + ln) % 5 == 0).alias("is_suspected_fraud"),
                    "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
                    "l_returnflag", "l_linestatus"))


RAW_BUILDERS = {
    "branches": raw_branches,
    "merchants": raw_merchants,
    "customers": raw_customers,
    "accounts": raw_accounts,
    "cards": raw_cards,
    "transactions": raw_transactions,
    "loan_applications": raw_loan_applications,
}


def raw_dataset(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return RAW_BUILDERS[dataset](spark, sf_dir)


def dedupe_order(dataset: str):
    """Tie-break order for the derived data (None: the contract's own order)."""
    return TXN_ORDER if dataset == "transactions" else None
