"""Curation: customer profile, account master, transaction events.

Pure DataFrame functions; reading and writing zones is the caller's job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bands import balance_band, customer_risk_band, transaction_risk_band
from ..sources.contracts import ACCOUNT_MASTER, CUSTOMER_PROFILE, FACT_COLUMNS


def curate_customers(validated: DataFrame) -> DataFrame:
    """Customer profile: full name (NULL parts skipped) and KYC risk band."""
    return (validated
            .withColumn("customer_name", F.concat_ws(" ", "first_name", "last_name"))
            .withColumn("customer_risk_band", customer_risk_band("kyc_status"))
            .select(*CUSTOMER_PROFILE))


def curate_accounts(validated: DataFrame) -> DataFrame:
    """Account master: balance as DOUBLE and its band."""
    return (validated
            .withColumn("current_balance", F.col("current_balance").try_cast("double"))
            .withColumn("balance_band", balance_band("current_balance"))
            .select(*ACCOUNT_MASTER))


def _as_timestamp(df: DataFrame, name: str):
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(name)
    return F.col(name) if isinstance(dtype, T.TimestampType) else F.col(name).try_cast("timestamp")


def curate_transactions(validated: DataFrame, merchants: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Transaction events: merchant risk looked up (unknown merchant kept), date, band.

    ``keep`` names further columns of ``validated`` that stay.

    The merchant dimension is pruned to (merchant_id, risk_level); whether it is
    broadcast is left to AQE, which knows its size in bytes when the join runs.
    """
    risk = merchants.select("merchant_id", "risk_level")
    return (validated.join(risk, "merchant_id", "left")
            .withColumn("transaction_ts", _as_timestamp(validated, "transaction_ts"))
            .withColumn("transaction_date", F.to_date("transaction_ts"))
            .withColumn("amount", F.col("amount").try_cast("double"))
            .withColumn("transaction_risk_band", transaction_risk_band())
            .select(*FACT_COLUMNS, *keep))
