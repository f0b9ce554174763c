"""Risk and balance bands as plain Column expressions.

CASE chains are first-match and a NULL condition falls through, so a NULL
KYC status, balance, fraud flag, merchant risk or amount ends at ``LOW``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's: band names, KYC codes and
# thresholds (balance 1,000,000 / 100,000; transaction amount 100,000).
HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"
KYC_REJECTED, KYC_PENDING = "REJECTED", "PENDING"
BALANCE_HIGH_AT = 1_000_000
BALANCE_MEDIUM_AT = 100_000
AMOUNT_MEDIUM_AT = 100_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def customer_risk_band(kyc_status: str | Column = "kyc_status") -> Column:
    kyc = _col(kyc_status)
    return (F.when(kyc == KYC_REJECTED, HIGH)
            .when(kyc == KYC_PENDING, MEDIUM)
            .otherwise(LOW))


def balance_band(balance: str | Column = "current_balance") -> Column:
    bal = _col(balance)
    return (F.when(bal >= BALANCE_HIGH_AT, HIGH)
            .when(bal >= BALANCE_MEDIUM_AT, MEDIUM)
            .otherwise(LOW))


def transaction_risk_band(fraud_flag: str | Column = "is_suspected_fraud",
                          merchant_risk: str | Column = "risk_level",
                          amount: str | Column = "amount") -> Column:
    return (F.when(_col(fraud_flag), HIGH)
            .when(_col(merchant_risk) == HIGH, HIGH)
            .when(_col(amount) >= AMOUNT_MEDIUM_AT, MEDIUM)
            .otherwise(LOW))
