"""Dataset contracts: columns, types, required columns, key and tie-break order.

The required columns (and, as the first of them, the unique key) are the one
declarative contract of the raw feed. Types are the ones the raw values parse
to. ``order`` is the tie-break used to keep one row per key; the feed itself
keeps an arbitrary row, ours keeps the first row of an explicit total order
so the result is repeatable.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Sort:
    column: str
    descending: bool = False
    nulls_last: bool | None = None   # None: Spark's default for the direction

    @property
    def nulls_go_last(self) -> bool:
        return self.descending if self.nulls_last is None else self.nulls_last


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[tuple[str, str], ...]   # (name, Spark SQL type)
    required: tuple[str, ...]
    order: tuple[Sort, ...] = field(default=())

    @property
    def key(self) -> str:
        return self.required[0]

    @property
    def names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def total_order(self) -> tuple[Sort, ...]:
        """``order`` followed by every other column, so ties are broken."""
        named = {s.column for s in self.order} | {self.key}
        return self.order + tuple(Sort(c) for c in self.names if c not in named)


S, D, TS, DT, BOOL = "string", "double", "timestamp", "date", "boolean"

# Columns and types of each dataset, then its required columns,
# the first of them the unique key.
CONTRACTS: dict[str, Contract] = {
    "branches": Contract(
        "branches",
        (("branch_id", S), ("branch_name", S), ("city", S), ("state", S), ("region", S)),
        ("branch_id", "city", "region"),
        (Sort("branch_name"),)),
    "merchants": Contract(
        "merchants",
        (("merchant_id", S), ("merchant_name", S), ("merchant_category", S), ("risk_level", S)),
        ("merchant_id", "merchant_category", "risk_level"),
        (Sort("merchant_name"),)),
    "customers": Contract(
        "customers",
        (("customer_id", S), ("first_name", S), ("last_name", S), ("city", S), ("state", S),
         ("kyc_status", S), ("customer_segment", S), ("home_branch_id", S), ("created_at", DT)),
        ("customer_id", "kyc_status", "home_branch_id"),
        (Sort("first_name"),)),
    "accounts": Contract(
        "accounts",
        (("account_id", S), ("customer_id", S), ("branch_id", S), ("account_type", S),
         ("account_status", S), ("open_date", DT), ("current_balance", D)),
        ("account_id", "customer_id", "branch_id"),
        (Sort("customer_id"),)),
    "cards": Contract(
        "cards",
        (("card_id", S), ("account_id", S), ("card_type", S), ("card_status", S),
         ("issued_date", DT)),
        ("card_id", "account_id", "card_status"),
        (Sort("account_id"),)),
    "transactions": Contract(
        "transactions",
        (("transaction_id", S), ("account_id", S), ("customer_id", S), ("merchant_id", S),
         ("transaction_ts", TS), ("transaction_type", S), ("channel", S), ("category", S),
         ("amount", D), ("currency", S), ("status", S), ("is_suspected_fraud", BOOL)),
        ("transaction_id", "account_id", "customer_id", "amount"),
        # the latest event wins
        (Sort("transaction_ts", descending=True),)),
    "loan_applications": Contract(
        "loan_applications",
        (("application_id", S), ("customer_id", S), ("application_date", DT), ("loan_type", S),
         ("requested_amount", D), ("application_status", S)),
        ("application_id", "customer_id", "requested_amount"),
        (Sort("customer_id"),)),
}

DATASETS = tuple(CONTRACTS)

_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
          "timestamp": T.TimestampType()}


def _struct(columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in
                         (c.split() for c in columns.split(","))])


# Curated and warehouse columns with their types, in order.
CUSTOMER_SCHEMA = _struct(
    "customer_id string, customer_name string, city string, state string, kyc_status string, "
    "customer_segment string, home_branch_id string, created_at date, batch_date string, "
    "customer_risk_band string")
ACCOUNT_SCHEMA = _struct(
    "account_id string, customer_id string, branch_id string, account_type string, "
    "account_status string, open_date date, current_balance double, batch_date string, "
    "balance_band string")
MERCHANT_SCHEMA = _struct(
    "merchant_id string, merchant_name string, merchant_category string, risk_level string, "
    "batch_date string, validated_at timestamp")
BRANCH_SCHEMA = _struct(
    "branch_id string, branch_name string, city string, state string, region string, "
    "batch_date string, validated_at timestamp")
FACT_SCHEMA = _struct(
    "transaction_id string, account_id string, customer_id string, merchant_id string, "
    "transaction_ts timestamp, transaction_date date, transaction_type string, channel string, "
    "category string, amount double, currency string, status string, is_suspected_fraud boolean, "
    "transaction_risk_band string, batch_date string")
DIM_SCHEMAS = {"dim_customers": CUSTOMER_SCHEMA, "dim_accounts": ACCOUNT_SCHEMA,
               "dim_merchants": MERCHANT_SCHEMA, "dim_branches": BRANCH_SCHEMA}
CUSTOMER_PROFILE = tuple(CUSTOMER_SCHEMA.names)
ACCOUNT_MASTER = tuple(ACCOUNT_SCHEMA.names)
FACT_COLUMNS = tuple(FACT_SCHEMA.names)
FACT_KEY = "transaction_id"
FACT_PARTITION = "transaction_date"
