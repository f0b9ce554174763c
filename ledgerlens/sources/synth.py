"""Distributed synthesis of the seven raw banking datasets.

The feed's generator is one process drawing from a seeded random stream, so
its output cannot be split across machines. Here every value is a pure
function of (seed, row number, column): a hash over a prime field in BIGINT
arithmetic that never overflows, so any partition of any table can be generated
independently, on any number of executors, with the same result. References
are drawn from the row numbers that exist, 0 to n - 1, and a transaction's
customer is re-derived from its account's hash instead of joining the accounts.

``synthesize`` lands a batch of any size as CSV. The registered ``synth_*``
queries take their row numbers from the driver's test tables (supplier ->
branches, part -> merchants, customer -> customers, orders -> accounts and loan
applications, four transactions an order), so the volume grows with them;
``SQL`` mirrors every expression for the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import parse_column
from ..session import fresh_dir
from .contracts import CONTRACTS, DATASETS
from .domains import (ACCOUNT_STATUS, ACCOUNT_TYPES, CARD_SHARE, CARD_STATUS, CARD_TYPES, CATEGORIES, CHANNELS, CITIES,
                      FIRST_NAMES, FRAUD_ONE_IN, KYC_STATUS, LAST_NAMES, LOAN_STATUS, LOAN_TYPES, REGIONS, RISK_LEVELS,
                      SEGMENTS, STATES, TXN_STATUS, TXN_TYPES)
from .testbridge import read_table
from .zones import Zones, read_raw_csv, write_raw_csv

SEED = 42
BATCH = "2026-04-25"
P = 2147483647            # the prime 2**31 - 1
LINES = 4                 # transactions an order in the registered queries
# Rows of a batch unless told otherwise.
SIZES = {"branches": 1_000, "merchants": 10_000, "customers": 100_000, "accounts": 150_000,
         "transactions": 1_000_000, "loan_applications": 50_000}


# --- the hash, as a Spark Column and as SQL text ----------------------------
# x -> x^5 permutes the field, and fifth powers of x and x + d have nothing in
# common, so columns of a row and neighbouring rows come out independent.

def _point(salt: int, seed: int) -> int:
    return (seed * 1_000_003 + salt * 7_368_787 + 12_345) % P


def h(row: Column, salt: int, seed: int = SEED) -> Column:
    """Uniform integer in [0, 2**31 - 1) from (seed, row, salt)."""
    lo, hi = row % P, F.floor(row / P).cast("long")
    x = (lo * 1_103_515_245 + hi * 40_503 + _point(salt, seed)) % P
    square = x * x % P
    return square * square % P * x % P


def h_sql(row: str, salt: int) -> str:
    x = f"((({row}) % {P} * 1103515245 + ({row}) // {P} * 40503 + {_point(salt, SEED)}) % {P})"
    square = f"({x} * {x} % {P})"
    return f"({square} * {square} % {P} * {x} % {P})"


def below(n, row: Column, salt: int, seed: int = SEED) -> Column:
    """Uniform integer in [0, n), for n up to 2**62."""
    return (h(row, salt, seed) * P + h(row, salt + 500, seed)) % n


def below_sql(n: str, row: str, salt: int) -> str:
    return f"(({h_sql(row, salt)} * {P} + {h_sql(row, salt + 500)}) % {n})"


def pick_sql(values: list[str], row: str, salt: int) -> str:
    arr = "[" + ", ".join(f"'{v}'" for v in values) + "]"
    return f"list_extract({arr}, cast({h_sql(row, salt)} % {len(values)} + 1 as integer))"


def between_sql(lo: int, hi: int, row: str, salt: int) -> str:
    return f"({h_sql(row, salt)} % {hi - lo + 1} + {lo})"


def money_sql(lo: int, hi: int, row: str, salt: int) -> str:
    return f"round({lo}::double + {hi - lo}::double * (cast({h_sql(row, salt)} as double) / {P}::double), 2)"


def padded(prefix: str, width: int, n: Column) -> Column:
    return F.concat(F.lit(prefix), F.format_string(f"%0{width}d", n))


def padded_sql(prefix: str, width: int, n: str) -> str:
    return f"('{prefix}' || printf('%0{width}d', {n}))"


def days_after(start: str, n: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), n.cast("int"))


def days_after_sql(start: str, n: str) -> str:
    return f"cast(date '{start}' + cast({n} as integer) as date)"


class Generator:
    """The datasets over given row numbers: ``rows(dataset)`` has a column ``i``, ``sizes`` counts them.

    Where it also has a column ``batch_date`` (text), each row is dated by its own;
    one run may so span any number of days. Else all rows are of ``batch``.
    """

    def __init__(self, rows: Callable[[str], DataFrame], sizes: dict[str, int], seed: int = SEED, batch: str = BATCH):
        self.rows, self.sizes, self.seed, self.batch = rows, sizes, seed, batch

    def _pick(self, values: list[str], row: Column, salt: int) -> Column:
        index = (h(row, salt, self.seed) % len(values) + 1).cast("int")
        return F.element_at(F.array(*[F.lit(v) for v in values]), index)

    def _between(self, lo: int, hi: int, row: Column, salt: int) -> Column:
        return h(row, salt, self.seed) % (hi - lo + 1) + lo

    def _money(self, lo: int, hi: int, row: Column, salt: int) -> Column:
        """A uniform real in [lo, hi), rounded half up to two decimals."""
        share = h(row, salt, self.seed).cast("double") / F.lit(float(P))
        return F.round(F.lit(float(lo)) + F.lit(float(hi - lo)) * share, 2)

    def _dated(self, dataset: str) -> DataFrame:
        rows = self.rows(dataset)
        return rows if "batch_date" in rows.columns else rows.withColumn("batch_date", F.lit(self.batch))

    def _ref(self, dataset: str, row: Column, salt: int) -> Column:
        return below(self.sizes[dataset], row, salt, self.seed)

    def branches(self) -> DataFrame:
        i = F.col("i")
        return self.rows("branches").select(
            padded("BR", 5, i).alias("branch_id"),
            F.concat(self._pick(CITIES, i, 1), F.lit(" Main Branch "), i.cast("string")).alias("branch_name"),
            self._pick(CITIES, i, 2).alias("city"), self._pick(STATES, i, 3).alias("state"),
            self._pick(REGIONS, i, 4).alias("region"))

    def merchants(self) -> DataFrame:
        i = F.col("i")
        return self.rows("merchants").select(
            padded("M", 6, i).alias("merchant_id"),
            F.concat(F.lit("Merchant "), i.cast("string")).alias("merchant_name"),
            self._pick(CATEGORIES, i, 5).alias("merchant_category"),
            self._pick(RISK_LEVELS, i, 6).alias("risk_level"))

    def customers(self) -> DataFrame:
        i = F.col("i")
        return self.rows("customers").select(
            padded("C", 8, i).alias("customer_id"),
            self._pick(FIRST_NAMES, i, 51).alias("first_name"), self._pick(LAST_NAMES, i, 52).alias("last_name"),
            self._pick(CITIES, i, 53).alias("city"), self._pick(STATES, i, 54).alias("state"),
            self._pick(KYC_STATUS, i, 55).alias("kyc_status"), self._pick(SEGMENTS, i, 56).alias("customer_segment"),
            padded("BR", 5, self._ref("branches", i, 57)).alias("home_branch_id"),
            days_after("2016-01-01", self._between(0, 3650, i, 58)).alias("created_at"))

    def _account_customer(self, account: Column) -> Column:
        return padded("C", 8, self._ref("customers", account, 11))

    def _accounts(self) -> DataFrame:
        i = F.col("i")
        return self.rows("accounts").select(
            "i", padded("A", 9, i).alias("account_id"), self._account_customer(i).alias("customer_id"),
            padded("BR", 5, self._ref("branches", i, 12)).alias("branch_id"),
            self._pick(ACCOUNT_TYPES, i, 13).alias("account_type"),
            self._pick(ACCOUNT_STATUS, i, 14).alias("account_status"),
            days_after("2017-01-01", self._between(0, 3200, i, 15)).alias("open_date"),
            self._money(500, 2_000_000, i, 16).alias("current_balance"))

    def accounts(self) -> DataFrame:
        return self._accounts().drop("i")

    def cards(self) -> DataFrame:
        i = F.col("i")
        return (self._accounts().filter(h(i, 21, self.seed) % 10 < CARD_SHARE)
                .select(padded("CARD", 9, i).alias("card_id"), "account_id",
                        self._pick(CARD_TYPES, i, 22).alias("card_type"),
                        self._pick(CARD_STATUS, i, 23).alias("card_status"),
                        F.col("open_date").alias("issued_date")))

    def transactions(self) -> DataFrame:
        i = F.col("i")
        account = self._ref("accounts", i, 31)
        day = F.to_date("batch_date")
        start = day.cast("timestamp")
        return self._dated("transactions").select(
            F.concat(F.lit("T"), F.date_format(day, "yyyyMMdd"), F.format_string("%010d", i)).alias("transaction_id"),
            padded("A", 9, account).alias("account_id"), self._account_customer(account).alias("customer_id"),
            padded("M", 6, self._ref("merchants", i, 32)).alias("merchant_id"),
            F.timestamp_add("SECOND", self._between(0, 86399, i, 33), start).alias("transaction_ts"),
            self._pick(TXN_TYPES, i, 34).alias("transaction_type"), self._pick(CHANNELS, i, 35).alias("channel"),
            self._pick(CATEGORIES, i, 36).alias("category"), self._money(10, 250_000, i, 37).alias("amount"),
            F.lit("INR").alias("currency"), self._pick(TXN_STATUS, i, 38).alias("status"),
            (h(i, 39, self.seed) % FRAUD_ONE_IN == FRAUD_ONE_IN - 1).alias("is_suspected_fraud"))

    def loan_applications(self) -> DataFrame:
        i = F.col("i")
        digits = F.replace(F.col("batch_date"), F.lit("-"), F.lit(""))
        return self._dated("loan_applications").select(
            F.concat(F.lit("L"), digits, F.format_string("%08d", i)).alias("application_id"),
            padded("C", 8, self._ref("customers", i, 41)).alias("customer_id"),
            F.to_date("batch_date").alias("application_date"),
            self._pick(LOAN_TYPES, i, 42).alias("loan_type"),
            self._money(50_000, 10_000_000, i, 43).alias("requested_amount"),
            self._pick(LOAN_STATUS, i, 44).alias("application_status"))


def synthesize(spark: SparkSession, root: str, sizes: dict[str, int] | None = None, seed: int = SEED,
               batch_date: str = BATCH) -> None:
    """Land a batch of all seven datasets as CSV in the raw zone under ``root``.

    ``sizes`` overrides rows per dataset (cards follow from the accounts).
    """
    sizes = {**SIZES, **(sizes or {})}
    made = Generator(lambda d: spark.range(sizes[d]).withColumnRenamed("id", "i"), sizes, seed, batch_date)
    zones = Zones(root)
    for dataset in DATASETS:
        write_raw_csv(getattr(made, dataset)(), zones.raw(dataset, batch_date))


# --- the registered queries: row numbers of the test tables -------------------

DRIVERS = {                      # dataset -> (test table, key column)
    "branches": ("supplier", "s_suppkey"),
    "merchants": ("part", "p_partkey"),
    "customers": ("customer", "c_custkey"),
    "accounts": ("orders", "o_orderkey"),
    "loan_applications": ("orders", "o_orderkey"),
    "transactions": ("orders", "o_orderkey"),
}
DAYS = (BATCH, "2026-05-01")       # of the queries that span two days
REFERRED = ("branches", "merchants", "customers", "accounts")


def _of_tables(spark: SparkSession, sf_dir: str, needs: tuple[str, ...], days: tuple[str, ...] = ()) -> Generator:
    def rows(dataset: str) -> DataFrame:
        table, key = DRIVERS[dataset]
        df = read_table(spark, sf_dir, table).select(F.col(key).alias("i"))
        if dataset == "transactions":
            lines = F.array(*[F.col("i") * LINES + k for k in range(LINES)])
            df = df.select(F.explode(lines).alias("i"))
        return df.withColumn("batch_date", F.explode(F.array(*map(F.lit, days)))) if days else df
    # how many rows the referred datasets have: a few numbers, sent with the plan
    sizes = {d: read_table(spark, sf_dir, DRIVERS[d][0]).count() for d in needs}
    return Generator(rows, sizes)


def _query(dataset: str, needs: tuple[str, ...], days: tuple[str, ...] = ()) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(_of_tables(spark, sf_dir, needs, days), dataset)()


def synth_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions of a batch as big as the test tables, landed as CSV with all other datasets and read back."""
    sizes = {d: read_table(spark, sf_dir, DRIVERS[d][0]).count() * (LINES if d == "transactions" else 1) for d in SIZES}
    root = fresh_dir(spark, "synth")
    synthesize(spark, root, sizes)
    contract = CONTRACTS["transactions"]
    raw = read_raw_csv(spark, Zones(root).raw("transactions", BATCH), contract)
    return raw.select(*[parse_column(raw, name, kind).alias(name) for name, kind in contract.columns])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "synth_branches": _query("branches", ()),
    "synth_merchants": _query("merchants", ()),
    "synth_customers": _query("customers", ("branches",)),
    "synth_accounts": _query("accounts", ("branches", "customers")),
    "synth_cards": _query("cards", ("branches", "customers")),
    "synth_transactions": _query("transactions", ("accounts", "customers", "merchants")),
    "synth_loan_applications": _query("loan_applications", ("customers",)),
    "synth_transactions_days": _query("transactions", ("accounts", "customers", "merchants"), DAYS),
    "synth_loans_days": _query("loan_applications", ("customers",), DAYS),
    "synth_landed": synth_landed,
}


# --- the same, as DuckDB SQL -------------------------------------------------

def _sql() -> dict[str, str]:
    n_b, n_c, n_a, n_m = (f"(select count(*) from {DRIVERS[d][0]})" for d in (
        "branches", "customers", "accounts", "merchants"))
    acct_cust = lambda a: below_sql(n_c, a, 11)
    accounts = f"""select i, {padded_sql('A', 9, 'i')} as account_id,
  {padded_sql('C', 8, acct_cust('i'))} as customer_id,
  {padded_sql('BR', 5, below_sql(n_b, 'i', 12))} as branch_id,
  {pick_sql(ACCOUNT_TYPES, 'i', 13)} as account_type,
  {pick_sql(ACCOUNT_STATUS, 'i', 14)} as account_status,
  {days_after_sql('2017-01-01', between_sql(0, 3200, 'i', 15))} as open_date,
  {money_sql(500, 2_000_000, 'i', 16)} as current_balance
from (select o_orderkey as i from orders) r"""
    orders = "select o_orderkey as i from orders"
    lines = f"select o_orderkey * {LINES} + k as i from orders, (select unnest(range({LINES})) as k) l"
    days = "(values " + ", ".join(f"('{d}')" for d in DAYS) + ") d(batch_date)"
    one_day = f"(select '{BATCH}' as batch_date) d"

    def transactions(numbers: str, dates: str) -> str:
        return f"""select 'T' || strftime(cast(batch_date as date), '%Y%m%d') || printf('%010d', i) as transaction_id,
  {padded_sql('A', 9, 'acct')} as account_id,
  {padded_sql('C', 8, acct_cust('acct'))} as customer_id,
  {padded_sql('M', 6, below_sql(n_m, 'i', 32))} as merchant_id,
  cast(batch_date as timestamp) + to_seconds({between_sql(0, 86399, 'i', 33)}) as transaction_ts,
  {pick_sql(TXN_TYPES, 'i', 34)} as transaction_type, {pick_sql(CHANNELS, 'i', 35)} as channel,
  {pick_sql(CATEGORIES, 'i', 36)} as category, {money_sql(10, 250_000, 'i', 37)} as amount,
  'INR' as currency, {pick_sql(TXN_STATUS, 'i', 38)} as status,
  ({h_sql('i', 39)} % {FRAUD_ONE_IN} = {FRAUD_ONE_IN - 1}) as is_suspected_fraud
from (select *, {below_sql(n_a, 'i', 31)} as acct from ({numbers}) n) r, {dates}"""

    def loans(dates: str) -> str:
        return f"""select 'L' || replace(batch_date, '-', '') || printf('%08d', i) as application_id,
  {padded_sql('C', 8, below_sql(n_c, 'i', 41))} as customer_id,
  cast(batch_date as date) as application_date, {pick_sql(LOAN_TYPES, 'i', 42)} as loan_type,
  {money_sql(50_000, 10_000_000, 'i', 43)} as requested_amount,
  {pick_sql(LOAN_STATUS, 'i', 44)} as application_status
from ({orders}) r, {dates}"""
    return {
        "synth_branches": f"""select {padded_sql('BR', 5, 'i')} as branch_id,
  {pick_sql(CITIES, 'i', 1)} || ' Main Branch ' || cast(i as varchar) as branch_name,
  {pick_sql(CITIES, 'i', 2)} as city, {pick_sql(STATES, 'i', 3)} as state,
  {pick_sql(REGIONS, 'i', 4)} as region
from (select s_suppkey as i from supplier) r""",
        "synth_merchants": f"""select {padded_sql('M', 6, 'i')} as merchant_id,
  'Merchant ' || cast(i as varchar) as merchant_name,
  {pick_sql(CATEGORIES, 'i', 5)} as merchant_category, {pick_sql(RISK_LEVELS, 'i', 6)} as risk_level
from (select p_partkey as i from part) r""",
        "synth_customers": f"""select {padded_sql('C', 8, 'i')} as customer_id,
  {pick_sql(FIRST_NAMES, 'i', 51)} as first_name, {pick_sql(LAST_NAMES, 'i', 52)} as last_name,
  {pick_sql(CITIES, 'i', 53)} as city, {pick_sql(STATES, 'i', 54)} as state,
  {pick_sql(KYC_STATUS, 'i', 55)} as kyc_status, {pick_sql(SEGMENTS, 'i', 56)} as customer_segment,
  {padded_sql('BR', 5, below_sql(n_b, 'i', 57))} as home_branch_id,
  {days_after_sql('2016-01-01', between_sql(0, 3650, 'i', 58))} as created_at
from (select c_custkey as i from customer) r""",
        "synth_accounts": f"""select account_id, customer_id, branch_id, account_type, account_status,
  open_date, current_balance from ({accounts}) a""",
        "synth_cards": f"""select {padded_sql('CARD', 9, 'i')} as card_id, account_id,
  {pick_sql(CARD_TYPES, 'i', 22)} as card_type, {pick_sql(CARD_STATUS, 'i', 23)} as card_status,
  open_date as issued_date
from ({accounts}) a where {h_sql('i', 21)} % 10 < {CARD_SHARE}""",
        "synth_transactions": transactions(lines, one_day),
        "synth_loan_applications": loans(one_day),
        "synth_transactions_days": transactions(lines, days),
        "synth_loans_days": loans(days),
        "synth_landed": transactions(f"select unnest(range((select {LINES} * count(*) from orders))) as i", one_day),
    }


SQL = _sql()
