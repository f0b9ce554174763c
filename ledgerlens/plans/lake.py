"""The daily batch: raw feed -> validated -> curated -> dimensions + fact -> summaries.

Each stage reads what the previous stage wrote, as the feed's jobs do, so a
lost executor costs a task retry and a lost driver costs a re-run of the
stage, never a recomputation from the raw files. Independent jobs of a stage
(seven validations, three curations, four dimension loads, four summaries)
are submitted together from threads and share the cluster.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators import curate, summaries
from ..operators.quality import validate
from ..sources.contracts import CONTRACTS, DATASETS, DIM_SCHEMAS, Sort
from ..sources.zones import Zones, read_raw_csv, require_schema, write_parquet
from . import catalog
from .tables import FactTable, ReplaceTable

DIMENSIONS = tuple(DIM_SCHEMAS)
CURATED = ("customer_profile", "account_master", "transaction_events")


def run_parallel(jobs: dict, workers: int = 8) -> dict:
    """Run independent Spark actions concurrently; re-raise the first failure."""
    if len(jobs) <= 1:
        return {name: fn() for name, fn in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(jobs))) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


@dataclass
class Lake:
    """Zones and tables under one root folder."""

    spark: SparkSession
    root: str
    fact_part_format: str = "yyyy-MM-dd"
    zones: Zones = field(init=False)

    def __post_init__(self):
        self.root = self.root.rstrip("/")
        self.zones = Zones(self.root)

    def table(self, name: str) -> ReplaceTable:
        return ReplaceTable(self.spark, self.zones.warehouse(name))

    @property
    def fact(self) -> FactTable:
        return FactTable(self.spark, self.zones.warehouse("fact_transactions"),
                         self.fact_part_format)

    def validated(self, dataset: str, batch_date: str) -> DataFrame:
        return self.spark.read.parquet(self.zones.validated(dataset, batch_date))

    def staged(self, name: str, batch_date: str) -> DataFrame:
        return self.spark.read.parquet(self.zones.staging(name, batch_date))

    # --- stages -----------------------------------------------------------

    def validate_raw(self, batch_date: str, orders: dict[str, tuple[Sort, ...]] | None = None,
                     extra_types: dict[str, dict[str, str]] | None = None,
                     datasets=DATASETS) -> None:
        """Raw CSV of each dataset -> validated Parquet (S1, P4, P5, P7, A13)."""
        orders, extra_types = orders or {}, extra_types or {}

        def job(dataset: str):
            contract = CONTRACTS[dataset]
            extras = extra_types.get(dataset, {})
            raw = read_raw_csv(self.spark, self.zones.raw(dataset, batch_date), contract,
                               extras=extras)
            out = validate(raw, contract, batch_date, order=orders.get(dataset))
            write_parquet(out, self.zones.validated(dataset, batch_date))

        run_parallel({d: (lambda d=d: job(d)) for d in datasets})

    def curate(self, batch_date: str, names=CURATED) -> None:
        """Validated -> customer_profile, account_master, transaction_events (one or all)."""
        v = lambda d: self.validated(d, batch_date)
        jobs = {
            "customer_profile": lambda: curate.curate_customers(v("customers")),
            "account_master": lambda: curate.curate_accounts(v("accounts")),
            "transaction_events": lambda: curate.curate_transactions(v("transactions"),
                                                                     v("merchants")),
        }
        run_parallel({name: (lambda name=name: write_parquet(
            jobs[name](), self.zones.staging(name, batch_date))) for name in names})

    def load_dimensions(self, batch_date: str) -> None:
        """Full refresh of the four dimensions from the latest batch (S10)."""
        sources = {
            "dim_customers": lambda: self.staged("customer_profile", batch_date),
            "dim_accounts": lambda: self.staged("account_master", batch_date),
            "dim_merchants": lambda: self.validated("merchants", batch_date),
            "dim_branches": lambda: self.validated("branches", batch_date),
        }
        run_parallel({name: (lambda name=name, src=src: self.table(name).replace(
            require_schema(src(), DIM_SCHEMAS[name], name))) for name, src in sources.items()})

    def merge_fact(self, batch_date: str, commit_ts=None) -> None:
        """Upsert the batch's transaction events into the fact (S12); a corrected day replaces its rows."""
        self.fact.merge(self.staged("transaction_events", batch_date), commit_ts=commit_ts)

    def summary(self, name: str) -> DataFrame:
        """A summary computed from the current fact and dimensions."""
        dim = lambda n: self.table(n).read()
        if name == "daily_branch_summary":
            return summaries.daily_branch_summary(self.fact.read(), dim("dim_accounts"), dim("dim_branches"))
        if name == "customer_risk_summary":
            return summaries.customer_risk_summary(dim("dim_customers"), self.fact.read())
        if name == "merchant_spend_summary":
            return summaries.merchant_spend_summary(dim("dim_merchants"), self.fact.read())
        if name == "account_balance_snapshot":
            return summaries.account_balance_snapshot(dim("dim_accounts"))
        raise KeyError(name)

    def build_summaries(self, names=summaries.SUMMARIES) -> None:
        """Full refresh of the summary tables (S11, S16: one or all)."""
        run_parallel({n: (lambda n=n: self.table(n).replace(self.summary(n))) for n in names})

    def run_batch(self, batch_date: str, orders=None, extra_types=None, commit_ts=None) -> None:
        """The whole daily batch for raw files already landed for ``batch_date``."""
        self.validate_raw(batch_date, orders, extra_types)
        self.curate(batch_date)
        self.load_dimensions(batch_date)
        self.merge_fact(batch_date, commit_ts)
        self.build_summaries()

    def register(self, database: str = "ledgerlens", at=None) -> str:
        """SQL access (S6, S7, S14): every built table as ``database.table``, now or as of ``at``.

        The database is created if absent. Lakes registered under different
        names stand side by side; see ``catalog`` for what is created.
        """
        catalog.create_database(self.spark, database)
        catalog.put_fact(self.spark, database, "fact_transactions", self.fact, at)
        for name in (*DIMENSIONS, *summaries.SUMMARIES):
            catalog.put_table(self.spark, database, name, self.table(name), at)
        return database
