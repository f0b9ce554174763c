"""Runs of the pipeline over the driver's test tables.

* ``lake_for`` lands the seven derived raw files as CSV for one batch date
  and runs the whole daily batch once per process and test folder; later
  queries read the tables it wrote.
* ``two_batch_fact`` upserts two batches into a fresh fact table: events
  before ``CUTOFF`` as batch A, the rest as batch B. Keys recurring on both
  sides are real updates, most of which change their date partition.
* ``streamed_fact`` feeds the same two batches through the incremental
  (file-stream) ingest instead.
* ``corrected_fact`` lands one batch date twice; the second delivery corrects
  some rows of the first and leaves others out.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.curate import curate_transactions
from ..operators.quality import validate
from ..session import fresh_dir
from ..sources.contracts import CONTRACTS, DATASETS
from ..sources.testbridge import BATCH_DATE, TXN_ORDER, raw_dataset, raw_transactions
from ..sources.zones import write_parquet, write_raw_csv
from .lake import Lake, run_parallel
from .tables import FactTable

# Fixed scenario values: the split between the two batches, their batch
# dates and commit times, and the time-travel instant (the reference's own
# example literal, which falls between the two commits).
CUTOFF = "1998-01-01"
BATCH_A, BATCH_B = BATCH_DATE, "2026-04-26"
COMMIT_A_TS, COMMIT_B_TS = "2026-04-25 06:00:00", "2026-04-26 06:00:00"
ASOF_TS = "2026-04-25 10:00:00"
# A date, a minute, with zones, between and after the commits.
ASOF_FORMS = ("2026-04-25", "2026-04-25 05:59", "2026-04-25 06:00", "2026-04-25T11:29:00+05:30",
              "2026-04-25T11:30:00+05:30", "2026-04-25T06:00:00Z", "2026-04-26", "2026-04-26 06:00:00.000001")

# Files of each day where a stream takes one at a time.
SPLIT_FILES = 3

# The derived batches hold about seven years of dates each, where a daily
# feed holds one; month partitions keep their files from being tiny.
FACT_PARTS = "yyyy-MM"

# Types of the tie-break columns the derived transaction feed carries, in
# the order they follow the contract columns in the feed file.
TXN_EXTRAS = {"l_partkey": "long", "l_suppkey": "long", "l_quantity": "double",
              "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
              "l_linestatus": "string"}

_LOCK = threading.RLock()
_BUILT: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, build):
    """What ``build`` made for this application and test folder; made once."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    with _LOCK:
        if key not in _BUILT:
            _BUILT[key] = build()
        return _BUILT[key]


def land_feed(spark: SparkSession, lake: Lake, sf_dir: str, batch_date: str,
              datasets=DATASETS) -> None:
    """Write the derived raw datasets as CSV feed files for ``batch_date``."""
    run_parallel({d: (lambda d=d: write_raw_csv(raw_dataset(spark, sf_dir, d),
                                                lake.zones.raw(d, batch_date)))
                  for d in datasets})


def lake_for(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake holding one full daily batch of the test data (built once, in a folder of its own)."""
    def build() -> Lake:
        lake = Lake(spark, fresh_dir(spark, "lake"), FACT_PARTS)
        land_feed(spark, lake, sf_dir, BATCH_DATE)
        lake.run_batch(BATCH_DATE, orders={"transactions": TXN_ORDER},
                       extra_types={"transactions": TXN_EXTRAS}, commit_ts=COMMIT_A_TS)
        return lake
    return _once(spark, sf_dir, "lake", build)


def batch_events(spark: SparkSession, sf_dir: str, lake: Lake, which: str) -> DataFrame:
    """Curated transaction events of batch A (before the cutoff) or B (from it)."""
    raw = raw_transactions(spark, sf_dir)
    ts = F.col("transaction_ts")
    cut = F.lit(f"{CUTOFF} 00:00:00").cast("timestamp")
    part, batch = (raw.filter(ts < cut), BATCH_A) if which == "A" else (raw.filter(ts >= cut), BATCH_B)
    valid = validate(part, CONTRACTS["transactions"], batch, order=TXN_ORDER, stamp=False)
    return curate_transactions(valid, lake.table("dim_merchants").read())


def staged_events(spark: SparkSession, sf_dir: str, lake: Lake, which: str) -> DataFrame:
    """Batch events written once to the staging zone, then read from there."""
    def build() -> str:
        batch = BATCH_A if which == "A" else BATCH_B
        path = f"{lake.root}/scenario/events_{which}/batch_date={batch}"
        write_parquet(batch_events(spark, sf_dir, lake, which), path)
        return path
    return spark.read.parquet(_once(spark, sf_dir, f"events-{which}", build))


def two_batch_fact(spark: SparkSession, sf_dir: str, repeat_b: bool = False) -> FactTable:
    """A fact table after upserting batch A, then B (then B again if ``repeat_b``)."""
    def build() -> FactTable:
        lake = lake_for(spark, sf_dir)
        table = FactTable(spark, f"{lake.root}/scenario/fact{'_repeat' if repeat_b else ''}", FACT_PARTS)
        a = staged_events(spark, sf_dir, lake, "A")
        b = staged_events(spark, sf_dir, lake, "B")
        table.merge(a, commit_ts=COMMIT_A_TS)
        table.merge(b, commit_ts=COMMIT_B_TS)
        if repeat_b:
            table.merge(b)
        return table
    return _once(spark, sf_dir, f"two-batch-{repeat_b}", build)


def streamed_fact(spark: SparkSession, sf_dir: str, split: bool = False) -> FactTable:
    """The two batches landed as CSV one after the other, each picked up by the stream.

    With ``split`` both land first, the later day before the earlier one, their
    duplicates spread over several files, and a micro-batch takes one file.
    """
    from ..streaming.ingest import TransactionIngest

    def build() -> FactTable:
        lake = lake_for(spark, sf_dir)
        root = f"{lake.root}/scenario/stream{'-split' if split else ''}"
        ingest = TransactionIngest(spark, landing=f"{root}/landing/transactions",
                                   checkpoint=f"{root}/checkpoint",
                                   fact=FactTable(spark, f"{root}/fact", FACT_PARTS, TXN_EXTRAS),
                                   merchants=lambda: lake.table("dim_merchants").read(),
                                   order=TXN_ORDER, extras=TXN_EXTRAS, max_files=1 if split else 1000)
        raw = raw_transactions(spark, sf_dir, SPLIT_FILES if split else 0)
        cut = F.lit(f"{CUTOFF} 00:00:00").cast("timestamp")
        batches = [(BATCH_A, raw.filter(F.col("transaction_ts") < cut)), (BATCH_B, raw.filter(F.col("transaction_ts") >= cut))]
        for batch, rows in reversed(batches) if split else batches:
            # what is dealt over few large files stays readable in pieces, and a file stays one micro-batch
            plain = {"compression": "none", "max_rows": 0} if split else {}
            write_raw_csv(rows, f"{ingest.landing}/batch_date={batch}", **plain)
            if not split:
                ingest.run_available()
        if split:
            ingest.run_available()
        return ingest.fact
    return _once(spark, sf_dir, f"stream-{split}", build)


def corrected_fact(spark: SparkSession, sf_dir: str) -> FactTable:
    """The fact after a day was run, landed again with corrections, and run again.

    The first delivery has every amount too low by 1; the second has the right
    amounts, without the rows of every third part. Those keep their first state.
    """
    def build() -> FactTable:
        lake = Lake(spark, fresh_dir(spark, "rerun"), FACT_PARTS)
        raw = raw_transactions(spark, sf_dir)
        deliveries = (raw.withColumn("amount", F.col("amount") - 1), raw.filter("l_partkey % 3 <> 0"))
        land_feed(spark, lake, sf_dir, BATCH_DATE, ("merchants",))
        lake.validate_raw(BATCH_DATE, datasets=("merchants",))
        for rows in deliveries:
            write_raw_csv(rows, lake.zones.raw("transactions", BATCH_DATE))
            lake.validate_raw(BATCH_DATE, {"transactions": TXN_ORDER}, {"transactions": TXN_EXTRAS},
                              ("transactions",))
            lake.curate(BATCH_DATE, ("transaction_events",))
            lake.merge_fact(BATCH_DATE)
        return lake.fact
    return _once(spark, sf_dir, "rerun", build)
