"""Benchmark: the daily batch and the headline queries at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line. ``pipeline`` is the whole daily batch from landed CSV
(validate 7, curate 3, load 4 dimensions, upsert the fact, build 4
summaries); each query is timed on the tables that batch wrote, forced
through a no-op sink, best of two runs. ``two_batch_merge`` upserts two
batches into a fresh fact table. The inputs are first dealt over as many files
as there are cores (untimed), as a cluster's inputs are: one file is one task.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.operators import reports  # noqa: E402
from ledgerlens.plans import scenarios  # noqa: E402
from ledgerlens.plans.lake import Lake  # noqa: E402
from ledgerlens.plans.registry import QUERIES  # noqa: E402
from ledgerlens.session import build_session, fresh_dir  # noqa: E402
from ledgerlens.sources.testbridge import BATCH_DATE, TEST_TABLES, TXN_ORDER, read_table  # noqa: E402


def timed(fn):
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def sink(df):
    df.write.format("noop").mode("overwrite").save()


def dealt(spark, sf_dir: str, files: int) -> str:
    """A copy of the input tables of which the large ones lie in ``files`` files."""
    out = fresh_dir(spark, "bench-input")
    for name in TEST_TABLES:
        df = read_table(spark, sf_dir, name)
        (df.repartition(files) if name in ("customer", "orders", "lineitem", "part") else df).write.parquet(
            f"{out}/{name}.parquet")
    return out


def main() -> None:
    source = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", max(8, cpus))
    sf_dir = dealt(spark, source, cpus)
    times: dict[str, float] = {}

    lake = Lake(spark, fresh_dir(spark, "bench-lake"), scenarios.FACT_PARTS)
    times["land_feed"] = timed(lambda: scenarios.land_feed(spark, lake, sf_dir, BATCH_DATE))
    times["pipeline"] = timed(lambda: lake.run_batch(
        BATCH_DATE, orders={"transactions": TXN_ORDER},
        extra_types={"transactions": scenarios.TXN_EXTRAS}))

    fact = lambda: lake.fact.read()
    dim = lambda n: lake.table(n).read()
    headline = {
        "daily_branch_summary": lambda: lake.summary("daily_branch_summary"),
        "customer_risk_summary": lambda: lake.summary("customer_risk_summary"),
        "merchant_spend_summary": lambda: lake.summary("merchant_spend_summary"),
        "account_balance_snapshot": lambda: lake.summary("account_balance_snapshot"),
        "daily_channel_volume": lambda: reports.daily_channel_volume(fact()),
        "high_risk_merchants": lambda: reports.high_risk_merchants(fact(), dim("dim_merchants")),
        "top_branch_regions": lambda: reports.top_branch_regions(fact(), dim("dim_accounts"),
                                                                 dim("dim_branches")),
        "check_by_date": lambda: reports.check_by_date(fact()),
        "validate_transactions": lambda: QUERIES["validate_transactions"](spark, sf_dir),
        "transform_transactions": lambda: QUERIES["transform_transactions"](spark, sf_dir),
    }
    for name, build in headline.items():
        times[name] = min(timed(lambda: sink(build())) for _ in range(2))

    from ledgerlens.plans.tables import FactTable
    events = {w: scenarios.batch_events(spark, sf_dir, lake, w) for w in ("A", "B")}
    staged = {}
    for w, df in events.items():
        path = lake.zones.staging(f"bench_events_{w}", BATCH_DATE)
        df.write.mode("overwrite").parquet(path)
        staged[w] = spark.read.parquet(path)
    table = FactTable(spark, fresh_dir(spark, "bench-fact"), scenarios.FACT_PARTS)
    times["two_batch_merge"] = timed(lambda: (table.merge(staged["A"]), table.merge(staged["B"])))

    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": {k: round(v, 3) for k, v in times.items()},
                      "sf": os.path.basename(source.rstrip("/")).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()
