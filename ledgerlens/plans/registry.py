"""Every query and job of the reference as ``(spark, sf_dir) -> DataFrame``.

Upstream stages (validation, curation) are computed directly from the
derived raw data, so they exercise the operators without I/O. Downstream
queries read the tables the daily batch wrote (``scenarios.lake_for``), as
the reference's jobs and SQL do. Wall-clock columns (``validated_at``) are
left out of compared outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import curate, reports, summaries
from ..operators.quality import duplicate_keys, require_not_null, validate
from ..sources.contracts import CONTRACTS, DATASETS, FACT_COLUMNS
from ..sources.testbridge import BATCH_DATE, dedupe_order, raw_dataset
from ..sources import landing, synth
from ..sources.zones import export_result, write_raw_csv
from ..session import fresh_dir
from . import catalog, scenarios
from .lake import Lake

Query = Callable[[SparkSession, str], DataFrame]


def _validated(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    return validate(raw_dataset(spark, sf_dir, dataset), CONTRACTS[dataset], BATCH_DATE,
                    order=dedupe_order(dataset), stamp=False)


def _validate_query(dataset: str) -> Query:
    return lambda spark, sf_dir: _validated(spark, sf_dir, dataset)


def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that arrive more than once: the row kept and how many copies there were."""
    contract = CONTRACTS["transactions"]
    copies = duplicate_keys(require_not_null(raw_dataset(spark, sf_dir, "transactions"),
                                             contract.required), contract.key)
    kept = _validated(spark, sf_dir, "transactions")
    return kept.join(copies, contract.key).select("transaction_id", "transaction_ts", "amount",
                                                  "copies")


def zone_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated transactions as written to and read back from the validated zone."""
    return scenarios.lake_for(spark, sf_dir).validated("transactions", BATCH_DATE) \
        .drop("validated_at")


def transform_customers(spark, sf_dir):
    return curate.curate_customers(_validated(spark, sf_dir, "customers"))


def transform_accounts(spark, sf_dir):
    return curate.curate_accounts(_validated(spark, sf_dir, "accounts"))


def transform_transactions(spark, sf_dir):
    return curate.curate_transactions(_validated(spark, sf_dir, "transactions"),
                                      _validated(spark, sf_dir, "merchants"))


def _dim(name: str) -> Query:
    def run(spark, sf_dir):
        df = scenarios.lake_for(spark, sf_dir).table(name).read()
        return df.drop("validated_at") if "validated_at" in df.columns else df
    return run


def _fact(spark, sf_dir) -> DataFrame:
    return scenarios.lake_for(spark, sf_dir).fact.read()


def _dims(spark, sf_dir, *names) -> list[DataFrame]:
    lake = scenarios.lake_for(spark, sf_dir)
    return [lake.table(n).read() for n in names]


def _summary(name: str) -> Query:
    return lambda spark, sf_dir: scenarios.lake_for(spark, sf_dir).summary(name)


def merge_transactions(spark, sf_dir):
    return scenarios.two_batch_fact(spark, sf_dir).read().select(*FACT_COLUMNS)


def merge_idempotent(spark, sf_dir):
    return scenarios.two_batch_fact(spark, sf_dir, repeat_b=True).read().select(*FACT_COLUMNS)


def merge_partition_move(spark, sf_dir):
    """Rows per date partition of the stored table after updates that move dates."""
    fact = scenarios.two_batch_fact(spark, sf_dir).read()
    return fact.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("transaction_count"))


def asof_fact(spark, sf_dir):
    return scenarios.two_batch_fact(spark, sf_dir).read(at=scenarios.ASOF_TS)


def asof_count(spark, sf_dir):
    return reports.row_count(asof_fact(spark, sf_dir), "transaction_count")


def merge_corrected_rerun(spark, sf_dir):
    return scenarios.corrected_fact(spark, sf_dir).read().select(*FACT_COLUMNS)


def asof_forms(spark, sf_dir):
    """Rows of the two-batch fact as of timestamps written in several forms."""
    table = scenarios.two_batch_fact(spark, sf_dir)
    out = None
    for at in scenarios.ASOF_FORMS:
        one = table.read(at=at).agg(F.count(F.lit(1)).alias("transaction_count")).select(
            F.lit(at).alias("as_of"), "transaction_count")
        out = one if out is None else out.unionByName(one)
    return out


# The business questions as SQL over the registered tables; {total} is an exact sum of the amounts.
SQL_REPORTS = {
    "sql_daily_channel_volume": """
        SELECT transaction_date, channel, count(*) AS transaction_count, {total} AS total_amount
        FROM {db}.fact_transactions GROUP BY transaction_date, channel
        ORDER BY transaction_date DESC, total_amount DESC""",
    "sql_high_risk_merchants": """
        SELECT m.merchant_category, m.risk_level, count(f.transaction_id) AS transaction_count, {total} AS total_amount
        FROM {db}.fact_transactions f JOIN {db}.dim_merchants m ON f.merchant_id = m.merchant_id
        WHERE f.transaction_risk_band = 'HIGH' GROUP BY m.merchant_category, m.risk_level ORDER BY total_amount DESC""",
    "sql_top_branch_regions": """
        SELECT b.region, b.state, b.city, count(*) AS transaction_count, {total} AS total_amount
        FROM {db}.fact_transactions f JOIN {db}.dim_accounts a ON f.account_id = a.account_id
        JOIN {db}.dim_branches b ON a.branch_id = b.branch_id GROUP BY b.region, b.state, b.city
        ORDER BY total_amount DESC NULLS LAST, region NULLS LAST, state NULLS LAST, city NULLS LAST LIMIT 20""",
    "sql_customer_risk_ranked": """
        SELECT customer_segment, customer_risk_band, customer_count, transaction_count, total_transaction_amount
        FROM {db}.customer_risk_summary ORDER BY total_transaction_amount DESC""",
}
TOTAL = "CAST(sum(CAST(amount AS DECIMAL(28,6))) AS DOUBLE)"


def _sql_report(name: str) -> Query:
    def run(spark, sf_dir):
        database = scenarios.lake_for(spark, sf_dir).register()
        return spark.sql(SQL_REPORTS[name].format(db=database, total=TOTAL))
    return run


def sql_asof_count(spark, sf_dir):
    """Rows of the two-batch fact as of a time, asked in SQL of a database registered as of it."""
    catalog.create_database(spark, "ledgerlens_asof")
    catalog.put_fact(spark, "ledgerlens_asof", "fact_transactions", scenarios.two_batch_fact(spark, sf_dir),
                     at=scenarios.ASOF_TS)
    return spark.sql("SELECT count(*) AS transaction_count FROM ledgerlens_asof.fact_transactions")


def export_roundtrip(spark, sf_dir):
    """The customer risk report as exported to CSV and read back."""
    report = customer_risk_ranked(spark, sf_dir)
    path = fresh_dir(spark, "export")
    export_result(report, path)
    return spark.read.schema(report.schema).option("header", True).option("enforceSchema", False).csv(path)


def partial_batch_completeness(spark, sf_dir):
    """Arrival check of a batch folder with one file without rows and all other datasets missing but two."""
    lake = Lake(spark, fresh_dir(spark, "partial"))
    scenarios.land_feed(spark, lake, sf_dir, BATCH_DATE, ("branches", "customers"))
    write_raw_csv(raw_dataset(spark, sf_dir, "cards").limit(0), lake.zones.raw("cards", BATCH_DATE))
    return landing.batch_completeness(spark, lake.zones.raw_batch(BATCH_DATE))


def incremental_upsert(spark, sf_dir):
    return scenarios.streamed_fact(spark, sf_dir).read().select(*FACT_COLUMNS)


def incremental_upsert_split(spark, sf_dir):
    """The same days in files that arrive in the wrong order, one a micro-batch."""
    return scenarios.streamed_fact(spark, sf_dir, split=True).read().select(*FACT_COLUMNS)


def daily_channel_volume(spark, sf_dir):
    return reports.daily_channel_volume(_fact(spark, sf_dir))


def high_risk_merchants(spark, sf_dir):
    return reports.high_risk_merchants(_fact(spark, sf_dir), *_dims(spark, sf_dir, "dim_merchants"))


def top_branch_regions(spark, sf_dir):
    return reports.top_branch_regions(_fact(spark, sf_dir),
                                      *_dims(spark, sf_dir, "dim_accounts", "dim_branches"))


def customer_risk_ranked(spark, sf_dir):
    return reports.customer_risk_ranked(*_dims(spark, sf_dir, "customer_risk_summary"))


def check_fact_count(spark, sf_dir):
    return reports.row_count(_fact(spark, sf_dir), "transaction_count")


def check_by_date(spark, sf_dir):
    return reports.check_by_date(_fact(spark, sf_dir))


def check_risk_band(spark, sf_dir):
    return reports.check_risk_band(_fact(spark, sf_dir))


def check_risk_band_rows(spark, sf_dir):
    return reports.check_risk_band(_fact(spark, sf_dir), "row_count")


def check_high_risk_success(spark, sf_dir):
    return reports.check_high_risk_success(_fact(spark, sf_dir))


def check_customer_count(spark, sf_dir):
    return reports.row_count(*_dims(spark, sf_dir, "dim_customers"), "customer_count")


def check_account_count(spark, sf_dir):
    return reports.row_count(*_dims(spark, sf_dir, "dim_accounts"), "account_count")


def quality_report(spark, sf_dir):
    return reports.quality_report(_fact(spark, sf_dir),
                                  *_dims(spark, sf_dir, "dim_customers", "dim_accounts"))


def batch_completeness(spark, sf_dir):
    lake = scenarios.lake_for(spark, sf_dir)
    return landing.batch_completeness(spark, lake.zones.raw_batch(BATCH_DATE))


QUERIES: dict[str, Query] = {
    **{f"validate_{d}": _validate_query(d) for d in DATASETS},
    "dedupe_by_key": dedupe_by_key,
    "zone_roundtrip": zone_roundtrip,
    "transform_customers": transform_customers,
    "transform_accounts": transform_accounts,
    "transform_transactions": transform_transactions,
    "load_dim_customers": _dim("dim_customers"),
    "load_dim_accounts": _dim("dim_accounts"),
    "load_dim_merchants": _dim("dim_merchants"),
    "load_dim_branches": _dim("dim_branches"),
    "merge_transactions": merge_transactions,
    "merge_idempotent": merge_idempotent,
    "merge_partition_move": merge_partition_move,
    "merge_corrected_rerun": merge_corrected_rerun,
    "incremental_upsert": incremental_upsert,
    "incremental_upsert_split": incremental_upsert_split,
    "asof_fact": asof_fact,
    "asof_count": asof_count,
    "asof_forms": asof_forms,
    **{name: _summary(name) for name in summaries.SUMMARIES},
    "daily_channel_volume": daily_channel_volume,
    "high_risk_merchants": high_risk_merchants,
    "top_branch_regions": top_branch_regions,
    "customer_risk_ranked": customer_risk_ranked,
    "check_fact_count": check_fact_count,
    "check_by_date": check_by_date,
    "check_risk_band": check_risk_band,
    "check_risk_band_rows": check_risk_band_rows,
    "check_high_risk_success": check_high_risk_success,
    "check_customer_count": check_customer_count,
    "check_account_count": check_account_count,
    "quality_report": quality_report,
    "batch_completeness": batch_completeness,
    "partial_batch_completeness": partial_batch_completeness,
    **{name: _sql_report(name) for name in SQL_REPORTS},
    "sql_asof_count": sql_asof_count,
    "export_roundtrip": export_roundtrip,
    **synth.QUERIES,
}
