"""Landing, re-landing and streaming of the feed."""

import os

import pytest

from ledgerlens.plans.lake import Lake
from ledgerlens.plans.tables import FactTable
from ledgerlens.sources import landing, synth
from ledgerlens.sources.contracts import CONTRACTS
from ledgerlens.sources.zones import read_raw_csv
from ledgerlens.streaming.ingest import TransactionIngest

HEADER = ",".join(CONTRACTS["transactions"].names)
DAY = "2026-04-25"


def _line(tid, amount):
    return f"{tid},A1,C1,M1,2026-04-25 10:00:00,DEBIT,UPI,FUEL,{amount},INR,SUCCESS,False"


def _csv(path, lines, header=HEADER):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join([header, *lines]) + "\n")


def _amounts(fact):
    return {r.transaction_id: r.amount for r in fact.read().collect()}


def test_corrected_rerun_through_the_lake(spark, scratch):
    lake = Lake(spark, scratch)
    _csv(f"{scratch}/raw/batch_date={DAY}/merchants.csv", ["M1,Shop,FUEL,LOW"],
         "merchant_id,merchant_name,merchant_category,risk_level")
    lake.validate_raw(DAY, datasets=("merchants",))
    for lines in ([_line("T1", 10)], [_line("T1", 99), _line("T2", 5)]):
        _csv(f"{scratch}/raw/batch_date={DAY}/transactions.csv", lines)
        lake.validate_raw(DAY, datasets=("transactions",))
        lake.curate(DAY, ("transaction_events",))
        lake.merge_fact(DAY)
    assert _amounts(lake.fact) == {"T1": 99.0, "T2": 5.0}


def _ingest(spark, scratch, feed, fact, **more):
    merchants = spark.createDataFrame([("M1", "LOW")], "merchant_id string, risk_level string")
    return TransactionIngest(spark, f"{scratch}/{feed}", f"{scratch}/{feed}-checkpoint", fact, lambda: merchants, **more)


def test_second_feed_late_file_and_reset_checkpoint(spark, scratch):
    fact = FactTable(spark, f"{scratch}/fact")
    _csv(f"{scratch}/one/batch_date={DAY}/a.csv", [_line("T1", 1)])
    first = _ingest(spark, scratch, "one", fact)
    first.run_available()
    _csv(f"{scratch}/two/batch_date={DAY}/a.csv", [_line("T2", 2)])
    _ingest(spark, scratch, "two", fact).run_available()
    assert _amounts(fact) == {"T1": 1.0, "T2": 2.0}
    _csv(f"{scratch}/one/batch_date={DAY}/late.csv", [_line("T3", 3)])
    first.run_available()
    assert _amounts(fact) == {"T1": 1.0, "T2": 2.0, "T3": 3.0}
    again = _ingest(spark, scratch, "one", fact, max_files=1)
    again.checkpoint += "-new"
    again.run_available()
    assert _amounts(fact) == {"T1": 1.0, "T2": 2.0, "T3": 3.0}


def test_reordered_header_of_a_part_is_an_error(spark, scratch):
    names = "branch_id,branch_name,city,state,region"
    _csv(f"{scratch}/branches.csv/part-0.csv", ["B1,Main,X,S1,WEST"], names)
    _csv(f"{scratch}/branches.csv/part-1.csv", ["B2,EAST,X,S1,Second"], "branch_id,region,city,state,branch_name")
    with pytest.raises(Exception, match="CSV header"):
        read_raw_csv(spark, f"{scratch}/branches.csv", CONTRACTS["branches"]).collect()


def test_completeness_of_an_empty_file_and_of_nothing(spark, scratch):
    folder = f"{scratch}/raw/batch_date={DAY}"
    _csv(f"{folder}/cards.csv", [], ",".join(CONTRACTS["cards"].names))
    _csv(f"{folder}/branches.csv", ["B1,Main,X,S1,WEST", "B2,Main,X,S1,WEST"], "branch_id,branch_name,city,state,region")
    got = {r.dataset: (r.file_present, r.row_count) for r in landing.batch_completeness(spark, folder).collect()}
    assert got["cards"] == (True, 0) and got["branches"] == (True, 2) and got["merchants"] == (False, 0)
    assert {tuple(r)[1:] for r in landing.batch_completeness(spark, f"{scratch}/none").collect()} == {(False, 0)}


def test_validated_at_is_stamped(spark, scratch):
    lake = Lake(spark, scratch)
    _csv(f"{scratch}/raw/batch_date={DAY}/branches.csv", ["B1,Main,X,S1,WEST"], "branch_id,branch_name,city,state,region")
    before = spark.sql("SELECT current_timestamp() AS t").first().t
    lake.validate_raw(DAY, datasets=("branches",))
    row = lake.validated("branches", DAY).first()
    assert row.validated_at >= before and row.batch_date == DAY


def test_ids_keep_all_digits(spark):
    from pyspark.sql import functions as F

    from ledgerlens.sources.testbridge import _padded
    keys = [7, 99999, 100000, 1000000, 1000001, 1000009, 12345678901]
    df = spark.createDataFrame([(k,) for k in keys], "k long").select(_padded("M", F.col("k"), 6).alias("id"))
    ids = [r.id for r in df.collect()]
    assert ids[0] == "M000007" and len(set(ids)) == len(keys) and ids[-1] == "M12345678901"


def test_synthesis_is_sound(spark, scratch):
    sizes = {"branches": 40, "merchants": 300, "customers": 2000, "accounts": 3000, "transactions": 20000,
             "loan_applications": 500}
    synth.synthesize(spark, scratch, sizes, seed=7, batch_date=DAY)
    lake = Lake(spark, scratch)
    read = lambda d: read_raw_csv(spark, lake.zones.raw(d, DAY), CONTRACTS[d])
    tables = {d: read(d).cache() for d in CONTRACTS}
    for d, n in sizes.items():
        key = CONTRACTS[d].key
        assert tables[d].count() == n == tables[d].select(key).distinct().count(), d
    for d, key, target in (("accounts", "customer_id", "customers"), ("accounts", "branch_id", "branches"),
                           ("customers", "home_branch_id", "branches"), ("cards", "account_id", "accounts"),
                           ("transactions", "account_id", "accounts"), ("transactions", "merchant_id", "merchants"),
                           ("transactions", "customer_id", "customers"), ("loan_applications", "customer_id", "customers")):
        ref = CONTRACTS[target].key
        orphans = tables[d].join(tables[target], tables[d][key] == tables[target][ref], "left_anti").count()
        assert orphans == 0, (d, key)
    t = tables["transactions"]
    pairs = t.join(tables["merchants"], "merchant_id").groupBy("category", "merchant_category").count()
    assert pairs.count() == 64
    assert t.groupBy("category", "transaction_type").count().count() == 16
    share = {r.status: r["count"] / 20000 for r in t.groupBy("status").count().collect()}
    assert abs(share["SUCCESS"] - 0.6) < 0.02 and abs(share["FAILED"] - 0.2) < 0.02
    places = tables["customers"].groupBy("city", "customer_segment").count()
    assert places.count() == 32
    cards = tables["cards"].count() / 3000
    assert abs(cards - 0.7) < 0.04


def test_sql_by_table_name(spark, scratch):
    lake = Lake(spark, scratch)
    lake.table("dim_branches").replace(spark.createDataFrame([("B1", 2)], "branch_id string, n int"))
    assert lake.register("ledgerlens_test") == "ledgerlens_test"
    assert spark.sql("SHOW DATABASES LIKE 'ledgerlens_test'").count() == 1
    assert spark.sql("SELECT sum(n) AS n FROM ledgerlens_test.dim_branches").first().n == 2


def test_micro_batches_of_any_size_give_one_table(spark, scratch):
    """Duplicates over several files of two days: one file a micro-batch, or all, in any order of arrival."""
    from ledgerlens.sources.contracts import Sort
    files = {("2026-04-25", "a"): [_line("T1", 5), _line("T2", 1)], ("2026-04-25", "b"): [_line("T1", 3), _line("T3", 9)],
             ("2026-04-26", "a"): [_line("T3", 4), _line("T4", 2)], ("2026-04-26", "b"): [_line("T4", 8)]}
    order = (Sort("amount", descending=True),)
    tables = []
    for k, (names, max_files) in enumerate(((sorted(files), 1000), (sorted(files), 1), (sorted(files, reverse=True), 1))):
        fact = FactTable(spark, f"{scratch}/fact{k}")
        ingest = _ingest(spark, scratch, f"feed{k}", fact, max_files=max_files, order=order)
        for day, name in names:
            _csv(f"{scratch}/feed{k}/batch_date={day}/{name}.csv", files[day, name])
            if max_files == 1:
                ingest.run_available()
        ingest.run_available()
        tables.append(_amounts(fact))
    assert tables == [{"T1": 5.0, "T2": 1.0, "T3": 4.0, "T4": 8.0}] * 3
    with pytest.raises(ValueError, match="order columns"):
        _ingest(spark, scratch, "none", FactTable(spark, f"{scratch}/other"), order=(Sort("l_partkey"),))


def test_times_with_a_zone(spark, scratch):
    texts = {"T1": "2026-04-25 10:00:00", "T2": "2026-04-25T10:00:00+05:30", "T3": "2026-04-25T23:30:00-02:00",
             "T4": "2026-04-25T10:00:00Z", "T5": "no time", "T6": ""}
    lake = Lake(spark, scratch)
    _csv(f"{scratch}/raw/batch_date={DAY}/merchants.csv", ["M1,Shop,FUEL,LOW"],
         "merchant_id,merchant_name,merchant_category,risk_level")
    _csv(f"{scratch}/raw/batch_date={DAY}/transactions.csv", [
        _line(t, 1).replace("2026-04-25 10:00:00", text) for t, text in texts.items()])
    lake.validate_raw(DAY, datasets=("merchants", "transactions"))
    lake.curate(DAY, ("transaction_events",))
    lake.merge_fact(DAY)
    assert dict(lake.fact.read().dtypes)["transaction_ts"] == "timestamp"
    got = {r.transaction_id: (r.t, r.d) for r in lake.fact.read().selectExpr(
        "transaction_id", "cast(transaction_ts AS string) t", "cast(transaction_date AS string) d").collect()}
    assert got == {"T1": ("2026-04-25 10:00:00", "2026-04-25"), "T2": ("2026-04-25 04:30:00", "2026-04-25"),
                   "T3": ("2026-04-26 01:30:00", "2026-04-26"), "T4": ("2026-04-25 10:00:00", "2026-04-25"),
                   "T5": (None, None), "T6": (None, None)}


def test_synthesis_over_days_and_rounding(spark):
    rows = lambda d: spark.createDataFrame([(i, day) for i in range(50) for day in ("2026-04-25", "2027-01-01")],
                                           "i long, batch_date string")
    made = synth.Generator(rows, {"accounts": 5, "customers": 5, "merchants": 5})
    got = made.transactions().selectExpr("transaction_id", "cast(to_date(transaction_ts) AS string) AS d", "amount").collect()
    assert len({r.transaction_id for r in got}) == 100
    assert all(r.transaction_id[1:9] == r.d.replace("-", "") for r in got) and {r.d for r in got} == {"2026-04-25", "2027-01-01"}
    assert all(round(r.amount, 2) == r.amount and 10 <= r.amount <= 250_000 for r in got)
    loans = made.loan_applications().collect()
    assert {(r.application_id[1:9], str(r.application_date)) for r in loans} == {("20260425", "2026-04-25"), ("20270101", "2027-01-01")}
