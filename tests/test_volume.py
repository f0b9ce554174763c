"""What the bank queries write and shuffle: landed files, merged rows, what a task sorts."""

import datetime as dt
import glob
import gzip
import os

from pyspark.sql import functions as F

from ledgerlens import session
from ledgerlens.plans import tables
from ledgerlens.plans.tables import FactTable
from ledgerlens.sources.contracts import CONTRACTS, FACT_COLUMNS, FACT_SCHEMA, Sort
from ledgerlens.sources.testbridge import _padded, raw_transactions
from ledgerlens.sources.zones import read_raw_csv, write_raw_csv
from ledgerlens.streaming.ingest import TransactionIngest


def test_landed_files_are_compressed_and_bounded(spark, scratch):
    names = CONTRACTS["branches"].names
    rows = [("B1", 'Main, "old"\nbranch', None, "S1", "WEST"), ("B2", "", "X", " ", "EAST")] * 5
    feed = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names)).coalesce(1)
    write_raw_csv(feed, f"{scratch}/branches.csv", max_rows=4)
    files = glob.glob(f"{scratch}/branches.csv/*.csv.gz")
    assert len(files) == 3 and all(gzip.open(f).readline().decode().strip() == ",".join(names) for f in files)
    plain = [("B1", 'Main', None, "S1", "WEST"), ("B2", None, "X", "S2", "EAST")] * 5
    write_raw_csv(spark.createDataFrame(plain, feed.schema), f"{scratch}/plain.csv", max_rows=4)
    back = read_raw_csv(spark, f"{scratch}/plain.csv", CONTRACTS["branches"])
    assert sorted(map(tuple, back.collect()), key=str) == sorted(plain, key=str)
    write_raw_csv(feed, f"{scratch}/one.csv", "none", 0)
    assert len(glob.glob(f"{scratch}/one.csv/*.csv")) == 1


def _events(spark, n, days, first=0):
    ids = spark.range(first, first + n, 1, 5).select(
        F.concat(F.lit("T"), "id").alias("transaction_id"),
        F.expr(f"date_add(date'2026-04-01', cast(id % {days} as int))").alias("transaction_date"),
        F.col("id").cast("double").alias("amount"))
    kinds = {f.name: f.dataType for f in FACT_SCHEMA}
    return ids.select(*[F.col(c) if c in ids.columns else F.lit(None).cast(kinds[c]).alias(c) for c in FACT_COLUMNS])


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_few_partitions_are_not_shuffled_by_a_merge(spark, scratch, monkeypatch):
    fact = FactTable(spark, f"{scratch}/fact")
    source = _events(spark, 40, 4).withColumn("part", fact._part())
    assert "Rebalance" not in _plan(fact._dealt(source, 40, 4))
    monkeypatch.setattr(tables, "TASK_ROWS", 20)
    monkeypatch.setattr(tables, "LEAST_ROWS", 5)
    monkeypatch.setattr(tables, "FILE_ROWS", 3)
    few, many = fact._dealt(source, 40, 4), fact._dealt(source, 40, 10)
    assert "Rebalance" not in _plan(few) and few.rdd.getNumPartitions() == 3
    assert "Rebalance" in _plan(many)


def test_merges_of_dealt_and_rebalanced_rows_agree(spark, scratch, monkeypatch):
    def state(path):
        fact = FactTable(spark, path)
        fact.merge(_events(spark, 60, 6))
        fact.merge(_events(spark, 30, 4, 20).withColumn("amount", F.lit(1.0)))
        fact.merge(spark.createDataFrame([], FACT_SCHEMA))
        return sorted((r.transaction_id, r.transaction_date, r.amount) for r in fact.read().collect())

    want = {f"T{i}": (dt.date(2026, 4, 1 + i % (4 if 20 <= i < 50 else 6)), 1.0 if 20 <= i < 50 else float(i)) for i in range(60)}
    dealt = state(f"{scratch}/dealt")
    monkeypatch.setattr(tables, "TASK_ROWS", 0)
    monkeypatch.setattr(tables, "SMALL_KEYS", 0)
    assert dealt == state(f"{scratch}/rebalanced") == sorted((k, *v) for k, v in want.items())


def test_bank_settings_end_where_the_corpus_begins(spark):
    key = "spark.sql.files.maxPartitionBytes"
    session.apply_session_conf(spark)
    before = spark.conf.get(key)
    session.apply_session_conf(spark, bank=True)
    assert {k: spark.conf.get(k) for k in session.BANK_CONF} == session.BANK_CONF
    session.apply_session_conf(spark)
    assert spark.conf.get(key) == before


def test_a_large_batch_with_few_matches_shuffles_no_whole_row(spark, scratch, monkeypatch):
    """The batch's keys are too many to send, those it has in common with the target are not."""
    monkeypatch.setattr(tables, "SMALL_KEYS", 40 * (tables.ROW_BYTES + 4))
    monkeypatch.setattr(tables, "TASK_ROWS", 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans, real = [], tables.upsert

    def spied(*args, **named):
        out = real(*args, **named)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(tables, "upsert", spied)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = FactTable(spark, f"{scratch}/fact")
        order = (Sort("amount", descending=True),)
        fact.merge(_events(spark, 100, 4), order=order)
        # of 100 rows the first ten come after their target row, ten before it, the others are new
        later = _events(spark, 100, 5, 80).withColumn("amount", F.col("amount") + F.when(F.col("amount") < 90, -1.0).otherwise(1.0))
        fact.merge(later, order=order)
        got = {r.transaction_id: (r.transaction_date.day, r.amount) for r in fact.read().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert got == {f"T{i}": (1 + i % 4, float(i)) if i < 90 else (1 + i % 5, i + 1.0) for i in range(180)}
    assert "BroadcastHashJoin" in plans[-1] and "SortMergeJoin" not in plans[-1]


def test_feed_is_dealt_over_files_before_its_numbers_are_text(spark, scratch):
    spark.range(60).selectExpr(
        "id % 20 l_orderkey", "id % 7 l_partkey", "id % 3 l_suppkey", "cast(id % 4 AS int) l_linenumber", "1.5D l_quantity",
        "id * 2.5D l_extendedprice", "0.1D l_discount", "0.2D l_tax", "'R' l_returnflag", "'O' l_linestatus",
        "timestamp'1998-01-01' + make_interval(0, 0, 0, cast(id AS int)) l_shipdate").write.parquet(f"{scratch}/lineitem.parquet")
    spark.range(18).selectExpr("id o_orderkey", "id o_custkey", "'F' o_orderstatus").write.parquet(f"{scratch}/orders.parquet")
    dealt = raw_transactions(spark, scratch, 3)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, raw_transactions(spark, scratch).collect()))
    places = dealt.select("l_partkey", F.spark_partition_id().alias("p")).distinct().collect()
    assert dealt.rdd.getNumPartitions() == 3 and len({r.l_partkey for r in places}) == len(places) == 7
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("AS transaction_id") < plan.index("RepartitionByExpression")


def _spied(monkeypatch):
    """Plans of the kept rows of the merges that follow."""
    plans, real = [], tables.upsert

    def spied(*args, **named):
        out = real(*args, **named)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(tables, "upsert", spied)
    return plans


def test_many_matches_are_sent_some_partitions_at_a_time(spark, scratch, monkeypatch):
    """The keys of all matches are too many to send, those of two partitions are not: no whole row is shuffled."""
    monkeypatch.setattr(tables, "SMALL_KEYS", 30 * (tables.ROW_BYTES + 4))
    plans, groups, real = _spied(monkeypatch), [], FactTable._groups
    monkeypatch.setattr(FactTable, "_groups", lambda self, met: groups.append(real(self, met)) or groups[-1])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for order in ((), (Sort("amount", descending=True),)):
            fact = FactTable(spark, f"{scratch}/fact{len(order)}")
            fact.merge(_events(spark, 150, 6), order=order)
            # six partitions of 25 rows; 90 of the 150 rows are replaced, all those of the second day among them
            later = (_events(spark, 150, 6).where("amount < 75 OR cast(amount AS int) % 6 = 1")
                     .withColumn("transaction_date", F.expr("date_add(transaction_date, 10)"))
                     .withColumn("amount", F.col("amount") + 1000))
            del plans[:], groups[:]
            fact.merge(later, order=order)
            got = {r.transaction_id: (r.transaction_date.day, r.amount) for r in fact.read().collect()}
            moved = lambda i: i < 75 or i % 6 == 1
            assert got == {f"T{i}": (1 + i % 6 + 10 * moved(i), i + 1000.0 * moved(i)) for i in range(150)}
            assert fact.read().count() == 150 and len(groups[-1]) > 1
            # the second day, all of whose rows moved, is read by none
            assert plans and not any("SortMergeJoin" in p or "2026-04-02" in p for p in plans)
            assert "2026-04-02" not in fact.live() and "2026-04-12" in fact.live()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_partition_of_too_many_matches_and_null_keys(spark, scratch, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_KEYS", 0)
    nameless = _events(spark, 4, 2).withColumn("transaction_id", F.lit(None).cast("string"))
    for order in ((), (Sort("amount", descending=True),)):
        fact = FactTable(spark, f"{scratch}/fact{len(order)}")
        fact.merge(_events(spark, 40, 2).unionByName(nameless), order=order)
        fact.merge(_events(spark, 30, 2, 20).withColumn("amount", F.lit(99.0)).unionByName(nameless), order=order)
        got = sorted((r.transaction_id or "", r.amount) for r in fact.read().collect())
        assert got == sorted([("", float(i)) for i in range(4)] * 2 + [(f"T{i}", 99.0 if i >= 20 else float(i)) for i in range(50)])


def test_a_busy_cluster_writes_many_partitions_unshuffled(spark, scratch, monkeypatch):
    monkeypatch.setattr(tables, "TASK_ROWS", 20)
    monkeypatch.setattr(tables, "LEAST_ROWS", 5)
    monkeypatch.setattr(tables, "FILE_ROWS", 3)
    fact = FactTable(spark, f"{scratch}/fact")
    source = _events(spark, 60, 6).withColumn("part", fact._part())
    # 30 rows a task: with 400 rows each of the four cores has one, with 100 it has not
    assert "Rebalance" not in _plan(fact._dealt(source, 400, 10)) and "Rebalance" in _plan(fact._dealt(source, 100, 10))
    monkeypatch.setattr(tables, "MOST_ROWS", 29)
    assert "Rebalance" in _plan(fact._dealt(source, 400, 10))


def test_a_merge_and_an_ingest_leave_no_step_folders(spark, scratch):
    held = lambda: {f for f in os.listdir(session.work_root(spark)) if f.startswith(("merge", "ingest"))}
    before, fact = held(), FactTable(spark, f"{scratch}/fact")
    for i in range(2):
        fact.merge(_events(spark, 20, 2, 10 * i), order=(Sort("amount"),))
    fact.merge(spark.createDataFrame([], FACT_SCHEMA))
    os.makedirs(f"{scratch}/feed/batch_date=2026-04-25")
    with open(f"{scratch}/feed/batch_date=2026-04-25/a.csv", "w") as fh:
        fh.write(",".join(CONTRACTS["transactions"].names) + "\nT7,A1,C1,M1,2026-04-25 10:00:00,DEBIT,UPI,FUEL,5,INR,SUCCESS,False\n")
    merchants = spark.createDataFrame([("M1", "LOW")], "merchant_id string, risk_level string")
    TransactionIngest(spark, f"{scratch}/feed", f"{scratch}/checkpoint", fact, lambda: merchants).run_available()
    assert fact.read().count() == 30 and held() == before


def test_what_a_bank_step_shuffled_goes_when_it_ends(spark, scratch):
    session.apply_session_conf(spark, bank=True)
    try:
        local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        held = lambda: {f.toString() for f in _listed(local.getAllFiles()) if "shuffle_" in f.toString()}
        before = held()
        rows = spark.range(1000).repartition(5, "id")
        rows.write.parquet(f"{scratch}/rows")
        assert held() <= before and spark.read.parquet(f"{scratch}/rows").count() == 1000
        assert rows.count() == 1000 == len(rows.collect()) == len(rows.collect())
    finally:
        session.apply_session_conf(spark)


def _listed(files):
    return [files.apply(i) for i in range(files.size())]


def test_padded_keys_are_as_a_formatter_writes_them(spark):
    keys = spark.createDataFrame([(k,) for k in (0, 7, 99999, 100000, 12345678901, -3, -1234567, None)], "k long")
    rows = keys.select(_padded("M", F.col("k"), 6).alias("got"), F.concat(F.lit("M"), F.format_string("%06d", "k")).alias("want")).collect()
    assert all(r.got == r.want for r in rows) and rows[1].got == "M000007"
