"""Driver contract: entry smoke, registry/oracle consistency, oracle parity at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")


def test_registry_and_oracle_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    missing = set(E.QUERIES) - set(o)
    assert not missing


@needs_data
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["transaction_date", "region", "state", "city", "transaction_count",
                          "total_amount", "high_risk_count"]
    assert df.count() > 0


def _norm(rows):
    return sorted(tuple("NULL" if v is None else (round(v, 6) if isinstance(v, float) else str(v))
                        for v in r) for r in rows)


@needs_data
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_parity(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [df.columns.index(c) for c in ocols]
    got = [tuple(r[i] for i in idx) for r in df.collect()]
    assert _norm(got) == _norm(res.fetchall())


def test_bank_queries_stand_without_the_corpus_packages(tmp_path):
    """A fresh interpreter that cannot import a corpus package still has the bank's queries."""
    import subprocess
    import sys
    code = ("import sys; sys.modules['xxhash'] = None\n"
            "import __spark_entry__ as E\nprint(len(E.queries()), 'daily_branch_summary' in E.queries())")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True,
                         cwd=os.path.dirname(E.__file__)).stdout.split()
    assert int(out[0]) == len(E.QUERIES) and out[1] == "True"


def test_a_wrong_setting_is_not_hidden(spark, monkeypatch):
    from ledgerlens import session
    monkeypatch.setattr(session, "SESSION_CONF", {"spark.sql.warehouse.dir": "/nowhere"})
    session.apply_session_conf(spark)
    monkeypatch.setattr(session, "SESSION_CONF", {"spark.sql.session.timeZone": "no such zone"})
    with pytest.raises(Exception, match="(?i)zone"):
        session.apply_session_conf(spark)
