"""Raw transaction CSV edge cases: reject, keep, parse, dedupe, band."""

import datetime as dt

from ledgerlens.operators.curate import curate_transactions
from ledgerlens.operators.quality import validate
from ledgerlens.sources.contracts import CONTRACTS
from ledgerlens.sources.zones import read_raw_csv

HEADER = ("transaction_id,account_id,customer_id,merchant_id,transaction_ts,transaction_type,"
          "channel,category,amount,currency,status,is_suspected_fraud")
ROWS = [
    "T1,A1,C1,M1,2026-04-25 10:00:00,DEBIT,UPI,FUEL,50.00,INR,SUCCESS,False",
    "T1,A1,C1,M1,2026-04-25 11:00:00,DEBIT,UPI,FUEL,60.00,INR,SUCCESS,False",
    "T2,A1,C1,M2,2026-04-25 10:00:00,DEBIT,UPI,FUEL,50.00,INR,SUCCESS,False",
    "T3,A1,C1,M1,2026-04-25 23:59:59,DEBIT,UPI,FUEL,100000,INR,SUCCESS,False",
    "T4,A1,C1,M1,2026-04-25 10:00:00,DEBIT,UPI,FUEL,99999.99,INR,SUCCESS,False",
    "T5,A1,C1,M9,2026-04-25 10:00:00,DEBIT,UPI,FUEL,5,INR,SUCCESS,True",
    "T6,A1,C1,M9,2026-04-25 10:00:00,DEBIT,UPI,FUEL,5,INR,SUCCESS,",
    "T7,A1,C1,M1,not-a-time,DEBIT,UPI,FUEL,abc,INR,SUCCESS,False",
    "T8,,C1,M1,2026-04-25 10:00:00,DEBIT,UPI,FUEL,5,INR,SUCCESS,False",
    '"",A1,C1,M1,2026-04-25 10:00:00,DEBIT,UPI,FUEL,5,INR,SUCCESS,False',
    "T9,A1,C1,M1,2026-04-25 10:00:00,DEBIT,UPI,FUEL,,INR,SUCCESS,False",
    'T10,"  ",C1,M1,2026-04-25 10:00:00,DEBIT,UPI,FUEL,5,INR,SUCCESS,False',
    "T11,A1",
]


def _curated(spark, scratch):
    path = f"{scratch}/transactions.csv"
    with open(path, "w") as fh:
        fh.write("\n".join([HEADER] + ROWS) + "\n")
    raw = read_raw_csv(spark, path, CONTRACTS["transactions"])
    valid = validate(raw, CONTRACTS["transactions"], "2026-04-25", stamp=False)
    merchants = spark.createDataFrame([("M1", "LOW"), ("M2", "HIGH")],
                                      "merchant_id string, risk_level string")
    return {r.transaction_id: r for r in curate_transactions(valid, merchants).collect()}


def test_edge_cases(spark, scratch):
    out = _curated(spark, scratch)
    assert sorted(out) == ["T1", "T10", "T2", "T3", "T4", "T5", "T6", "T7"]
    assert out["T1"].transaction_ts == dt.datetime(2026, 4, 25, 11)
    assert out["T1"].amount == 60.0 and out["T1"].transaction_risk_band == "LOW"
    assert out["T2"].transaction_risk_band == "HIGH"
    assert out["T3"].transaction_risk_band == "MEDIUM"
    assert out["T3"].transaction_date == dt.date(2026, 4, 25)
    assert out["T4"].transaction_risk_band == "LOW"
    assert out["T5"].transaction_risk_band == "HIGH"
    assert out["T6"].is_suspected_fraud is None and out["T6"].transaction_risk_band == "LOW"
    t7 = out["T7"]
    assert t7.transaction_ts is None and t7.transaction_date is None and t7.amount is None
    assert t7.transaction_risk_band == "LOW"
    assert out["T10"].account_id == "  "


def test_missing_column_is_an_error(spark, scratch):
    path = f"{scratch}/bad.csv"
    with open(path, "w") as fh:
        fh.write("transaction_id,account_id\nT1,A1\n")
    try:
        read_raw_csv(spark, path, CONTRACTS["transactions"])
    except ValueError as err:
        assert "missing columns" in str(err)
    else:
        raise AssertionError("expected a contract error")


def test_validate_is_idempotent_on_parsable_rows(spark, scratch):
    """validate(validate(x)) == validate(x), except rows whose required text did
    not parse: they pass the NOT NULL test as text and are NULL afterwards."""
    path = f"{scratch}/transactions.csv"
    with open(path, "w") as fh:
        fh.write("\n".join([HEADER] + ROWS) + "\n")
    c = CONTRACTS["transactions"]
    once = validate(read_raw_csv(spark, path, c), c, "2026-04-25", stamp=False)
    twice = validate(once.drop("batch_date"), c, "2026-04-25", stamp=False)
    unparsable = {"T7"}
    assert sorted(r for r in once.collect() if r.transaction_id not in unparsable) == \
        sorted(twice.collect())
    assert once.filter("transaction_id = 'T7'").first().amount is None
