from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerspark.config import CleaningRules
from ledgerspark.operators import cleaning as C
from ledgerspark.plans.silver import silver_branches, silver_customers, silver_transactions
from ledgerspark.schemas import (
    BRANCHES,
    CUSTOMERS,
    GAZETTEER,
    RATES,
    SILVER_BRANCHES,
    SILVER_CUSTOMERS,
    SILVER_TRANSACTIONS,
    TRANSACTIONS,
)
from decimal import Decimal


def txn(id, **other):
    row = dict(
        transaction_id=id,
        customer_id="C1",
        branch_id="B1",
        channel="web",
        transaction_type="payment",
        amount=10.0,
        currency="USD",
        timestamp="2023-01-01 10:00:00",
        status="completed",
    )
    row.update(other)
    return tuple(row[n] for n in TRANSACTIONS.names)


def txns(spark, *rows):
    return spark.createDataFrame(list(rows), TRANSACTIONS)


def by_id(df):
    return {r.transaction_id: r for r in df.collect()}


def test_latest_copy_wins_and_ties_are_fixed(spark):
    df = txns(
        spark,
        txn("T1", status="pending"),
        txn("T1", status="completed"),
        txn("T2", amount=1.0),
        txn("T2", amount=2.0, timestamp="2023-01-02 00:00:00"),
    )
    kept = by_id(C.clean_duplicate_transactions(df, ["transaction_id"], "timestamp"))
    assert kept["T1"].status == "pending"
    assert kept["T2"].amount == 2.0
    again = C.clean_duplicate_transactions(
        C.clean_duplicate_transactions(df, ["transaction_id"], "timestamp").coalesce(1),
        ["transaction_id"],
        "timestamp",
    )
    assert by_id(again) == kept


def test_latest_invalid_copy_is_not_replaced_by_an_older_valid_one(spark):
    df = txns(
        spark,
        txn("T1", amount=5.0),
        txn("T1", amount=200000.0, timestamp="2023-01-02 00:00:00"),
    )
    assert C.clean_transactions(df).count() == 0


def test_fill_then_drop(spark):
    df = txns(
        spark,
        txn("T1", currency=None, channel=None),
        txn("T2", amount=None),
        txn("T3", status=None),
    )
    kept = by_id(C.handle_missing_values(df, CleaningRules().transaction_fill))
    assert set(kept) == {"T1"}
    assert (kept["T1"].currency, kept["T1"].channel) == ("USD", "web")


def test_amount_range_is_inclusive(spark):
    amounts = {"T1": -1.0, "T2": 0.0, "T3": 100000.0, "T4": 100000.01, "T5": None}
    df = txns(spark, *[txn(i, amount=a) for i, a in amounts.items()])
    assert set(by_id(C.remove_invalid_values(df, {"amount": (0, 100000)}))) == {"T2", "T3"}


def test_unreadable_timestamp_stays_as_null(spark):
    kept = by_id(C.clean_transactions(txns(spark, txn("T1", timestamp="n/a"))))
    assert kept["T1"].timestamp is None


def test_trim_and_upper(spark):
    df = txns(spark, txn("T1", channel=" x "), txn("T2", channel="\tx"))
    kept = by_id(C.capitalize_string_data(C.trim_whitespaces(df)))
    assert kept["T1"].channel == "X"
    assert kept["T2"].channel == "\tX"


def test_cast_gives_null_not_an_error(spark):
    df = spark.createDataFrame([("1",), ("x",), ("99999999999",)], "v string")
    assert [r.v for r in C.validate_data_types(df, {"v": "int"}).collect()] == [1, None, None]


def test_uniqueness(spark):
    df = txns(spark, txn("T1"), txn("T1"), txn("T2"))
    assert C.enforce_uniqueness(df, ["transaction_id"]).count() == 2
    report = C.uniqueness_violations(df, ["transaction_id"]).collect()
    assert [(r.transaction_id, r.row_count) for r in report] == [("T1", 2)]


def test_anomaly_flag(spark):
    df = txns(spark, txn("T1", amount=9.0), txn("T2", amount=None), txn("T3", amount=1.0))
    conditions = {"big": F.col("amount") > 5, "odd": F.col("currency") == "XYZ"}
    once = C.flag_anomalies(df, conditions)
    assert {r.transaction_id: r.anomaly_flag for r in once.collect()} == {
        "T1": True,
        "T2": False,
        "T3": False,
    }
    twice = C.flag_anomalies(once, {"small": F.col("amount") < 2})
    flags = {r.transaction_id: r.anomaly_flag for r in twice.collect()}
    assert flags == {"T1": True, "T2": False, "T3": True}


def customer(id, **other):
    row = dict(
        customer_id=id,
        name=" ann ",
        email="ann@bank.example",
        phone="(555) 123-4567",
        address="1 Main St 12345",
        credit_score=700,
        join_date=date(2020, 1, 1),
        last_update=None,
        customer_type="regular",
    )
    row.update(other)
    return row


def test_silver_customers(spark):
    rows = [
        customer("c1"),
        customer("c2", join_date=None),
        customer("c3", join_date=date(2014, 12, 31)),
        customer("c4", email="abc", phone="n/a", address="Main St"),
        customer("c5", address="x 99999999999"),
        customer("c6", name=None),
    ]
    df = spark.createDataFrame([tuple(r[n] for n in CUSTOMERS.names) for r in rows], CUSTOMERS)
    df = df.withColumn("last_update", F.lit("2023-01-02 03:04:05").cast("timestamp"))
    silver = silver_customers(df)
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in SILVER_CUSTOMERS
    ]
    got = {r.customer_id: r for r in silver.collect()}
    assert set(got) == {"C1", "C2", "C4", "C5"}
    assert got["C1"].name == "ANN" and got["C1"].phone == 5551234567
    assert got["C1"].domain == "BANK.EXAMPLE" and got["C1"].postal_code == 12345
    assert got["C1"].last_update == "2023-01-02 03:04:05" and got["C1"].year == 2020
    assert got["C2"].join_date == date(2023, 1, 1)
    assert (got["C4"].domain, got["C4"].phone, got["C4"].postal_code) == (None, None, None)
    assert got["C5"].postal_code is None


def test_silver_branches(spark):
    rows = [
        ("B1", "One", " Paris ", "CET", "EUR"),
        ("B2", "Two", None, "CET", "EUR"),
        ("B3", "Three", "Rome", None, "EUR"),
    ]
    places = spark.createDataFrame([("paris", 48.8566, 2.355)], GAZETTEER)
    silver = silver_branches(spark.createDataFrame(rows, BRANCHES), places)
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in SILVER_BRANCHES
    ]
    got = {r.branch_id: (r.location, r.latitude, r.longitude) for r in silver.collect()}
    assert got == {"B1": ("PARIS", 48.86, 2.36), "B2": ("UNKNOWN", None, None)}


@pytest.fixture(scope="module")
def rates(spark):
    return spark.createDataFrame([("USD", Decimal("1")), ("EUR", Decimal("0.92"))], RATES)


def test_silver_transactions(spark, rates):
    df = txns(
        spark,
        txn("t1", currency="EUR", amount=92.0),
        txn("t2", currency="XYZ", channel=None),
        txn("t3", timestamp="n/a"),
        txn("t4", amount=0.005, currency="USD"),
    )
    silver = silver_transactions(df, rates)
    assert [(f.name, f.dataType) for f in silver.schema] == [
        (f.name, f.dataType) for f in SILVER_TRANSACTIONS
    ]
    got = by_id(silver)
    assert got["T1"].Amount_USD == 100.0 and (got["T1"].year, got["T1"].month) == (2023, 1)
    assert got["T2"].Amount_USD == 10.0 and got["T2"].channel == "WEB"
    assert got["T3"].timestamp is None and got["T3"].year is None
    assert got["T4"].Amount_USD == 0.01
