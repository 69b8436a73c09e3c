"""Rules at their edges, with the library's default thresholds."""

from datetime import date

import pytest

from ledgerspark.config import SegmentRules
from ledgerspark.operators import audits, rollups as R
from ledgerspark.plans import fraud, segments as S
from ledgerspark.schemas import SILVER_TRANSACTIONS


def txns(spark, *rows):
    """Silver transactions from (id, customer, timestamp, usd) and overrides."""
    full = []
    for id, customer, moment, usd, *other in rows:
        row = dict.fromkeys(SILVER_TRANSACTIONS.names)
        row.update(
            transaction_id=id, customer_id=customer, branch_id="B1", channel="WEB",
            transaction_type="PAYMENT", amount=usd, currency="USD", timestamp=moment,
            status="COMPLETED", Amount_USD=usd,
        )
        if moment:
            row.update(year=int(moment[:4]), month=int(moment[5:7]))
        row.update(*other)
        full.append(tuple(row[n] for n in SILVER_TRANSACTIONS.names))
    return spark.createDataFrame(full, SILVER_TRANSACTIONS)


def at(hour):
    return f"2023-01-01 {hour}:00" if len(hour) == 5 else hour


def test_fraud_amount_edges(spark):
    df = txns(
        spark,
        ("T1", "A", "2023-01-01 00:00:00", 30000.0),
        ("T2", "B", "2023-01-01 00:00:00", 30000.01),
        ("T3", "C", "2023-01-01 00:00:00", 50000.01),
        ("T4", "D", "2023-01-01 00:00:00", 100000.01),
        ("T5", "E", "2023-01-01 00:00:00", None),
    )
    got = {r.transaction_id: (r.flag_type, r.confidence_score, r.flag_id)
           for r in fraud.fraud_flags(df).collect()}
    assert got == {
        "T2": ("watchlist_match", 0.90, "F1001"),
        "T3": ("unusual_amount", 0.75, "F1002"),
        "T4": ("pattern_anomaly", 0.85, "F1003"),
    }
    assert fraud.fraud_flags(df).columns == [
        "transaction_id", "customer_id", "month", "year", "flag_type", "confidence_score",
        "transaction_datetime", "flag_id",
    ]


def test_velocity_edge(spark):
    seven = [(f"S{i}", "A", "2023-01-01 00:00:00", 1.0) for i in range(7)]
    eight = [(f"E{i}", "B", "2023-01-01 00:00:00", 1.0) for i in range(8)]
    flagged = fraud.flagged(txns(spark, *seven, *eight)).collect()
    assert {(r.customer_id, r.flag_type, r.confidence_score) for r in flagged} == {
        ("B", "velocity_check", 0.60)
    }
    assert len(flagged) == 8


def test_segments_at_their_edges(spark):
    customers = spark.createDataFrame(
        [
            ("C1", date(2022, 12, 1), 700),
            ("C2", date(2022, 12, 2), 700),
            ("C3", date(2022, 12, 3), 599),
            ("C4", date(2018, 3, 1), 600),
            ("C5", date(2018, 3, 2), 700),
        ],
        "customer_id string, join_date date, credit_score int",
    )
    df = txns(
        spark,
        ("T1", "C1", "2023-02-19 00:00:00", 100000.0),
        ("T2", "C2", "2023-02-19 00:00:01", 100000.01),
    )
    got = {}
    for r in S.segment_members(customers, df).collect():
        got.setdefault(r.segment_name, set()).add(r.customer_id)
    assert got == {
        "High_Value": {"C2"},
        "New_User": {"C2", "C3"},
        "Inactive": {"C1", "C3", "C4", "C5"},
        "Credit_Risk": {"C3"},
        "Loyal": {"C4"},
    }
    numbered = S.customer_segmentation(customers, df)
    assert numbered.columns == [
        "segment_id", "customer_id", "segment_name", "segment_description", "last_update"
    ]
    ids = [(r.segment_id, r.customer_id, r.segment_name) for r in numbered.collect()]
    assert sorted(ids)[:2] == [("S1001", "C1", "Inactive"), ("S1002", "C2", "High_Value")]
    assert sorted(i for i, _, _ in ids) == [f"S{1001 + n}" for n in range(9)]
    assert sum(r["count"] for r in S.segment_counts(numbered).collect()) == 9
    later = S.new_user(customers, SegmentRules(as_of="2030-01-01"))
    assert later.count() == 0


def test_peak_hours_are_inclusive(spark):
    moments = ["07:59", "08:00", "18:59", "19:00"]
    df = txns(spark, *[(f"T{i}", "A", at(h), 1.0) for i, h in enumerate(moments)])
    got = {r.time_period: r.transaction_count for r in R.peak_off_peak(df).collect()}
    assert got == {"Peak": 2, "Off-Peak": 2}


def test_histogram_edges_and_null(spark):
    amounts = [50.0, 50.01, 100.0, 10000.0, 10000.01, None, -1.0]
    df = txns(spark, *[(f"T{i}", "A", "2023-01-01 00:00:00", a) for i, a in enumerate(amounts)])
    got = {r.amount_range: r.transaction_count for r in R.amount_histogram(df).collect()}
    assert got == {"0-50": 2, "50-100": 2, "5000-10000": 1, "10000+": 2}


def test_value_tiers(spark):
    totals = {"A": 1000.0, "B": 1000.01, "C": 5000.0, "D": 5000.01, "E": None}
    df = txns(spark, *[(c, c, "2023-01-01 00:00:00", a) for c, a in totals.items()])
    got = {r.customer_id: r.segment for r in R.value_tiers(df).collect()}
    assert got == {
        "A": "Low Value", "B": "Medium Value", "C": "Medium Value", "D": "High Value",
        "E": "High Value",
    }


def test_churn_edge(spark):
    df = txns(
        spark,
        ("T1", "A", "2023-06-30 00:00:00", 1.0),
        ("T2", "B", "2023-01-01 23:59:59", 1.0),
        ("T3", "C", "2022-12-31 23:59:59", 1.0),
    )
    got = {r.customer_id: (r.days_since_last_transaction, r.churn_status)
           for r in R.churn_status(df).collect()}
    assert got == {"A": (0, "Active"), "B": (180, "Active"), "C": (181, "Churned")}
    row = R.active_churned(df).first()
    assert (row.active_customers, row.churned_customers) == (2, 1)
    totals, counts = R.aggregate_customers(
        spark.createDataFrame([("A", "VIP"), ("B", "VIP"), ("Z", "VIP")],
                              "customer_id string, customer_type string"), df)
    assert tuple(totals.first()) == ("VIP", 2, 1.0, 2.0) and tuple(counts.first()) == (2, 1)


def test_rollup_rounds_half_up_and_counts_non_nulls(spark):
    df = txns(
        spark,
        ("T1", "A", "2023-01-01 00:00:00", 0.0),
        ("T2", "A", "2023-01-01 00:00:00", 0.01),
        ("T3", "A", "2023-01-01 00:00:00", None),
        ("T4", "B", "2023-01-01 00:00:00", None),
    )
    got = {r.customer_id: tuple(r)[1:] for r in R.rollup(df, ["customer_id"]).collect()}
    assert got == {"A": (0.01, 0.01, 0.0, 0.01, 2), "B": (None, None, None, None, 0)}


def test_rollups_add_up(spark, sf_dir):
    from ledgerspark.workload import bank

    s = bank.silver(spark, sf_dir)
    grand = R.rollup(s.transactions, []).first()
    for frame in (
        R.rollup(s.transactions, ["channel"]),
        R.rollup(s.transactions, ["year", "month"]),
        R.rollup_by_attribute(s.transactions, s.branches, "branch_id", "location"),
    ):
        rows = frame.collect()
        assert sum(r.transaction_count for r in rows) == grand.transaction_count
        assert sum(r.total_amount for r in rows) == pytest.approx(grand.total_amount, abs=0.01)
    shares = [r.percentage_of_total for r in R.percent_of_total(s.transactions).collect()]
    assert sum(shares) == pytest.approx(100, abs=0.005 * len(shares))


def test_rollups_from_the_summary_equal_direct_ones(spark, sf_dir):
    from ledgerspark.plans.gold import gold_tables
    from ledgerspark.workload import bank

    s = bank.silver(spark, sf_dir)
    tables = gold_tables()
    direct = {
        "branch_aggregations_table": R.rollup(s.transactions, ["branch_id"]),
        "year_month_aggregations_table": R.rollup(s.transactions, ["year", "month"]),
        "channel_type_aggregations_table": R.rollup(s.transactions, ["channel", "transaction_type"]),
        "date_aggregations_table": R.rollup_by_date(s.transactions),
        "location_aggregations_table": R.rollup_by_attribute(
            s.transactions, s.branches, "branch_id", "location"
        ),
        "customer_aggregations_table": R.rollup(s.transactions, ["customer_id"]),
        "customer_segments_table": R.value_tiers(s.transactions),
        "last_transaction_table": R.last_transactions(s.transactions),
        "churn_table": R.churn_status(s.transactions),
        "customer_segmentation": R.customer_type_totals(s.customers, s.transactions),
        "segment_count_table": S.segment_counts(S.segment_members(s.customers, s.transactions)),
        "peak_off_peak_table": R.peak_off_peak(s.transactions),
        "percentage_table": R.percent_of_total(s.transactions),
    }
    for name, frame in direct.items():
        published = tables[name](s)
        assert published.columns == frame.columns
        assert sorted(map(tuple, published.collect()), key=repr) == sorted(
            map(tuple, frame.collect()), key=repr
        )


def test_flags_in_one_pass_equal_outer_joins(spark, sf_dir):
    from ledgerspark.workload import bank

    t = bank.silver(spark, sf_dir).transactions
    one = fraud.flagged(t, bank.FRAUD)
    joined = fraud.flagged_by_outer_joins(t, bank.FRAUD)
    assert one.count() == joined.count() > 0
    assert one.exceptAll(joined).count() == 0


def test_audits(spark):
    customers = spark.createDataFrame([("A", date(2023, 1, 2))], "customer_id string, join_date date")
    branches = spark.createDataFrame([("B1", "EUR")], "branch_id string, currency string")
    df = txns(
        spark,
        ("T1", "A", "2023-01-01 23:59:59", 1.0),
        ("T2", "A", "2023-01-02 00:00:00", 1.0, {"currency": "EUR"}),
        ("T3", "Z", "2023-01-03 00:00:00", 1.0, {"branch_id": "B9"}),
        ("T3", "Z", "2023-01-03 00:00:00", 1.0, {"branch_id": "B9", "status": "PENDING"}),
    )
    got = {r.violation: r.transaction_count
           for r in audits.audit_integrity(customers, branches, df).collect()}
    assert got == {"before_join_date": 1, "unknown_customer": 2, "unknown_branch": 2}
    assert [tuple(r) for r in audits.audit_currency(branches, df).collect()] == [
        ("T1", "B1", "USD", "EUR")
    ]
    assert [tuple(r) for r in audits.audit_status_conflicts(df).collect()] == [("T3", 2)]
