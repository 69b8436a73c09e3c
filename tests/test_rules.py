"""Declared rules: the report, the gate and the rows' own lists."""

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import rules as Q
from ledgerspark.plans.gold import publish_gold
from ledgerspark.workload import bank
from tests.test_plans import scans

ROWS = [("a", 5.0, "USD"), ("b", -1.0, None), ("c", None, "EUR"), ("d", 500.0, "XXX"), (None, -2.0, "USD")]
RULES = [
    Q.required("currency", allowed=0.2),
    Q.within("amount", 0, 100),
    Q.one_of("currency", ["USD", "EUR"]),
    Q.matching("id", "^[a-z]$"),
    Q.Rule("paid in dollars", lambda: (F.col("amount") > 1) & (F.col("currency") != "USD"), allowed=1),
]


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(ROWS, "id string, amount double, currency string")


def test_report(rows):
    found = [tuple(r)[1:] for r in Q.rule_report(rows, RULES, "id").collect()]
    assert found == [
        (5, 1, "b", "b", 0.2, True),
        (5, 3, "b", "d", 0.0, False),  # the third offender has no key
        (5, 1, "d", "d", 0.0, False),
        (5, 0, None, None, 0.0, True),
        (5, 1, "d", "d", 1.0, True),
    ]


def test_report_of_no_rows_passes_and_odd_rules_are_refused(rows):
    empty = Q.rule_report(rows.limit(0), RULES, "id").collect()
    assert [(r.row_count, r.violations, r.passed) for r in empty] == [(0, 0, True)] * 5
    for odd in ([], [RULES[0], RULES[0]]):
        with pytest.raises(ValueError):
            Q.rule_report(rows, odd, "id")


def test_gate_names_what_fails(rows):
    assert Q.enforce(rows, [RULES[0], RULES[3]], "id") is rows
    with pytest.raises(Q.RulesBroken, match=r"amount within 0 and 100: 3 of 5 rows, first b; currency one of USD, EUR: 1 of 5"):
        Q.enforce(rows, RULES, "id")


def test_rows_list_what_they_break(rows):
    found = {r.id: r.broken_rules for r in Q.broken_rules(rows, RULES).collect()}
    assert found["a"] == [] and found["b"] == ["currency required", "amount within 0 and 100"]
    assert found["d"] == ["amount within 0 and 100", "currency one of USD, EUR", "paid in dollars"]


def test_rules_read_a_table_once(spark, sf_dir):
    table = bank.silver(spark, sf_dir).transactions
    checks = [Q.required("customer_id"), Q.within("amount", 0, 1), Q.matching("status", "^[A-Z]+$")]
    assert scans(Q.rule_report(table, checks, "transaction_id")) == 1


def test_nothing_is_published_of_frames_that_fail(spark, sf_dir):
    checks = {"transactions": [Q.within("amount", 0, 1)]}
    with pytest.raises(Q.RulesBroken, match="transactions: amount within"):
        publish_gold(bank.silver(spark, sf_dir), bank.GOLD, checks=checks)
    assert not spark.catalog.tableExists("gold.channel_aggregations_table")
    with pytest.raises(ValueError, match="no silver frame"):
        publish_gold(bank.silver(spark, sf_dir), bank.GOLD, checks={"accounts": RULES})
