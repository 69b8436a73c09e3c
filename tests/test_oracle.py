"""Every registered query against its SQL on the same tables."""

import pytest

import __spark_entry__ as contract
from ledgerspark.operators.profiling import data_summary
from ledgerspark.operators.rollups import median_approx
from ledgerspark.workload import bank, oracle, queries as registered
from tests.oracle_check import compare, duck

QUERIES = registered.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_the_contract_has_all_of_them():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_approximate_profile_is_close(spark, sf_dir):
    raw = bank.raw_transactions(spark, sf_dir)
    exact = {r.column_name: r for r in data_summary(raw).collect()}
    for row in data_summary(raw, approx=True).collect():
        truth = exact[row.column_name].unique_count
        assert abs(row.unique_count - truth) <= 0.2 * truth
        assert row.null_count == exact[row.column_name].null_count


def test_approximate_median_rank(spark, sf_dir):
    transactions = bank.silver(spark, sf_dir).transactions
    amounts = transactions.select("channel", "Amount_USD").collect()
    for row in median_approx(transactions).collect():
        group = [r.Amount_USD for r in amounts if r.channel == row.channel]
        rank = sum(a <= row.median_amount_usd for a in group)
        assert abs(rank - len(group) / 2) <= max(2, len(group) / 1000)
