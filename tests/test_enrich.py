from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from ledgerspark.functions import enrich as E
from ledgerspark.functions.money import (
    PART,
    count_excluded,
    divided_to_cents,
    exact_sum,
    exact_sum_unrounded,
    exact_total,
)
from ledgerspark.operators.rollups import rollup
from ledgerspark.schemas import RATES


def one(df):
    return df.first()


def test_format_dates_skips_missing_columns(spark, caplog):
    df = spark.createDataFrame([("2023-01-05", "2023-01-05 6:07:08")], "d string, t string")
    row = one(E.format_dates(df, ["d", "nope"], ["t", "nor"]))
    assert str(row.d) == "2023-01-05" and row.t == "2023-01-05 06:07:08"
    assert "nope" in caplog.text and "nor" in caplog.text


def test_date_parts(spark):
    df = spark.createDataFrame([("2023-04-05 06:07:08",), ("bad",)], "t string")
    assert E.extract_date_parts(df, "t").columns == ["t", "year"]
    rows = E.extract_date_parts(df, "t", Year=False, Month=True, Day=True).collect()
    assert (rows[0].month, rows[0].day) == (4, 5) and rows[1].month is None
    with pytest.raises(ValueError):
        E.extract_date_parts(df, "missing")


def test_currency(spark):
    rates = spark.createDataFrame([("EUR", Decimal("0.92")), ("NIL", Decimal("0"))], RATES)
    df = spark.createDataFrame(
        [(1, 1.0, "EUR"), (2, 1.0, "XYZ"), (3, None, "EUR"), (4, 1.0, "NIL"), (5, 1.0, None)],
        "id int, amount double, currency string",
    )
    got = {r.id: r.Amount_USD for r in E.convert_currency_to_usd(df, rates).collect()}
    assert got == {1: 1.09, 2: 1.0, 3: None, 4: None, 5: 1.0}
    strict = E.convert_currency_to_usd(df, rates, default_rate=None)
    assert {r.id: r.Amount_USD for r in strict.collect()}[2] is None
    missing = {r.currency: r.rate_missing for r in E.count_missing_rates(df, rates).collect()}
    assert missing == {"XYZ": 1, None: 1}


def test_quotients_round_half_up(spark):
    rows = [(1.005, "1"), (0.125, "1"), (2.675, "1"), (-0.125, "1"), (1e12, "0.5"), (0.01, "3")]
    df = spark.createDataFrame([(a, Decimal(r)) for a, r in rows], "a double, r decimal(10,4)")
    got = [r.q for r in df.select(divided_to_cents(F.col("a"), F.col("r")).alias("q")).collect()]
    assert got == [1.01, 0.13, 2.68, -0.13, 2e12, 0.0]


def test_sums_are_exact_and_cannot_overflow(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (float("nan"),), (None,)], "a double")
    assert df.agg(exact_sum("a")).first()[0] == Decimal("0.30")
    huge = spark.range(4).select(F.lit(2**63 - 1).alias("v"))
    assert huge.agg(exact_total(F.col("v"))).first()[0] == 4 * (2**63 - 1)
    assert df.filter("a is null").agg(exact_sum("a")).first()[0] is None


def test_totals_of_billions_of_rows_do_not_overflow():
    """The parts of a sum, not the rows: 2.5 billion times minus one cent."""
    rows, value = 2_500_000_000, -1
    mask = (1 << PART) - 1
    high, middle, low = value >> 2 * PART, value >> PART & mask, value & mask
    assert all(abs(rows * part) < 2**63 for part in (high, middle, low))
    assert ((rows * high << PART) + rows * middle << PART) + rows * low == rows * value


def test_measures_leave_out_the_same_amounts(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1e17), ("a", float("nan")), ("a", None)], "k string, Amount_USD double")
    row = rollup(df, ["k"]).first()
    assert (row.total_amount, row.average_amount, row.min_amount, row.max_amount, row.transaction_count) == (1, 1, 1, 1, 1)
    assert df.agg(count_excluded("Amount_USD")).first()[0] == 2


def test_one_rounding_form_at_every_size(spark):
    from decimal import ROUND_HALF_UP, Decimal

    amounts = [0.005, -0.005, 1.005, 999_999_999.99, 1e9 + 0.07, 3e9 + 0.01, 8e12 + 0.05]
    rates = [Decimal("0.8000"), Decimal("1.6000"), Decimal("0.3200")]
    df = spark.createDataFrame([(a, r) for a in amounts for r in rates], "a double, r decimal(10,4)")
    for a, r, q in df.select("a", "r", divided_to_cents(F.col("a"), F.col("r")).alias("q")).collect():
        exact = (Decimal(repr(a)) / r).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert q == float(exact), (a, r)


def test_unrounded_sums_keep_fractions_of_a_cent(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("a"))
    assert df.agg(exact_sum_unrounded("a")).first()[0] == Decimal("4.000000")
    rows = [(-0.25,), (1e15 + 0.5,), (float("nan"),), (None,), (1e17,)]
    mixed = spark.createDataFrame(rows, "a double")
    assert mixed.agg(exact_sum_unrounded("a")).first()[0] == Decimal("1000000000000000.25")
    assert mixed.filter("a is null").agg(exact_sum_unrounded("a")).first()[0] is None


def test_repeated_dimension_rows_do_not_repeat_facts(spark):
    branches = spark.createDataFrame([("B1", " lima ")], "branch_id string, location string")
    places = [("Lima", 1.0, 2.0), ("LIMA ", 1.0, 1.0)]
    gazetteer = spark.createDataFrame(places, "location string, latitude double, longitude double")
    assert [tuple(r)[2:] for r in E.add_coordinates(branches, gazetteer).collect()] == [(1.0, 1.0)]
    rates = spark.createDataFrame(
        [("EUR", Decimal("0.5")), ("EUR", Decimal("0.8"))], "currency string, rate decimal(10,4)"
    )
    facts = spark.createDataFrame([("EUR", 8.0)], "currency string, amount double")
    assert [r.Amount_USD for r in E.convert_currency_to_usd(facts, rates).collect()] == [10.0]
