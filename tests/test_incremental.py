"""Deliveries one by one against all rows at once; what a delivery does not touch stays as it is."""

import glob
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from ledgerspark.config import CatalogConfig
from ledgerspark.operators import rollups as R
from ledgerspark.plans.incremental import GoldStore
from ledgerspark.scratch import scratch_path
from ledgerspark.sources.tables import bootstrap_catalog
from tests.test_gold import txns


@pytest.fixture()
def store(spark):
    run = uuid4().hex
    catalog = CatalogConfig(f"b_{run}", f"s_{run}", f"g_{run}", location=scratch_path(spark, "catalog"))
    bootstrap_catalog(spark, catalog)
    return GoldStore(spark, catalog)


@pytest.fixture()
def dimensions(spark):
    customers = spark.createDataFrame(
        [("A", "REGULAR", 500, "2010-01-01"), ("B", "VIP", 700, "2022-12-24")],
        "customer_id string, customer_type string, credit_score int, join_date string",
    ).withColumn("join_date", F.col("join_date").cast("date"))
    branches = spark.createDataFrame([("B1", "ROME", "CET")], "branch_id string, location string, timezone string")
    return customers, branches


FIRST = [("T1", "A", "2023-01-05 09:00:00", 10.25), ("T2", "B", "2023-02-07 23:00:00", 99.5), ("T3", "A", "2023-02-08 08:00:00", None)]
LATE = [("T4", "A", "2023-01-05 19:00:00", 0.75), ("T5", "C", "2023-01-31 12:00:00", 12000.0), ("T6", "B", None, 5.0)]
MENDED = [("T4", "A", "2023-01-06 19:00:00", 0.5)]


def files(store, table):
    return sorted(glob.glob(f"{store.catalog.location}/{store.catalog.gold}/{table}/**/*.parquet", recursive=True))


def rows_of(df):
    return sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def check(spark, store, rows):
    def table(name):
        return spark.read.table(f"{store.catalog.gold}.{name}")

    expected = {
        "date_aggregations_table": R.rollup_by_date(rows),
        "channel_type_aggregations_table": R.rollup(rows, ["channel", "transaction_type"]),
        "year_month_aggregations_table": R.rollup(rows, ["year", "month"]),
        "customer_aggregations_table": R.rollup(rows, ["customer_id"]),
        "customer_segments_table": R.value_tiers(rows),
        "last_transaction_table": R.last_transactions(rows),
        "currency_analysis": R.currency_analysis(rows),
        "transaction_frequency_table": R.amount_histogram(rows),
        "peak_off_peak_table": R.peak_off_peak(rows),
        "percentage_table": R.percent_of_total(rows),
        "median_table": R.median_exact(rows),
    }
    for name, frame in expected.items():
        assert rows_of(table(name).drop("period")) == rows_of(frame), name


def test_deliveries_equal_all_rows_at_once(spark, store, dimensions):
    months = store.add("one", txns(spark, *FIRST))
    assert months == ["2023-01", "2023-02"]
    assert len(store.publish(*dimensions, months)) == 22
    check(spark, store, txns(spark, *FIRST))
    february = [f for f in files(store, "date_aggregations_table") if "2023-02" in f]
    late = store.add("two", txns(spark, *LATE))
    assert late == ["2023-01", "none"]
    store.publish(*dimensions, late)
    check(spark, store, txns(spark, *FIRST, *LATE))
    assert february and [f for f in files(store, "date_aggregations_table") if "2023-02" in f] == february
    # a delivery that comes again takes its own place, with the rows it has now
    again = store.add("two", txns(spark, *MENDED))
    assert again == late
    store.publish(*dimensions, again)
    check(spark, store, txns(spark, *FIRST, *MENDED))
    with pytest.raises(ValueError):
        store.add("it's three", txns(spark, *LATE))


def test_nothing_new_writes_nothing(spark, store, dimensions):
    store.publish(*dimensions, store.add("one", txns(spark, *FIRST)))
    before = [files(store, name) for name in store.builders()]
    assert store.publish(*dimensions, store.add("none", txns(spark, *FIRST).limit(0))) == []
    assert [files(store, name) for name in store.builders()] == before


def test_published_figures_read_partials_only(spark, store, dimensions):
    store.add("one", txns(spark, *FIRST))
    silver = store.silver(*dimensions)
    for name, build in store.builders().items():
        assert not any("/delivery-" in path for path in build(silver).inputFiles()), name
    assert all("/parts_uniques" in path for path in store.profile().inputFiles())
    january = store.parts("moments").filter("period = '2023-01'")
    assert "PartitionFilters: [isnotnull(period" in january._jdf.queryExecution().toString()


def test_sketches_of_days_merge(spark, store):
    many = spark.range(20_000).select(
        F.concat(F.lit("T"), "id").alias("transaction_id"), F.concat(F.lit("C"), F.col("id") % 300).alias("customer_id"),
        *[F.lit("x").alias(c) for c in ("branch_id", "channel", "transaction_type", "currency", "status")],
        F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 200), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        ((F.col("id") * 7919) % 20_000).cast("double").alias("Amount_USD"),
    )
    some = GoldStore(spark, store.catalog, kept=("medians", "uniques"))
    some.add("odd", many.filter("substr(transaction_id, -1) in ('1', '3', '5', '7', '9')"))
    some.add("even", many.filter("substr(transaction_id, -1) in ('0', '2', '4', '6', '8')"))
    found = {r.column_name: r for r in some.profile().collect()}
    assert {r.total_count for r in found.values()} == {20_000} and found["status"].unique_count == 1
    assert abs(found["transaction_id"].unique_count - 20_000) < 1300 and abs(found["customer_id"].unique_count - 300) < 20
    assert abs(some.medians().first().median_amount_usd - 10_000) < 200
    few = some.profile(F.col("day") < "2023-11-20").filter("column_name = 'transaction_id'").first()
    exact = many.filter("timestamp < '2023-11-20'").count()
    assert few.total_count == exact and abs(few.unique_count - exact) < 0.07 * exact
