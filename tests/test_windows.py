"""Segmented windows equal the plain ones, also with one group holding most rows."""

import pytest
from pyspark.sql import Window, functions as F

from ledgerspark.operators import rollups as R, windows as W


@pytest.fixture(scope="module")
def points(spark):
    g = F.when(F.col("id") % 3 < 2, "big").when(F.col("id") % 30 == 5, F.lit(None)).otherwise(
        F.concat(F.lit("g"), F.col("id") % 11)
    )
    amount = F.when(F.col("id") % 17 == 0, F.lit(None)).otherwise(
        ((F.col("id") * 7919) % 100000) / 100
    )
    return spark.range(4000).select(
        g.alias("g"), ((F.col("id") * 31) % 50).alias("t"), "id", amount.alias("v")
    )


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


ORDER = ["t", "id"]

# No bucket; buckets that all fit a task; some too large; all too large.
CUTS = [(None, 250), ("t div 10", 10_000), ("t div 10", 100), ("t", 60)]


@pytest.fixture(params=[1, 16])
def segments(spark, request):
    """Number of range partitions: one, or more than some groups have rows."""
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("bucket,rows_per_task", CUTS)
def test_cumulative_sum(points, segments, bucket, rows_per_task):
    w = Window.partitionBy("g").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0)
    plain = points.withColumn("c", F.sum(F.col("v").cast("decimal(18,2)")).over(w).cast("double"))
    ours = W.cumulative_sum(
        points, "v", ["g"], ORDER, "c", bucket and F.expr(bucket), rows_per_task
    )
    assert ours.columns == [*points.columns, "c"]
    assert rows(ours, "id", "c") == rows(plain, "id", "c")


@pytest.mark.parametrize("bucket,rows_per_task", CUTS)
@pytest.mark.parametrize("width", [1, 7, 50])
def test_rolling_rows(points, segments, width, bucket, rows_per_task):
    w = Window.partitionBy("g").orderBy(*ORDER).rowsBetween(-(width - 1), 0)
    v = F.col("v").cast("decimal(18,2)")
    mean = F.try_divide(F.sum(v).over(w), F.count(v).over(w).cast("decimal(20,0)"))
    plain = points.withColumn("r", F.round(mean, 2).cast("double"))
    ours = W.rolling_average_rows(
        points, "v", ["g"], ORDER, width, "r", bucket and F.expr(bucket), rows_per_task
    )
    assert ours.columns == [*points.columns, "r"]
    assert rows(ours, "id", "r") == rows(plain, "id", "r")


def test_halo_crosses_short_segments(spark, segments):
    """Segments with fewer rows than the window reach back over several others."""
    df = spark.range(100).select(F.lit("g").alias("g"), "id", F.lit(1.0).alias("v"))
    ours = W.rolling_average_rows(df, "v", ["g"], ["id"], 30, "r")
    assert {r.r for r in ours.collect()} == {1.0}
    total = W.cumulative_sum(df, "v", ["g"], ["id"], "c")
    assert rows(total, "id", "c") == [(i, float(i + 1)) for i in sorted(range(100), key=lambda i: repr((i, float(i + 1))))]


def test_sequential_ids(spark, points, segments):
    numbered = W.sequential_ids(points.select("id"), ["id"], "n", "F")
    got = {r.id: r.n for r in numbered.collect()}
    assert got == {i: f"F{1001 + i}" for i in range(4000)}


def test_ids_beyond_the_width_keep_their_digits(spark):
    numbered = W.sequential_ids(spark.range(9001), ["id"], "n", "S")
    got = [r.n for r in numbered.collect()]
    assert len(set(got)) == 9001 and "S10000" in got and "S9999" in got
    padded = W.sequential_ids(spark.range(3), ["id"], "n", "S", start=1, width=4)
    assert sorted(r.n for r in padded.collect()) == ["S0001", "S0002", "S0003"]


def test_ids_of_nothing(spark):
    assert W.sequential_ids(spark.range(0), ["id"], "n").collect() == []


def test_rolling_days(spark):
    df = spark.createDataFrame(
        [
            ("a", "2023-01-01 01:00:00", 1.0),
            ("a", "2023-01-01 23:00:00", 2.0),
            ("a", "2023-01-07 00:00:00", 3.0),
            ("a", "2023-01-08 00:00:00", 10.0),
        ],
        "g string, timestamp string, v double",
    )
    got = {str(r.date): r.rolling_avg_amount_usd for r in W.rolling_average_days(df, "v", ["g"]).collect()}
    assert got == {"2023-01-01": 1.5, "2023-01-07": 2.0, "2023-01-08": 6.5}


def test_last_transaction_counts_null_as_a_key(spark):
    df = spark.createDataFrame(
        [("a", "1"), ("a", "3"), (None, "2"), (None, "5")], "customer_id string, timestamp string"
    )
    got = rows(W.with_last_transaction(df), "customer_id", "timestamp", "last_transaction_date")
    assert got == sorted(
        [("a", "1", "3"), ("a", "3", "3"), (None, "2", "5"), (None, "5", "5")], key=repr
    )


def test_exact_median(spark, points, segments):
    df = points.withColumnRenamed("v", "Amount_USD")
    plain = df.groupBy("g").agg(F.expr("percentile_disc(0.5) within group (order by Amount_USD)").alias("m"))
    ours = R.median_exact(df, ["g"])
    assert rows(ours, "g", "median_amount_usd") == rows(plain, "g", "m")


def test_full_buckets_are_cut_to_size(points):
    cut = W.segmented(points, ["g"], ORDER, F.expr("t div 10"), 100)
    parts = cut.groupBy("g", *W.SEGMENT).count()
    assert parts.agg(F.max("count")).first()[0] <= 100
    assert cut.count() == points.count()
