"""Joins give the same rows however they are carried out."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerspark.operators import joins as J


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, some keys unknown, some null."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") % 40)
    )
    return spark.range(3000).select("id", key.cast("int").alias("k"))


@pytest.fixture(scope="module")
def lookup(spark):
    keys = spark.range(30).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    return keys.unionByName(spark.createDataFrame([(None, -1), (8, -8)], "k int, v long"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(facts, lookup, how, null_safe):
    plain = facts.alias("l").join(lookup.alias("r"), J._equal(["k"], null_safe), how)
    plain = plain.select(*J._output(facts, lookup, ["k"], how))
    for rows_per_task in (10, 100, 1_000_000):
        salted = J.skew_join(
            facts, lookup, ["k"], how, null_safe=null_safe, rows_per_task=rows_per_task
        )
        assert salted.columns == plain.columns
        assert rows(salted) == rows(plain)
    measured = J.lookup_join(facts, lookup, ["k"], how, null_safe=null_safe)
    assert rows(measured) == rows(plain)
    beyond = J.lookup_join(facts, lookup, ["k"], how, null_safe=null_safe, max_rows=3)
    assert rows(beyond) == rows(plain)


def test_every_hot_key_gets_enough_salts(spark, facts):
    hot = J.hot_keys(J.key_counts(facts, ["k"]), rows_per_task=100)
    found = {r.k: r["__salts"] for r in hot.collect()}
    counts = {r.k: r["__n"] for r in J.key_counts(facts, ["k"]).collect()}
    assert found == {k: -(-n // 100) for k, n in counts.items() if n > 100} and 7 in found
    many = spark.range(30_000).selectExpr("id % 10001 AS k")
    assert J.hot_keys(J.key_counts(many, ["k"]), rows_per_task=1).count() == 10_001


def test_a_long_list_of_hot_keys_is_not_broadcast(spark, facts, lookup, monkeypatch):
    plain = facts.join(lookup, "k", "left").count()
    monkeypatch.setattr(J, "fits_broadcast", lambda *a, **k: False)
    assert J.skew_join(facts, lookup, ["k"], "left", rows_per_task=50).count() == plain


def test_lookups_accept_the_same_joins_at_every_size(facts, lookup):
    for how in ("right", "full_outer"):
        for most in (1, 1000):
            with pytest.raises(ValueError):
                J.lookup_join(facts, lookup, ["k"], how, max_rows=most)


def test_nested_columns_count_for_the_broadcast(spark):
    wide = spark.range(90).selectExpr("id", "sequence(0, 9999) AS a", "map('k', repeat('x', 1000)) AS m")
    assert not J.fits_broadcast(wide, max_bytes=1 << 20)


def test_hot_key_is_split_over_tasks(spark, facts, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = J.skew_join(facts, lookup, ["k"], rows_per_task=50)
        plan = joined._jdf.queryExecution().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        sizes = [
            r["count"]
            for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 900


def test_broadcast_is_measured(spark):
    small = spark.range(10).withColumn("s", F.lit("x"))
    assert J.fits_broadcast(small, max_rows=10)
    assert not J.fits_broadcast(small, max_rows=9)
    wide = spark.range(10).withColumn("s", F.repeat(F.lit("x"), 1000))
    assert not J.fits_broadcast(wide, max_bytes=5000)
    assert J.fits_broadcast(spark.range(0))


def test_outer_joins_refuse_salting(facts, lookup):
    with pytest.raises(ValueError):
        J.skew_join(facts, lookup, ["k"], "full_outer")


def test_full_outer_keeps_null_keys_apart(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([("x", 3), (None, 4), ("y", 5)], "k string, b int")
    got = sorted(map(tuple, J.full_outer([a, b], ["k"]).collect()), key=repr)
    assert got == sorted([("x", 1, 3), (None, 2, None), (None, None, 4), ("y", None, 5)], key=repr)


def test_three_tables_keep_transaction_columns(spark):
    txns = spark.createDataFrame(
        [("T1", "C1", "B1"), ("T2", "C2", "B1"), ("T3", "C1", "B9")],
        "transaction_id string, customer_id string, branch_id string",
    )
    customers = spark.createDataFrame([("C1", "n")], "customer_id string, name string")
    branches = spark.createDataFrame([("B1", "n")], "branch_id string, name string")
    joined = J.join_customer_branch_transaction(customers, branches, txns)
    assert joined.columns == txns.columns
    assert rows(joined) == [("T1", "C1", "B1")]


@pytest.mark.parametrize("hot_left,hot_right", [(400, 1), (1, 400), (60, 50), (300, 0), (0, 300), (0, 0)])
def test_full_outer_splits_hot_keys(spark, hot_left, hot_right):
    left = [("h", i) for i in range(hot_left)] + [(None, i) for i in range(120)] + [(f"k{i}", i) for i in range(30)] + [("k1", 7)]
    right = [("h", i) for i in range(hot_right)] + [(None, 1)] * 110 + [(f"k{i}", i) for i in range(20, 60)] + [("k59", 8)]
    a, b = spark.createDataFrame(left, "k string, a int"), spark.createDataFrame(right, "k string, b int")
    found = J.full_outer([a, b], ["k"], rows_per_task=40)
    plain = a.join(b, ["k"], "full_outer")
    assert found.columns == plain.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))


def test_full_outer_chain_with_a_hot_key(spark):
    frames = [
        spark.createDataFrame([("h", 1, i) for i in range(n)] + [(f"k{i}", i, i) for i in range(j, 9)], f"k string, l int, c{j} int")
        for j, n in enumerate((90, 1, 2))
    ]
    plain = frames[0].join(frames[1], ["k", "l"], "full_outer").join(frames[2], ["k", "l"], "full_outer")
    found = J.full_outer(frames, ["k", "l"], rows_per_task=50)
    assert Counter(map(tuple, found.select(*plain.columns).collect())) == Counter(map(tuple, plain.collect()))
    assert "Union" in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("slots", [1, 7])
def test_full_keys_are_those_of_a_plain_count(spark, monkeypatch, slots):
    monkeypatch.setattr(J, "SLOTS", slots)
    rows = [(k, l) for k, n in ((1, 90), (2, 40), (3, 41), (None, 60), (4, 1)) for l in ["x"] * n]
    df = spark.createDataFrame(rows, "k int, l string")
    assert sorted(map(tuple, J._full_keys(df, ["k", "l"], 40).collect()), key=repr) == [(1, "x", 90), (3, "x", 41), (None, "x", 60)]
    assert J._full_keys(df, ["k", "l"], 90).count() == 0


def test_a_full_outer_chain_joins_each_pair_once(spark):
    frames = [spark.createDataFrame([(i, i) for i in range(n, n + 9)], f"k int, v{n} int") for n in range(3)]
    chained = J.full_outer(frames, ["k"])
    assert chained._jdf.queryExecution().optimizedPlan().toString().count("Join FullOuter") == 1
    assert chained.count() == 11
