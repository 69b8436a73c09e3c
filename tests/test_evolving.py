"""Tables that widen with their deliveries."""

from uuid import uuid4

import pytest
from pyspark.sql import types as T

from ledgerspark.config import StreamConfig
from ledgerspark.scratch import scratch_path
from ledgerspark.sources.evolving import DELIVERY, SchemaStore, deliver, read_delivery, read_evolving, widened
from ledgerspark.streaming.evolving import start_evolving

KINDS = {"id": T.IntegerType(), "amount": T.DoubleType()}


@pytest.fixture()
def names(spark):
    database = f"evolving_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'evolving')}'")
    return f"{database}.rows", SchemaStore(spark, f"{database}.schemas")


def held(spark, table, *columns):
    return sorted(map(tuple, read_evolving(spark, table).select(*columns).collect()), key=str)


def test_new_columns_are_added_and_older_rows_have_null(spark, names):
    table, store = names
    assert store.current() == (0, T.StructType())
    deliver(spark.createDataFrame([(1, 2.5)], "id int, amount double"), table, store, 1)
    files = set(spark.read.table(table).inputFiles())
    deliver(spark.createDataFrame([("web", 7, 2)], "channel string, Amount int, id int"), table, store, 2)
    deliver(spark.createDataFrame([(3,)], "id int"), table, store, 3)
    assert spark.read.table(table).columns == ["id", "amount", "channel", DELIVERY]
    assert held(spark, table, "id", "amount", "channel") == [(1, 2.5, None), (2, 7.0, "web"), (3, None, None)]
    assert files <= set(spark.read.table(table).inputFiles())
    assert [r.version for r in store.versions().orderBy("version").collect()] == [1, 2]


def test_a_delivery_that_comes_again_replaces_itself(spark, names):
    table, store = names
    for rows in ([(1, 1.0), (2, 2.0)], [(1, 5.0)]):
        deliver(spark.createDataFrame(rows, "id int, amount double"), table, store, 4)
    deliver(spark.createDataFrame([], "id int, note string"), table, store, 5)
    assert held(spark, table, "id", "amount", "note") == [(1, 5.0, None)]


def test_what_does_not_fit_is_refused_before_anything_is_written(spark, names):
    table, store = names
    deliver(spark.createDataFrame([(1, 1.0)], "id int, amount double"), table, store, 1)
    for odd in ("id string, extra int", "id bigint, extra int", "id int, amount array<int>", f"id int, {DELIVERY} int"):
        with pytest.raises(ValueError):
            deliver(spark.createDataFrame([], odd), table, store, 2)
    assert store.current()[0] == 1 and held(spark, table, "id", "amount") == [(1, 1.0)]
    twice = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("A", T.IntegerType())])
    with pytest.raises(ValueError):
        widened(T.StructType(), twice)


def csv(spark, path, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)


def test_headers_say_which_column_is_which(spark):
    path = scratch_path(spark, "headers")
    csv(spark, f"{path}/a", "amount,ID,note", "1.5,1,x", ",2,")
    rows = read_delivery(spark, f"{path}/a", KINDS)
    assert rows.dtypes == [("amount", "double"), ("ID", "int"), ("note", "string")]
    assert sorted(r.ID for r in rows.collect()) == [1, 2]
    csv(spark, f"{path}/b", "id,amount,note", "1,1.5,x")
    with pytest.raises(Exception, match="header"):
        read_delivery(spark, [f"{path}/a", f"{path}/b"], KINDS).collect()


def test_a_stream_takes_each_file_once_over_restarts(spark, names):
    table, store = names
    path, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")

    def run(most=None):
        config = StreamConfig(max_files_per_trigger=most)
        start_evolving(spark, path, KINDS, table, checkpoint, store, config, available_now=True).awaitTermination()

    csv(spark, f"{path}/first", "id,amount", "1,1.5")
    run()
    csv(spark, f"{path}/second", "channel,id", "web,2")
    csv(spark, f"{path}/third", "id,status,amount", "3,done,2.5", "4,,")
    run()
    run()
    found = held(spark, table, "id", "amount", "channel", "status")
    assert found == [(1, 1.5, None, None), (2, None, "web", None), (3, 2.5, None, "done"), (4, None, None, None)]
    assert spark.read.table(table).select(DELIVERY).distinct().count() == 2
    csv(spark, f"{path}/fourth", "id", "5")
    csv(spark, f"{path}/fifth", "id,note", "6,n")
    run(most=1)
    assert spark.read.table(table).select(DELIVERY).distinct().count() == 4
    assert held(spark, table, "id", "note")[4:] == [(5, None), (6, "n")]
