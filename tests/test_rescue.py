"""Lines that do not fit their schema are set apart whole, whatever is selected, and counted."""

from uuid import uuid4

import pytest
from pyspark.sql import functions as F, types as T

from ledgerspark.config import StreamConfig
from ledgerspark.scratch import scratch_path
from ledgerspark.sources import files
from ledgerspark.streaming.ingest import read_stream, write_stream

KINDS = {"id": T.IntegerType(), "name": T.StringType(), "paid": T.DateType(), "amount": T.DoubleType()}
SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in KINDS.items()])
GOOD = ["1,ann,2023-01-02,5.5", "2,,,", '3,"a, b",2023-01-02,1e3', "4,ann,2023-01-02,NaN"]
BAD = ["x,ann,2023-01-02,5.5", "5,ann,soon,5.5", "6,ann,2023-01-02,much", "7,ann,2023-01-02", "8,ann,2023-01-02,5.5,more", "99999999999,ann,2023-01-02,1", "9"]


@pytest.fixture()
def folder(spark):
    path = scratch_path(spark, "dirty")
    spark.createDataFrame([(line,) for line in GOOD + BAD[:4]], "value string").coalesce(1).write.text(path)
    spark.createDataFrame([(line,) for line in BAD[4:]], "value string").coalesce(1).write.mode("append").text(path)
    return path


def test_all_lines_are_kept(spark, folder):
    read = files.read_csv_rescued(spark, folder, SCHEMA, header=False)
    assert sorted(r.id for r in files.good_rows(read).collect()) == [1, 2, 3, 4]
    assert files.good_rows(read).columns == SCHEMA.names
    assert sorted(r.rescued_line for r in files.quarantined_rows(read).collect()) == sorted(BAD)
    counts = sorted((r.good_rows, r.quarantined_rows) for r in files.rescue_counts(read).collect())
    assert counts == [(0, 3), (4, 4)]


def test_a_line_s_fate_does_not_depend_on_the_columns(spark, folder):
    read = files.read_csv_rescued(spark, folder, SCHEMA, header=False)
    for columns in (["name"], ["id"], ["amount", "paid"]):
        assert files.good_rows(read).select(*columns).count() == len(GOOD)
        assert read.filter("quarantined").select(*columns).count() == len(BAD)
    assert read.filter("quarantined").count() == len(BAD)


def test_headers_and_empty_files(spark):
    path = scratch_path(spark, "dirty")
    spark.createDataFrame([("id,name,paid,amount",), ("1,a,2023-01-02,2",)], "value string").coalesce(1).write.text(path)
    read = files.read_csv_rescued(spark, path, SCHEMA)
    assert files.good_rows(read).count() == 1 and files.quarantined_rows(read).count() == 0
    empty = scratch_path(spark, "dirty")
    spark.createDataFrame([], "value string").write.text(empty)
    assert files.read_csv_rescued(spark, empty, SCHEMA).count() == 0


def test_a_stream_sets_lines_apart_once(spark, folder):
    database, checkpoint = f"run_{uuid4().hex}", scratch_path(spark, "checkpoint")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    config = StreamConfig(header=False)
    for more in (None, ["10,z,2023-01-01,1", "11,z"], None):
        if more:
            spark.createDataFrame([(line,) for line in more], "value string").coalesce(1).write.mode("append").text(folder)
        arriving = read_stream(spark, folder, SCHEMA, config, rescue=True)
        write_stream(arriving, f"{database}.t", checkpoint, config, available_now=True).awaitTermination()
    table = spark.read.table(f"{database}.t")
    assert files.good_rows(table).count() == len(GOOD) + 1
    assert sorted(r.rescued_line for r in files.quarantined_rows(table).collect()) == sorted([*BAD, "11,z"])
    assert files.rescue_counts(table).agg(F.sum("good_rows") + F.sum("quarantined_rows")).first()[0] == 13
    plan = files.good_rows(table)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(quarantined" in plan
