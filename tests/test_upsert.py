"""Streams into keyed tables: any order, again, late, after a failure; untouched partitions keep their files."""

import glob
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from ledgerspark import scratch
from ledgerspark.config import StreamConfig
from ledgerspark.operators import rollups as R
from ledgerspark.operators.cleaning import clean_duplicate_transactions
from ledgerspark.schemas import SILVER_TRANSACTIONS
from ledgerspark.scratch import scratch_path
from ledgerspark.sources.files import write_csv
from ledgerspark.streaming import upsert as U
from ledgerspark.streaming.ingest import read_stream
from tests.test_gold import txns

ROWS = "id string, moment string, status string"
COPIES = [("a", "2023-01-02", "done"), ("b", "2023-01-01", "open"), ("a", "2023-01-01", "open"), ("b", "2023-01-01", "done"),
          ("c", None, "open"), ("c", "2020-01-01", None), (None, "2023-01-01", "x"), (None, "2023-01-02", "y"), ("a", "2023-01-02", "done")]


@pytest.fixture()
def place(spark):
    folder = scratch_path(spark, "database")
    name = f"run_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return f"{name}.t", folder


def files(folder):
    return set(glob.glob(f"{folder}/t/**/*.parquet", recursive=True))


def rows_of(df, columns):
    return sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect())))


def keyed(spark, rows, buckets=4):
    return spark.createDataFrame(rows, ROWS).withColumn(U.BUCKET, U.key_bucket(["id"], buckets))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_latest_copy_wins_in_any_order(spark, place, order):
    table, _ = place
    for batch, part in enumerate(order):
        U.upsert(keyed(spark, COPIES[part::3]), batch, table, ["id"], "moment", U.BUCKET, scratch_path(spark, "staged"))
    expected = clean_duplicate_transactions(spark.createDataFrame(COPIES, ROWS), ["id"], "moment")
    assert rows_of(U.read_latest(spark, table), ROWS.replace(" string", "").split(", ")) == rows_of(expected, expected.columns)


def test_untouched_partitions_keep_their_files(spark, place):
    table, folder = place
    staging = scratch_path(spark, "staged")
    U.upsert(keyed(spark, [(f"k{i}", "2023-01-01", "open") for i in range(40)]), 0, table, ["id"], "moment", U.BUCKET, staging)
    before = files(folder)
    one = keyed(spark, [("k7", "2023-01-02", "done")])
    touched = f"{U.BUCKET}={one.first()[U.BUCKET]}/"
    U.upsert(one, 1, table, ["id"], "moment", U.BUCKET, staging)
    assert {f for f in before if touched not in f} <= files(folder) and len(before) == 4
    assert not {f for f in before if touched in f} & files(folder)
    assert U.read_latest(spark, table).filter("status = 'done'").count() == 1 and spark.read.table(table).count() == 40


def test_a_batch_cut_short_is_mended_from_its_staged_rows(spark, place, monkeypatch):
    table, folder = place
    staging = scratch_path(spark, "staged")
    U.upsert(keyed(spark, [(f"k{i}", "2023-01-01", "open") for i in range(40)]), 0, table, ["id"], "moment", U.BUCKET, staging)
    more = keyed(spark, [("k1", "2023-01-05", "done"), ("new", "2023-01-01", "open")])

    def fail(df, name, cut):
        spark.sql(f"ALTER TABLE {name} DROP PARTITION ({U.BUCKET} = {more.first()[U.BUCKET]})")
        raise OSError("lost while replacing")

    with monkeypatch.context() as broken:
        broken.setattr(U, "overwrite_partitions", fail)
        with pytest.raises(OSError):
            U.upsert(more, 1, table, ["id"], "moment", U.BUCKET, staging)
    assert spark.read.table(table).count() < 40
    for _ in range(2):
        U.upsert(more, 1, table, ["id"], "moment", U.BUCKET, staging)
        assert spark.read.table(table).count() == 41
    assert U.read_latest(spark, table).filter("id = 'k1'").first().status == "done"


def test_daily_rollup_over_restarts_and_late_rows(spark, place):
    table, folder = place
    path, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")
    deliveries = [
        [("T1", "A", "2023-01-05 09:00:00", 10.25), ("T2", "B", "2023-02-07 23:00:00", 99.5)],
        [("T3", "A", "2023-02-07 00:00:00", 1.0), ("T4", "A", "2023-03-01 00:00:00", 2.5), ("T5", "A", None, 7.0)],
        [("T6", "B", "2023-03-01 23:59:59", 4.0), ("T7", "B", "2022-01-01 00:00:00", 9.0)],
    ]
    january = None
    for rows in deliveries:
        write_csv(txns(spark, *rows), path, mode="append")
        arriving = read_stream(spark, path, SILVER_TRANSACTIONS)
        U.start_daily_rollup(
            arriving, table, ["channel"], checkpoint, StreamConfig(watermark="60 days"), available_now=True
        ).awaitTermination()
        now = {f for f in files(folder) if "period=2023-01" in f}
        assert january in (None, now)
        january = now
    counted = [r for d in deliveries for r in d if r[0] not in ("T5", "T7")]  # no timestamp; later than the watermark
    dated = txns(spark, *counted).withColumn("date", F.col("timestamp").cast("date"))
    expected = R.rollup(dated, ["date", "channel"])
    assert rows_of(U.read_daily_rollup(spark, table), expected.columns) == rows_of(expected, expected.columns)


def test_a_batch_is_ranked_once_with_what_is_stored_in_small_tasks(spark, place, monkeypatch):
    table, _ = place
    monkeypatch.setattr(scratch, "SORT_ROWS", 2)
    usual, calls = int(spark.conf.get(scratch.PARTITIONS)), []

    def ranked(df, *args):
        calls.append((df.count(), int(spark.conf.get(scratch.PARTITIONS))))
        return clean_duplicate_transactions(df, *args)

    monkeypatch.setattr(U, "clean_duplicate_transactions", ranked)
    for batch in range(2):
        rows = [(f"k{i}", f"2023-01-0{batch + 1}", "open") for i in range(40)]
        U.upsert(keyed(spark, rows), batch, table, ["id"], "moment", U.BUCKET, scratch_path(spark, "staged"))
    assert calls == [(40, max(usual, 20)), (80, max(usual, 40))]
    assert int(spark.conf.get(scratch.PARTITIONS)) == usual
    assert {(r.moment, r.status) for r in U.read_latest(spark, table).collect()} == {("2023-01-02", "open")}
