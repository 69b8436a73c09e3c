from decimal import Decimal
from uuid import uuid4

import pytest

from ledgerspark.config import StreamConfig
from ledgerspark.schemas import CUSTOMERS, RATES, TRANSACTIONS
from ledgerspark.scratch import scratch_path
from ledgerspark.streaming.ingest import (
    read_stream,
    reset_stream,
    stream_transaction_table,
    write_stream,
)
from ledgerspark.streaming.silver import silver_transactions_stream
from ledgerspark.streaming.summary import latest_summary, start_summary, streaming_data_summary

HEADER = ",".join(TRANSACTIONS.names)


def drop(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *rows]) + "\n")


def row(id, moment="2023-01-01 00:00:00", amount="5.0", currency="EUR", status="completed"):
    return f"{id},C1,B1,web,payment,{amount},{currency},{moment},{status}"


@pytest.fixture
def database(spark):
    name = f"stream_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    return name


def test_ingest_takes_each_file_once_and_can_be_reset(spark, tmp_path, database):
    folder, table, checkpoint = tmp_path / "in", f"{database}.t", str(tmp_path / "cp")

    def run(where):
        stream_transaction_table(
            spark, str(folder), TRANSACTIONS, table, where, available_now=True
        ).awaitTermination()
        return sorted(r.transaction_id for r in spark.read.table(table).collect())

    drop(folder, "a.csv", row("T1"), row("T2"))
    assert run(checkpoint) == ["T1", "T2"]
    assert run(checkpoint) == ["T1", "T2"]
    drop(folder, "b.csv", row("T3"))
    assert run(checkpoint) == ["T1", "T2", "T3"]
    fresh = reset_stream(spark, table, checkpoint)
    assert fresh != checkpoint and reset_stream(spark, table, fresh) != fresh
    assert spark.read.table(table).count() == 0
    assert run(fresh) == ["T1", "T2", "T3"]


def test_processing_time_trigger(spark, tmp_path, database):
    folder = tmp_path / "in"
    drop(folder, "a.csv", row("T1"))
    query = stream_transaction_table(
        spark, str(folder), TRANSACTIONS, f"{database}.t", str(tmp_path / "cp"),
        StreamConfig(processing_time="1 second"),
    )
    try:
        query.processAllAvailable()
        assert spark.read.table(f"{database}.t").count() == 1
    finally:
        query.stop()


def test_summary(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    with pytest.raises(ValueError):
        streaming_data_summary(spark.range(1))
    drop(folder, "a.csv", row("T1", amount="1.0"), row("T2", amount=""))
    for expected in (2, 3):
        summary = streaming_data_summary(read_stream(spark, str(folder), TRANSACTIONS))
        start_summary(summary, out, str(tmp_path / "cp"), available_now=True).awaitTermination()
        got = {r.column_name: r for r in latest_summary(summary, out).collect()}
        assert got["amount"].total_count == expected
        drop(folder, "b.csv", row("T3", amount="3.0"))
    assert (got["amount"].non_null_count, got["amount"].null_count) == (2, 1)
    assert (got["amount"].mean, got["amount"].min, got["amount"].max) == (2.0, 1.0, 3.0)
    assert got["transaction_id"].unique_count == 3 and got["currency"].unique_count == 1
    for i in range(4, 7):
        drop(folder, f"{i}.csv", row(f"T{i}"))
        summary = streaming_data_summary(read_stream(spark, str(folder), TRANSACTIONS))
        start_summary(summary, out, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert latest_summary(summary, out).first().total_count == 6
    assert latest_summary(summary, out).columns == summary.columns
    assert len([p for p in (tmp_path / "out").iterdir() if p.is_dir()]) == 2


def test_timestamps_of_a_stream_are_kept(spark, tmp_path, database):
    folder = tmp_path / "in"
    folder.mkdir()
    line = "C1,a,e,p,x,700,2022-01-02,2023-03-04 05:06:07,VIP"
    (folder / "a.csv").write_text(",".join(CUSTOMERS.names) + "\n" + line + "\n")
    arriving = read_stream(spark, str(folder), CUSTOMERS)
    write_stream(arriving, f"{database}.c", str(tmp_path / "cp"), available_now=True).awaitTermination()
    got = spark.read.table(f"{database}.c").first()
    assert (str(got.join_date), str(got.last_update)) == ("2022-01-02", "2023-03-04 05:06:07")


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path, database):
    folder, table = tmp_path / "in", f"{database}.t"
    rates = spark.createDataFrame([("EUR", Decimal("0.50"))], RATES)

    def run():
        raw = read_stream(spark, str(folder), TRANSACTIONS)
        silver = silver_transactions_stream(raw, rates, config=StreamConfig(watermark="2 days"))
        write_stream(silver, table, str(tmp_path / "cp"), available_now=True).awaitTermination()
        return sorted(r.transaction_id for r in spark.read.table(table).collect())

    drop(folder, "a.csv", row("t1"))
    drop(folder, "b.csv", row("t2", moment="2023-01-10 00:00:00"))
    assert run() == ["T1", "T2"]
    # The state of t1 is gone by now; its copy and any other row as old are behind the watermark.
    drop(folder, "c.csv", row("t1"), row("t3"), row("t4", moment="2023-01-09 00:00:00"))
    assert run() == ["T1", "T2", "T4"]


def test_silver_survives_restarts_and_overlaps(spark, tmp_path, database):
    folder, table = tmp_path / "in", f"{database}.t"
    rates = spark.createDataFrame([("EUR", Decimal("0.50"))], RATES)

    def run():
        raw = read_stream(spark, str(folder), TRANSACTIONS)
        silver = silver_transactions_stream(raw, rates, config=StreamConfig(watermark="2 days"))
        write_stream(silver, table, str(tmp_path / "cp"), available_now=True).awaitTermination()
        return {r.transaction_id: r for r in spark.read.table(table).collect()}

    drop(folder, "a.csv", row("t1"), row("t1", status="pending"), row("t2", amount="100001"),
         row("t3", moment="bad"))
    assert set(run()) == {"T1"}
    drop(folder, "b.csv", row("t1"), row("t4", moment="2023-01-02 10:00:00", currency=""))
    got = run()
    assert set(got) == {"T1", "T4"} and spark.read.table(table).count() == 2
    assert got["T1"].Amount_USD == 10.0 and got["T1"].status == "COMPLETED"
    assert (got["T4"].currency, got["T4"].Amount_USD, got["T4"].month) == ("USD", 5.0, 1)
