"""What the plans must and must not contain."""

import re
from dataclasses import replace
from pathlib import Path
from threading import Barrier
from uuid import uuid4

import pytest
from pyspark.sql import DataFrameWriter

import ledgerspark
from ledgerspark import scratch
from ledgerspark.config import CatalogConfig
from ledgerspark.functions.enrich import convert_currency_to_usd
from ledgerspark.operators import cleaning as C, rollups as R
from ledgerspark.operators.profiling import data_summary
from ledgerspark.plans import fraud, gold
from ledgerspark.plans.gold import gold_tables, publish_gold
from ledgerspark.scratch import materialise, scratch_path
from ledgerspark.workload import bank
from ledgerspark.workload.queries import queries

LAZY = sorted(
    set(queries())
    - {"publish_gold", "catalog_bootstrap"}
    - {n for n in queries() if n.startswith(("stream_", "sink_", "scan_"))}
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_nested_loops(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    for node in ("PythonEval", "BatchEvalPython", "ArrowEval", "MapInPandas", "FlatMapGroups",
                 "CartesianProduct", "NestedLoop"):
        assert node not in text


@pytest.mark.parametrize(
    "name", ["agg_channel", "txn_with_location", "fraud_velocity", "cumulative_sum", "rolling_avg_rows",
             "last_txn_window", "dedup_latest", "clean_transactions", "median_exact"]
)
def test_rows_never_meet_in_one_partition(spark, sf_dir, name):
    assert "SinglePartition" not in plan(queries()[name](spark, sf_dir)).split("Subquery")[0]


def test_dedup_combines_before_the_shuffle(spark, sf_dir):
    raw = bank.raw_transactions(spark, sf_dir)
    text = plan(C.clean_duplicate_transactions(raw, ["transaction_id"], "timestamp"))
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


def test_amount_range_stays_above_the_dedup(spark, sf_dir):
    raw = bank.raw_transactions(spark, sf_dir)
    text = plan(C.clean_transactions(raw, bank.CLEANING))
    assert text.index("100000") < text.index("WindowGroupLimit")


def test_lookups_are_broadcast_when_measured_small(spark, sf_dir):
    silver = bank.silver(spark, sf_dir)
    text = plan(convert_currency_to_usd(silver.transactions.drop("Amount_USD"), bank.rates(spark)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_scans_are_pruned_and_filtered(spark, sf_dir):
    t = bank.silver(spark, sf_dir).transactions
    assert "ReadSchema: struct<channel:string,Amount_USD:double>" in plan(R.rollup(t, ["channel"]))
    text = plan(fraud.detect_watchlist_match(t.filter("timestamp > '2001-01-01'")))
    assert "GreaterThan(timestamp,2001-01-01)" in text


def test_library_never_collects():
    root = Path(ledgerspark.__file__).parent
    for file in root.rglob("*.py"):
        if file.relative_to(root).parts[0] == "llm":
            continue
        source = file.read_text()
        for call in (".collect()", "toPandas", "localCheckpoint", "udf(", "crossJoin", "toLocalIterator"):
            assert call not in source, f"{call} in {file}"


def scans(df):
    df.count()
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    return final.count("FileScan parquet")


def test_profiles_read_their_input_once(spark, sf_dir):
    raw = bank.silver(spark, sf_dir).transactions
    assert scans(data_summary(raw)) == 1
    assert scans(data_summary(raw, approx=True)) == 1


def test_published_memberships_read_no_transactions(spark, sf_dir):
    s = bank.silver(spark, sf_dir)
    summary = materialise(R.customer_partials(s.transactions), "customers")
    members = gold_tables(bank.GOLD)["segment_count_table"](replace(s, customer_summary=summary))
    text = plan(members)
    assert "Amount_USD" not in text and "transaction_id" not in text


def test_partitioned_transactions_are_pruned(spark, sf_dir):
    name = f"cut_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'cut')}'")
    s = bank.silver(spark, sf_dir)
    catalog = CatalogConfig(gold=name, partition_transactions_by=("year", "month"))
    published = publish_gold(s, bank.GOLD, catalog)
    assert len(published) == 25
    placed = spark.read.table(f"{name}.transaction_with_location_table")
    assert placed.count() == s.transactions.count()
    text = plan(placed.filter("year = 2001 and month > 6").select("transaction_id"))
    assert re.search(r"PartitionFilters: \[[^]]*year[^]]*month", text) and "PushedFilters: []" in text
    totals = spark.read.table(f"{name}.channel_aggregations_table")
    assert sum(r.transaction_count for r in totals.collect()) == placed.count()


def test_silver_is_built_in_tasks_of_few_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(scratch, "SORT_ROWS", 100)
    names = (scratch.PARTITIONS, scratch.ADVISORY)
    usual, seen, write = [spark.conf.get(n) for n in names], [], DataFrameWriter.parquet

    def noted(self, *args, **kwargs):
        seen.append((int(spark.conf.get(names[0])), spark.conf.get(names[1])))
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    path = bank.build_silver(spark, sf_dir)
    rows = bank.table(spark, sf_dir, "lineitem").count()
    assert seen == [(max(int(usual[0]), -(-rows // 100)), f"{scratch.SORT_BYTES}b")] * 3
    assert [spark.conf.get(n) for n in names] == usual
    built = spark.read.parquet(f"{path}/transactions")
    assert sorted(built.collect()) == sorted(bank.silver(spark, sf_dir).transactions.collect())


def test_sizes_of_tasks_are_set_back_after_a_failure(spark):
    names = (scratch.ADAPTIVE, scratch.ADVISORY, scratch.PARTITIONS)
    usual = [spark.conf.get(n) for n in names]
    with pytest.raises(KeyError), scratch.small_sorts(spark, 10**9):
        assert int(spark.conf.get(scratch.PARTITIONS)) == 2000
        raise KeyError
    assert [spark.conf.get(n) for n in names] == usual


def test_gold_tables_are_written_beside_each_other(spark, sf_dir, monkeypatch):
    both, written = Barrier(2, timeout=60), []

    def meet(frame, name, cut):
        both.wait()
        written.append(name)

    monkeypatch.setattr(gold, "gold_tables", lambda *_: {"one": lambda s: s.branches, "two": lambda s: s.branches})
    monkeypatch.setattr(gold, "overwrite_table", meet)
    assert publish_gold(bank.silver(spark, sf_dir), bank.GOLD, CatalogConfig(gold="g")) == ["g.one", "g.two"]
    assert sorted(written) == ["g.one", "g.two"]
