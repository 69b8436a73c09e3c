from datetime import date
from uuid import uuid4

import pytest

from ledgerspark.config import CatalogConfig, GoldRules, LakeConfig
from ledgerspark.operators.profiling import data_summary, null_counts
from ledgerspark.plans.gold import gold_tables, publish_gold
from ledgerspark.schemas import BRANCHES, BRONZE_TABLES, SILVER_TABLES
from ledgerspark.scratch import scratch_path, scratch_root
from ledgerspark.sources import database
from ledgerspark.sources.database import DatabaseTable, extract_jdbc, read_database_table
from ledgerspark.sources.files import configure_lake, lake_uri, read_csv, spread_scan, write_csv
from ledgerspark.sources.tables import bootstrap_catalog, overwrite_table, read_table


def test_csv_binds_by_position(spark, tmp_path):
    file = tmp_path / "branches.csv"
    file.write_text("branch_id,name,location,timezone,currency\nB0,First,Paris,CET,EUR\n")
    row = read_csv(spark, str(file), BRANCHES).first()
    assert (row.branch_name, row.currency) == ("First", "EUR")


def test_csv_round_trip_keeps_blanks_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([("B0", " a ", None, "x,y", '"q"')], BRANCHES)
    write_csv(df, str(tmp_path / "out"))
    assert read_csv(spark, str(tmp_path / "out"), BRANCHES).collect() == df.collect()


def test_lake(spark, monkeypatch):
    lake = LakeConfig("acct", "box", "c.csv", "b.csv", "t/", key_env="TEST_LAKE_KEY")
    assert lake_uri(lake, "/a/b.csv") == "abfss://box@acct.dfs.core.windows.net/a/b.csv"
    monkeypatch.delenv("TEST_LAKE_KEY", raising=False)
    with pytest.raises(KeyError):
        configure_lake(spark, lake)
    monkeypatch.setenv("TEST_LAKE_KEY", "k")
    assert configure_lake(spark, lake) == "abfss://box@acct.dfs.core.windows.net/"
    assert spark.conf.get("fs.azure.account.key.acct.dfs.core.windows.net") == "k"


def test_scratch_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert scratch_root(spark).startswith(shared)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_narrow_scans_are_spread(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    assert spread_scan(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, 1, 50)
    assert spread_scan(many) is many


class Reader:
    """Stands in for ``spark.read``: records the calls, answers from given frames."""

    def __init__(self, answers):
        self.answers, self.calls = answers, []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return next(frame for part, frame in self.answers.items() if part in table)


def test_jdbc_reads_in_ranges(spark):
    bounds = spark.createDataFrame([(5, 905)], "lo int, hi int")
    reader = Reader({"MIN(": bounds, "customers": spark.range(3)})
    table = DatabaseTable("customers", "id", num_partitions=9)
    assert read_database_table(reader, "jdbc:x", table, {"user": "u"}).count() == 3
    name, options = reader.calls[-1]
    assert name == "customers" and options["numPartitions"] == 9 and options["column"] == "id"
    assert (options["lowerBound"], options["upperBound"]) == ("5", "905")
    assert options["properties"] == {"user": "u", "fetchsize": "10000"}


def test_extract_goes_on_after_a_failure(spark, tmp_path):
    def read(session, url, table, properties):
        if table.name == "branches":
            raise RuntimeError("no such table")
        return session.range(4)

    tables = [DatabaseTable("branches", "id"), DatabaseTable("customers", "id")]
    failures = extract_jdbc(spark, "jdbc:x", tables, str(tmp_path), read=read)
    assert list(failures) == ["branches"]
    assert spark.read.parquet(str(tmp_path / "customers")).count() == 4


@pytest.fixture
def catalog(spark):
    run = uuid4().hex
    return CatalogConfig(
        f"bronze_{run}", f"silver_{run}", f"gold_{run}", location=scratch_path(spark, "catalog")
    )


def test_bootstrap_is_repeatable_and_exact(spark, catalog):
    bootstrap_catalog(spark, catalog)
    bootstrap_catalog(spark, catalog)
    for layer, tables in ((catalog.bronze, BRONZE_TABLES), (catalog.silver, SILVER_TABLES)):
        assert {t.name for t in spark.catalog.listTables(layer)} == set(tables)
        for name, schema in tables.items():
            assert [(f.name, f.dataType) for f in read_table(spark, f"{layer}.{name}").schema] == [
                (f.name, f.dataType) for f in schema
            ]


def test_overwrite_by_partition(spark, catalog):
    bootstrap_catalog(spark, catalog)
    df = spark.range(100).selectExpr("id", "id % 3 AS year")
    for _ in range(2):
        overwrite_table(df, f"{catalog.gold}.t", ["year"])
    stored = read_table(spark, f"{catalog.gold}.t")
    assert stored.count() == 100
    plan = stored.filter("year = 1")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_publishing_twice_replaces(spark, sf_dir, catalog):
    from ledgerspark.workload import bank

    bootstrap_catalog(spark, catalog)
    silver = bank.silver(spark, sf_dir)
    first = publish_gold(silver, bank.GOLD, catalog)
    counts = {name: read_table(spark, name).count() for name in first}
    assert publish_gold(silver, bank.GOLD, catalog) == first
    assert {name: read_table(spark, name).count() for name in first} == counts
    assert len(first) == len(gold_tables(GoldRules(), catalog)) == 25


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, "a", date(2023, 1, 1), 0.0), (3, "a", None, -0.0), (None, None, None, None)],
        "n int, s string, d date, f double",
    )
    got = {r.column_name: tuple(r)[1:] for r in data_summary(df).collect()}
    assert got["n"] == (3, 2, 1, 2, 2.0, pytest.approx(2**0.5), 1.0, 3.0)
    assert got["s"] == (3, 2, 1, 1, None, None, None, None)
    assert got["d"] == (3, 1, 2, 1, None, None, None, None)
    assert got["f"][:4] == (3, 2, 1, 1)
    assert tuple(null_counts(df).first()) == (1, 1, 2, 1)
    empty = {r.column_name: r.unique_count for r in data_summary(df.limit(0)).collect()}
    assert empty == {"n": 0, "s": 0, "d": 0, "f": 0}
