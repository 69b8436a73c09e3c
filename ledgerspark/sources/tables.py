"""Managed tables of the three layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from ledgerspark.config import CatalogConfig
from ledgerspark.schemas import BRONZE_TABLES, SILVER_TABLES


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def overwrite_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh. Partitioned tables are rebalanced by partition value before the write, so a
    large partition is split over tasks and a small one gives one file."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


PARTITION_MODE = "spark.sql.sources.partitionOverwriteMode"


def overwrite_partitions(df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows for, and no other; the first write makes the table."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        overwrite_table(df, name, partition_by)
        return
    before = spark.conf.get(PARTITION_MODE)
    spark.conf.set(PARTITION_MODE, "dynamic")
    try:
        ordered = df.select(*spark.read.table(name).columns)
        ordered.hint("rebalance", *partition_by).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(PARTITION_MODE, before)


def columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def bootstrap_catalog(spark: SparkSession, catalog: CatalogConfig = CatalogConfig()) -> None:
    """Create the layers and their bronze and silver tables where they are missing."""
    layers = {catalog.bronze: BRONZE_TABLES, catalog.silver: SILVER_TABLES, catalog.gold: {}}
    for layer, tables in layers.items():
        place = f" LOCATION '{catalog.location}/{layer}'" if catalog.location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{place}")
        for name, schema in tables.items():
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {layer}.{name} ({columns_ddl(schema)}) USING PARQUET"
            )


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")
