"""Extract of relational tables to Parquet."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class DatabaseTable:
    """A table and the numeric or date column its reads split on."""

    name: str
    partition_column: str
    num_partitions: int = 64
    fetch_size: int = 10_000


def _query(spark: SparkSession, url: str, sql: str, properties: Mapping[str, str]) -> DataFrame:
    return spark.read.jdbc(url, f"({sql}) q", properties=dict(properties))


def read_database_table(
    spark: SparkSession, url: str, table: DatabaseTable, properties: Mapping[str, str]
) -> DataFrame:
    """Parallel read in ranges of the partition column."""
    options = {**properties, "fetchsize": str(table.fetch_size)}
    column = table.partition_column
    bounds = _query(
        spark, url, f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table.name}", options
    ).first()
    if bounds[0] is None:
        return spark.read.jdbc(url, table.name, properties=options)
    return spark.read.jdbc(
        url,
        table.name,
        column=column,
        lowerBound=str(bounds[0]),
        upperBound=str(bounds[1]),
        numPartitions=table.num_partitions,
        properties=options,
    )


def extract_jdbc(
    spark: SparkSession,
    url: str,
    tables: Sequence[DatabaseTable],
    out_dir: str,
    properties: Mapping[str, str] | None = None,
    read=read_database_table,
) -> dict[str, str]:
    """Copy tables to ``out_dir/<table>``; a table that fails does not stop the others.

    Returns the failures by table.
    """
    failures = {}
    for table in tables:
        try:
            frame = read(spark, url, table, properties or {})
            frame.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{table.name}")
        except Exception as error:  # noqa: BLE001 - reported to the caller
            log.error("extract of %s failed: %s", table.name, error)
            failures[table.name] = str(error)
    return failures
