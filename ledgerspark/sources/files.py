"""CSV files, and the external storage account they may live in."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerspark.config import LakeConfig


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """The schema binds by position: the header is skipped, its names are not compared."""
    return spark.read.csv(path, schema=schema, header=header, enforceSchema=True)


RESCUED = "rescued_line"
QUARANTINED = "quarantined"
SOURCE = "source_file"


def rescue_options(schema: T.StructType) -> tuple[T.StructType, dict]:
    """A schema with a column for lines that don't fit it, and the reader's options that fill it."""
    wider = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    return wider, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED, "columnPruning": False, "enforceSchema": True}


def marked(df: DataFrame) -> DataFrame:
    """Rows with the file they came from, and whether they are to be set apart.

    The reader parses no more values than a query reads, and a value that is not parsed rescues no line. So the test
    reads all columns: else a line's fate would depend on what is selected.
    """
    values = [F.col(f"`{c}`").cast("string") for c in df.columns if c != RESCUED]
    fits = F.array(F.col(RESCUED), *values).eqNullSafe(F.array(F.lit(None).cast("string"), *values))
    return df.withColumn(SOURCE, F.col("_metadata.file_path")).withColumn(QUARANTINED, ~fits)


def read_csv_rescued(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """``read_csv`` that loses no line: one with a value that can't be read, or with too few or too many fields, is
    marked ``quarantined`` and kept whole in ``rescued_line``, beside the file it came from."""
    wider, options = rescue_options(schema)
    return marked(spark.read.options(**options).schema(wider).option("header", header).csv(path))


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(QUARANTINED)).drop(RESCUED, SOURCE, QUARANTINED)


def quarantined_rows(df: DataFrame) -> DataFrame:
    """The lines that were set apart, as they stand in their file."""
    return df.filter(F.col(QUARANTINED)).select(RESCUED, SOURCE)


def rescue_counts(df: DataFrame) -> DataFrame:
    """Good and quarantined rows of every file; together they are all its rows."""
    bad = F.count_if(F.col(QUARANTINED))
    return df.groupBy(SOURCE).agg((F.count("*") - bad).alias("good_rows"), bad.alias("quarantined_rows"))


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """Values are written with their outer blanks, which the writer strips unless told not to."""
    df.write.mode(mode).csv(
        path, header=header, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def lake_uri(lake: LakeConfig, path: str = "") -> str:
    root = f"abfss://{lake.container}@{lake.account}.dfs.core.windows.net/"
    return root + path.lstrip("/")


def configure_lake(spark: SparkSession, lake: LakeConfig) -> str:
    """Give the session the account key from the environment; returns the account's root."""
    key = os.environ.get(lake.key_env)
    if not key:
        raise KeyError(f"environment variable {lake.key_env} is not set")
    spark.conf.set(f"fs.azure.account.key.{lake.account}.dfs.core.windows.net", key)
    return lake_uri(lake)


def spread_scan(df: DataFrame) -> DataFrame:
    """Deal out a scan that has fewer splits than the cluster has cores; leave any other alone.

    A table in one file with one row group is read by one task, and all work up to the next
    shuffle would stay in it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
