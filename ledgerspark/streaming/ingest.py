"""Exactly-once file ingest into a table: each new file once, each micro-batch once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerspark.config import StreamConfig
from ledgerspark.sources.files import QUARANTINED, marked, rescue_options
from ledgerspark.sources.tables import truncate_table


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    config: StreamConfig = StreamConfig(),
    rescue: bool = False,
) -> DataFrame:
    """Each new file of a folder once. What can't be read is null; with ``rescue`` a line that does not fit the schema
    is also marked and kept whole, as ``read_csv_rescued`` does."""
    schema, options = rescue_options(schema) if rescue else (schema, {"enforceSchema": True})
    reader = spark.readStream.schema(schema).option("header", config.header).options(**options)
    if config.timestamp_format:
        reader = reader.option("timestampFormat", config.timestamp_format)
    if config.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", config.max_files_per_trigger)
    return marked(reader.csv(path)) if rescue else reader.csv(path)


def write_stream(
    df: DataFrame,
    table: str,
    checkpoint: str,
    config: StreamConfig = StreamConfig(),
    available_now: bool = False,
) -> StreamingQuery:
    """Append to ``table``: at the configured interval, or what is there now and then stop.

    Rescued lines go to a partition of their own, in the same pass and as exactly once as the rest.
    """
    writer = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode(config.output_mode)
    )
    if QUARANTINED in df.columns:
        writer = writer.partitionBy(QUARANTINED)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=config.processing_time)
    return writer.toTable(table)


def stream_transaction_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    table: str,
    checkpoint: str,
    config: StreamConfig = StreamConfig(),
    available_now: bool = False,
) -> StreamingQuery:
    return write_stream(
        read_stream(spark, path, schema, config), table, checkpoint, config, available_now
    )


def reset_stream(spark: SparkSession, table: str, checkpoint: str) -> str:
    """Empty the sink and name a checkpoint the next start has not seen, so all files count again."""
    truncate_table(spark, table)
    stem, _, number = checkpoint.rpartition("-reset")
    return f"{stem}-reset{int(number) + 1}" if stem and number.isdigit() else f"{checkpoint}-reset1"
