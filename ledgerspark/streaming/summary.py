"""Running profile of a stream: one query, one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerspark.operators.profiling import STATS, approx_unique, column_stats, summarise


def streaming_data_summary(df: DataFrame, relative_error: float = 0.05) -> DataFrame:
    """Row count, and per column non-nulls, approximate distinct values and moments."""
    if not df.isStreaming:
        raise ValueError("a running profile needs a stream")

    def stats_of(field: T.StructField) -> dict[str, Column]:
        exact = column_stats(field.name, field.dataType)
        return {**exact, **approx_unique(field.name, relative_error)}

    return summarise(df, stats_of, [*STATS, "unique_count"])


def start_summary(
    summary: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Keep the last two summaries under ``path``: a batch replaces the one before the last."""

    def save(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch", F.lit(batch_id).cast("bigint"))
        numbered.write.mode("overwrite").parquet(f"{path.rstrip('/')}/slot={batch_id % 2}")

    writer = (
        summary.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(save)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.start()


def latest_summary(summary: DataFrame, path: str) -> DataFrame:
    """The rows of the newest batch written by ``start_summary``."""
    spark = summary.sparkSession
    schema = T.StructType([*summary.schema.fields, T.StructField("batch", T.LongType())])
    batches = spark.read.schema(schema).parquet(path)
    newest = batches.agg(F.max("batch")).scalar()
    return batches.filter(F.col("batch") == newest).drop("batch", "slot")
