"""Streams into tables with one row per key: the latest copy wins, and only touched partitions are written.

A micro-batch is merged with the stored rows of the partitions that its keys fall into. The merged rows are written to a
staging folder named after the batch first and replace the partitions from there. A batch that is run again after a
failure takes the staged rows if they are complete, so rows of a partition that was being replaced are not lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerspark.config import StreamConfig
from ledgerspark.operators import rollups as R
from ledgerspark.operators.cleaning import clean_duplicate_transactions
from ledgerspark.scratch import small_sorts
from ledgerspark.sources.tables import overwrite_partitions

BUCKET = "key_bucket"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The partition of a key: all copies of it share one, whatever else they hold."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _complete(spark: SparkSession, path: str) -> bool:
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def upsert(
    batch: DataFrame, batch_id: int, table: str, keys: Sequence[str], order_by: str, partition_by: str, staging: str
) -> None:
    """Merge ``batch`` into ``table``: the latest row per key by ``order_by``, ties to the greatest other columns, in their order.

    ``partition_by`` is a column that follows from the keys alone. Batches may come in any order, and again.
    """
    spark, staged = batch.sparkSession, f"{staging.rstrip('/')}/batch-{batch_id}"
    if not _complete(spark, staged):
        others = [c for c in batch.columns if c not in (*keys, order_by, partition_by)]
        # One row per partition of the table that the batch touches.
        counts = batch.groupBy(partition_by).agg(F.count("*").alias("n"))
        touched = counts.agg(F.collect_list(F.struct(partition_by, "n")).alias("all")).first()["all"]
        rows, merged = sum(t.n for t in touched), batch
        if spark.catalog.tableExists(table):
            stored = spark.read.table(table).filter(F.col(partition_by).isin([t[0] for t in touched]))
            rows, merged = rows + stored.count(), batch.unionByName(stored)
        with small_sorts(spark, rows):
            latest = clean_duplicate_transactions(merged, keys, order_by, others)
            latest.write.mode("overwrite").parquet(staged)
    ready = spark.read.parquet(staged)
    with small_sorts(spark, ready.count()):
        overwrite_partitions(ready, table, [partition_by])


def _start(writer: DataStreamWriter, checkpoint: str, config: StreamConfig, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=config.processing_time).start()


def start_latest(
    arriving: DataFrame,
    table: str,
    keys: Sequence[str],
    order_by: str,
    checkpoint: str,
    buckets: int = 64,
    config: StreamConfig = StreamConfig(),
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the latest copy of every key of a stream in ``table``, partitioned by a hash of the key.

    The same rows as keep-latest over all that has arrived, however late a copy is: no watermark bounds it, and no state
    is held but the table. ``buckets`` must stay the same for the life of the table.
    """
    staging = f"{checkpoint.rstrip('/')}-staged"

    def save(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn(BUCKET, key_bucket(keys, buckets))
        upsert(keyed, batch_id, table, keys, order_by, BUCKET, staging)

    return _start(arriving.writeStream.foreachBatch(save), checkpoint, config, available_now)


def read_latest(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(table).drop(BUCKET)


def daily_partials(transactions: DataFrame, keys: Sequence[str], watermark: str) -> DataFrame:
    """Running partials per day and ``keys`` of a stream of silver transactions.

    A day's state is dropped once the watermark has passed its end; rows later than that, and rows without a readable
    timestamp, are not counted.
    """
    timed = transactions.withColumn("moment", F.col("timestamp").try_cast("timestamp")).filter("moment is not null")
    day = F.window("moment", "1 day").alias("window")
    return R.partials(timed.withWatermark("moment", watermark), [day, *keys])


def start_daily_rollup(
    transactions: DataFrame,
    table: str,
    keys: Sequence[str],
    checkpoint: str,
    config: StreamConfig = StreamConfig(),
    available_now: bool = False,
) -> StreamingQuery:
    """Keep total, mean, minimum, maximum and count per day and ``keys`` of a stream in ``table``.

    Each micro-batch writes the figures it has changed, over the months they fall into. Days are those of the session's
    time zone, which must be one without changes of the clock.
    """
    staging = f"{checkpoint.rstrip('/')}-staged"

    def save(batch: DataFrame, batch_id: int) -> None:
        day = F.to_date("window.start")
        dated = batch.withColumns({"date": day, "period": F.date_format(day, "yyyy-MM")})
        figures = R.measures(dated, ["date", "period", *keys]).withColumn("batch", F.lit(batch_id).cast("bigint"))
        upsert(figures, batch_id, table, ["date", *keys], "batch", "period", staging)

    partials = daily_partials(transactions, keys, config.watermark)
    return _start(partials.writeStream.outputMode("update").foreachBatch(save), checkpoint, config, available_now)


def read_daily_rollup(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(table).drop("period", "batch")
