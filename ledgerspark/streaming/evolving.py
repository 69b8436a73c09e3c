"""File streams whose columns change: each new file once, into a table that widens."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerspark.config import StreamConfig
from ledgerspark.sources.evolving import SchemaStore, deliver, read_delivery

FILES_PER_TRIGGER = 1000
FILE = "path string, modificationTime timestamp, length bigint, content binary"


def start_evolving(
    spark: SparkSession,
    path: str,
    kinds: Mapping[str, T.DataType],
    table: str,
    checkpoint: str,
    store: SchemaStore,
    config: StreamConfig = StreamConfig(),
    available_now: bool = False,
) -> StreamingQuery:
    """Add the CSV files of the folders under ``path`` to ``table``; files of one folder share a header.

    The stream carries the names of new files only, no contents; a micro-batch reads its files by their own headers and
    is one delivery, so a batch that is run again after a failure replaces what it wrote. The names of a batch, at most
    ``config.max_files_per_trigger``, are all that the driver holds.
    """
    most = config.max_files_per_trigger or FILES_PER_TRIGGER
    arriving = (
        spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", most).load(f"{path.rstrip('/')}/*")
    )

    def save(batch: DataFrame, batch_id: int) -> None:
        files = batch.agg(F.sort_array(F.collect_set("path")).alias("files")).first()["files"]
        folders: dict[str, list[str]] = {}
        for file in files:
            folders.setdefault(file.rpartition("/")[0], []).append(file)
        if folders:
            parts = [read_delivery(batch.sparkSession, of_one, kinds) for of_one in folders.values()]
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
            deliver(rows, table, store, batch_id)

    writer = arriving.select("path").writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=config.processing_time).start()
