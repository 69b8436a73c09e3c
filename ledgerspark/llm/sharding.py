"""Contiguous shards of near equal bytes, from prefix sums of per-partition totals.

Rows are ordered by a hash of their text, so equal texts are neighbours. The order is cut into
buckets by the leading bits of the hash, and a bucket into parts of about ``rows_per_part`` rows by
a hash of the id, so that a group of copies of any size is spread over as many tasks as it needs. Every part reports its bytes
and rows; their prefix sums give a part its offset, and a running sum inside the part gives each row
its place. The order is then cut at equal byte targets.

DataFrame functions only. What is broadcast is one row per bucket (4,096 at most) or per shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerspark.scratch import materialise

BUCKET_BITS = 12


def _sized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    )


def _before(value: str, window) -> F.Column:
    return F.sum(value).over(window) - F.col(value)


def _offsets(rows: DataFrame) -> DataFrame:
    """Bytes and rows before each part: prefix sums over the parts of a bucket and over buckets."""
    parts = rows.groupBy("bucket", "part").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    buckets = parts.groupBy("bucket").agg(F.sum("b").alias("bb"), F.sum("n").alias("bn"))
    every = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = buckets.select(
        "bucket", _before("bb", every).alias("bytes0"), _before("bn", every).alias("rows0")
    )
    within = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    return parts.select(
        "bucket", "part", _before("b", within).alias("bytes1"), _before("n", within).alias("rows1")
    ).join(F.broadcast(buckets), "bucket").select(
        "bucket",
        "part",
        (F.col("bytes0") + F.col("bytes1")).alias("bytes_before"),
        (F.col("rows0") + F.col("rows1")).alias("rows_before"),
    )


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_part: int = 20_000,
    slack: float = 0.01,
) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` of every row; size is the text's UTF-8 bytes plus 1.

    A row goes to the shard that holds its middle byte. A run of equal texts goes by the middle of
    the run, and so stays whole, if it has no more than ``slack`` of a shard's bytes; larger
    runs are cut. So a shard is off its target by a row or by ``slack`` of it. ``slot`` counts the
    rows of a shard from 0 without gaps. Null text is empty, a null id is a row like any other,
    repeated rows keep a slot each, an empty table gives no rows; further columns are not read.
    """
    rows = materialise(
        _sized(docs, id_col, text_col).withColumn("bucket", F.shiftrightunsigned("h", 64 - BUCKET_BITS)),
        "shard-sizes",
    )
    counts = rows.groupBy("bucket").agg(F.ceil(F.count("*") / rows_per_part).alias("parts"))
    rows = rows.join(F.broadcast(counts), "bucket").withColumn(
        "part", F.pmod(F.xxhash64("id", "h"), F.col("parts"))
    )
    total = max(1, rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    rows = rows.join(_offsets(rows), ["bucket", "part"])
    running = (
        Window.partitionBy("bucket", "part").orderBy("h", "id", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    copies = Window.partitionBy("bucket", "part", "h")
    rows = (
        rows.withColumn("place", F.col("rows_before") + F.count("*").over(running) - 1)
        .withColumn("end", F.col("bytes_before") + F.sum("size").over(running))
        .withColumn("copies_end", F.max("end").over(copies))
        .withColumn("copies_size", F.sum("size").over(copies))
    )
    whole = F.col("copies_size") <= int(slack * total / shards)
    twice_middle = F.when(whole, 2 * F.col("copies_end") - F.col("copies_size")).otherwise(
        2 * F.col("end") - F.col("size")
    )
    shard = F.least(F.lit(shards - 1), F.floor(twice_middle * shards / (2 * total))).cast("int")
    placed = materialise(
        rows.select("id", "size", "text_crc32", shard.alias("shard"), "place"), "shard-places"
    )
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", **settings) -> None:
    """Write the rows of ``docs`` to one folder per shard; ids must be unique and not null."""
    placed = shard_by_bytes(docs, shards, id_col, **settings).select(id_col, "shard")
    docs.drop("shard").join(placed, id_col).write.partitionBy("shard").parquet(path)
