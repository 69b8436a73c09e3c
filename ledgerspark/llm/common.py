"""What several operators of this subpackage share."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerspark.operators.joins import lookup_join

WORD = r"[^\x20\x09-\x0D]+"


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 500
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_SIZE = "2m"
SCAN_BATCH = "spark.sql.parquet.columnarReaderBatchSize"
SCAN_ROWS = 64

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of every executor this package, once per application.

    Texts are long, so a session that does not say otherwise hands ``BATCH_ROWS`` rows and ``BATCH_SIZE`` bytes at a time to a worker,
    which takes several times as much while it works on them, and keeps it. It reads ``SCAN_ROWS`` rows of a Parquet file at
    once: a scan holds all values of a column's batch in one array, and doubles it as it grows.
    """
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, str(BATCH_ROWS))
    if spark.conf.get(BATCH_BYTES) == "67108864b":
        spark.conf.set(BATCH_BYTES, BATCH_SIZE)
    if spark.conf.get(SCAN_BATCH) == "4096":
        spark.conf.set(SCAN_BATCH, str(SCAN_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parents[1]
        stem = f"{tempfile.mkdtemp(prefix='ledgerspark-code-')}/{package.name}"
        spark.sparkContext.addPyFile(
            shutil.make_archive(stem, "zip", root_dir=package.parent, base_dir=package.name)
        )
        _shipped.add(app)


def fold(doc_id: Column) -> Column:
    """Fold 0 to 4 of a row: crc32 of the id as text; rows of fold 0 are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label`` of the labels outside fold 0, one row for each pair; nulls teach nothing."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    return known.filter(F.col("label").isin(0, 1) & (fold(F.col("doc_id")) != 0)).distinct()


def labelled_rows(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, text, label`` of the rows of ``docs`` with a known label; null text is empty."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return lookup_join(texts, known, ["doc_id"], "inner")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def bounded_sample(rows: DataFrame, keys: list[str], bound: int, seed: int = 0) -> DataFrame:
    """``bound`` rows of ``rows``, all if fewer, chosen by a hash of ``keys``: reruns take the same ones.

    Rows equal in ``keys`` are told apart by their place, so the bound holds however often a key repeats.
    """
    placed = rows.withColumn("__place", F.monotonically_increasing_id())
    return smallest_hashes(placed, keys, "__place", bound, seed).drop("__place")


def smallest_hashes(rows: DataFrame, keys: list[str], row_key: str, bound: int, seed: int = 0) -> DataFrame:
    """``bound`` rows of ``rows``, all if fewer: those with the smallest hashes of ``keys``.

    ``row_key`` is a number that no two rows share, best a written one. It parts equal rows, so the bound is a hard one however often a
    key or a text repeats. Only hashes and numbers are ordered, and of a large table only a share of them.
    """
    total = rows.count()
    if total <= bound:
        return rows
    if bound <= 0:
        return rows.limit(0)
    at = F.xxhash64(F.lit(seed), *keys)
    ranked = rows.select(F.struct(at.alias("hash"), F.col(row_key).alias("row")).alias("at"))
    most = int((1 << 63) * min(1.0, -1 + 2 * (2 * bound + 1000) / total))
    few = ranked.filter(F.col("at.hash") < most) if most < (1 << 63) - (1 << 53) else ranked
    edge = (few if few.count() >= bound else ranked).orderBy("at").limit(bound).agg(F.max("at").alias("at")).first()["at"]
    below = (at < edge["hash"]) | ((at == edge["hash"]) & (F.col(row_key) <= edge["row"]))
    return rows.filter(below)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on uint64 that spreads every input bit over the word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x
