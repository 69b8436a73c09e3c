"""Written intermediate results in the folder all executors share.

A frame whose rows must not move between two uses (range-partitioned segments, stream inputs) is
written here and read back, so a lost executor replays files, not the partitioning.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ADAPTIVE = "spark.sql.adaptive.enabled"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARTITIONS = "spark.sql.shuffle.partitions"
SORT_ROWS = 500_000
SORT_BYTES = 16 << 20  # as shuffled; in a sort the rows take several times as much

_own_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, or the folder given to ``setCheckpointDir``.

    Where neither is set a session on one machine uses a temporary folder; a cluster is refused.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    app = context.applicationId
    if shared:
        return f"{shared.rstrip('/')}/ledgerspark/{app}"
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _own_roots:
        _own_roots[app] = tempfile.mkdtemp(prefix="ledgerspark-")
    return _own_roots[app]


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once and return the written rows."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_sorts(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, what is run shuffles ``rows`` wide rows to tasks that sort them in memory, and does not spill them.

    The engine's usual tasks are of 64 MB as shuffled, or as many as the session's setting, however many the rows.
    Only for what is written inside: settings count when a frame is run.
    """
    before = {name: spark.conf.get(name) for name in (ADAPTIVE, ADVISORY, PARTITIONS)}
    advised = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before[ADVISORY])
    spark.conf.set(ADAPTIVE, True)  # off in a stream's session
    spark.conf.set(ADVISORY, f"{min(advised, SORT_BYTES)}b")
    spark.conf.set(PARTITIONS, max(int(before[PARTITIONS]), -(-rows // SORT_ROWS)))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
