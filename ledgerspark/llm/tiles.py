"""Vectors packed into tiles: one row holds the matrix of some thousand vectors.

A search pairs every tile of queries with every tile of the searched rows, by a join on a tile number,
so that a task holds two tiles at a time whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerspark.llm.common import BATCH
from ledgerspark.scratch import materialise

TILE_BYTES = 4 << 20
MAX_GROUPS = 1 << 16


@contextmanager
def small_batches(spark, rows: int):
    """Hand so few rows at a time to Python; for rows that hold a tile."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


def finite_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id bigint, vector array<double>`` of the rows with an id and a vector of finite numbers only."""
    vector = F.col(vector_col).cast("array<double>")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("vector")).filter(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & ~odd
    )


def first_of_each(queries: DataFrame) -> DataFrame:
    """One query for each id: of rows that share an id the least vector."""
    return queries.groupBy("id").agg(F.min("vector").alias("vector"))


Finish = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, bytes]]


def packed(
    rows: DataFrame, dtype: str, max_rows: int, tag: str, finish: Finish | None = None
) -> DataFrame:
    """Written tiles ``tile, dim, ids, matrix, index`` of ``id, vector`` rows.

    Tiles have vectors of one length, and no more than ``max_rows`` rows or ``TILE_BYTES`` bytes.
    ``finish`` may reorder a tile and add an index to it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, waiting = TaskContext.get().partitionId(), 0, {}

        def tile(dim: int) -> pd.DataFrame:
            nonlocal number
            number += 1
            held = waiting.pop(dim)
            ids = np.concatenate([i for i, _ in held])
            matrix = np.concatenate([m for _, m in held])
            index = b""
            if finish is not None:
                ids, matrix, index = finish(ids, matrix)
            row = (part << 32 | number, dim, ids.tobytes(), matrix.tobytes(), index)
            return pd.DataFrame([row], columns=["tile", "dim", "ids", "matrix", "index"])

        for batch in batches:
            lengths = batch["vector"].str.len().to_numpy()
            for dim in np.unique(lengths):
                of_dim = batch[lengths == dim]
                ids = of_dim["id"].to_numpy(dtype=np.int64)
                matrix = np.array(of_dim["vector"].tolist(), dtype=dtype).reshape(len(ids), dim)
                most = max(1, min(max_rows, TILE_BYTES // (8 * max(1, int(dim)))))
                while len(ids):
                    held = waiting.setdefault(int(dim), [])
                    room = most - sum(len(i) for i, _ in held)
                    held.append((ids[:room], matrix[:room]))
                    ids, matrix = ids[room:], matrix[room:]
                    if sum(len(i) for i, _ in held) == most:
                        yield tile(int(dim))
        for dim in list(waiting):
            yield tile(dim)

    return materialise(
        rows.mapInPandas(run, "tile bigint, dim int, ids binary, matrix binary, index binary"), tag
    )


def search_tiles(
    queries: DataFrame,
    searched: DataFrame,
    search: Callable[[pd.Series, pd.Series], tuple[np.ndarray, np.ndarray, np.ndarray]],
    value: str,
    tag: str,
) -> DataFrame:
    """Written ``branch, query_id, vec_id, score``: the best of each pair of tiles.

    ``search`` gets a row of ``queries`` and one of ``searched`` and gives three arrays of equal length.
    """
    spark = queries.sparkSession
    groups = max(1, min(MAX_GROUPS, searched.count()))
    searched = searched.withColumn("branch", F.pmod(F.xxhash64("tile"), F.lit(groups)).cast("int"))
    searched = searched.repartition(groups, "branch")
    queries = queries.withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    named = [F.col(f"q.{c}").alias(f"q_{c}") for c in ("ids", "matrix", "index")]
    named += [F.col(f"s.{c}").alias(f"s_{c}") for c in ("ids", "matrix", "index")]
    same = (F.col("q.branch") == F.col("s.branch")) & (F.col("q.dim") == F.col("s.dim"))
    pairs = queries.alias("q").hint("shuffle_merge").join(searched.alias("s"), same).select(
        F.col("q.branch").alias("branch"), F.col("q.dim").alias("dim"), *named
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                query_id, vec_id, score = search(row)
                yield pd.DataFrame(
                    {"branch": np.int32(row.branch), "query_id": query_id, "vec_id": vec_id, "score": score}
                )

    with small_batches(spark, 8):
        return materialise(
            pairs.mapInPandas(run, f"branch int, query_id bigint, vec_id bigint, score {value}"), tag
        )


def merged_tops(found: DataFrame, k: int, branches: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score``: lists merged by groups of branches, then into one per query.

    Each step keeps ``k`` rows of a list in the task that has them before it shuffles any.
    """
    order = [F.col("score").desc(), F.col("vec_id")]
    group = F.pmod(F.col("branch"), F.lit(branches))
    for keys in ([F.col("query_id"), group], [F.col("query_id")]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        found = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def matrix_of(data: bytes, dim: int, dtype: str) -> np.ndarray:
    flat = np.frombuffer(data, dtype=dtype)
    return flat.reshape(-1, dim) if dim else flat.reshape(0, 0)


def every(id_col: str, step: int) -> Column:
    return F.pmod(F.col(id_col), F.lit(step)) == 0
