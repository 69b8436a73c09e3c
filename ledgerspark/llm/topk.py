"""Exact top-k search: matrix products of query tiles and shards, partial selection, merged lists."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ledgerspark.llm.tiles import (
    every, finite_vectors, first_of_each, matrix_of, merged_tops, packed, search_tiles
)

QUERY_ROWS, SHARD_ROWS = 512, 8192
LONG = (-(1 << 63), (1 << 63) - 1)


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; beyond 64 bits they stop at the ends of the range."""
    dim = queries.shape[1]
    if not dim or not len(shard):
        return np.zeros((len(queries), len(shard)), dtype=np.int64)
    bound = int(max(-int(queries.min()), int(queries.max()))) * int(max(-int(shard.min()), int(shard.max()))) * dim
    if bound < 1 << 53:
        return (queries.astype(np.float64) @ shard.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return queries @ shard.T
    exact = queries.astype(object) @ shard.astype(object).T
    return np.clip(exact, *LONG).astype(np.int64)


def best_of_rows(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int):
    """The ``k`` highest of each row but its own id; ``ids`` ascend, so equal scores keep their order."""
    rows, columns = [], []
    mine = ids[None, :] == own[:, None]
    for r in range(len(scores)):
        open_ = np.flatnonzero(~mine[r]) if mine[r].any() else np.arange(len(ids))
        values = scores[r, open_]
        if len(values) > k:
            edge = np.partition(values, len(values) - k)[len(values) - k]
            above = np.flatnonzero(values > edge)
            taken = np.concatenate([above, np.flatnonzero(values == edge)[: k - len(above)]])
        else:
            taken = np.arange(len(values))
        rows.append(np.full(len(taken), r))
        columns.append(open_[taken])
    return np.concatenate(rows), np.concatenate(columns)


def _by_id(ids: np.ndarray, matrix: np.ndarray):
    order = np.argsort(ids, kind="stable")
    return ids[order], matrix[order], b""


def exact_top_k(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 1024.0,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for each id of ``queries`` among all of ``rows``.

    Scores are inner products of the vectors' components turned to ``floor(scale * x)``. Ties go to
    the smaller id. A query's own id is no candidate; vectors of other lengths aren't either. Rows with a
    null id, a null vector or components that are null or not finite take no part. Of query rows that share an id
    the one with the least vector counts, candidates that share an id are rows of their own. With fewer
    than ``k`` candidates all are returned; an empty table gives no rows; further columns are not read.
    """

    def integral(df: DataFrame) -> DataFrame:
        whole = F.transform("vector", lambda x: F.floor(x * F.lit(scale)))
        return finite_vectors(df, id_col, vector_col).withColumn("vector", whole)

    def search(row):
        asked = np.frombuffer(row.q_ids, dtype=np.int64)
        ids = np.frombuffer(row.s_ids, dtype=np.int64)
        scores = products(matrix_of(row.q_matrix, row.dim, "int64"), matrix_of(row.s_matrix, row.dim, "int64"))
        r, c = best_of_rows(scores, ids, asked, k)
        return asked[r], ids[c], scores[r, c]

    tiles = packed(first_of_each(integral(queries)), "int64", QUERY_ROWS, "topk-queries")
    shards = packed(integral(rows), "int64", SHARD_ROWS, "topk-shards", _by_id)
    return merged_tops(search_tiles(tiles, shards, search, "bigint", "topk-partial"), k)


def search_every_hundredth(rows: DataFrame, k: int = 10) -> DataFrame:
    return exact_top_k(rows, rows.filter(every("vec_id", 100)), k)
