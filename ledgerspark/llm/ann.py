"""Approximate nearest neighbours by stable random projections and a kd-tree.

Unit vectors are projected on ``axes`` Gaussian directions. The squared length of a projected
difference, divided by the squared true distance, follows the chi-square distribution with ``axes``
degrees of freedom. Every tile of rows keeps a kd-tree of its projections; a search visits leaves by their
distance, verifies projected neighbours nearer than the next leaf on the full vectors, and
stops as soon as a nearer neighbour would lie beyond that leaf with probability ``certainty`` only by
chance: each true neighbour is then missed with a probability of 1 - ``certainty`` at most.
"""

from __future__ import annotations

import io
import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ledgerspark.llm.tiles import (
    every, finite_vectors, first_of_each, matrix_of, merged_tops, packed, search_tiles
)

QUERY_ROWS, TILE_ROWS, LEAF = 256, 8192, 64


def chi_square(x: float, axes: int) -> float:
    """The distribution function for an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    if half > 700:
        return 1.0
    for i in range(1, axes // 2):
        term *= half / i
        total += term
    return 1.0 - math.exp(-half) * total


def critical_ratio(certainty: float, axes: int) -> float:
    """The ratio of squared distances at which the chi-square test holds."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, axes) < certainty else (low, middle)
    return high


def directions(dim: int, axes: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, axes))


def kd_leaves(points: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Indices of ``points`` by leaf: halves at the median of the widest side."""
    done, open_ = [], [np.arange(len(points))]
    while open_:
        own = open_.pop()
        if len(own) <= leaf:
            done.append(own)
            continue
        held = points[own]
        side = int(np.argmax(held.max(axis=0) - held.min(axis=0)))
        order = np.argpartition(held[:, side], len(own) // 2)
        open_ += [own[order[len(own) // 2 :]], own[order[: len(own) // 2]]]
    return done


def _index(axes: int, seed: int):
    def build(ids: np.ndarray, matrix: np.ndarray):
        unit = matrix / np.sqrt((matrix * matrix).sum(axis=1))[:, None]
        points = unit @ directions(matrix.shape[1], axes, seed)
        leaves = kd_leaves(points)
        order = np.concatenate(leaves)
        ends = np.cumsum([len(x) for x in leaves])
        low = np.array([points[x].min(axis=0) for x in leaves])
        high = np.array([points[x].max(axis=0) for x in leaves])
        out = io.BytesIO()
        np.savez(out, points=points[order], ends=ends, low=low, high=high)
        return ids[order], matrix[order], out.getvalue()

    return build


def _nearest(ids, scores, k):
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search_tree(query, point, own, ids, matrix, lengths, tree, ratio, k):
    """Ids and cosines of the neighbours found for one query in one tile."""
    points, ends, low, high = tree
    gaps = np.maximum(0, np.maximum(low - point, point - high))
    reach = (gaps * gaps).sum(axis=1)
    order = np.argsort(reach, kind="stable")
    starts = np.concatenate([[0], ends[:-1]])
    length = math.sqrt((query * query).sum())
    best_ids, best = np.empty(0, dtype=np.int64), np.empty(0)
    waiting, far = np.empty(0, dtype=np.int64), np.empty(0)
    at, step = 0, 1
    while at < len(order):
        rows = np.concatenate([np.arange(starts[x], ends[x]) for x in order[at : at + step]])
        at, step = at + step, step * 2
        edge = reach[order[at]] if at < len(order) else math.inf
        away = ((points[rows] - point) ** 2).sum(axis=1)
        waiting, far = np.concatenate([waiting, rows]), np.concatenate([far, away])
        near = far < edge
        seen = waiting[near]
        seen = seen[ids[seen] != own]
        waiting, far = waiting[~near], far[~near]
        cosines = (matrix[seen] * query).sum(axis=1) / (lengths[seen] * length)
        best_ids, best = _nearest(np.concatenate([best_ids, ids[seen]]), np.concatenate([best, cosines]), k)
        if len(best) == k and edge > 1e-12 and edge >= ratio * max(0.0, 2 - 2 * best[-1]):
            break
    return best_ids, best


def nearest_neighbours(
    rows: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    axes: int = 8,
    certainty: float = 0.98,
    seed: int = 6,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for each id of ``queries``: the cosine in double precision.

    Every row is indexed. Ties go to the smaller id; equal vectors project alike, so they are verified
    together. A query's own id is no candidate; vectors of other lengths aren't either. Rows with a null id, a null or zero
    vector or components that are null or not finite take no part. Of query rows that share an id
    the one with the least vector counts, candidates that share an id are rows of their own. With fewer
    than ``k`` candidates all are returned; an empty table gives no rows; further columns are not read.
    """
    ratio = critical_ratio(certainty, axes)

    def directed(df: DataFrame) -> DataFrame:
        return finite_vectors(df, id_col, vector_col).filter(F.exists("vector", lambda x: x != 0))

    def search(row):
        asked, ids = np.frombuffer(row.q_ids, dtype=np.int64), np.frombuffer(row.s_ids, dtype=np.int64)
        wanted, matrix = (matrix_of(m, row.dim, "float64") for m in (row.q_matrix, row.s_matrix))
        kept = np.load(io.BytesIO(row.s_index))
        tree = [kept[n] for n in ("points", "ends", "low", "high")]
        lengths = np.sqrt((matrix * matrix).sum(axis=1))
        unit = wanted / np.sqrt((wanted * wanted).sum(axis=1))[:, None]
        points = unit @ directions(row.dim, axes, seed)
        found = [
            search_tree(q, p, own, ids, matrix, lengths, tree, ratio, k)
            for q, p, own in zip(wanted, points, asked, strict=True)
        ]
        return (
            np.repeat(asked, [len(i) for i, _ in found]),
            np.concatenate([i for i, _ in found]),
            np.concatenate([s for _, s in found]),
        )

    tiles = packed(first_of_each(directed(queries)), "float64", QUERY_ROWS, "ann-queries")
    index = packed(directed(rows), "float64", TILE_ROWS, "ann-index", _index(axes, seed))
    return merged_tops(search_tiles(tiles, index, search, "double", "ann-partial"), k)


def search_every_fiftieth(rows: DataFrame, k: int = 5) -> DataFrame:
    return nearest_neighbours(rows, rows.filter(every("vec_id", 50)), k)
