"""Hard negatives by a vertical scan (BOND) over columnar tiles.

A tile holds some thousand vectors column by column. For an anchor the columns are read in the order of the anchor's
descending magnitudes, a few at a time. Each row has a partial product and, from the least and greatest
value of every unread column, the least and the most that its rest can still add. These bounds shrink the
bitmap of candidates until what is left is resolved:

1. positives: a row stays while its most reaches the k-th best least of the anchor's label;
2. negatives: each positive opens a window of scores. A row of another label stays while its bounds reach into a
   window in which no k rows are surely better.

A task holds two tiles; what it leaves is at most k rows of an anchor and a window, which Spark merges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from ledgerspark.llm.tiles import every, matrix_of, merged_tops, packed, search_tiles
from ledgerspark.scratch import materialise

ANCHOR_ROWS, TILE_ROWS = 256, 8192
STEP = 8  # columns read between two cuts of the bitmap
LONG = (-(1 << 63), (1 << 63) - 1)

Keep = Callable[[np.ndarray, np.ndarray], np.ndarray]


def vertical_scan(anchor: np.ndarray, columns: np.ndarray, bitmap: np.ndarray, keep: Keep) -> tuple[np.ndarray, np.ndarray]:
    """Positions and exact products of the candidates in ``bitmap`` that ``keep`` never rules out.

    ``keep`` gets the least and the most that each remaining candidate's product can be, and says which stay.
    """
    low, high = columns.min(axis=1), columns.max(axis=1)
    ends = np.sort(np.stack([anchor * low, anchor * high]), axis=0)
    order = np.argsort(-np.abs(anchor), kind="stable")
    at = np.flatnonzero(bitmap)
    partial = np.zeros(len(at), dtype=columns.dtype)
    for start in range(0, len(order), STEP):
        read, rest = order[start : start + STEP], order[start + STEP :]
        block = columns[read] if len(at) == columns.shape[1] else columns[np.ix_(read, at)]
        partial = partial + anchor[read] @ block
        stays = keep(partial + ends[0, rest].sum(), partial + ends[1, rest].sum())
        if not stays.all():
            at, partial = at[stays], partial[stays]
        if not len(at):
            break
    return at, partial


def reaching(k: int) -> Keep:
    """Candidates that may be among the ``k`` best."""

    def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        if len(least) <= k:
            return np.ones(len(least), dtype=bool)
        return most >= np.partition(least, len(least) - k)[len(least) - k]

    return keep


def reaching_windows(windows: Iterable[tuple[int, int]], k: int) -> Keep:
    """Candidates that may be among the ``k`` best of a window of products, ends included."""

    def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(least), dtype=bool)
        for low, high in windows:
            may = (most >= low) & (least <= high)
            sure = least[may & (least >= low) & (most <= high)]
            if len(sure) > k:
                may &= most >= np.partition(sure, len(sure) - k)[len(sure) - k]
            stays |= may
        return stays

    return keep


def best(at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Which ``k`` come first by falling score; ``at`` ascends with the id, so ties go to the smaller one."""
    return np.argsort(-scores, kind="stable")[:k]


class Tile:
    """Ids, labels and columns of a tile, ready to be scanned by anchors of bounded size."""

    def __init__(self, ids: bytes, matrix: bytes, anchors: np.ndarray):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        held = np.frombuffer(matrix, dtype=np.int64).reshape(-1, len(self.ids))
        self.labels, columns = held[0], held[1:]
        bound = len(columns) * _largest(anchors) * _largest(columns)
        kind = np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object
        self.columns, self.anchors = columns.astype(kind), anchors.astype(kind)

    def scan(self, row: int, bitmap: np.ndarray, keep: Keep) -> tuple[np.ndarray, np.ndarray]:
        at, scores = vertical_scan(self.anchors[row], self.columns, bitmap, keep)
        if scores.dtype == object:
            scores = np.clip(scores, *LONG)
        return at, scores.astype(np.int64)


def _largest(values: np.ndarray) -> int:
    return max(-int(values.min()), int(values.max())) if values.size else 0


def _columns_by_id(ids: np.ndarray, matrix: np.ndarray):
    order = np.argsort(ids, kind="stable")
    return ids[order], np.ascontiguousarray(matrix[order].T), b""


def _integral(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """``id, label, vector`` (whole numbers) of the rows that take part."""
    vector = F.col("vector")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = rows.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    sound = named.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & ~odd)
    return sound.withColumn("vector", F.transform(vector, lambda x: F.floor(x * F.lit(scale))))


def mine_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: float = 256.0,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of every anchor.

    Scores are inner products of components turned to ``floor(scale * x)``; ties go to the smaller id. An anchor's
    positives are its first ``positives`` rows of the same label under another id. A positive's negatives are the first
    ``negatives`` rows of another label whose score is within ``low_percent`` to ``high_percent`` of the positive's; a
    negative positive's window is empty; an anchor's own id is never its negative. Rows with a null id, label or vector, or with components that are null or
    not finite, take no part. Of anchor rows that share an id the one with the least label and vector counts; other rows that
    share an id are rows of their own, positives of equal id and score count once. Vectors meet those of their length.
    Products beyond 64 bits stop at the ends of the range. An empty table gives no rows; further columns are not read.
    """
    settings = (id_col, vector_col, label_col, scale)
    labelled = F.concat(F.array("label"), F.col("vector")).alias("vector")
    tiles = packed(
        _integral(rows, *settings).select("id", labelled), "int64", TILE_ROWS, "negatives-tiles", _columns_by_id
    )
    own = materialise(
        _integral(anchors, *settings).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("own"))
        .select("id", "own.label", "own.vector"),
        "negatives-anchors",
    )

    def near(row):
        asked = np.frombuffer(row.q_ids, dtype=np.int64)
        held = matrix_of(row.q_matrix, row.dim, "int64")
        tile = Tile(row.s_ids, row.s_matrix, held[:, 1:])
        found = []
        for r in range(len(asked)):
            bitmap = (tile.labels == held[r, 0]) & (tile.ids != asked[r])
            at, scores = tile.scan(r, bitmap, reaching(positives))
            chosen = best(at, scores, positives)
            found.append((np.full(len(chosen), asked[r]), tile.ids[at[chosen]], scores[chosen]))
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))

    asked = packed(own.select("id", labelled), "int64", ANCHOR_ROWS, "negatives-asked")
    tops = merged_tops(search_tiles(asked, tiles, near, "bigint", "negatives-near"), positives)
    pairs = materialise(
        tops.select(
            F.col("query_id").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        ).distinct(),
        "negatives-positives",
    )

    lead = positives + 2  # label, number of positives, their scores, then the vector

    def apart(row):
        asked = np.frombuffer(row.q_ids, dtype=np.int64)
        held = matrix_of(row.q_matrix, row.dim + lead - 1, "int64")
        tile = Tile(row.s_ids, row.s_matrix, held[:, lead:])
        found = []
        for r in range(len(asked)):
            scores_of = {int(s) for s in held[r, 2 : 2 + held[r, 1]]}
            windows = [(-(-low_percent * s // 100), high_percent * s // 100) for s in sorted(scores_of)]
            windows = [(low, high) for low, high in windows if low <= high]
            bitmap = (tile.labels != held[r, 0]) & (tile.ids != asked[r])
            at, scores = tile.scan(r, bitmap, reaching_windows(windows, negatives))
            chosen = [np.empty(0, dtype=np.int64)]
            for low, high in windows:
                inside = np.flatnonzero((scores >= low) & (scores <= high))
                chosen.append(inside[best(at[inside], scores[inside], negatives)])
            chosen = np.unique(np.concatenate(chosen))
            found.append((np.full(len(chosen), asked[r]), tile.ids[at[chosen]], scores[chosen]))
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))

    listed = pairs.groupBy("anchor_id").agg(F.collect_list("positive_score").alias("scores"))
    padded = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda i: F.coalesce(F.try_element_at("scores", i), F.lit(0).cast("bigint")))
    opened = own.join(listed, own["id"] == listed["anchor_id"]).select(
        "id", F.concat(F.array("label", F.size("scores").cast("bigint")), padded, F.col("vector")).alias("vector")
    )
    opened = packed(opened, "int64", ANCHOR_ROWS, "negatives-opened").withColumn("dim", F.col("dim") - (lead - 1))
    found = search_tiles(opened, tiles, apart, "bigint", "negatives-apart")
    return _ranked(found, pairs, negatives, low_percent, high_percent)


def _ranked(found: DataFrame, pairs: DataFrame, k: int, low: int, high: int, branches: int = 64) -> DataFrame:
    """The first ``k`` of every anchor and positive, first by groups of tiles, then in all."""
    wide = "decimal(25,0)"
    score, bar = F.col("score").cast(wide) * 100, F.col("positive_score").cast(wide)
    held = found.join(pairs, F.col("query_id") == F.col("anchor_id")).filter((score >= bar * low) & (score <= bar * high))
    own = ["anchor_id", "positive_id", "positive_score"]
    group = F.pmod(F.col("branch"), F.lit(branches))
    for keys in ([*own, group], own):
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id"))
        held = held.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return held.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def mine_every_hundredth(rows: DataFrame) -> DataFrame:
    """Anchors: ids divisible by 100. Where the id is divisible by 7 the label is first moved on by one, modulo 10."""
    moved = F.when(every("vec_id", 7), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return mine_negatives(rows, rows.filter(every("vec_id", 100)))
