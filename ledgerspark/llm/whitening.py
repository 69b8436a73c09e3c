"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Components become whole numbers. Each task packs its rows dimension by dimension: shifted by the least value, every bit of
the numbers is a plane, and a plane is packed across rows into 64-bit words. The number of rows in which two planes are
both set is the popcount of their AND; weighted by the planes' powers of two these counts are the exact
cross-products. Tasks hand over whole sums in limbs, so that Spark's sums are exact in any order. Means are taken off in
whole numbers, n * sum(x_i * x_j) - sum(x_i) * sum(x_j), before the first division; only then comes ``eigh``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerspark.scratch import materialise

PACKED_ROWS = 8192
LIMB_BITS, LIMBS = 40, 4
LARGEST = float(1 << 62)
FLAT = 1e-12  # components with a smaller share of the variance have no spread


def scatter(x: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Exact sums and cross-products (Python integers) of the rows of a whole-number matrix, from its bit planes."""
    rows, dim = x.shape
    low = x.min(axis=0)
    shifted = x.astype(np.uint64) - low.astype(np.uint64)
    depth = [int(v).bit_length() for v in shifted.max(axis=0)]
    owner = np.repeat(np.arange(dim), depth)
    power = np.concatenate([np.arange(b) for b in depth] or [[]]).astype(np.uint64)
    planes = ((shifted[:, owner] >> power) & np.uint64(1)).astype(bool).T
    packed = np.packbits(planes, axis=1)
    words = np.zeros((len(planes), -(-packed.shape[1] // 8) * 8), dtype=np.uint8)
    words[:, : packed.shape[1]] = packed
    words = words.view(np.uint64)
    both = np.zeros((len(planes), len(planes)), dtype=np.int64)
    for p in range(len(planes)):
        both[p, p:] = np.bitwise_count(words[p:] & words[p]).sum(axis=1, dtype=np.int64)
    both = np.triu(both) + np.triu(both, 1).T
    safe = 2 * max(depth, default=0) + rows.bit_length() < 62
    weights = np.zeros((len(planes), dim), dtype=np.int64 if safe else object)
    weights[np.arange(len(planes)), owner] = [1 << int(b) for b in power]
    cross = (weights.T @ (both if safe else both.astype(object)) @ weights).astype(object)
    totals = (np.diag(both).astype(weights.dtype) @ weights).astype(object)
    base = low.astype(object)
    cross = cross + np.outer(base, totals) + np.outer(totals, base) + rows * np.outer(base, base)
    return list(totals + rows * base), cross


def _limbs(value: int) -> list[int]:
    mask = (1 << LIMB_BITS) - 1
    return [value >> LIMB_BITS * i & mask for i in range(LIMBS - 1)] + [value >> LIMB_BITS * (LIMBS - 1)]


def _places(dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(dim)


def _scatter_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``dim, place, l0..l3``: number of rows, sums, then the upper triangle, once for a task and length."""
    waiting: dict[int, list[np.ndarray]] = {}
    found: dict[int, list] = {}

    def add(dim: int) -> None:
        x = np.concatenate(waiting.pop(dim))
        totals, cross = scatter(x)
        own = [len(x), *totals, *cross[_places(dim)]]
        found[dim] = [a + b for a, b in zip(found[dim], own, strict=True)] if dim in found else own

    for batch in batches:
        lengths = batch["x"].str.len().to_numpy()
        for dim in map(int, np.unique(lengths)):
            held = waiting.setdefault(dim, [])
            of_dim = batch["x"][lengths == dim].tolist()
            held.append(np.array(of_dim, dtype=np.int64).reshape(len(of_dim), dim))
            if sum(map(len, held)) >= PACKED_ROWS:
                add(dim)
    for dim in list(waiting):
        add(dim)
    for dim, values in found.items():
        limbs = np.array([_limbs(int(v)) for v in values], dtype=np.int64)
        yield pd.DataFrame({"dim": dim, "place": np.arange(len(values))} | {f"l{i}": limbs[:, i] for i in range(LIMBS)})


@dataclass(frozen=True)
class Whitening:
    """Components of vectors of one length: unit eigenvectors as rows, by falling eigenvalue."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, from whole numbers."""
        n, sums = self.n, self.sums
        if self._small(x, 1 << 62):
            return (n * x - np.array(sums, dtype=np.int64)) / n
        return ((n * x.astype(object) - np.array(sums, dtype=object)) / n).astype(float)

    def _small(self, x: np.ndarray, bound: int) -> bool:
        most = max((abs(int(v)) for v in (x.min(initial=0), x.max(initial=0))), default=0)
        return self.n * most + max(map(abs, self.sums), default=0) < bound

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows by components; a component without spread has no number (null, once it leaves pandas)."""
        centred, found = self.centred(x), np.full((len(x), len(self.values)), np.nan)
        for c, (vector, value) in enumerate(zip(self.vectors, self.values, strict=True)):
            if value > FLAT * self.trace:
                found[:, c] = (centred * vector).sum(axis=1) / np.sqrt(value)
        return found

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n * x - sums)^2; none where a BIGINT can't hold it."""
        if self._small(x, int(np.sqrt((1 << 62) / max(1, len(self.sums))))):
            return ((self.n * x - np.array(self.sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        far = self.n * x.astype(object) - np.array(self.sums, dtype=object)
        return [v if v < 1 << 63 else None for v in map(int, (far * far).sum(axis=1))]


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``id, x``: vectors of finite numbers as whole ones; those that a BIGINT can't hold count as not finite."""
    vector = F.col(vector_col).cast("array<double>")
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c * scale) >= LARGEST))
    whole = F.transform(vector, lambda c: F.floor(c * F.lit(scale)))
    return rows.filter(F.col(vector_col).isNotNull() & ~odd).select(F.col(id_col).alias("id"), whole.alias("x"))


def _fitted(dim: int, places: dict[int, int], components: int) -> Whitening:
    n, sums = places[0], [places[1 + i] for i in range(dim)]
    spread = np.zeros((dim, dim))
    for at, (i, j) in enumerate(zip(*_places(dim), strict=True)):
        spread[i, j] = spread[j, i] = (n * places[1 + dim + at] - sums[i] * sums[j]) / (n * n)
    values, vectors = np.linalg.eigh(spread)
    values, vectors = values[::-1][:components], vectors.T[::-1][:components]
    first = np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1)[:, None], axis=1) if dim else vectors
    return Whitening(n, sums, vectors * np.where(first < 0, -1, 1), values, float(np.trace(spread)))


def fit_whitening(fit_list: DataFrame, components: int) -> dict[int, Whitening]:
    """A whitening for each length of vector in ``fit_list`` (``x``); what is collected grows with lengths, not with rows."""
    parts = fit_list.select("x").mapInPandas(
        _scatter_parts, "dim int, place int, " + ", ".join(f"l{i} bigint" for i in range(LIMBS))
    )
    found: dict[int, dict[int, int]] = {}
    for row in parts.groupBy("dim", "place").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)]).collect():
        value = sum(row[f"l{i}"] << LIMB_BITS * i for i in range(LIMBS))
        found.setdefault(row.dim, {})[row.place] = value
    return {dim: _fitted(dim, places, components) for dim, places in found.items()}


def _identity_error(fit_list: DataFrame, models: dict[int, Whitening]) -> float | None:
    """Largest entry of the whitened vectors' covariance minus the identity, over ``fit_list``, to 12 places."""
    shared = fit_list.sparkSession.sparkContext.broadcast(models)

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch):
                white = shared.value[dim].whitened(x)
                found[dim] = found.get(dim, 0) + white.T @ white
        for dim, sums in found.items():
            i, j = np.indices(sums.shape)
            yield pd.DataFrame({"dim": dim, "i": i.ravel(), "j": j.ravel(), "total": sums.ravel()})

    sums = fit_list.select("x").mapInPandas(products, "dim int, i int, j int, total double")
    rows = sums.groupBy("dim", "i", "j").agg(F.sum("total").alias("total")).collect()
    errors = [abs(r.total / models[r.dim].n - (r.i == r.j)) for r in rows if r.total is not None]
    return round(float(max(errors)), 12) if errors else None


def _by_length(batch: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places in the batch and matrix of the vectors of each length."""
    lengths = batch["x"].str.len().to_numpy()
    for dim in map(int, np.unique(lengths)):
        at = np.flatnonzero(lengths == dim)
        yield dim, at, np.array(batch["x"].iloc[at].tolist(), dtype=np.int64).reshape(len(at), dim)


def whiten(
    rows: DataFrame,
    components: int = 4,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error`` of every vector and component.

    Components become ``floor(scale * c)``. The fit is over distinct vectors, all of them. Rows with a null vector, or with
    entries that are null, not finite or beyond a BIGINT, are left out; null ids and repeated rows stay rows of their
    own. Vectors of another length have a fit of their own. Vectors with fewer than ``components`` entries have so many
    components. A component without spread (one distinct vector, constant or dependent entries) has a null ``whitened``;
    ``explained`` is null where nothing varies, ``identity_error`` where no component has spread; ``deviation`` is null beyond
    64 bits. An empty table gives no rows; further columns are not read.
    """
    vectors = whole_vectors(rows, id_col, vector_col, scale)
    fit_list = materialise(vectors.select("x").distinct(), "whitening-fit")
    models = fit_whitening(fit_list, components)
    error = _identity_error(fit_list, models)
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, at, x in _by_length(batch):
                model = shared.value[dim]
                k, white = len(model.values), model.whitened(x)
                share = model.values / model.trace if model.trace > 0 else np.full(k, np.nan)
                yield pd.DataFrame(
                    {
                        "id": batch["id"].to_numpy()[np.repeat(at, k)],
                        "component": np.tile(np.arange(1, k + 1), len(at)),
                        "n": model.n,
                        "deviation": pd.array(model.deviations(x), dtype="Int64").repeat(k),
                        "whitened": white.ravel(),
                        "explained": np.tile(share, len(at)),
                    }
                )

    # as text, since pandas has no null among whole numbers
    found = vectors.withColumn("id", F.col("id").cast("string")).mapInPandas(
        run, "id string, component int, n bigint, deviation bigint, whitened double, explained double"
    )
    return found.select(
        F.col("id").cast(rows.schema[id_col].dataType).alias(id_col), "component", "n", "deviation", "whitened", "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
