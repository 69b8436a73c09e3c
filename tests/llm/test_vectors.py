"""Hard negatives and whitening against brute force in whole numbers."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from ledgerspark.llm import negatives, whitening

ROWS = "vec_id long, embedding array<float>, label int, rank int, n long, component string"
ODD = [float("nan"), float("inf"), None]


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, None, 0, "x") for i, v, y in rows], ROWS)


def mined(rows, anchors, positives=5, k=10):
    """The contract read plainly."""
    def whole(vector):
        return [math.floor(256 * float(np.float32(c))) for c in vector]

    sound = [(i, whole(v), y) for i, v, y in rows if i is not None and y is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    found = []
    for a in sorted({i for i, _, _ in sound if i in anchors}):
        label, own = min((y, v) for i, v, y in sound if i == a)
        scored = sorted((-sum(p * q for p, q in zip(own, v)), i, y) for i, v, y in sound if i != a and len(v) == len(own))
        near = [(i, -s) for s, i, y in scored if y == label][:positives]
        for positive, bar in sorted(set(near)):
            fit = [(i, -s) for s, i, y in scored if y != label and 30 * bar <= -100 * s <= 90 * bar][:k]
            found += [(a, positive, r, i, bar, s) for r, (i, s) in enumerate(fit, 1)]
    return sorted(found)


def answers(found):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    own = [(i, [rng.gauss(0, 0.3) + (i % 3) * 0.2 for _ in range(12)], i % 4) for i in range(0, 400)]
    hot = [(1000 + i, own[0][1], i % 4) for i in range(150)]  # one vector holds a quarter of all rows: ties
    odd = [(2000, [0.1] * 11 + [c], 1) for c in ODD] + [(2001, None, 1), (2002, own[5][1], None), (None, own[5][1], 2)]
    again = [own[100], (100, own[7][1], 3), own[3], (2003, [], 1), (2004, [0.5] * 3, 1), (2005, [0.4] * 3, 2), (2100, [0.5] * 3, 1)]
    return own + hot + odd + again


@pytest.mark.parametrize("tile", [16, 8192])
def test_negatives_equal_brute_force(spark, rows, monkeypatch, tile):
    monkeypatch.setattr(negatives, "TILE_ROWS", tile)
    docs = table(spark, rows).repartition(3)
    asked = docs.filter("vec_id % 100 = 0")
    anchors = {i for i, _, _ in rows if i is not None and i % 100 == 0}
    found = answers(negatives.mine_negatives(docs, asked))
    assert found == mined(rows, anchors) and len(found) > 100


def test_negatives_of_few_rows_and_of_none(spark):
    few = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [-1.0, 0.0], 2), (100, [0.0, 1.0], 7)]
    docs = table(spark, few)
    assert answers(negatives.mine_every_hundredth(docs)) == []  # the id 0 moves on to label 2
    assert answers(negatives.mine_negatives(docs, docs.filter("vec_id = 0"))) == [(0, 1, 1, 2, 65536, 32768)]
    assert negatives.mine_every_hundredth(docs.limit(0)).count() == 0


def test_products_beyond_the_range(spark):
    huge = [(0, [3e38, 3e38], 1), (1, [3e38, 1.0], 1), (2, [1.0, 0.0], 2), (100, [1e18, 1.0], 2)]
    found = negatives.mine_negatives(table(spark, huge), table(spark, huge).filter("vec_id = 0")).collect()
    assert all(-(1 << 63) <= r.negative_score <= r.positive_score < 1 << 63 for r in found)


def test_scan_shrinks_its_bitmap():
    rng = np.random.default_rng(1)
    columns = np.floor(256 * rng.normal(0, 0.2, (64, 4000)))
    anchor = np.floor(256 * rng.normal(0, 0.2, 64) * np.linspace(3, 0, 64))
    asked = []

    def keep(least, most):
        asked.append(len(least))
        return negatives.reaching(5)(least, most)

    at, scores = negatives.vertical_scan(anchor, columns, np.ones(4000, dtype=bool), keep)
    assert sorted(scores)[-5:] == sorted(anchor @ columns)[-5:] and (scores == anchor @ columns[:, at]).all()
    assert asked[0] == 4000 and asked[-1] < 400 and asked == sorted(asked, reverse=True)


@pytest.mark.parametrize("shape,most", [((1, 3), 5), ((200, 7), 200), ((9000, 2), 3), ((50, 3), 1 << 61), ((5, 0), 1)])
def test_bit_planes_give_exact_products(shape, most):
    x = np.random.default_rng(2).integers(-most, most, shape, endpoint=True)
    totals, cross = whitening.scatter(x)
    exact = x.astype(object)
    assert totals == list(exact.sum(axis=0)) if shape[1] else totals == []
    assert (cross == exact.T @ exact).all()


def test_limbs_hold_any_sum():
    for value in (0, -1, 1 << 150, -(1 << 140) + 12345, 7):
        assert sum(v << whitening.LIMB_BITS * i for i, v in enumerate(whitening._limbs(value))) == value


def vectors(spark, n, dim=6, seed=5):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(0, 1, (n, dim)) @ rng.normal(0, 0.4, (dim, dim)) + 0.3
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(mixed)]
    return rows + [(900 + i, rows[0][1], 0) for i in range(n // 2)]  # a third holds one vector


def test_whitening_equals_brute_force(spark):
    rows = vectors(spark, 60) + [(None, [0.25] * 6, 0), (7, [0.5] * 6, 0)]
    odd = [(1900, [0.1] * 5 + [c], 0) for c in ODD] + [(1901, None, 0), (1902, [1e30] * 6, 0)]
    found = whitening.whiten(table(spark, rows + odd).repartition(4)).collect()
    x = {tuple(math.floor(256 * c) for c in v) for _, v, _ in rows}
    n, sums = len(x), [sum(v[d] for v in x) for d in range(6)]
    spread = np.array([[float(sum(Fraction((n * v[i] - sums[i]) * (n * v[j] - sums[j]), n * n) for v in x) / n) for j in range(6)] for i in range(6)])
    values, axes = np.linalg.eigh(spread)
    assert len(found) == 4 * len(rows)
    of = {}
    for r in found:
        of.setdefault((r.vec_id, r.component), []).append(r)
    for i, v, _ in rows:
        whole = [math.floor(256 * c) for c in v]
        for c in range(1, 5):
            own = next(r for r in of[i, c] if r.deviation == sum((n * a - s) ** 2 for a, s in zip(whole, sums)))
            centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(whole, sums)])
            assert abs(own.whitened) == pytest.approx(abs(centred @ axes[:, -c]) / np.sqrt(values[-c]), rel=1e-8, abs=1e-9)
            assert own.explained == pytest.approx(values[-c] / np.trace(spread), rel=1e-9)
            assert own.n == n and own.identity_error < 1e-9


def test_whitening_without_spread_and_of_odd_lengths(spark):
    none = whitening.whiten(table(spark, vectors(spark, 5)).limit(0))
    assert none.count() == 0 and none.columns[:3] == ["vec_id", "component", "n"]
    one = whitening.whiten(table(spark, [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0), (3, [], 0), (4, None, 0)])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one) == [
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)
    ]
    flat = whitening.whiten(table(spark, [(1, [0.5, 0.1], 0), (2, [1.5, 0.1], 0), (3, [0.2], 0), (4, [0.4], 0)])).collect()
    assert [(r.vec_id, r.component) for r in flat if r.whitened is None] == [(1, 2), (2, 2)]
    assert {r.vec_id: abs(round(r.whitened, 9)) for r in flat if r.component == 1} == {1: 1, 2: 1, 3: 1, 4: 1}


def test_deviation_beyond_a_bigint_is_null(spark):
    far = whitening.whiten(table(spark, [(1, [1e12], 0), (2, [0.0], 0), (3, [-1e12], 0)]), components=1).collect()
    by_id = {r.vec_id: r for r in far}
    assert by_id[1].deviation is None and by_id[2].deviation is not None
    assert by_id[1].whitened == pytest.approx(-by_id[3].whitened)
