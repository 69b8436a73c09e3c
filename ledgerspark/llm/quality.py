"""Quality: positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are the rows labelled 1; unlabelled web text is a sample of all other documents and
carries no label. A logistic classifier over measures of form (symbols, case, repetition, word and line
lengths) minimises prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)), so the
risk of the negatives hidden in the unlabelled text cannot be driven below zero. The class prior is estimated from
the scores of a positive-against-unlabelled classifier, from the part of the positives' range that unlabelled
text fills least.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerspark.llm.common import bounded_sample, held_out, known_labels, labelled_rows
from ledgerspark.scratch import materialise

SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
WIDTH = len(SYMBOLS) + 16


def form(text: str) -> np.ndarray:
    """Measures of the form of ``text``; none of them names a word or a language."""
    data = text.encode("utf-8", "replace")
    found = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256).astype(float)
    total = max(1, len(data))
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    upper, lower = found[65:91].sum(), found[97:123].sum()
    kinds = set(words)
    again = sum(map(operator.eq, words, words[1:]))
    twice = len(set(zip(words, words[1:], strict=False)))
    shouted = sum(map(str.isupper, words))
    plain = sum(map(str.isalpha, words))
    return np.concatenate(
        [
            np.sqrt(found[np.frombuffer(SYMBOLS, dtype=np.uint8)] / total),
            [
                np.log1p(len(words)),
                len(kinds) / n,
                len(kinds) / n * np.log1p(n),
                again / n,
                twice / n,
                shouted / n,
                plain / n,
                upper / max(1.0, upper + lower),
                np.sqrt(found[48:58].sum() / total),
                found[128:].sum() / total,
                np.log1p(total / n),
                np.log1p(total / len(lines)),
                len(set(lines)) / len(lines),
                max(map(len, words), default=0) > 40,
                len(words) == 0,
                min(len(words), 20) / 20,
            ],
        ]
    )


@dataclass(frozen=True)
class QualityModel:
    """Weights over measures that are centred, scaled and held to a range; the last one is the bias."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    prior: float

    def logits(self, measures: np.ndarray) -> np.ndarray:
        return _ready(measures, self.centre, self.spread) @ self.weights

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(texts):
            return np.empty(0)
        return _sigmoid(self.logits(np.array([form(t) for t in texts])))


def _ready(measures: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    scaled = np.clip((measures - centre) / spread, -8, 8)
    return np.hstack([scaled, np.maximum(0, scaled - 1), np.maximum(0, -1 - scaled), np.ones((len(scaled), 1))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Adam:
    def __init__(self, size: int, rate: float) -> None:
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient**2
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, doubt: float = 0.1) -> float:
    """The share of positives in unlabelled text, from scores that neither classifier was fitted to.

    Above any threshold unlabelled text has at least prior * the positives' share; the bound is taken where,
    with its sampling error, it is least.
    """
    edges = np.unique(np.quantile(positive, np.linspace(0, 1, 201)))
    p = np.array([(positive >= e).mean() for e in edges])
    u = np.array([(unlabelled >= e).mean() for e in edges])
    slack = np.sqrt(np.log(4 / doubt) / 2) * (len(positive) ** -0.5 + len(unlabelled) ** -0.5)
    upper = np.where(p > 0, (u + slack) / np.maximum(p, 1e-9), np.inf)
    at = int(np.argmin(upper))
    return float(np.clip(u[at] / p[at], 0.05, 0.995))


def fit_separator(positive: np.ndarray, unlabelled: np.ndarray, rounds: int, decay: float) -> np.ndarray:
    """Logistic weights that tell positives from unlabelled rows, both weighing half."""
    weights, adam = np.zeros(positive.shape[1]), _Adam(positive.shape[1], 0.05)
    for _ in range(rounds):
        gradient = -0.5 * positive.T @ (1 - _sigmoid(positive @ weights)) / len(positive)
        gradient += 0.5 * unlabelled.T @ _sigmoid(unlabelled @ weights) / len(unlabelled)
        weights -= adam.step(gradient + decay * weights)
    return weights


def fit_non_negative(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, rounds: int, decay: float, batches: int = 4
) -> np.ndarray:
    """Weights that minimise the non-negative risk by the logistic loss, in a fixed order of batches."""
    rng = np.random.default_rng(2)
    weights, adam = np.zeros(positive.shape[1]), _Adam(positive.shape[1], 0.03)
    total = np.zeros_like(weights)
    for turn in range(rounds):
        parts = zip(
            np.array_split(rng.permutation(len(positive)), batches),
            np.array_split(rng.permutation(len(unlabelled)), batches),
            strict=True,
        )
        for i, j in parts:
            if not len(i) or not len(j):
                continue
            p, u = positive[i], unlabelled[j]
            fp, fu = p @ weights, u @ weights
            hidden = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            negative = u.T @ _sigmoid(fu) / len(u) - prior * p.T @ _sigmoid(fp) / len(p)
            if hidden >= 0:
                gradient = negative - prior * p.T @ (1 - _sigmoid(fp)) / len(p)
            else:  # overfitted: climb back until the negatives' risk is no longer below zero
                gradient = -negative
            weights -= adam.step(gradient + decay * weights)
        if turn >= rounds // 2:
            total += weights
    return total / (rounds - rounds // 2)


def fit_measures(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, rounds: int = 200, decay: float = 1e-4
) -> QualityModel:
    """The model for measured rows of both samples; without any of one of them it knows nothing."""
    if not len(positive) or not len(unlabelled):
        size = WIDTH * 3 + 1
        weights = np.zeros(size)
        weights[-1] = 30.0 if len(positive) or not len(unlabelled) else 0.0
        return QualityModel(np.zeros(WIDTH), np.ones(WIDTH), weights, 1.0)
    every = np.vstack([positive, unlabelled])
    centre, spread = every.mean(axis=0), every.std(axis=0) + 1e-3
    p, u = _ready(positive, centre, spread), _ready(unlabelled, centre, spread)
    if prior is None:
        halves = [(slice(0, None, 2), slice(1, None, 2)), (slice(1, None, 2), slice(0, None, 2))]
        found = []
        for fit, test in halves:
            w = fit_separator(p[fit], u[fit], rounds, 1e-3) if len(p) > 1 and len(u) > 1 else np.zeros(p.shape[1])
            found.append(estimate_prior(p[test] @ w, u[test] @ w) if len(p) > 1 and len(u) > 1 else 0.5)
        prior = float(np.mean(found))
    weights = fit_non_negative(p, u, prior, rounds, decay)
    return QualityModel(centre, spread, weights, prior)


def _measured(rows: DataFrame) -> np.ndarray:
    """The measures of a bounded sample, in an order that does not depend on the partitions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"m": [form(t).tobytes() for t in batch["text"]]})

    held = sorted(rows.select("text").mapInPandas(run, "m binary").toPandas()["m"])
    return np.array([np.frombuffer(m) for m in held]).reshape(len(held), WIDTH)


def _shuffled(rows: np.ndarray) -> np.ndarray:
    return rows[np.random.default_rng(len(rows)).permutation(len(rows))]


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    prior: float | None = None,
    max_positive: int = 12_000,
    max_unlabelled: int = 12_000,
) -> QualityModel:
    """Learn from ``max_positive`` rows labelled 1 and ``max_unlabelled`` unlabelled rows at most.

    Labels come only from rows outside fold 0, and so does the unlabelled text, whose labels, if any, are not read. The driver gets
    the measures of these samples, never texts. ``prior`` is estimated where it is not given.
    """
    trusted = bounded_sample(known_labels(labels, label).filter("label = 1"), ["doc_id"], max_positive, seed=2)
    positive = materialise(labelled_rows(docs, trusted).select("doc_id", "text"), "quality-positive")
    unlabelled = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return fit_measures(
        _shuffled(_measured(bounded_sample(positive, ["doc_id", "text"], max_positive, seed=2))),
        _shuffled(_measured(bounded_sample(unlabelled, ["doc_id", "text"], max_unlabelled, seed=3))),
        prior,
    )


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row, over the whole text; null text counts as empty.

    Null ids and repeated rows are scored like any other, further columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "score": shared.value.score(list(batch["text"]))})

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with their columns, whose text scores ``threshold`` or more.

    Null text counts as empty, texts are read whole, repeated rows stay or go together, an empty table gives no rows; no
    column is added, so none can clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score([t or "" for t in text]), dtype=float)

    return docs.filter(score("text") >= threshold)
