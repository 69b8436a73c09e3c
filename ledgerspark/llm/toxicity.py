"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Every n-gram of a lower-cased text, with white space folded, is hashed to a slot. Over all labelled texts Spark
counts the texts of either class that hold a slot. Every slot that two of them hold is scaled by its
log-count ratio, and a logistic regression over all of these is fitted on a bounded sample of rows, whose gradients executors
take; its penalty, not a list of fixed length, leaves slots out. A text is scored by the slots with a weight that it holds, whatever its length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ledgerspark.llm.common import known_labels, labelled_rows, smallest_hashes
from ledgerspark.scratch import materialise

BITS = 20
GRAMS = (4, 5, 6)
TOXIC_SHARE = 0.25  # of the loss, whatever the share of toxic rows
FIT_TASKS = 8  # that take the gradient over the sample; each sends one array, in pieces
PIECE = 1 << 15
FIRMNESS = (10, 3, 1)
CLOSE = 1e-4
UNIT = float(1 << 50)


def gram_slots(text: str) -> np.ndarray:
    """Slots of all n-grams of ``text``, with repeats; a text shorter than an n-gram has none of it."""
    folded = f" {' '.join(text.lower().split())} "
    codes = np.frombuffer(folded.encode("utf-32-le", "replace"), dtype=np.uint32)
    h, out = codes.copy(), []
    for n in range(2, GRAMS[-1] + 1):
        if len(codes) < n:
            break
        h = h[:-1] * np.uint32(0x9E3779B1)
        h += codes[n - 1 :]
        if n in GRAMS:
            mixed = h ^ (h >> np.uint32(15))
            mixed *= np.uint32(0x85EBCA6B + 2 * n)
            mixed >>= np.uint32(32 - BITS)
            out.append(mixed)
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint32)


def held_slots(text: str, kept: np.ndarray | None = None) -> np.ndarray:
    """Distinct slots of ``text``; with ``kept`` their positions among the kept slots, -1 left out."""
    slots = gram_slots(text)
    if kept is not None:
        slots = kept[slots]
        slots = slots[slots >= 0]
    return np.unique(slots).astype(np.int64)


@dataclass(frozen=True)
class ToxicityModel:
    """``kept`` maps slots to weights' positions (-1: none); ``weights`` include the log-count ratios."""

    kept: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        total = self.bias + float(self.weights[held_slots(text, self.kept)].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def _counted_pieces(rows: DataFrame) -> DataFrame:
    """``at, places, toxic, clean``: each task's texts of either class that hold a slot.

    A row has the slots from ``at`` on that the task has met, packed, so a task hands on ``2**BITS / PIECE`` rows at most.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, last = np.zeros((2, 1 << BITS), dtype=np.int64), np.zeros(1 << BITS, dtype=np.int32)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                slots = gram_slots(text)
                places = np.arange(len(slots), dtype=np.int32)
                last[slots] = places
                held[label, slots[last[slots] == places]] += 1  # each slot once, at its last place
        for at in range(0, 1 << BITS, PIECE):
            clean, toxic = held[:, at : at + PIECE]
            met = np.flatnonzero(clean + toxic)
            if len(met):
                packed = met.astype(np.uint16).tobytes(), toxic[met].tobytes(), clean[met].tobytes()
                yield pd.DataFrame([(at, *packed)], columns=["at", "places", "toxic", "clean"])

    return rows.select("text", "label").mapInPandas(count, "at int, places binary, toxic binary, clean binary")


def _class_counts(rows: DataFrame) -> DataFrame:
    """``slot, toxic, clean``: texts of either class that hold the slot; at most 2**BITS rows.

    Pieces are added up before they become rows. A task that adds holds one number for a slot and class, however many pieces it gets.
    """

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece in batch.itertuples(index=False):
                own = sums.setdefault(piece.at, np.zeros((2, PIECE), dtype=np.int64))
                places = np.frombuffer(piece.places, dtype=np.uint16)
                own[0, places] += np.frombuffer(piece.clean, dtype=np.int64)
                own[1, places] += np.frombuffer(piece.toxic, dtype=np.int64)
        for at, (clean, toxic) in sums.items():
            met = np.flatnonzero(clean + toxic)
            yield pd.DataFrame({"slot": at + met, "toxic": toxic[met], "clean": clean[met]})

    counts = _counted_pieces(rows).repartition("at").mapInPandas(add, "slot int, toxic bigint, clean bigint")
    return counts.groupBy("slot").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


Pull = Callable[[np.ndarray, float], tuple[float, np.ndarray, float]]


def fit_logistic(
    pull: Pull, weights: np.ndarray, bias: float, decay: float, choose: float, rounds: int, pairs: int = 5, close: float = CLOSE
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise a convex loss with ``decay`` on half the squares and ``choose`` on the absolute values.

    Starts from the given ones. Quasi-Newton steps that stay within an orthant, so that weights can be zero. ``pull`` gives loss, gradient and
    the bias's gradient at a point. Ends after ``rounds`` steps, or when a step gains less than ``close`` of the loss.
    """
    firm = np.append(np.full(len(weights), choose), 0.0)

    def at(x: np.ndarray) -> tuple[float, np.ndarray]:
        own, (loss, steep, lift) = x[:-1], pull(x[:-1], float(x[-1]))
        loss += decay / 2 * float(own @ own) + choose * float(np.abs(own).sum())
        return loss, np.append(steep + decay * own, lift)

    def downhill(x: np.ndarray, steep: np.ndarray) -> np.ndarray:
        """The gradient of the loss with its penalty, on the side that leads down where a weight is zero."""
        up, down = steep + firm, steep - firm
        edge = np.where(up < 0, up, np.where(down > 0, down, 0.0))
        return np.where(x > 0, up, np.where(x < 0, down, edge))

    x = np.append(weights, bias)
    loss, steep = at(x)
    history: list[tuple[np.ndarray, np.ndarray]] = []
    for done in range(1, rounds + 1):
        slope = downhill(x, steep)
        step = _curved(slope, history)
        step[step * slope <= 0] = 0.0
        sides = np.where(x != 0, np.sign(x), -np.sign(slope))
        length = 1.0
        while True:
            to = x - length * step
            to[:-1][to[:-1] * sides[:-1] <= 0] = 0.0
            to_loss, to_steep = at(to)
            if to_loss <= loss - 1e-4 * float(slope @ (x - to)) or length < 1e-6:
                break
            length /= 2
        if to_loss >= loss:
            break
        moved, bent = to - x, to_steep - steep
        if float(moved @ bent) > 1e-14:
            history = [*history[1 - pairs :], (moved.astype(np.float32), bent.astype(np.float32))]
        gain, x, loss, steep = loss - to_loss, to, to_loss, to_steep
        if done > pairs and gain < close * loss:
            break
    return x[:-1], float(x[-1])


def _curved(slope: np.ndarray, history: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The slope times the inverse of the curvature that ``history`` (moves and changes of slope, in half the space) tells."""
    step, shares = slope.copy(), []
    for moved, bent in reversed(history):
        shares.append(float(moved @ step) / float(moved @ bent))
        step -= shares[-1] * bent
    if history:
        moved, bent = history[-1]
        step *= float(moved @ bent) / float(bent @ bent)
    else:
        step /= max(1.0, float(np.sqrt(slope @ slope)))
    for (moved, bent), share in zip(history, reversed(shares), strict=True):
        step += moved * (share - float(bent @ step) / float(moved @ bent))
    return step


def _pulls(held: DataFrame, scale: np.ndarray, sizes: dict[int, int]) -> Pull:
    """Loss and gradient over the written rows of ``held`` (``label, places`` of slots), summed on executors.

    ``scale`` is the ratio at each place, ``sizes`` the rows of each label. Every task hands over one number for a place, in
    pieces. Errors are whole numbers of a small unit, so the sums are exact and do not depend on how rows are dealt.
    """
    context, size = held.sparkSession.sparkContext, len(scale)
    share = np.array([(1 - TOXIC_SHARE) / max(1, sizes.get(0, 0)), TOXIC_SHARE / max(1, sizes.get(1, 0))])

    def pull(weights: np.ndarray, bias: float) -> tuple[float, np.ndarray, float]:
        shared = context.broadcast((weights * scale, bias))

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scaled, shift = shared.value
            pulls, lift, loss = np.zeros(size), 0, 0
            for batch in batches:
                labels = batch["label"].to_numpy()
                lengths = batch["places"].str.len().to_numpy() // 4
                places = np.frombuffer(b"".join(batch["places"]), dtype=np.int32)
                rows = np.repeat(np.arange(len(labels)), lengths)
                totals = shift + np.bincount(rows, scaled[places], minlength=len(labels))
                own = share[labels]
                errors = np.rint((1 / (1 + np.exp(-np.clip(totals, -50, 50))) - labels) * own * UNIT)
                pulls += np.bincount(places, errors[rows], minlength=size)
                lift += int(errors.sum())
                loss += int(np.rint(np.logaddexp(0, np.where(labels == 1, -totals, totals)) * own * UNIT).sum())
            for at in range(0, max(1, size), PIECE):
                piece = pulls[at : at + PIECE].astype(np.int64).tobytes()
                yield pd.DataFrame({"at": [at], "pulls": [piece], "lift": [lift], "loss": [loss]})
                lift = loss = 0

        kinds = "at int, pulls binary, lift bigint, loss bigint"
        found = held.coalesce(_tasks(sizes)).mapInPandas(add, kinds).toArrow()
        shared.destroy()
        steep = np.zeros(size, dtype=np.int64)
        for at, piece in zip(found["at"].to_pylist(), found["pulls"], strict=True):
            steep[at : at + PIECE] += np.frombuffer(piece.as_buffer(), dtype=np.int64)
        lift, loss = (sum(found[c].to_pylist()) / UNIT for c in ("lift", "loss"))
        return loss, steep / UNIT * scale, lift

    return pull


def _narrowed(held: DataFrame, opened: np.ndarray, size: int) -> DataFrame:
    """``held`` with the places among ``opened`` only."""
    kept = np.full(size, -1, dtype=np.int32)
    kept[opened] = np.arange(len(opened))
    shared = held.sparkSession.sparkContext.broadcast(kept)

    def narrow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shared.value[np.frombuffer(p, dtype=np.int32)] for p in batch["places"]]
            yield pd.DataFrame({"label": batch["label"], "places": [f[f >= 0].tobytes() for f in found]})

    return materialise(held.mapInPandas(narrow, "label int, places binary"), "toxicity-narrowed")


def _fitted(
    held: DataFrame, scale: np.ndarray, sizes: dict[int, int], decay: float, choose: float, rounds: int
) -> tuple[np.ndarray, float]:
    """Weights of all places and the bias.

    Every place may have a weight; those that the gradient does not pull away from zero need not be looked at. So the
    fit opens the places that are pulled, steps over these, and takes the gradient of all again, until no more are
    pulled; from a firmer penalty down, so that few open in vain.
    """
    weights, opened = np.zeros(len(scale)), np.empty(0, dtype=np.int64)
    bias, whole = float(np.log(TOXIC_SHARE / (1 - TOXIC_SHARE))), _pulls(held, scale, sizes)
    for firm in FIRMNESS:
        bar = firm * choose
        while True:
            pulled = np.flatnonzero(np.abs(whole(weights, bias)[1]) > 1.05 * bar)
            joining = np.setdiff1d(pulled, opened)
            if not len(joining):
                break
            opened = np.union1d(opened, joining)
            some = _pulls(_narrowed(held, opened, len(scale)), scale[opened], sizes)
            close = CLOSE if firm == FIRMNESS[-1] else 10 * CLOSE
            weights[opened], bias = fit_logistic(some, weights[opened], bias, decay, bar, rounds, close=close)
    return weights, bias


def _tasks(sizes: dict[int, int]) -> int:
    return max(1, min(FIT_TASKS, sum(sizes.values()) // 500))


def _held(sample: DataFrame, slots: np.ndarray, sizes: dict[int, int]) -> DataFrame:
    """Written ``label, places`` of the sampled texts: each is hashed once; places are those of its slots in ``slots``."""
    shared = sample.sparkSession.sparkContext.broadcast(_kept(slots))

    def hold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held = [held_slots(t, shared.value).astype(np.int32).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"label": batch["label"], "places": held})

    dealt = sample.select("text", "label").repartition(_tasks(sizes))
    return materialise(dealt.mapInPandas(hold, "label int, places binary"), "toxicity-slots")


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    max_rows: int = 6_000,
    smoothing: float = 0.5,
    decay: float = 2e-3,
    choose: float = 0.01,
    rounds: int = 60,
) -> ToxicityModel:
    """Learn from the labelled rows outside fold 0.

    Class counts cover all of them; the weights are fitted on ``max_rows`` rows of either class at most. Every slot
    that two labelled rows hold is open to the fit, however many there are: its absolute-value penalty, ``choose``
    over the root of the toxic rows, leaves most weights at zero. Sampled texts are hashed once and stay on the executors, which
    take the gradient; the driver holds arrays of one number for a slot, whatever the rows or their lengths. With no row
    of one class all scores are 0 or 1, with no rows 0. Equal rows count each; rows with a null id have no label.
    """
    rows = labelled_rows(docs, known_labels(labels, label)).withColumn("row", F.monotonically_increasing_id())
    rows = materialise(rows, "toxicity-labelled")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return ToxicityModel(_kept(np.empty(0, dtype=np.int64)), np.zeros(0), 50.0 if sizes.get(1) else -50.0)
    p = (F.col("toxic") + smoothing) / (sizes[1] + 2 * smoothing)
    q = (F.col("clean") + smoothing) / (sizes[0] + 2 * smoothing)
    ratios = (
        _class_counts(rows).filter(F.col("toxic") + F.col("clean") >= 2)
        .select("slot", F.log(p / q).alias("ratio")).filter("ratio != 0").toArrow()
    )
    slots, scale = ratios["slot"].to_numpy().astype(np.int64), ratios["ratio"].to_numpy()
    order = np.argsort(slots)
    slots, scale = slots[order], scale[order]
    del ratios, order
    sample = [smallest_hashes(rows.filter(F.col("label") == c), ["doc_id", "text"], "row", max_rows, seed=9) for c in (0, 1)]
    taken = {c: min(max_rows, n) for c, n in sizes.items()}
    held = _held(sample[0].unionAll(sample[1]), slots, taken)
    weights, bias = _fitted(held, scale, taken, decay, choose / np.sqrt(taken[1]), rounds)
    chosen = np.flatnonzero(weights)
    return ToxicityModel(_kept(slots[chosen]), weights[chosen] * scale[chosen], bias)


def _kept(slots: np.ndarray) -> np.ndarray:
    kept = np.full(1 << BITS, -1, dtype=np.int32)
    kept[slots] = np.arange(len(slots))
    return kept


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, score`` of every row, over the whole text; null text counts as empty.

    Null ids and repeated rows are scored like any other, further columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "score": [own.score(t) for t in batch["text"]]})

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with their columns, whose text scores below ``threshold``.

    Null text counts as empty, texts are read whole, repeated rows stay or go together, an empty table gives no rows; no
    column is added, so none can clash.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t or "") for t in text], dtype=float)

    return docs.filter(score("text") < threshold)
