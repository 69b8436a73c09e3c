"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are dealt by a hash into blocks of about ``block_words`` words. A source is
taken whole as often as its target allows, and the rest of its target is filled with blocks of one
more pass, in an order permuted for that pass; the last of these blocks is cut where the target is met. That
fixes the exact number of blocks each source gives. The output shards get them by a binary tree: at
every node the blocks of all sources are split between the left and the right shards by one draw from
the multivariate hypergeometric distribution, until a leaf has the exact block quota of each source
for one shard. Leaves draw disjoint ranges of the permuted blocks, and a shard's rows are shuffled by
sorting them locally by a hash. All draws follow from the seed, so reruns agree.

The driver holds one row per source (``max_sources`` at most, else it raises). Blocks and quotas per
shard are tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerspark.llm.common import WORD, mix64
from ledgerspark.operators.joins import lookup_join
from ledgerspark.scratch import materialise

MAX_BLOCKS = 500_000_000  # the generator draws from fewer than 10^9


def weighted_targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Targets in proportion to ``weights`` that add up to ``share`` times all sizes.

    No target exceeds ``most`` times its size; what is cut off is shared by weight among the others
    until none is above. If ``share`` exceeds ``most``, every target is at its stop.
    """
    stops = [most * n for n in sizes]
    targets, open_ = [0.0] * len(sizes), list(range(len(sizes)))
    left = share * sum(sizes)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        above = [i for i in open_ if weights[i] * unit >= stops[i]]
        if not above:
            for i in open_:
                targets[i] = weights[i] * unit
            break
        for i in above:
            targets[i] = stops[i]
            left -= stops[i]
        open_ = [i for i in open_ if i not in set(above)]
    return targets


def permuted(index: np.ndarray, count: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A bijection of 0..count-1 for every key: a Feistel network, walked until it is in range."""
    index, count, key = (np.asarray(x).astype(np.uint64) for x in (index, count, key))
    half = np.ones(len(count), dtype=np.uint64)
    while (small := (np.uint64(1) << (np.uint64(2) * half)) < count).any():
        half[small] += np.uint64(1)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.copy(), np.arange(len(index))
    while len(todo):
        h, m = half[todo], mask[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            left, right = right, left ^ (mix64(right + key[todo] + np.uint64(r << 40)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= count[todo]]
    return out.astype(np.int64)


def shard_quotas(quotas: np.ndarray, shards: int, first: int, last: int, seed: int) -> Iterator[tuple]:
    """``(shard, before, quota)`` arrays of the leaves ``first`` to ``last - 1`` of the tree.

    ``before`` counts the blocks of each source that shards to the left have. A node's draw depends
    on the seed and its span alone, so every task that passes a node splits it alike.
    """
    stack = [(0, shards, quotas.astype(np.int64), np.zeros(len(quotas), dtype=np.int64))]
    while stack:
        low, high, own, before = stack.pop()
        if high <= first or low >= last:
            continue
        if high - low == 1:
            yield low, before, own
            continue
        middle = (low + high) // 2
        total = int(own.sum())
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(own, total * (middle - low) // (high - low), method="marginals")
        stack.append((middle, high, own - left, before + left))
        stack.append((low, middle, left, before))


@dataclass(frozen=True)
class Mix:
    """Rows of ``sources`` (one each) and of ``blocks`` (source, block, draws) of a planned mix."""

    sources: DataFrame
    blocks: DataFrame
    shards: int


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id, source, size, h`` of every row: what the mix is planned from."""
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        _key(docs, id_col, text_col).alias("h"),
    )


def plan_mix(
    sized: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = 8192,
    block_rows: int = 8192,
    shard_words: int = 4 << 20,
    max_sources: int = 100_000,
    seed: int = 20,
) -> Mix:
    """Plan a mix of the rows of :func:`measure`, which should be written rows.

    Sources in code point order, null last, have ``weights`` in turn.
    """
    spark = sized.sparkSession
    totals = (
        sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
        .limit(max_sources + 1).collect()
    )
    if len(totals) > max_sources:
        raise ValueError(f"more than {max_sources} sources: give max_sources, or coarser sources")
    totals.sort(key=lambda r: (r.source is None, r.source or ""))
    words = [r.words for r in totals]
    goals = weighted_targets(words, [weights[i % len(weights)] for i in range(len(totals))], share, most)
    unit = max(block_words, -(-int(sum(goals)) // MAX_BLOCKS))
    plan = [
        (i, r.source, r.words, goal, round(goal) // max(r.words, 1), round(goal) % max(r.words, 1),
         max(1, -(-r.words // unit), -(-r.rows // block_rows)))
        for i, (r, goal) in enumerate(zip(totals, goals, strict=True))
    ]
    sources = spark.createDataFrame(
        plan,
        f"source_id int, source {sized.schema['source'].dataType.simpleString()}, source_size bigint, "
        "target double, passes bigint, rest bigint, blocks bigint",
    )
    blocks = _drawn_blocks(with_blocks(sized, sources), seed)
    blocks = materialise(blocks, "mix-blocks")
    drawn = {
        r.source_id: r.n
        for r in blocks.filter("rest_words > 0").groupBy("source_id").agg(F.count("*").alias("n")).collect()
    }
    quotas = np.array([p[4] * p[6] + drawn.get(p[0], 0) for p in plan], dtype=np.int64)
    shards = max(1, -(-int(sum(goals)) // shard_words))
    dealt = _dealt_blocks(spark, quotas, shards, seed)
    passes = F.explode(F.sequence(F.lit(0), F.col("passes").cast("int"))).alias("pass")
    draws = blocks.select("*", passes).filter("pass < passes or rest_words > 0")
    last = F.col("pass") == F.col("passes")
    draws = draws.select(
        "source_id",
        "block",
        "pass",
        F.when(last, F.col("passes") * F.col("blocks") + F.col("rest_rank"))
        .otherwise(F.col("pass") * F.col("blocks") + _rank(seed)("block", "blocks", "source_id", "pass"))
        .alias("draw"),
        F.when(last, F.col("cut_h")).alias("cut_h"),
        F.when(last, F.col("cut_words")).alias("cut_words"),
    ).join(dealt, ["source_id", "draw"])
    draw = F.struct("pass", "shard", "cut_h", "cut_words")
    draws = draws.groupBy("source_id", "block").agg(F.sort_array(F.collect_list(draw)).alias("draws"))
    return Mix(sources, materialise(draws, "mix-draws"), shards)


def with_blocks(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's plan and their block; ``sources`` has at most ``max_sources`` rows."""
    plan = F.broadcast(sources.withColumnRenamed("source", "__source"))
    return (
        sized.join(plan, F.col("source").eqNullSafe(F.col("__source")))
        .drop("__source")
        .withColumn("block", F.pmod(F.col("h"), F.col("blocks")))
    )


def _rank(seed: int):
    @F.pandas_udf("bigint")
    def rank(block: pd.Series, blocks: pd.Series, source: pd.Series, turn: pd.Series) -> pd.Series:
        key = mix64(source.to_numpy() * 1_000_003 + turn.to_numpy() * 7919 + seed)
        return pd.Series(permuted(block.to_numpy(), blocks.to_numpy(), key))

    return rank


def _drawn_blocks(rows: DataFrame, seed: int) -> DataFrame:
    """Every block with rows, and how much of it the pass for the rest of the target takes.

    ``rest_words`` is null if that pass leaves it out. ``rest_rank`` counts the blocks with
    words before it in that pass. Of a
    block that is cut, rows with ``h < cut_h`` are taken whole and the rows at ``cut_h`` give
    ``cut_words`` each.
    """
    plan = ["source_id", "passes", "rest", "blocks", "block"]
    blocks = rows.groupBy(*plan).agg(F.sum("size").alias("words")).withColumn(
        "rank", _rank(seed)("block", "blocks", "source_id", "passes")
    )
    runs = 4096  # ranks that are summed together before their sums are summed
    blocks = blocks.withColumn("run", F.floor(F.col("rank") / runs))
    sums = blocks.groupBy("source_id", "run").agg(F.sum("words").alias("w"), F.count_if(F.col("words") > 0).alias("n"))
    above = Window.partitionBy("source_id").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select(
        "source_id", "run", (F.sum("w").over(above) - F.col("w")).alias("w0"), (F.sum("n").over(above) - F.col("n")).alias("n0")
    )
    inside = Window.partitionBy("source_id", "run").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.join(sums, ["source_id", "run"]).select(
        *plan,
        "words",
        (F.col("w0") + F.sum("words").over(inside) - F.col("words")).alias("before"),
        (F.col("n0") + F.count_if(F.col("words") > 0).over(inside) - 1).alias("rest_rank"),
    )
    left = F.col("rest") - F.col("before")
    blocks = blocks.withColumn(
        "rest_words", F.when((left > 0) & (F.col("words") > 0), F.least(left, F.col("words")))
    )
    cut = blocks.filter("rest_words < words").select("source_id", "block", "rest_words")
    parts = (
        rows.select("source_id", "block", "h", "size").join(F.broadcast(cut), ["source_id", "block"])
        .groupBy("source_id", "block", "rest_words", "h").agg(F.sum("size").alias("w"), F.count("*").alias("n"))
    )
    upto = Window.partitionBy("source_id", "block").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    room = F.col("rest_words") - (F.sum("w").over(upto) - F.col("w"))
    edges = (
        parts.withColumn("room", room).filter("room >= 0 and room < w")
        .select("source_id", "block", F.col("h").alias("cut_h"), F.floor(F.col("room") / F.col("n")).alias("cut_words"))
    )
    return blocks.join(F.broadcast(edges), ["source_id", "block"], "left").select(
        *plan, "rest_words", "rest_rank", "cut_h", "cut_words"
    )


def _dealt_blocks(spark, quotas: np.ndarray, shards: int, seed: int) -> DataFrame:
    """``source_id, draw, shard``: the shard of every drawn block, a range of draws for each leaf."""

    def leaves(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            first, last = int(batch["id"].min()), int(batch["id"].max()) + 1
            for shard, before, own in shard_quotas(quotas, shards, first, last, seed):
                used = np.flatnonzero(own)
                yield pd.DataFrame(
                    {"shard": shard, "source_id": used, "low": before[used], "high": (before + own)[used] - 1}
                )

    tasks = max(1, min(10_000, shards // 256))
    ranges = spark.range(0, shards, 1, tasks).mapInPandas(leaves, "shard bigint, source_id int, low bigint, high bigint")
    return ranges.select("source_id", F.explode(F.sequence("low", "high")).alias("draw"), "shard")


def _taken(size: Column, h: Column) -> Column:
    """``copies``: pass, shard and words of each copy of a row that the mix takes; whole rows but one per source."""
    copies = F.transform(
        F.coalesce(F.col("draws"), F.array().cast("array<struct<pass:int,shard:bigint,cut_h:bigint,cut_words:bigint>>")),
        lambda d: F.struct(
            d["pass"].alias("pass"),
            d["shard"].alias("shard"),
            F.when(d["cut_h"].isNull() | (h < d["cut_h"]), size)
            .when(h == d["cut_h"], F.least(size, d["cut_words"]))
            .otherwise(F.lit(0).cast("bigint"))
            .alias("words"),
        ),
    )
    return F.filter(copies, lambda c: (c["words"] > 0) | ((size == 0) & (c["words"] == 0)))


def apply_mix(rows: DataFrame, mix: Mix) -> DataFrame:
    """``source_size, target, copies`` beside the columns of ``rows``, which has ``source, size, h``."""
    blocked = with_blocks(rows, mix.sources).drop("passes", "rest", "blocks")
    return lookup_join(blocked, mix.blocks, ["source_id", "block"], "left").withColumn(
        "copies", _taken(F.col("size"), F.col("h"))
    ).drop("source_id", "block", "draws")


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` of every row of ``docs``.

    ``size`` counts the words of the text (null: none), ``copies`` lists pass, shard and words of every copy. The words
    taken of a source are its target, rounded, but for what equal rows at the edge of the cut share unevenly.
    Null sources are one source, the last. Rows without words may be taken but add nothing. Repeated rows are
    taken each by itself, yet always alike. An empty table gives no rows. Further columns are not read.
    """
    sized = materialise(measure(docs), "mix-sizes")
    mixed = apply_mix(sized, plan_mix(sized, **settings))
    return mixed.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", "copies")


def mixed_texts(docs: DataFrame, **settings) -> DataFrame:
    """The columns of ``docs`` once for each copy that the mix takes, with ``__shard`` and ``__order``.

    Texts are whole: the document at a source's cut is taken or left, whichever is nearer to the target. A source
    is off its target by at most half the words of that document, and of the rows that repeat its id and text.
    """
    return _texts_of(docs, plan_mix(materialise(measure(docs), "mix-sizes"), **settings), settings.get("seed", 20))


def _texts_of(docs: DataFrame, mix: Mix, seed: int) -> DataFrame:
    held = docs.select(F.struct("*").alias("row"), "doc_id", "source", "text")
    rows = held.select(
        "row", "source", word_count(F.col("text")).alias("size"), _key(held, "doc_id", "text").alias("h")
    )
    copies = apply_mix(rows, mix).select("row", "size", "h", F.explode("copies").alias("copy"))
    order = F.xxhash64(F.lit(seed), "copy.pass", "copy.shard", "h")
    nearer = copies.filter(2 * F.col("copy.words") >= F.col("size"))
    return nearer.select("row.*", F.col("copy.shard").alias("__shard"), order.alias("__order"))


def shuffled_shards(docs: DataFrame, **settings) -> DataFrame:
    """:func:`mixed_texts` dealt out by shard, the rows of each shard in shuffled order.

    Shards have about equal words and each is a task of its own, so no task gets much more than another, whatever the
    sources' sizes. Columns named
    ``__shard`` and ``__order`` must not be among those of ``docs``; an empty table gives no rows.
    """
    clash = {"__shard", "__order"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {', '.join(sorted(clash))} are the mix's own")
    mix = plan_mix(materialise(measure(docs), "mix-sizes"), **settings)
    texts = _texts_of(docs, mix, settings.get("seed", 20))
    # By number: a hash deals several shards to one task and none to others.
    return texts.repartitionById(mix.shards, F.col("__shard").cast("int")).sortWithinPartitions("__shard", "__order")


def write_mix(docs: DataFrame, path: str, **settings) -> None:
    """Write :func:`shuffled_shards` in one folder per shard; nulls and repeated rows as there, no rows no folder."""
    shuffled_shards(docs, **settings).drop("__order").write.partitionBy("__shard").parquet(path)
