"""Near-duplicates by an inverted join of MinHash signature coordinates.

1. Every text becomes its set of word shingles, a digest of the set and a signature. Texts with one set
   are one class from here on, so exact copies cost one row each.
2. Classes are posted under their coordinate-value pairs. Two classes that match in ``least`` of
   ``size`` coordinates share one of the rarest ``size - least + 1`` pairs of either, so only this prefix is
   posted; long lists come last in that order and are mostly skipped.
3. In every posting list one hub, the class with the most shared pairs, meets the other members. Their
   links are confirmed on the full sets and joined to components. A list within one component is done.
4. What is left of the lists is merged into clusters where one list holds most of another, and dealt
   into tiles; every pair of tiles meets in one task, which counts matching coordinates of members of different
   components and confirms those with ``least`` matches or more on their full sets.

A task holds two tiles of bounded size; only confirmed links leave it. Nothing is capped or dropped:
a link is missed only if fewer than ``least`` coordinates match, which for a similarity of 0.75 or more has a
probability below 3e-5 by default.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ledgerspark.llm.shingles import digest, shingle_set, signature
from ledgerspark.llm.tiles import small_batches
from ledgerspark.operators.joins import lookup_join
from ledgerspark.scratch import materialise

SIZE, LEAST = 64, 33
PERCENT = 75
TILE_ROWS, TILE_SHINGLES = 256, 1 << 20


def linked(common: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * common >= PERCENT * (n + m - common)


def _sketches(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``id, n, digest, signature``; without words the last two are null."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "n": [len(s) for s in sets],
                    "digest": [digest(s) if len(s) else None for s in sets],
                    "signature": [signature(s, size) if len(s) else None for s in sets],
                }
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return rows.mapInPandas(run, "id bigint, n bigint, digest binary, signature array<int>")


def _postings(classes: DataFrame, size: int, least: int) -> DataFrame:
    """``token, digest, shared``: the prefix of every class, lists of one member left out."""
    tokens = classes.select("digest", F.posexplode("signature").alias("place", "value")).select(
        "digest",
        (F.shiftleft(F.col("place").cast("bigint"), 32) + F.col("value").cast("bigint")).alias("token"),
    )
    counts = tokens.groupBy("token").agg(F.count("*").alias("holders")).filter("holders > 1")
    own = Window.partitionBy("digest")
    prefix = (
        tokens.join(counts, "token")
        .withColumn("shared", F.count("*").over(own))
        .withColumn("at", F.row_number().over(own.orderBy("holders", "token")))
        .filter(F.col("at") <= F.col("shared") - (least - 1))
    )
    return prefix.select("token", "digest", "shared")


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``digest, n, signature, shingles`` (packed) of the texts of the ids in ``wanted``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                s = shingle_set(text)
                row = (digest(s), len(s), signature(s, size).tobytes(), s.tobytes())
                yield pd.DataFrame([row], columns=["digest", "n", "signature", "shingles"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).filter(
        "id is not null and text is not null"
    )
    chosen = lookup_join(rows, wanted, ["id"], "left_semi")
    return chosen.mapInPandas(run, "digest binary, n bigint, signature binary, shingles binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, least: int, tag: str) -> DataFrame:
    """The pairs ``a, b`` with enough matching coordinates that are linked by their full sets."""
    a = sets.select(*[F.col(c).alias(f"a_{c}") for c in sets.columns])
    b = sets.select(*[F.col(c).alias(f"b_{c}") for c in sets.columns])
    sized = pairs.join(a, F.col("a") == F.col("a_digest")).join(b, F.col("b") == F.col("b_digest"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for r in batch.itertuples(index=False):
                match = np.frombuffer(r.a_signature, np.int32) == np.frombuffer(r.b_signature, np.int32)
                ok = match.sum() >= least
                if ok:
                    one, two = np.frombuffer(r.a_shingles, np.uint64), np.frombuffer(r.b_shingles, np.uint64)
                    ok = linked(len(np.intersect1d(one, two, assume_unique=True)), len(one), len(two))
                keep.append(bool(ok))
            yield batch.loc[keep, ["a", "b"]]

    with small_batches(pairs.sparkSession, 256):
        return materialise(
            sized.drop("a_digest", "b_digest", "a_n", "b_n").mapInPandas(run, "a binary, b binary"), tag
        )


def components(links: DataFrame, tag: str) -> DataFrame:
    """``digest, component`` of every linked class: the least digest it reaches.

    Each round takes the least label of the neighbours, then the label of that label, and is written; rounds end
    when no label changes.
    """
    both = materialise(
        links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{tag}-edges",
    )
    labels = materialise(
        both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("digest"), F.least("a", "least").alias("component")
        ),
        f"{tag}-labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("digest").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("digest")).agg(F.min("component").alias("near"))
        )
        step = labels.join(near, "digest").select(
            "digest", F.least("component", "near").alias("next"), F.col("component").alias("before")
        )
        step = materialise(step, f"{tag}-step")
        jumped = step.join(
            step.select(F.col("digest").alias("next"), F.col("next").alias("component")), "next"
        )
        moved = materialise(jumped.select("digest", "component", "before"), f"{tag}-labels")
        labels = moved.select("digest", "component")
        if moved.filter("component != before").isEmpty():
            return labels


def _clusters(lists: DataFrame) -> DataFrame:
    """``cluster, digest, component``: lists merged into the longest one that has most of their members."""
    sizes = lists.groupBy("token").agg(F.count("*").alias("members"))
    lists = materialise(lists.join(sizes, "token"), "dedup-lists")
    longest = lists.groupBy("digest").agg(F.max(F.struct("members", "token")).alias("longest"))
    shares = lists.join(longest, "digest").groupBy("token", "members", "longest").agg(F.count("*").alias("n"))
    best = shares.groupBy("token", "members").agg(F.max(F.struct("n", "longest")).alias("best"))
    into = best.select(
        "token",
        F.when(2 * F.col("best.n") > F.col("members"), F.col("best.longest.token"))
        .otherwise(F.col("token")).alias("cluster"),
    )
    return lists.join(into, "token").select("cluster", "digest", "component").distinct()


def _tile_links(frame: pd.DataFrame, least: int) -> pd.DataFrame:
    """Confirmed links between the members of two tiles, or within one, of different components."""
    frame = frame.reset_index(drop=True)
    signatures = np.array([np.frombuffer(s, np.int32) for s in frame["signature"]])
    labels = pd.factorize(frame["component"])[0]
    sizes = frame["n"].to_numpy()
    sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    local = np.split(flat, np.cumsum(sizes)[:-1])
    sides = frame["tile"].to_numpy()
    first, last = sides.min(), sides.max()
    marked = np.zeros(len(flat), dtype=bool)
    digests, found = frame["digest"].to_numpy(), []
    for i in np.flatnonzero(sides == first):
        others = np.arange(i + 1, len(frame)) if first == last else np.flatnonzero(sides == last)
        others = others[labels[others] != labels[i]]
        low, high = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[100 * low >= PERCENT * high]
        others = others[(signatures[others] == signatures[i]).sum(axis=1) >= least]
        if not len(others):
            continue
        marked[local[i]] = True
        common = np.array([marked[local[j]].sum() for j in others])
        marked[local[i]] = False
        found += [(digests[i], digests[j]) for j in others[linked(common, sizes[i], sizes[others])]]
    return pd.DataFrame(found, columns=["a", "b"])


def _tiled_links(clusters: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    members = clusters.join(sets, "digest")
    weights = members.groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    tiles = F.ceil(F.greatest(F.col("rows") / TILE_ROWS, F.col("shingles") / TILE_SHINGLES)).cast("int")
    members = members.join(weights.select("cluster", tiles.alias("tiles")), "cluster").withColumn(
        "tile", F.pmod(F.xxhash64("digest"), F.col("tiles")).cast("int")
    )
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    dealt = members.select("*", every).select(
        "cluster", "digest", "component", "n", "signature", "shingles", "tile",
        F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
    )
    return materialise(
        dealt.groupBy("cluster", "i", "j").applyInPandas(
            lambda frame: _tile_links(frame, least), "a binary, b binary"
        ),
        "dedup-tile-links",
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, least: int = LEAST
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every row.

    Texts are linked at a Jaccard similarity of 0.75 or more of their sets of five-word shingles; ``component_id`` is the
    least id that is reached by links, ``kept`` says that it is the row's own. Texts without words,
    and null texts, are linked to nothing. Rows with a null id are linked to equal sets only and kept where no id
    is reached. Rows that repeat an id stay or go together. An empty table gives no rows; further columns are not read.
    """
    sketches = materialise(_sketches(docs, id_col, text_col, size), "dedup-sketches")
    classes = materialise(
        sketches.filter("digest is not null").groupBy("digest").agg(
            F.min("id").alias("first_id"), F.count("*").alias("members"), F.first("signature").alias("signature")
        ),
        "dedup-classes",
    )
    postings = materialise(
        _postings(classes.filter("first_id is not null"), size, least), "dedup-postings"
    )
    central = F.struct(-F.col("shared"), F.xxhash64("digest"), F.col("digest"))
    lists = postings.groupBy("token").agg(F.count("*").alias("members"), F.min(central).alias("hub")).filter(
        "members > 1"
    )
    posted = materialise(
        postings.select("token", "digest").join(lists.select("token", F.col("hub.digest").alias("hub")), "token"),
        "dedup-posted",
    )
    wanted = posted.select("digest").distinct().join(classes, "digest").select(F.col("first_id").alias("id"))
    sets = materialise(_sets(docs, wanted.distinct(), id_col, text_col, size), "dedup-sets")
    hubs = posted.filter("digest != hub").select(F.col("hub").alias("a"), F.col("digest").alias("b")).distinct()
    links = _confirmed(hubs, sets, least, "dedup-hub-links")
    labels = components(links, "dedup-hubs")
    left = posted.filter("digest != hub").select("token", "digest").join(labels, "digest", "left").select(
        "token", "digest", F.coalesce("component", "digest").alias("component")
    )
    open_ = left.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    left = left.join(open_.filter("low != high").select("token"), "token", "left_semi")
    more = _tiled_links(_clusters(left), sets, least)
    if not more.isEmpty():
        labels = components(links.unionAll(more), "dedup-all")
    firsts = labels.join(classes.select("digest", "first_id"), "digest")
    reached = firsts.groupBy("component").agg(F.min("first_id").alias("component_id"))
    reached = labels.join(reached, "component").select("digest", "component_id")
    shared = classes.join(reached, "digest", "left").filter("members > 1 or component_id is not null").select(
        "digest", F.coalesce("component_id", "first_id").alias("component_id")
    )
    rows = sketches.select("id", "n", "digest").join(shared, "digest", "left")
    component = F.coalesce("component_id", "id")
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )


def keep_first(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, with their columns, that are the first of their component: one row of each.

    Rows are told apart by a key that is written with them, so ids may be null, repeat or collide. The first row has the
    least id, null last. Rows without words all stay.
    """
    keyed = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "dedup-rows")
    found = near_duplicates(keyed, id_col="__row", **settings).select("__row", "component_id")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row").alias("row"))
    firsts = (
        found.join(keyed.select("__row", "doc_id"), "__row")
        .groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.row").alias("__row"))
    )
    return lookup_join(keyed, materialise(firsts, "dedup-firsts"), ["__row"], "left_semi").select(*docs.columns)
