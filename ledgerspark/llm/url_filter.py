"""URL rules: a blocked Bloom filter passes possible hits to an exact hash join.

A rule is a host, a path prefix and a verdict. It fits its host and all subdomains, if the path
starts with the rule's path; the longest fitting rule wins. For every url the keys a rule could have
are listed (host suffixes of as many labels and path prefixes of the lengths that occur among the rules),
tested against the filter inside the task, and only possible hits meet the rules themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.operators.joins import lookup_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_RULE = 16
MAX_FILTER_BYTES = 64 << 20
BLOCK_WORDS = 8
PROBES = 7


def url_host(url: str) -> Column:
    rest = F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.when(F.instr(url, "://") > 0, host).otherwise("")


def url_path(url: str) -> Column:
    rest = F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, path).otherwise("")


def _hashes(host: Column, path: Column) -> tuple[Column, Column]:
    """The hash that picks a block, and the one whose bits are set in it."""
    return F.xxhash64(host, path), F.xxhash64(F.lit("bits"), host, path)


def build_filter(rules: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> np.ndarray:
    """The filter as an array of (blocks, 8) words of 64 bits.

    It has ``BITS_PER_RULE`` bits a rule and at most ``max_bytes`` bytes. Beyond that it fills up and
    passes more false hits to the join, which removes them: the result stays the same.
    """
    rows = rules.agg(F.count("*")).first()[0]
    blocks = max(1, min(max_bytes // (8 * BLOCK_WORDS), -(-rows * BITS_PER_RULE // (64 * BLOCK_WORDS))))
    block, bits = _hashes(F.col("host"), F.col("path"))
    probes = F.explode(F.array(*[F.shiftright("bits", 9 * i).bitwiseAND(F.lit(511)) for i in range(PROBES)]))
    words = (
        rules.select(F.pmod(block, F.lit(blocks)).alias("block"), bits.alias("bits"))
        .select("block", probes.alias("bit"))
        .groupBy((F.col("block") * BLOCK_WORDS + F.floor(F.col("bit") / 64)).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("mask"))
    )
    filled = np.zeros(blocks * BLOCK_WORDS, dtype=np.int64)
    found = words.toArrow()  # two numbers for a word, not rows
    filled[found["word"].to_numpy()] = found["mask"].to_numpy()
    return filled.view(np.uint64).reshape(blocks, BLOCK_WORDS)


def probe_filter(filled: np.ndarray, block: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which keys may be listed; keys that are listed always may."""
    rows = np.mod(block, filled.shape[0])
    found = np.ones(len(rows), dtype=bool)
    for i in range(PROBES):
        bit = ((bits >> (9 * i)) & 511).astype(np.uint64)
        word = filled[rows, (bit >> np.uint64(6)).astype(np.int64)]
        found &= (word >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return found


def _probe_udf(spark, filled: np.ndarray):
    shared = spark.sparkContext.broadcast(filled)

    @F.pandas_udf("array<boolean>")
    def possible(block: pd.Series, bits: pd.Series) -> pd.Series:
        lengths = [len(x) for x in block]
        if not sum(lengths):
            return pd.Series([[] for _ in lengths])
        found = probe_filter(shared.value, np.concatenate(block.to_numpy()), np.concatenate(bits.to_numpy()))
        return pd.Series(np.split(found, np.cumsum(lengths)[:-1]))

    return possible


def _candidate_keys(rules: DataFrame) -> Column:
    """All keys a rule for ``host`` and ``path`` could have, as an array of structs."""
    shapes = rules.agg(
        F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(0)),
        F.sort_array(F.collect_set(F.length("path"))),
    ).first()
    labels, lengths = shapes[0], shapes[1]
    parts = F.slice(F.reverse(F.split("host", r"\.")), 1, max(1, labels))
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.array_join(F.reverse(F.slice(parts, F.lit(1), n)), "."),
    )
    fitting = F.filter(F.lit(lengths).cast("array<int>"), lambda n: n <= F.length("path"))
    prefixes = F.transform(fitting, lambda n: F.substring(F.col("path"), F.lit(1), n))
    return F.flatten(
        F.transform(
            suffixes,
            lambda h: F.transform(prefixes, lambda p: F.struct(h.alias("host"), p.alias("path"))),
        )
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``id, host, path, rule, verdict`` of every row.

    ``rules`` has ``host, path, verdict``; rows with a null are not rules, of equal rules with two verdicts
    the greater one (``block``) counts, of rules of equal length the greater text. ``rule`` is null and the
    verdict ``default`` where none fits. A null url or one without ``://`` has an empty host and path. Null
    ids and repeated rows are rows like any other; further columns are not read.
    """
    rules = rules.select("host", "path", "verdict").dropna().groupBy("host", "path").agg(
        F.max("verdict").alias("verdict")
    )
    filled = build_filter(rules)
    possible = _probe_udf(pages.sparkSession, filled)
    seen = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(url_host(url_col), F.lit("")).alias("url_host"),
        F.coalesce(url_path(url_col), F.lit("")).alias("url_path"),
    )
    keyed = seen.withColumns({"host": F.col("url_host"), "path": F.col("url_path")}).withColumn(
        "keys", _candidate_keys(rules)
    )
    tested = keyed.withColumn(
        "flags",
        possible(
            F.transform("keys", lambda k: _hashes(k.host, k.path)[0]),
            F.transform("keys", lambda k: _hashes(k.host, k.path)[1]),
        ),
    )
    hits = F.filter(F.arrays_zip("keys", "flags"), lambda x: x.flags)
    hits = tested.select("row", "id", "url_host", "url_path", F.explode_outer(hits).alias("hit")).select(
        "row", "id", "url_host", "url_path", F.col("hit.keys.host").alias("host"), F.col("hit.keys.path").alias("path")
    )
    found = lookup_join(hits, rules, ["host", "path"], "left")
    text = F.concat("host", "path")
    best = F.max(
        F.when(F.col("verdict").isNotNull(), F.struct(F.length(text).alias("n"), text.alias("rule"), F.col("verdict").alias("verdict")))
    ).alias("best")
    return found.groupBy("row", "id", "url_host", "url_path").agg(best).select(
        F.col("id").alias(id_col),
        F.col("url_host").alias("host"),
        F.col("url_path").alias("path"),
        "best.rule",
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
