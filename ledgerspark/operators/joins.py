"""Joins that hold when one key carries a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerspark.scratch import materialise

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
ROWS_PER_TASK = 1_000_000
KEYLESS_SALTS = 10_000
SLOTS = 1 << 16

# How much of a join's left side may be spread over salts without changing the result.
SPREADABLE = {"inner", "left", "left_outer", "left_semi", "left_anti"}


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _equal(on: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"l.{c}"), F.col(f"r.{c}")) for c in on]
    return _all([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _width(field: T.StructField) -> Column:
    """Bytes of a value, at least; nested values by eight times their text, an upper bound."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(column)
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(column))) * 8
    else:
        size = F.lit(0)
    return F.coalesce(size, F.lit(0)).cast("bigint") + 16


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``df`` against both limits: every column counts, one row per partition moves."""
    width = reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields])
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join a dimension: broadcast when it measures small, spread by key otherwise.

    ``how`` is one of ``SPREADABLE``, whatever the dimension's size. ``counts`` is for ``skew_join``.

    On a stream the micro-batch bounds the work, so beyond the limits a plain join is left to the
    engine.
    """
    if how not in SPREADABLE:
        raise ValueError(f"a lookup cannot be a {how} join")
    on = list(on)
    small = fits_broadcast(lookup, max_rows, max_bytes)
    if not small and not df.isStreaming:
        return skew_join(df, lookup, on, how, counts=counts, null_safe=null_safe)
    right = F.broadcast(lookup) if small else lookup
    joined = df.alias("l").join(right.alias("r"), _equal(on, null_safe), how)
    return joined.select(*_output(df, lookup, on, how))


def _output(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> list[Column]:
    mine = [F.col(f"l.{c}") for c in left.columns]
    if how in ("left_semi", "left_anti"):
        return mine
    return [*mine, *[F.col(f"r.{c}") for c in right.columns if c not in on]]


def key_counts(df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.groupBy(*on).agg(F.count("*").alias("__n"))


def hot_keys(counts: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every key with too many rows for one task, and the number of salts it is spread over."""
    salts = F.ceil(F.col("__n") / rows_per_task).cast("int")
    return counts.filter(F.col("__n") > rows_per_task).select(
        *[c for c in counts.columns if c != "__n"], salts.alias("__salts")
    )


def _with_salts(
    df: DataFrame, hot: DataFrame, on: Sequence[str], null_safe: bool, spread: Column | None
) -> DataFrame:
    """``df`` with the salts of its key, null for a key that is not hot.

    A list of hot keys that measures small is broadcast. A longer one is joined on the key and a
    hash, repeated for every value of the hash, so that no key's rows meet in one task; ``spread`` is that
    hash, or None where a key has few rows.
    """
    if fits_broadcast(hot):
        tagged = df.alias("l").join(F.broadcast(hot).alias("r"), _equal(on, null_safe), "left")
    elif spread is None:
        tagged = df.alias("l").join(hot.alias("r"), _equal(on, null_safe), "left")
    else:
        ways = hot.agg(F.max("__salts")).scalar()
        dealt = df.withColumn("__way", F.pmod(spread, ways).cast("int"))
        every = hot.withColumn("__way", F.explode(F.sequence(F.lit(0), F.lit(ways) - 1)))
        same = _equal(on, null_safe) & (F.col("l.__way") == F.col("r.__way"))
        tagged = dealt.alias("l").join(every.alias("r"), same, "left")
    return tagged.select(*[F.col(f"l.{c}") for c in df.columns], "r.__salts")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
    null_safe: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Shuffle join in which only the hot keys of ``left`` are salted.

    Hot rows go to ``__salts`` tasks by a hash of ``spread_by`` (default: the whole row) and the
    matching right rows are repeated once per salt; all other keys join as usual. ``counts`` takes
    per-key row counts (``__n``) the caller has already; ``left`` should be a written table, since
    it is read once more to count keys otherwise. Rows with a null key cannot match, and are
    spread too; with ``null_safe`` null is a key like any other.
    """
    if how not in SPREADABLE:
        raise ValueError(f"{how} join cannot be salted on its left side")
    on = list(on)
    hot = hot_keys(key_counts(left, on) if counts is None else counts, rows_per_task)
    hot = hot.select(*on, "__salts")
    spread = F.xxhash64(*(spread_by or left.columns))

    salt = F.when(F.col("__salts").isNotNull(), F.pmod(spread, F.col("__salts")))
    if not null_safe:
        keyless = ~_all([F.col(c).isNotNull() for c in on])
        salt = F.when(keyless, F.pmod(spread, F.lit(KEYLESS_SALTS))).otherwise(salt)
    salted = _with_salts(left, hot, on, null_safe, spread).withColumn("__salt", F.coalesce(salt, F.lit(0)).cast("int"))
    copies = F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)
    repeated = _with_salts(right, hot, on, null_safe, None).withColumn("__salt", F.explode(copies))

    a = salted.drop("__salts").alias("l")
    b = repeated.drop("__salts").alias("r")
    joined = a.join(b, _equal(on, null_safe) & (F.col("l.__salt") == F.col("r.__salt")), how)
    return joined.select(*_output(left, right, on, how))


def join_customer_branch_transaction(
    customers: DataFrame, branches: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Transactions of known customers at known branches; transaction columns only.

    Inner joins: a customer or branch listed twice repeats its transactions. Hot customers are told
    from the transactions themselves, so the first join is not run again to count its keys.
    """
    at_branch = lookup_join(transactions, branches.select("branch_id"), ["branch_id"], "inner")
    known = customers.select("customer_id")
    counts = key_counts(transactions, ["customer_id"])
    return lookup_join(at_branch, known, ["customer_id"], "inner", counts=counts)


def transaction_with_location(transactions: DataFrame, branches: DataFrame) -> DataFrame:
    places = branches.select("branch_id", "location", "timezone")
    return lookup_join(transactions, places, ["branch_id"], "left")


def full_outer(frames: Sequence[DataFrame], on: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Chain of full outer joins; a null key matches nothing, so its rows stay apart.

    Keys with more than ``rows_per_task`` rows on either side are joined apart from the rest, their rows spread over tasks.
    Beside the keys the frames' columns must differ.
    """
    on = list(on)
    return reduce(lambda a, b: _full_outer(a, b, on, rows_per_task), frames)


def _full_keys(df: DataFrame, on: list[str], rows_per_task: int) -> DataFrame:
    """Counts of the keys with more than ``rows_per_task`` rows.

    Rows are counted by a hash of the key first, which moves little. Only keys whose hash has that many rows are counted
    themselves.
    """
    slotted = df.select(*on, F.pmod(F.xxhash64(*on), F.lit(SLOTS)).alias("__slot"))
    full = materialise(key_counts(slotted, ["__slot"]).filter(F.col("__n") > rows_per_task), "full-slots")
    within = slotted.join(F.broadcast(full.select("__slot")), "__slot", "left_semi")
    return key_counts(within, on).filter(F.col("__n") > rows_per_task)


def _full_outer(left: DataFrame, right: DataFrame, on: list[str], rows_per_task: int) -> DataFrame:
    # Written, since both are read to count and to join, and a left side is a join itself.
    left, right = materialise(left, "outer-left"), materialise(right, "outer-right")
    counts = _full_keys(left, on, rows_per_task).withColumn("__left", F.lit(True)).unionAll(
        _full_keys(right, on, rows_per_task).withColumn("__left", F.lit(False))
    )
    known = _all([F.col(c).isNotNull() for c in on])
    # Null keys too tell that a plain join would put many rows into one task.
    hot = materialise(counts, "hot-keys")
    if hot.isEmpty():
        return left.join(right, on, "full_outer")
    # The side with more of a key's rows is spread, the other one repeated.
    sides = hot.filter(known).groupBy(*on).agg(F.max(F.struct("__n", "__left"))["__left"].alias("__left"))
    by_left, by_right = (sides.filter(F.col("__left") == side).select(*on) for side in (True, False))
    mine, theirs = left.filter(known), right.filter(known)
    parts = [left.filter(~known), right.filter(~known)]
    parts += _spread_outer(mine, theirs, by_left, on, rows_per_task)
    parts += _spread_outer(theirs, mine, by_right, on, rows_per_task)
    cold = [lookup_join(side, sides.select(*on), on, "left_anti") for side in (mine, theirs)]
    plain = cold[0].join(cold[1], on, "full_outer")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, plain)


def _spread_outer(
    more: DataFrame, fewer: DataFrame, keys: DataFrame, on: list[str], rows_per_task: int
) -> list[DataFrame]:
    """The full outer join over ``keys`` in two parts: all rows of ``more``, and what of ``fewer`` matches none."""
    more, fewer = (lookup_join(side, keys, on, "left_semi") for side in (more, fewer))
    return [
        skew_join(more, fewer, on, "left", rows_per_task=rows_per_task),
        skew_join(fewer, more.select(*on).distinct(), on, "left_anti", rows_per_task=rows_per_task),
    ]
