"""Ordered computations over few, very large groups.

A plain window would put each group into one task. Here a group is cut into segments along its
order, each computed on its own; what a segment needs from the ones before it (a total, a few last
rows, an offset) is a small frame with at most a few rows per segment. Segments are cut by a bucket
of the order where the caller names one, and by range partitions elsewhere; those are written once,
so that a row's place is fixed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerspark.functions.money import (
    as_double,
    cents,
    countable,
    exact_mean,
    exact_sum,
    exact_total,
    in_money,
    mean_in_cents,
)
from ledgerspark.operators.joins import hot_keys, key_counts, lookup_join, skew_join
from ledgerspark.scratch import materialise

SEGMENT = ("__bucket", "__part")
SEGMENT_ROWS = 5_000_000
MAX_RANGES = 1_000_000  # what one shuffle can deal to

# Fixed value: monotonically_increasing_id keeps the row's place in its partition in 33 bits.
PLACE_BITS = 33


def ordered_segments(
    df: DataFrame, keys: Sequence[str], tag: str, ranges: int | None = None
) -> DataFrame:
    """Rows sorted by ``keys`` over all partitions, with their partition and place, written once.

    ``keys`` should identify a row: rows equal in all of them stay in one partition.
    """
    dealt = df.repartitionByRange(*keys) if ranges is None else df.repartitionByRange(ranges, *keys)
    placed = dealt.sortWithinPartitions(*keys)
    row = F.monotonically_increasing_id()
    return materialise(
        placed.select(
            "*",
            F.shiftright(row, PLACE_BITS).alias("__segment"),
            row.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("__place"),
        ),
        tag,
    )


def sequential_ids(
    df: DataFrame,
    order_by: Sequence[str],
    out: str,
    prefix: str = "",
    start: int = 1001,
    width: int = 4,
) -> DataFrame:
    """Gap-free ids in the order of ``order_by``: ``prefix`` and the number, zero-padded.

    Numbers wider than ``width`` keep all their digits.
    """
    rows = ordered_segments(df, order_by, "ids")
    before = Window.orderBy("__segment").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so the unpartitioned window and the broadcast stay small.
    offsets = (
        rows.groupBy("__segment")
        .agg(F.count("*").alias("__size"))
        .select("__segment", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    )
    number = (F.col("__offset") + F.col("__place") + start).cast("string")
    padded = F.lpad(number, F.greatest(F.lit(width), F.length(number)), F.lit("0"))
    return rows.join(F.broadcast(offsets), "__segment").select(
        *df.columns, F.concat(F.lit(prefix), padded).alias(out)
    )


def day_of(timestamp: str) -> Column:
    """Bucket of a text timestamp, ``yyyy-MM-dd``."""
    return F.substring(timestamp, 1, 10)


def segmented(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    bucket: Column | None,
    rows_per_task: int,
) -> DataFrame:
    """Rows with the segment of their group they belong to (``SEGMENT``) and a place in it.

    ``bucket`` cuts the groups by value, which needs no preparation: the day of the leading
    timestamp, say. It must not fall along the order. Buckets with too many rows for one task, and
    all rows without a bucket, are cut by range-partitioning them.
    """
    keys = list(keys)
    order = [*keys, "__bucket", *order_by]
    if bucket is None:
        rows = df.agg(F.count("*")).first()[0]
        return _cut(df.withColumn("__bucket", F.lit(0)), order, rows, rows_per_task)
    bucketed = df.withColumn("__bucket", bucket)
    cut_by = [*keys, "__bucket"]
    counts = materialise(key_counts(bucketed, cut_by), "buckets")
    hot = hot_keys(counts, rows_per_task).select(*cut_by)
    full = counts.filter(F.col("__n") > rows_per_task).agg(F.sum("__n")).first()[0]
    if not full:
        return _uncut(bucketed)
    cold_rows = lookup_join(bucketed, hot, cut_by, "left_anti", null_safe=True)
    hot_rows = lookup_join(bucketed, hot, cut_by, "left_semi", null_safe=True)
    return _uncut(cold_rows).unionByName(_cut(hot_rows, order, full, rows_per_task))


def _uncut(df: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return df.withColumns({"__part": zero, "__place": zero})


def _cut(df: DataFrame, order: Sequence[str], rows: int, rows_per_task: int) -> DataFrame:
    """Twice as many ranges as full tasks, as their sampled bounds are uneven, or the usual number."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(MAX_RANGES, max(usual, -(-2 * rows // rows_per_task)))
    return ordered_segments(df, order, "segments", ranges).withColumnRenamed("__segment", "__part")


def cumulative_sum(
    df: DataFrame,
    value: str,
    group_by: Sequence[str],
    order_by: Sequence[str],
    out: str = "cumulative_sum",
    bucket: Column | None = None,
    rows_per_task: int = SEGMENT_ROWS,
) -> DataFrame:
    """Running total of an amount per group. For ``bucket`` see ``segmented``."""
    rows = segmented(df, group_by, order_by, bucket, rows_per_task)
    summed = running_total(rows, cents(value), group_by, order_by, out)
    return summed.select(*df.columns, as_double(in_money(F.col(out))).alias(out))


def running_total(
    rows: DataFrame, value: Column, group_by: Sequence[str], order_by: Sequence[str], out: str
) -> DataFrame:
    """Running total of a BIGINT ``value`` over ``segmented`` rows, as an exact decimal.

    Each segment is opened by a carry row with the group's total before it, kept apart from the
    running sum so that only it has to be a decimal.
    """
    keys = list(group_by)
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(*SEGMENT)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carries = (
        rows.groupBy(*keys, *SEGMENT)
        .agg(exact_total(value).alias("__total"))
        .select(
            *keys,
            *SEGMENT,
            F.lit(-1).cast("bigint").alias("__place"),
            F.sum("__total").over(earlier).alias("__carry"),
        )
    )
    opened = rows.withColumn("__amount", value).unionByName(carries, allowMissingColumns=True)
    running = (
        Window.partitionBy(*keys, *SEGMENT)
        .orderBy("__place", *order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = opened.withColumns(
        {
            "__carry": F.first("__carry").over(running).cast("decimal(36,0)"),
            "__within": F.sum("__amount").over(running).cast("decimal(19,0)"),
        }
    )
    both = F.coalesce("__carry", F.lit(0)) + F.coalesce("__within", F.lit(0))
    known = F.col("__carry").isNotNull() | F.col("__within").isNotNull()
    return summed.filter(F.col("__place") >= 0).withColumn(out, F.when(known, both))


def rolling_average_rows(
    df: DataFrame,
    value: str,
    group_by: Sequence[str],
    order_by: Sequence[str],
    rows: int = 7,
    out: str = "rolling_avg_amount_usd",
    bucket: Column | None = None,
    rows_per_task: int = SEGMENT_ROWS,
) -> DataFrame:
    """Mean of the current and the ``rows - 1`` rows before it in the group, to cents.

    Each segment is opened by copies of the group's last ``rows - 1`` rows before it. For
    ``bucket`` see ``segmented``.
    """
    keys, before = list(group_by), rows - 1
    opened = segmented(df, keys, order_by, bucket, rows_per_task).withColumn(
        "__amount", cents(value)
    )
    if before:
        halo = _last_rows_before(opened, keys, order_by, before)
        opened = opened.unionByName(halo, allowMissingColumns=True)
    frame = (
        Window.partitionBy(*keys, *SEGMENT)
        .orderBy("__place", *order_by)
        .rowsBetween(-before, Window.currentRow)
    )
    averaged = opened.withColumns(
        {"__sum": F.sum("__amount").over(frame), "__count": F.count("__amount").over(frame)}
    ).withColumn(out, mean_in_cents(F.col("__sum"), F.col("__count")))
    return averaged.filter(F.col("__place") >= 0).select(*df.columns, out)


def _last_rows_before(
    amounts: DataFrame, keys: list[str], order_by: Sequence[str], rows: int
) -> DataFrame:
    """For every segment of a group, the group's last ``rows`` amounts before it, at negative
    places.

    Only the last ``rows`` rows of each segment can be among them, so the lists are collected over
    those alone.
    """
    order = ["__place", *order_by]
    backwards = Window.partitionBy(*keys, *SEGMENT).orderBy(*[F.desc(c) for c in order])
    columns = list(dict.fromkeys([*keys, *SEGMENT, *order, "__amount"]))
    tails = (
        amounts.select(*columns)
        .withColumn("__back", F.row_number().over(backwards))
        .filter(F.col("__back") <= rows)
    )
    along = Window.partitionBy(*keys).orderBy(*SEGMENT, *order)
    # Wrapped, since a list leaves out nulls, and a null amount still takes its place.
    previous = F.collect_list(F.struct("__amount")).over(along.rowsBetween(-rows, -1))
    segment = F.struct(*SEGMENT)
    opening = (
        tails.withColumn("__halo", previous)
        .withColumn("__continues", F.lag(segment).over(along).eqNullSafe(segment))
        .filter(~F.col("__continues"))
    )
    return opening.select(
        *keys, *SEGMENT, F.size("__halo").alias("__size"), F.posexplode("__halo")
    ).select(
        *keys,
        *SEGMENT,
        (F.col("pos") - F.col("__size")).cast("bigint").alias("__place"),
        F.col("col.__amount").alias("__amount"),
    )


def rolling_average_days(
    df: DataFrame,
    value: str,
    group_by: Sequence[str],
    timestamp: str = "timestamp",
    days: int = 7,
    out: str = "rolling_avg_amount_usd",
) -> DataFrame:
    """Mean over the current and the ``days - 1`` calendar days before it, per group and day.

    All rows of a day share the value, so the result has one row per group and day, and the window
    runs over daily sums.
    """
    keys = list(group_by)
    daily = (
        df.withColumn("date", F.to_date(F.col(timestamp).try_cast("timestamp")))
        .groupBy(*keys, "date")
        .agg(exact_sum(value).alias("__sum"), F.count(countable(value)).alias("__count"))
    )
    span = Window.partitionBy(*keys).orderBy(F.unix_date("date")).rangeBetween(-(days - 1), 0)
    mean = exact_mean(F.sum("__sum").over(span), F.sum("__count").over(span))
    return daily.select(*keys, "date", as_double(mean, 2).alias(out))


def with_last_transaction(
    df: DataFrame, key: str = "customer_id", timestamp: str = "timestamp"
) -> DataFrame:
    """Every row with the last ``timestamp`` of its key, null being a key too.

    The figures per key are written, since the join reads them three times: for hot keys, for salts and to join.
    """
    stats = df.groupBy(key).agg(
        F.max(timestamp).alias("last_transaction_date"), F.count("*").alias("__n")
    )
    stats = materialise(stats, "last-of-key")
    return skew_join(
        df,
        stats.select(key, "last_transaction_date"),
        [key],
        "left",
        counts=stats.select(key, "__n"),
        null_safe=True,
    )
