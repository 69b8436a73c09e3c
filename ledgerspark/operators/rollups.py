"""Grouped measures. Every group-by combines on the map side, so hot keys shuffle as partials."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.functions.money import (
    as_double,
    countable,
    exact_mean,
    exact_sum,
    exact_sum_unrounded,
)
from ledgerspark.operators.joins import lookup_join
from ledgerspark.operators.windows import SEGMENT_ROWS, running_total, segmented
from ledgerspark.scratch import materialise

AMOUNT = "Amount_USD"


PARTIALS = ("__sum", "__min", "__max", "__count")

# Key sets few enough in values to combine well on the map side; the published rollups follow from
# them. One set of all keys would hardly combine at all.
SUMMARIES = (
    ("currency", "channel", "transaction_type", "status"),
    ("year", "month", "date", "hour"),
    ("branch_id",),
)


def partials(df: DataFrame, keys: Sequence[str], measure: str = AMOUNT) -> DataFrame:
    """Measures per key in a form that ``coarser`` can group further."""
    return df.groupBy(*keys).agg(
        exact_sum(measure).alias("__sum"),
        F.min(countable(measure)).alias("__min"),
        F.max(countable(measure)).alias("__max"),
        F.count(countable(measure)).alias("__count"),
    )


def coarser(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partials by fewer keys out of partials by more; equal, since the sums are exact."""
    merge = {"__sum": F.sum, "__min": F.min, "__max": F.max, "__count": F.sum}
    return parts.groupBy(*keys).agg(*[fn(c).alias(c) for c, fn in merge.items()])


def measures(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    total, low, high, count = [F.col(c) for c in PARTIALS]
    return parts.select(
        *keys,
        as_double(total, 2).alias("total_amount"),
        as_double(exact_mean(total, count), 2).alias("average_amount"),
        low.alias("min_amount"),
        high.alias("max_amount"),
        count.alias("transaction_count"),
    )


def rollup(df: DataFrame, keys: Sequence[str], measure: str = AMOUNT) -> DataFrame:
    """Total, mean (both to cents), minimum, maximum and count of ``measure`` per key."""
    return measures(partials(df, keys, measure), keys)


def rollup_by_attribute(
    df: DataFrame, dimension: DataFrame, on: str, attribute: str, measure: str = AMOUNT
) -> DataFrame:
    """``rollup`` by an attribute of a dimension, left-joined.

    Facts are combined per dimension key before the join, so it moves one row per key, however the
    rows are spread over the keys.
    """
    return measures_by_attribute(partials(df, [on], measure), dimension, on, attribute)


def measures_by_attribute(
    parts: DataFrame, dimension: DataFrame, on: str, attribute: str
) -> DataFrame:
    joined = parts.join(dimension.select(on, attribute), on, "left")
    return measures(coarser(joined, [attribute]), [attribute])


def summary_partials(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partials by one of ``SUMMARIES``."""
    moment = F.col("timestamp")
    parts_of_time = {"date": moment.try_cast("date"), "hour": F.hour(moment.try_cast("timestamp"))}
    return partials(df.withColumns(parts_of_time), keys)


def rollup_by_date(df: DataFrame, measure: str = AMOUNT) -> DataFrame:
    return rollup(df.withColumn("date", F.col("timestamp").try_cast("date")), ["date"], measure)


def currency_analysis(df: DataFrame) -> DataFrame:
    """Unrounded total and mean per currency."""
    parts = df.groupBy("currency").agg(
        exact_sum_unrounded(AMOUNT).cast("double").alias("total_amount_by_currency"),
        F.count(countable(AMOUNT)).alias("__count"),
    )
    mean = F.try_divide(F.col("total_amount_by_currency"), F.col("__count"))
    return parts.withColumn("avg_amount_by_currency", mean).drop("__count")


def customer_partials(df: DataFrame) -> DataFrame:
    """One pass over the transactions from which all figures per customer follow."""
    return df.groupBy("customer_id").agg(
        exact_sum(AMOUNT).alias("__sum"),
        F.min(countable(AMOUNT)).alias("__min"),
        F.max(countable(AMOUNT)).alias("__max"),
        F.count(countable(AMOUNT)).alias("__count"),
        exact_sum_unrounded("amount").alias("__spend"),
        F.count(countable("amount")).alias("__spends"),
        F.max("timestamp").alias("last_transaction_date"),
    )


def customer_type_totals(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Customers with transactions, mean amount and spend per customer type.

    Transactions are summed per customer first; the join then meets one row per customer.
    """
    return type_totals_of(customers, customer_partials(transactions))


def type_totals_of(customers: DataFrame, parts: DataFrame) -> DataFrame:
    spend = parts.select("customer_id", "__spend", "__spends")
    joined = customers.select("customer_id", "customer_type").join(spend, "customer_id")
    totals = joined.groupBy("customer_type").agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.sum("__spend").cast("double").alias("total_spend"),
        F.sum("__spends").alias("__count"),
    )
    mean = F.try_divide(F.col("total_spend"), F.col("__count"))
    return totals.select(
        "customer_type", "total_customers", mean.alias("avg_transaction_amount"), "total_spend"
    )


def last_transactions(transactions: DataFrame) -> DataFrame:
    """Last transaction per customer next to the last one of all."""
    return last_of(
        transactions.groupBy("customer_id").agg(F.max("timestamp").alias("last_transaction_date"))
    )


def last_of(parts: DataFrame) -> DataFrame:
    last = parts.select("customer_id", "last_transaction_date")
    return last.withColumn("current_date", last.agg(F.max("last_transaction_date")).scalar())


def churn_status(transactions: DataFrame, churn_days: int = 180) -> DataFrame:
    return churn_of(last_transactions(transactions), churn_days)


def churn_of(last: DataFrame, churn_days: int = 180) -> DataFrame:
    days = F.datediff(
        F.col("current_date").try_cast("timestamp"),
        F.col("last_transaction_date").try_cast("timestamp"),
    )
    status = F.when(F.col("days_since_last_transaction") > churn_days, "Churned").otherwise("Active")
    return last.withColumn("days_since_last_transaction", days).withColumn("churn_status", status)


def active_churned(transactions: DataFrame, churn_days: int = 180) -> DataFrame:
    """One row: customers whose last transaction is within / beyond ``churn_days`` of the last."""
    known = churn_status(transactions, churn_days).filter(
        F.col("days_since_last_transaction").isNotNull()
    )
    churned = (F.col("churn_status") == "Churned").cast("bigint")
    return known.agg(
        F.coalesce(F.sum(1 - churned), F.lit(0)).alias("active_customers"),
        F.coalesce(F.sum(churned), F.lit(0)).alias("churned_customers"),
    )


def aggregate_customers(
    customers: DataFrame, transactions: DataFrame, churn_days: int = 180
) -> tuple[DataFrame, DataFrame]:
    """Totals by customer type, and the one-row active / churned counts."""
    return customer_type_totals(customers, transactions), active_churned(transactions, churn_days)


def monthly_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("year", "month", "customer_id").agg(
        F.count("transaction_id").alias("monthly_count")
    )


def value_tiers(df: DataFrame, low: float = 1000, medium: float = 5000) -> DataFrame:
    """Customers by total spend; both edges are inclusive, no total counts as High."""
    return tiers_of(partials(df, ["customer_id"]), low, medium)


def tiers_of(parts: DataFrame, low: float = 1000, medium: float = 5000) -> DataFrame:
    total = F.col("total_amount_usd")
    segment = F.when(total <= low, "Low Value").when(total <= medium, "Medium Value")
    totals = parts.select("customer_id", as_double(F.col("__sum"), 2).alias("total_amount_usd"))
    return totals.withColumn("segment", segment.otherwise("High Value"))


def peak_off_peak(df: DataFrame, first_hour: int = 8, last_hour: int = 18) -> DataFrame:
    """Totals in and outside the peak hours, both inclusive (18 covers 18:59)."""
    hour = F.hour(F.col("timestamp").try_cast("timestamp"))
    period = _period(hour, first_hour, last_hour)
    return _period_measures(partials(df.withColumn("time_period", period), ["time_period"]))


def peak_of(parts: DataFrame, first_hour: int = 8, last_hour: int = 18) -> DataFrame:
    """``peak_off_peak`` from partials by hour and any other keys."""
    period = _period(F.col("hour"), first_hour, last_hour)
    return _period_measures(coarser(parts.withColumn("time_period", period), ["time_period"]))


def _period(hour: Column, first_hour: int, last_hour: int) -> Column:
    return F.when(hour.between(first_hour, last_hour), "Peak").otherwise("Off-Peak")


def _period_measures(parts: DataFrame) -> DataFrame:
    return parts.select(
        "time_period",
        as_double(F.col("__sum"), 2).alias("total_amount_usd"),
        as_double(exact_mean(F.col("__sum"), F.col("__count")), 2).alias("average_amount_usd"),
        F.col("__count").alias("transaction_count"),
    )


def bucket_label(value: Column, edges: Sequence[float]) -> Column:
    """Label of the first edge not below ``value``; null falls to the open last bucket."""
    lows = [0, *edges[:-1]]
    label = F.when(value <= edges[0], f"{lows[0]}-{edges[0]}")
    for low, high in list(zip(lows, edges))[1:]:
        label = label.when(value <= high, f"{low}-{high}")
    return label.otherwise(f"{edges[-1]}+")


def amount_histogram(
    df: DataFrame, edges: Sequence[float] = (50, 100, 500, 1000, 5000, 10000)
) -> DataFrame:
    labelled = df.select(bucket_label(F.col(AMOUNT), edges).alias("amount_range"))
    return labelled.groupBy("amount_range").agg(F.count("*").alias("transaction_count"))


def median_approx(
    df: DataFrame, keys: Sequence[str] = ("channel",), accuracy: int = 10000
) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.percentile_approx(AMOUNT, 0.5, accuracy).alias("median_amount_usd")
    )


def median_exact(df: DataFrame, keys: Sequence[str] = ("channel",)) -> DataFrame:
    """Lower median: the least amount with at least half of the group's amounts up to it.

    Amounts are counted per value and the counts are summed along the value order, so no group is
    held in one task. The counts are written, and all else is read from them.
    """
    keys = list(keys)
    values = df.filter(F.col(AMOUNT).isNotNull()).groupBy(*keys, AMOUNT).agg(
        F.count("*").alias("__n")
    )
    values = materialise(values, "amounts")
    rows = segmented(values, keys, [AMOUNT], None, SEGMENT_ROWS)
    upto = running_total(rows, F.col("__n"), keys, [AMOUNT], "__upto")
    upto = upto.select(*keys, AMOUNT, "__upto")
    sizes = rows.groupBy(*keys).agg(F.sum("__n").alias("__size"))
    reached = lookup_join(upto, sizes, keys, null_safe=True).filter(
        F.col("__upto") * 2 >= F.col("__size")
    )
    return reached.groupBy(*keys).agg(F.min(AMOUNT).alias("median_amount_usd"))


def percent_of_total(df: DataFrame, keys: Sequence[str] = ("channel",)) -> DataFrame:
    """Total per group and its share of the grand total, in percent to two digits."""
    return share_of_total(partials(df, list(keys)), keys)


def share_of_total(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``percent_of_total`` from partials by the same keys."""
    totals = parts.select(*keys, "__sum")
    grand = totals.agg(F.sum("__sum")).scalar()
    share = F.round(F.try_divide(F.col("__sum") * 100, grand), 2)
    return totals.select(
        *keys,
        as_double(F.col("__sum"), 2).alias("total_amount_usd"),
        share.cast("double").alias("percentage_of_total"),
    )
