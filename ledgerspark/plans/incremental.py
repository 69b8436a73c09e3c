"""Gold tables kept up to date delivery by delivery.

A delivery of silver transactions is read once. What it adds to every published figure is written as partials per
key and day to small tables, partitioned by delivery and month. The published tables follow from the partials of all
deliveries, without the transactions: exact sums merge, distinct counts and medians come from sketches that do. The table by
day is written again for the months that the delivery touches only; late rows are rows like any other.

A delivery that comes again, also with other rows, takes the place of its former self. So a run that was cut short is
mended by running it again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerspark.config import CatalogConfig, GoldRules
from ledgerspark.functions.money import countable, exact_sum_unrounded
from ledgerspark.operators import rollups as R
from ledgerspark.plans.gold import Silver, gold_tables
from ledgerspark.scratch import materialise
from ledgerspark.sources.tables import overwrite_partitions, overwrite_table

MEDIAN_K = 4000  # size of a median's sketch: a rank error of about 0.13 %
UNIQUE_LG = 12  # 2**12 registers for a distinct count: a standard error of about 1.6 %
PREFIX = "parts_"
WRITERS = 4  # published tables written at a time: each is small

BY_DATE = "date_aggregations_table"

# Tables of single transactions and of numbers over all of them, which a delivery can change anywhere.
WHOLE = ("fraud_flags_table", "transaction_with_location_table", "rolling_avg_table")


@dataclass(frozen=True)
class Family:
    """Partials by keys: per day, unless figures by these keys and days would be as many as the transactions."""

    keys: tuple[str, ...]
    parts: Callable[[DataFrame, Sequence[str]], DataFrame]
    daily: bool = True


def _currency_parts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        exact_sum_unrounded(R.AMOUNT).alias("__total"), F.count(countable(R.AMOUNT)).alias("__count")
    )


def _range_parts(edges: Sequence[float]) -> Callable[[DataFrame, Sequence[str]], DataFrame]:
    def parts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        labelled = df.withColumn("amount_range", R.bucket_label(F.col(R.AMOUNT), edges))
        return labelled.groupBy(*keys).agg(F.count("*").alias("__count"))

    return parts


def _median_parts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    known = df.filter(F.col(R.AMOUNT).isNotNull())
    return known.groupBy(*keys).agg(F.kll_sketch_agg_double(R.AMOUNT, MEDIAN_K).alias("__sketch"))


def _unique_parts(columns: Sequence[str]) -> Callable[[DataFrame, Sequence[str]], DataFrame]:
    """A row for a column and day: its rows, its values that are there, and a sketch of the distinct ones."""

    def parts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        days = [k for k in keys if k != "column_name"]
        figures: list[Column] = [F.count("*").alias("__rows")]
        for i, c in enumerate(columns):
            value = F.col(f"`{c}`").cast("string")
            figures += [F.count(value).alias(f"__n{i}"), F.hll_sketch_agg(value, UNIQUE_LG).alias(f"__s{i}")]
        wide = df.groupBy(*days).agg(*figures)
        long = [
            F.struct(F.lit(c).alias("column_name"), F.col("__rows"), F.col(f"__n{i}").alias("__count"), F.col(f"__s{i}").alias("__sketch"))
            for i, c in enumerate(columns)
        ]
        return wide.select(*days, F.inline(F.array(*long)))

    return parts


def families(rules: GoldRules, profiled: Sequence[str]) -> dict[str, Family]:
    kinds, moments, branches = R.SUMMARIES
    return {
        "kinds": Family(kinds, R.partials),
        "moments": Family(moments, R.partials),
        "branches": Family(branches, R.partials),
        "customers": Family(("customer_id",), lambda df, _: R.customer_partials(df), daily=False),
        "currencies": Family(("currency",), _currency_parts),
        "ranges": Family(("amount_range",), _range_parts(rules.histogram_edges)),
        "medians": Family(("channel",), _median_parts),
        "uniques": Family(("column_name",), _unique_parts(profiled)),
    }


PROFILED = ("transaction_id", "customer_id", "branch_id", "channel", "transaction_type", "currency", "status", "Amount_USD")


@dataclass(frozen=True)
class GoldStore:
    """The partials of all deliveries, and the tables published from them, in a catalog's gold layer."""

    spark: SparkSession
    catalog: CatalogConfig = CatalogConfig()
    rules: GoldRules = GoldRules()
    profiled: tuple[str, ...] = PROFILED
    kept: tuple[str, ...] | None = None  # families, all by default; tables that need others can't be published

    def table(self, family: str) -> str:
        return f"{self.catalog.gold}.{PREFIX}{family}"

    def parts(self, family: str) -> DataFrame:
        return self.spark.read.table(self.table(family))

    def add(self, delivery: str, transactions: DataFrame) -> list[str]:
        """Write the partials of a delivery and give the months (``yyyy-MM``) it touches; those of its former self too.

        A delivery's name has letters, digits, dots, hyphens and underscores. Months are as many as a calendar has; rows without a readable timestamp are under ``none``. A delivery without
        rows touches none.
        """
        if not re.fullmatch(r"[\w.-]+", delivery, re.ASCII):
            raise ValueError(f"no name for a delivery: {delivery!r}")
        moment = F.col("timestamp")
        day = moment.try_cast("date")
        rows = transactions.withColumns({"day": day, "date": day, "hour": F.hour(moment.try_cast("timestamp"))})
        rows = materialise(rows, "delivery")
        touched = _months(rows.select(_period("day")))
        for name, family in self._families().items():
            by_day = ["day"] if family.daily else []
            parts = family.parts(rows, [*family.keys, *by_day]).withColumn("delivery", F.lit(delivery))
            if family.daily:
                parts = parts.withColumn("period", _period("day"))
            touched |= self._forget(name, delivery)
            overwrite_partitions(parts, self.table(name), ["delivery", "period"] if family.daily else ["delivery"])
        return sorted(touched)

    def _families(self) -> dict[str, Family]:
        known = families(self.rules, self.profiled)
        return known if self.kept is None else {name: known[name] for name in self.kept}

    def _forget(self, family: str, delivery: str) -> set[str]:
        """Drop what a delivery left before; the months it was about."""
        if not self.spark.catalog.tableExists(self.table(family)):
            return set()
        former = self.parts(family).filter(F.col("delivery") == delivery)
        months = set()
        if "period" in former.columns:
            months = _months(former)
        places = [f"delivery = '{delivery}', period = '{m}'" for m in months] or [f"delivery = '{delivery}'"]
        dropped = ", ".join(f"PARTITION ({place})" for place in places)
        self.spark.sql(f"ALTER TABLE {self.table(family)} DROP IF EXISTS {dropped}")
        return months

    def publish(self, customers: DataFrame, branches: DataFrame, months: Sequence[str]) -> list[str]:
        """Write what follows from partials, where ``months`` have changed it; the names of the tables written.

        Without months nothing is written. The table by date is partitioned by month and keeps the files of all others.
        """
        if not months:
            return []
        by_date = f"{self.catalog.gold}.{BY_DATE}"
        builders = {f"{self.catalog.gold}.{name}": build for name, build in self.builders().items()}
        known = self.spark.catalog.tableExists(by_date)
        changed = F.col("period").isin(list(months)) if known else F.lit(True)
        days = builders.pop(by_date)(self.silver(customers, branches, changed))
        overwrite_partitions(days.withColumn("period", _period("date")), by_date, ["period"])
        left = _months(self.parts("moments").filter(changed))
        for gone in set(months) - left:
            self.spark.sql(f"ALTER TABLE {by_date} DROP IF EXISTS PARTITION (period = '{gone}')")
        silver = self.silver(customers, branches)
        with ThreadPoolExecutor(WRITERS) as writers:
            list(writers.map(lambda item: overwrite_table(item[1](silver), item[0]), builders.items()))
        return [by_date, *builders]

    def builders(self) -> dict[str, Callable[[Silver], DataFrame]]:
        prefix = self.catalog.main_table_prefix
        left_out = {*WHOLE, *[f"{prefix}{name}" for name in WHOLE]}
        found = {name: build for name, build in gold_tables(self.rules, self.catalog).items() if name not in left_out}
        return found | {
            "currency_analysis": lambda _: self.currency_analysis(),
            "transaction_frequency_table": lambda _: self.histogram(),
            "median_table": lambda _: self.medians(),
        }

    def silver(self, customers: DataFrame, branches: DataFrame, changed: Column | None = None) -> Silver:
        """What the gold tables are built from: partials in place of transactions, those of moments where ``changed``."""
        kinds, moments, places = R.SUMMARIES
        by_moment = self.parts("moments")
        summaries = {
            kinds: self.parts("kinds"),
            moments: by_moment if changed is None else by_moment.filter(changed),
            places: self.parts("branches"),
        }
        return Silver(customers, branches, self.spark.createDataFrame([], "nothing string"), summaries, self.customers())

    def customers(self) -> DataFrame:
        """Figures per customer over all deliveries."""
        merge = {"__sum": F.sum, "__min": F.min, "__max": F.max, "__count": F.sum, "__spend": F.sum, "__spends": F.sum}
        merged = [fn(c).alias(c) for c, fn in merge.items()]
        last = F.max("last_transaction_date").alias("last_transaction_date")
        return self.parts("customers").groupBy("customer_id").agg(*merged, last)

    def currency_analysis(self) -> DataFrame:
        sums = self.parts("currencies").groupBy("currency").agg(
            F.sum("__total").cast("double").alias("total_amount_by_currency"), F.sum("__count").alias("__count")
        )
        mean = F.try_divide(F.col("total_amount_by_currency"), F.col("__count"))
        return sums.withColumn("avg_amount_by_currency", mean).drop("__count")

    def histogram(self) -> DataFrame:
        return self.parts("ranges").groupBy("amount_range").agg(F.sum("__count").alias("transaction_count"))

    def medians(self, days: Column | None = None) -> DataFrame:
        """Approximate median per channel from the merged sketches of all days, or of some."""
        held = self.parts("medians") if days is None else self.parts("medians").filter(days)
        merged = held.groupBy("channel").agg(F.kll_merge_agg_double("__sketch", MEDIAN_K).alias("__sketch"))
        return merged.select(
            "channel", F.kll_sketch_get_quantile_double("__sketch", F.lit(0.5)).alias("median_amount_usd")
        )

    def profile(self, days: Column | None = None) -> DataFrame:
        """Rows, values and approximate distinct values of the profiled columns, over all days or some of them."""
        held = self.parts("uniques") if days is None else self.parts("uniques").filter(days)
        return held.groupBy("column_name").agg(
            F.sum("__rows").alias("total_count"),
            F.sum("__count").alias("non_null_count"),
            F.hll_sketch_estimate(F.hll_union_agg("__sketch")).alias("unique_count"),
        )


def _period(day: str) -> Column:
    """The month of a day as text, also where there is none: a partition's name can't be null."""
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none")).alias("period")


def _months(df: DataFrame) -> set[str]:
    """The months in ``period``: one aggregated row, as long as a calendar at most."""
    return set(df.agg(F.collect_set("period")).first()[0])
