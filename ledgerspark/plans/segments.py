"""Customer segments; a customer may belong to several."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.config import SegmentRules
from ledgerspark.functions.money import exact_sum_unrounded
from ledgerspark.operators.windows import sequential_ids

# The published segment descriptions.
DESCRIPTIONS = {
    "High_Value": "Customers with high transaction volume",
    "New_User": "Customers who joined in last 30 days",
    "Inactive": "No transactions in last 90 days",
    "Credit_Risk": "Customers with low credit scores",
    "Loyal": "Consistent activity for over 5 years",
}


def _days_before(rules: SegmentRules, days: int) -> date:
    return date.fromisoformat(rules.as_of) - timedelta(days=days)


def _members(customers: DataFrame, name: str, rules: SegmentRules) -> DataFrame:
    return customers.select(
        "customer_id",
        F.lit(name).alias("segment_name"),
        F.lit(DESCRIPTIONS[name]).alias("segment_description"),
        F.lit(rules.as_of).cast("timestamp").alias("last_update"),
    )


def spend_of(transactions: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    return transactions.groupBy("customer_id").agg(
        exact_sum_unrounded(rules.high_value_measure).alias("__spend")
    )


def high_value(transactions: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    return _high_value(spend_of(transactions, rules), rules)


def _high_value(spend: DataFrame, rules: SegmentRules) -> DataFrame:
    return _members(spend.filter(F.col("__spend") > rules.high_value_total), "High_Value", rules)


def new_user(customers: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    after = _days_before(rules, rules.new_user_days)
    return _members(customers.filter(F.col("join_date") > F.lit(after)), "New_User", rules)


def recent_customers(transactions: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    """Customers with a transaction after the cutoff; text timestamps compare as they sort."""
    return transactions.filter(F.col("timestamp") > _cutoff(rules)).select("customer_id").distinct()


def _cutoff(rules: SegmentRules) -> Column:
    return F.lit(f"{_days_before(rules, rules.inactive_days)} 00:00:00")


def inactive(
    customers: DataFrame, transactions: DataFrame, rules: SegmentRules = SegmentRules()
) -> DataFrame:
    silent = customers.join(recent_customers(transactions, rules), "customer_id", "left_anti")
    return _members(silent, "Inactive", rules)


def credit_risk(customers: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    low = customers.filter(F.col("credit_score") < rules.credit_risk_below)
    return _members(low, "Credit_Risk", rules)


def loyal(customers: DataFrame, rules: SegmentRules = SegmentRules()) -> DataFrame:
    before = _days_before(rules, rules.loyal_days)
    return _members(customers.filter(F.col("join_date") < F.lit(before)), "Loyal", rules)


def segment_members(
    customers: DataFrame, transactions: DataFrame, rules: SegmentRules = SegmentRules()
) -> DataFrame:
    """All memberships, not numbered."""
    recent = recent_customers(transactions, rules)
    return _members_of(customers, spend_of(transactions, rules), recent, rules)


def segment_members_of(
    customers: DataFrame, parts: DataFrame, rules: SegmentRules = SegmentRules()
) -> DataFrame:
    """The same memberships from the per-customer partials, which sum up ``amount``."""
    recent = parts.filter(F.col("last_transaction_date") > _cutoff(rules)).select("customer_id")
    return _members_of(customers, parts, recent, rules)


def _members_of(
    customers: DataFrame, spend: DataFrame, recent: DataFrame, rules: SegmentRules
) -> DataFrame:
    """One pass over the customers for the four segments that are theirs."""
    marked = customers.join(recent.withColumn("__recent", F.lit(True)), "customer_id", "left")
    rule = {
        "New_User": F.col("join_date") > F.lit(_days_before(rules, rules.new_user_days)),
        "Inactive": F.col("__recent").isNull(),
        "Credit_Risk": F.col("credit_score") < rules.credit_risk_below,
        "Loyal": F.col("join_date") < F.lit(_days_before(rules, rules.loyal_days)),
    }
    texts = {
        name: F.struct(
            F.lit(name).alias("segment_name"),
            F.lit(DESCRIPTIONS[name]).alias("segment_description"),
        )
        for name in rule
    }
    held = F.array_compact(F.array(*[F.when(rule[name], texts[name]) for name in rule]))
    theirs = marked.select("customer_id", F.inline(held)).withColumn(
        "last_update", F.lit(rules.as_of).cast("timestamp")
    )
    return _high_value(spend, rules).unionByName(theirs)


def customer_segmentation(
    customers: DataFrame, transactions: DataFrame, rules: SegmentRules = SegmentRules()
) -> DataFrame:
    return numbered_members(segment_members(customers, transactions, rules))


def numbered_members(members: DataFrame) -> DataFrame:
    numbered = sequential_ids(members, ["customer_id", "segment_name"], "segment_id", "S")
    return numbered.select(
        "segment_id", "customer_id", "segment_name", "segment_description", "last_update"
    )


def segment_counts(members: DataFrame) -> DataFrame:
    return members.groupBy("segment_name").agg(F.count("segment_name").alias("count"))
