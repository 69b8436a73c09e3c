"""Checks of rules that hold between tables. They report, they do not repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspark.operators.joins import lookup_join


def audit_integrity(
    customers: DataFrame, branches: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Transactions per violation: before the customer joined, unknown customer, unknown branch.

    Transactions are counted per customer and day, and per branch, before they meet a dimension:
    an hour never decides whether a day lies before the join date.
    """
    day = F.to_date(F.col("timestamp").try_cast("timestamp"))
    per_customer = transactions.groupBy("customer_id", day.alias("__day")).agg(
        F.count("*").alias("__n")
    )
    joined = customers.select("customer_id", "join_date", F.lit(True).alias("__known"))
    customer_days = per_customer.join(joined, "customer_id", "left")
    customer_kind = F.when(F.col("__known").isNull(), "unknown_customer").when(
        F.col("__day") < F.col("join_date"), "before_join_date"
    )
    per_branch = transactions.groupBy("branch_id").agg(F.count("*").alias("__n"))
    unknown_branch = per_branch.join(branches.select("branch_id"), "branch_id", "left_anti")
    found = customer_days.select(customer_kind.alias("violation"), "__n").unionByName(
        unknown_branch.select(F.lit("unknown_branch").alias("violation"), "__n")
    )
    return (
        found.filter(F.col("violation").isNotNull())
        .groupBy("violation")
        .agg(F.sum("__n").alias("transaction_count"))
    )


def audit_currency(branches: DataFrame, transactions: DataFrame) -> DataFrame:
    """Transactions in another currency than their branch's."""
    own = branches.select("branch_id", F.col("currency").alias("branch_currency"))
    together = lookup_join(transactions, own, ["branch_id"], "inner")
    return together.filter(F.col("currency") != F.col("branch_currency")).select(
        "transaction_id", "branch_id", "currency", "branch_currency"
    )


def audit_status_conflicts(transactions: DataFrame) -> DataFrame:
    """Transaction ids recorded with more than one status."""
    statuses = transactions.groupBy("transaction_id").agg(
        F.count_distinct("status").alias("status_count")
    )
    return statuses.filter(F.col("status_count") > 1)
