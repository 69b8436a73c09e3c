"""Fraud flags: three amount rules and a monthly velocity rule, first match wins.

The score does not follow the precedence, so it is chosen with the flag and not by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspark.config import FraudRules
from ledgerspark.operators.joins import full_outer, skew_join
from ledgerspark.operators.rollups import AMOUNT, monthly_counts
from ledgerspark.operators.windows import sequential_ids
from ledgerspark.scratch import materialise

# Confidence per flag, in order of precedence.
SCORES = {
    "pattern_anomaly": 0.85,
    "unusual_amount": 0.75,
    "watchlist_match": 0.90,
    "velocity_check": 0.60,
}
MONTH = ["year", "month", "customer_id"]
IDENTITY = ["transaction_id", "customer_id", "year", "month", "timestamp"]


def _score(flag: str, condition: Column) -> Column:
    return F.when(condition, F.lit(SCORES[flag])).alias(flag)


def detect_pattern_anomaly(df: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    return df.select("*", _score("pattern_anomaly", F.col(AMOUNT) > rules.pattern_above))


def detect_unusual_amount(df: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    return df.select("*", _score("unusual_amount", F.col(AMOUNT) > rules.unusual_above))


def detect_watchlist_match(df: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    return df.select("*", _score("watchlist_match", F.col(AMOUNT) > rules.watchlist_above))


def detect_velocity_check(df: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    """Transactions of a customer's busy month.

    Only the busy months are joined back, and the counts that make them busy also tell which of
    them are too large for one task. They are written, so that the transactions are counted once.
    """
    counts = materialise(monthly_counts(df), "monthly-counts")
    busy = counts.filter(F.col("monthly_count") > rules.velocity_above)
    scored = busy.select(*MONTH, F.lit(SCORES["velocity_check"]).alias("velocity_check"))
    sizes = counts.withColumnRenamed("monthly_count", "__n")
    return skew_join(df, scored, MONTH, "left", counts=sizes, spread_by=["transaction_id"])


def _first_match(df: DataFrame) -> DataFrame:
    names = [F.when(F.col(flag).isNotNull(), F.lit(flag)) for flag in SCORES]
    return df.select(
        "transaction_id",
        "customer_id",
        "month",
        "year",
        F.coalesce(*names).alias("flag_type"),
        F.coalesce(*[F.col(flag) for flag in SCORES]).alias("confidence_score"),
        F.col("timestamp").alias("transaction_datetime"),
    ).filter(F.col("flag_type").isNotNull())


def flagged(df: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    """Flagged transactions, not numbered."""
    narrow = df.select(*IDENTITY, AMOUNT)
    return (
        narrow.transform(detect_velocity_check, rules)
        .transform(detect_pattern_anomaly, rules)
        .transform(detect_unusual_amount, rules)
        .transform(detect_watchlist_match, rules)
        .transform(_first_match)
    )


def flagged_by_outer_joins(df: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    """The same flags from one frame per rule, joined on the transaction's identity.

    Equal to ``flagged`` where the identity is unique and complete; kept to pin the join's
    semantics.
    """
    detectors = [
        detect_pattern_anomaly,
        detect_unusual_amount,
        detect_watchlist_match,
        detect_velocity_check,
    ]
    frames = [
        detect(df, rules).select(*IDENTITY, flag).filter(F.col(flag).isNotNull())
        for flag, detect in zip(SCORES, detectors)
    ]
    return _first_match(full_outer(frames, IDENTITY))


def fraud_flags(df: DataFrame, rules: FraudRules = FraudRules()) -> DataFrame:
    return sequential_ids(flagged(df, rules), ["transaction_id"], "flag_id", "F")
