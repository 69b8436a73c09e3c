"""Cleaning steps: duplicates, missing values, types, blanks, ranges, case, anomaly flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ledgerspark.config import CleaningRules


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def remove_duplicates(df: DataFrame, primary_keys: Sequence[str]) -> DataFrame:
    """Any one row per key. Use ``clean_duplicate_transactions`` where it matters which."""
    return df.dropDuplicates(list(primary_keys))


def enforce_uniqueness(df: DataFrame, unique_cols: Sequence[str]) -> DataFrame:
    return remove_duplicates(df, unique_cols)


def uniqueness_violations(df: DataFrame, unique_cols: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    counts = df.groupBy(*unique_cols).agg(F.count("*").alias("row_count"))
    return counts.filter(F.col("row_count") > 1)


def clean_duplicate_transactions(
    df: DataFrame,
    primary_keys: Sequence[str],
    order_by_col: str,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The latest row per key; ties go to the greatest remaining columns, in their order.

    The ``= 1`` filter lets each map task keep one row per key before the shuffle, so a key with
    many copies costs one row per task.
    """
    keys = list(primary_keys)
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in (*keys, order_by_col)]
    latest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (order_by_col, *tie_breakers)])
    ranked = df.withColumn("__rank", F.row_number().over(latest))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def fill_missing(df: DataFrame, fill_values: Mapping) -> DataFrame:
    return df.na.fill(dict(fill_values))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(subset) if subset is not None else None)


def handle_missing_values(df: DataFrame, fill_values: Mapping) -> DataFrame:
    """Fill the listed columns, then drop every row in which any column is still null."""
    return df.transform(fill_missing, fill_values).transform(drop_incomplete)


def validate_data_types(df: DataFrame, schema: Mapping) -> DataFrame:
    """Cast the listed columns; a value that does not convert becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in schema.items()})


def trim_whitespaces(df: DataFrame) -> DataFrame:
    """Strip outer spaces (spaces only, not tabs) from every string column."""
    return df.withColumns({c: F.trim(c) for c in _strings(df)})


def capitalize_string_data(df: DataFrame) -> DataFrame:
    """Upper-case every string column."""
    return df.withColumns({c: F.upper(c) for c in _strings(df)})


def remove_invalid_values(df: DataFrame, invalid_values: Mapping) -> DataFrame:
    """Keep rows inside the inclusive range of every listed column; null is outside."""
    for name, (low, high) in invalid_values.items():
        kind = df.schema[name].dataType
        low, high = F.lit(low), F.lit(high)
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            low, high = low.cast(kind), high.cast(kind)
        df = df.filter(F.col(name).between(low, high))
    return df


def flag_anomalies(df: DataFrame, anomaly_conditions: Mapping[str, Column]) -> DataFrame:
    """Set ``anomaly_flag`` where any condition holds; an unknown condition does not set it.

    A flag the frame already carries is kept.
    """
    seed = F.col("anomaly_flag") if "anomaly_flag" in df.columns else F.lit(False)
    hits = [F.coalesce(c, F.lit(False)) for c in anomaly_conditions.values()]
    flag = reduce(lambda a, b: a | b, hits, F.coalesce(seed, F.lit(False)))
    return df.withColumn("anomaly_flag", flag)


def clean_customers(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return (
        df.transform(clean_duplicate_transactions, ["customer_id"], "last_update")
        .transform(handle_missing_values, rules.customer_fill)
        .transform(validate_data_types, {"join_date": "date"})
        .transform(trim_whitespaces)
        .transform(remove_invalid_values, {"join_date": rules.join_date_range})
        .transform(capitalize_string_data)
    )


def clean_branches(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return (
        df.transform(clean_duplicate_transactions, ["branch_id"], "branch_name")
        .transform(handle_missing_values, rules.branch_fill)
        .transform(trim_whitespaces)
        .transform(capitalize_string_data)
    )


def clean_transactions(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    """Duplicates go first: the latest copy decides, also when it is then found invalid."""
    return (
        df.transform(clean_duplicate_transactions, ["transaction_id"], "timestamp")
        .transform(handle_missing_values, rules.transaction_fill)
        .transform(validate_data_types, {"timestamp": "timestamp"})
        .transform(trim_whitespaces)
        .transform(remove_invalid_values, {"amount": rules.amount_range})
    )
