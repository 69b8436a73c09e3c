"""Bronze to silver: cleaned and enriched tables with the fixed silver schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerspark.config import CleaningRules
from ledgerspark.functions.enrich import (
    add_coordinates,
    convert_currency_to_usd,
    domain_extract,
    extract_date_parts,
    extract_pincode,
    format_dates,
    format_phone_numbers,
)
from ledgerspark.operators.cleaning import (
    capitalize_string_data,
    clean_branches,
    clean_customers,
    clean_transactions,
)
from ledgerspark.schemas import SILVER_BRANCHES, SILVER_CUSTOMERS, SILVER_TRANSACTIONS


def silver_customers(customers: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    return (
        customers.transform(clean_customers, rules)
        .transform(format_dates, ["join_date"], ["last_update"])
        .transform(extract_date_parts, "join_date")
        .transform(format_phone_numbers, "phone")
        .transform(domain_extract, "email")
        .transform(extract_pincode, "address", "postal_code")
        .select(*SILVER_CUSTOMERS.names)
    )


def silver_branches(
    branches: DataFrame, gazetteer: DataFrame, rules: CleaningRules = CleaningRules()
) -> DataFrame:
    return (
        branches.transform(clean_branches, rules)
        .transform(add_coordinates, gazetteer)
        .select(*SILVER_BRANCHES.names)
    )


def finish_transactions(cleaned: DataFrame, rates: DataFrame) -> DataFrame:
    """Case, date parts, text timestamps and USD amounts; the same for batch and stream."""
    return (
        cleaned.transform(capitalize_string_data)
        .transform(extract_date_parts, "timestamp", Month=True)
        .transform(format_dates, timestamp_columns=["timestamp"])
        .transform(convert_currency_to_usd, rates)
        .select(*SILVER_TRANSACTIONS.names)
    )


def silver_transactions(
    transactions: DataFrame, rates: DataFrame, rules: CleaningRules = CleaningRules()
) -> DataFrame:
    return finish_transactions(clean_transactions(transactions, rules), rates)
