"""Scalar enrichment of customers, branches and transactions, all as built-in expressions."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerspark.functions.money import divided_to_cents
from ledgerspark.operators.joins import lookup_join

log = logging.getLogger(__name__)

# Fixed value: the text form of timestamps in the silver layer.
TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss"


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    for name in names:
        if name not in df.columns:
            log.warning("column %s does not exist, skipped", name)
    return [name for name in names if name in df.columns]


def format_dates(
    df: DataFrame, date_columns: Sequence[str] = (), timestamp_columns: Sequence[str] = ()
) -> DataFrame:
    """Dates become DATE, timestamps become fixed-width text; what cannot be read becomes null.

    The text sorts like the time it stands for, so range predicates on it still reach the scan.
    """
    dates = {c: F.col(c).try_cast("date") for c in _present(df, date_columns)}
    stamps = {
        c: F.date_format(F.col(c).try_cast("timestamp"), TIMESTAMP_TEXT)
        for c in _present(df, timestamp_columns)
    }
    return df.withColumns({**dates, **stamps})


def extract_date_parts(
    df: DataFrame, date_column: str, Year: bool = True, Month: bool = False, Day: bool = False
) -> DataFrame:
    if date_column not in df.columns:
        raise ValueError(f"no column {date_column} to take date parts from")
    moment = F.col(date_column).try_cast("timestamp")
    parts = {
        "year": (Year, F.year(moment)),
        "month": (Month, F.month(moment)),
        "day": (Day, F.dayofmonth(moment)),
    }
    return df.withColumns({name: part for name, (wanted, part) in parts.items() if wanted})


def format_phone_numbers(df: DataFrame, phone_column: str) -> DataFrame:
    """Digits only, as BIGINT; null when there are none or too many."""
    digits = F.regexp_replace(phone_column, "[^0-9]", "")
    return df.withColumn(phone_column, digits.try_cast("bigint"))


def domain_extract(df: DataFrame, col_name: str) -> DataFrame:
    return df.withColumn("domain", F.get(F.split(col_name, "@"), F.lit(1)))


def extract_pincode(df: DataFrame, address_column: str, pincode_column: str) -> DataFrame:
    """Digits closing the address, as INT; null when there are none or they do not fit."""
    digits = F.regexp_extract(address_column, r"(\d+)$", 1)
    return df.withColumn(pincode_column, digits.try_cast("int"))


def add_coordinates(df: DataFrame, gazetteer: DataFrame, digits: int = 2) -> DataFrame:
    """Latitude and longitude by location name, compared without case and outer blanks.

    A name the gazetteer lacks keeps null coordinates; of one that it lists several times, or in several
    spellings, the least pair counts.
    """
    place = F.upper(F.trim("location"))
    known = gazetteer.select(
        place.alias("__place"),
        F.round("latitude", digits).alias("latitude"),
        F.round("longitude", digits).alias("longitude"),
    )
    known = known.groupBy("__place").agg(F.min(F.struct("latitude", "longitude")).alias("__at"))
    known = known.select("__place", "__at.latitude", "__at.longitude")
    return lookup_join(df.withColumn("__place", place), known, ["__place"]).drop("__place")


def convert_currency_to_usd(
    df: DataFrame, rates: DataFrame, default_rate: float | None = 1, out: str = "Amount_USD"
) -> DataFrame:
    """``amount`` divided by its currency's units per USD, rounded half up to cents.

    An unlisted currency takes ``default_rate``; with ``None`` it gives null instead. Of a currency
    that ``rates`` lists several times the greatest rate counts.
    """
    listed = rates.groupBy("currency").agg(F.max(F.col("rate").cast("decimal(10,4)")).alias("__rate"))
    rate = F.col("__rate")
    if default_rate is not None:
        rate = F.coalesce(rate, F.lit(default_rate).cast("decimal(10,4)"))
    return lookup_join(df, listed, ["currency"]).withColumn(
        out, divided_to_cents(F.col("amount"), rate)
    ).drop("__rate")


def count_missing_rates(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Rows per currency that ``convert_currency_to_usd`` would convert at the default rate."""
    per_currency = df.groupBy("currency").agg(F.count("*").alias("rate_missing"))
    listed = rates.select("currency")
    return per_currency.join(listed, "currency", "left_anti")
