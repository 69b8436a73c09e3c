"""Silver transactions as a stream.

A stream cannot look back for the latest copy, so the first copy seen within the watermark stays.
Where the last copy must win, run the batch cleaning over the bronze table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerspark.config import CleaningRules, StreamConfig
from ledgerspark.operators.cleaning import (
    handle_missing_values,
    remove_invalid_values,
    trim_whitespaces,
)
from ledgerspark.plans.silver import finish_transactions


def silver_transactions_stream(
    raw: DataFrame,
    rates: DataFrame,
    rules: CleaningRules = CleaningRules(),
    config: StreamConfig = StreamConfig(),
) -> DataFrame:
    """Deduplicate within the watermark, then clean and convert like the batch plan.

    Unlike there, rows with an unreadable timestamp are dropped: they have no event time.
    """
    timed = (
        raw.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
        .filter(F.col("timestamp").isNotNull())
        .withWatermark("timestamp", config.watermark)
    )
    cleaned = (
        timed.dropDuplicatesWithinWatermark(["transaction_id"])
        .transform(handle_missing_values, rules.transaction_fill)
        .transform(trim_whitespaces)
        .transform(remove_invalid_values, {"amount": rules.amount_range})
    )
    return finish_transactions(cleaned, rates)
