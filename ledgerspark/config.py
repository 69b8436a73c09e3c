"""Frozen settings. Threshold defaults are the rules of the published gold tables."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LakeConfig:
    """External storage account. The key is read from an environment variable, never stored."""

    account: str
    container: str
    customers: str
    branches: str
    transactions: str
    key_env: str = "LEDGERSPARK_STORAGE_KEY"


@dataclass(frozen=True)
class CatalogConfig:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    main_table_prefix: str = ""
    location: str | None = None
    # Columns to partition published transactions by, so that cutoffs on them skip files.
    partition_transactions_by: tuple = ()


@dataclass(frozen=True)
class StreamConfig:
    header: bool = True
    timestamp_format: str | None = None
    max_files_per_trigger: int | None = 1000
    output_mode: str = "append"
    processing_time: str = "30 seconds"
    watermark: str = "1 day"


@dataclass(frozen=True)
class CleaningRules:
    customer_fill: dict = field(default_factory=lambda: {"join_date": "2023-01-01"})
    join_date_range: tuple = ("2015-01-01", "2023-12-31")
    branch_fill: dict = field(default_factory=lambda: {"location": "Unknown"})
    transaction_fill: dict = field(default_factory=lambda: {"currency": "USD", "channel": "web"})
    amount_range: tuple = (0, 100000)


@dataclass(frozen=True)
class SegmentRules:
    """The descriptions published with the segments name other periods; the day counts rule."""

    as_of: str = "2023-03-01"
    high_value_total: float = 100000
    high_value_measure: str = "amount"
    new_user_days: int = 90
    inactive_days: int = 10
    credit_risk_below: int = 600
    loyal_days: int = 5 * 365


@dataclass(frozen=True)
class FraudRules:
    pattern_above: float = 100000
    unusual_above: float = 50000
    watchlist_above: float = 30000
    velocity_above: int = 7


@dataclass(frozen=True)
class GoldRules:
    segments: SegmentRules = SegmentRules()
    fraud: FraudRules = FraudRules()
    churn_days: int = 180
    tier_edges: tuple = (1000, 5000)
    peak_hours: tuple = (8, 18)
    histogram_edges: tuple = (50, 100, 500, 1000, 5000, 10000)
    rolling_rows: int = 7
