"""The gold tables by name, each built from the three silver frames."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

from ledgerspark.config import CatalogConfig, GoldRules
from ledgerspark.operators import rollups as R
from ledgerspark.operators.joins import transaction_with_location
from ledgerspark.operators.rules import Rule, RulesBroken, enforce
from ledgerspark.operators.windows import day_of, rolling_average_rows
from ledgerspark.plans import segments as S
from ledgerspark.plans.fraud import fraud_flags
from ledgerspark.scratch import materialise
from ledgerspark.sources.tables import overwrite_table


@dataclass(frozen=True)
class Silver:
    customers: DataFrame
    branches: DataFrame
    transactions: DataFrame
    # Partials of the transactions, by key set and by customer, where they are written already.
    summaries: Mapping[tuple[str, ...], DataFrame] = field(default_factory=dict)
    customer_summary: DataFrame | None = None


Builder = Callable[[Silver], DataFrame]

WRITERS = 4  # tables written at a time, so that the last tasks of one leave no core idle

KEYS = {"customers": "customer_id", "branches": "branch_id", "transactions": "transaction_id"}


def gold_tables(
    rules: GoldRules = GoldRules(), catalog: CatalogConfig = CatalogConfig()
) -> dict[str, Builder]:
    """Table name to builder, in publishing order."""

    def by(*keys: str) -> Builder:
        return lambda s: R.measures(R.coarser(_summary(s, keys), keys), keys)

    def by_branch(attribute: str) -> Builder:
        return lambda s: R.measures_by_attribute(
            _summary(s, ["branch_id"]), s.branches, "branch_id", attribute
        )

    def members(s: Silver) -> DataFrame:
        if rules.segments.high_value_measure == "amount":
            return S.segment_members_of(s.customers, _per_customer(s), rules.segments)
        return S.segment_members(s.customers, s.transactions, rules.segments)

    def shares(s: Silver) -> DataFrame:
        return R.share_of_total(R.coarser(_summary(s, ["channel"]), ["channel"]), ["channel"])

    main = catalog.main_table_prefix
    return {
        f"{main}customer_segmentation_table": lambda s: S.numbered_members(members(s)),
        f"{main}fraud_flags_table": lambda s: fraud_flags(s.transactions, rules.fraud),
        "segment_count_table": lambda s: S.segment_counts(members(s)),
        "customer_segmentation": lambda s: R.type_totals_of(s.customers, _per_customer(s)),
        "customer_aggregations_table": lambda s: R.measures(_per_customer(s), ["customer_id"]),
        "currency_analysis": lambda s: R.currency_analysis(s.transactions),
        "branch_aggregations_table": by("branch_id"),
        "transaction_with_location_table": lambda s: transaction_with_location(
            s.transactions, s.branches
        ),
        "location_aggregations_table": by_branch("location"),
        "timezone_aggregations_table": by_branch("timezone"),
        "currency_aggregations_table": by("currency"),
        "channel_aggregations_table": by("channel"),
        "transaction_type_aggregations_table": by("transaction_type"),
        "year_month_aggregations_table": by("year", "month"),
        "date_aggregations_table": by("date"),
        "status_aggregations_table": by("status"),
        "channel_type_aggregations_table": by("channel", "transaction_type"),
        "customer_segments_table": lambda s: R.tiers_of(_per_customer(s), *rules.tier_edges),
        "last_transaction_table": lambda s: R.last_of(_per_customer(s)),
        "churn_table": lambda s: R.churn_of(R.last_of(_per_customer(s)), rules.churn_days),
        "peak_off_peak_table": lambda s: R.peak_of(_summary(s, ["hour"]), *rules.peak_hours),
        "transaction_frequency_table": lambda s: R.amount_histogram(
            s.transactions, rules.histogram_edges
        ),
        "median_table": lambda s: R.median_approx(s.transactions),
        "percentage_table": shares,
        "rolling_avg_table": lambda s: rolling_average_rows(
            s.transactions,
            R.AMOUNT,
            ["channel"],
            ["timestamp", "transaction_id"],
            rules.rolling_rows,
            bucket=day_of("timestamp"),
        ),
    }


def _summary(silver: Silver, keys: Sequence[str]) -> DataFrame:
    cover = next(names for names in R.SUMMARIES if set(keys) <= set(names))
    if cover in silver.summaries:
        return silver.summaries[cover]
    return R.summary_partials(silver.transactions, cover)


def _per_customer(silver: Silver) -> DataFrame:
    if silver.customer_summary is None:
        return R.customer_partials(silver.transactions)
    return silver.customer_summary


def pass_checks(silver: Silver, checks: Mapping[str, Sequence[Rule]]) -> None:
    """``RulesBroken`` unless every named frame passes its rules; each is read once."""
    if not set(checks) <= set(KEYS):
        raise ValueError(f"no silver frame: {', '.join(sorted(set(checks) - set(KEYS)))}")
    failed = []
    for name, rules in checks.items():
        try:
            enforce(getattr(silver, name), rules, KEYS[name])
        except RulesBroken as broken:
            failed.append(f"{name}: {broken}")
    if failed:
        raise RulesBroken("; ".join(failed))


def publish_gold(
    silver: Silver,
    rules: GoldRules = GoldRules(),
    catalog: CatalogConfig = CatalogConfig(),
    checks: Mapping[str, Sequence[Rule]] | None = None,
) -> list[str]:
    """Write every gold table and return their qualified names. A rerun replaces them.

    ``checks`` are rules by the name of a silver frame; nothing is written unless all frames pass theirs. Tables of single transactions are partitioned by ``catalog.partition_transactions_by``.

    The rollups come from a few small written summaries and the customers' tables from another, so
    the transactions are read once for each of those and not for each table.
    """
    pass_checks(silver, checks or {})
    with ThreadPoolExecutor(WRITERS) as writers:
        customers = writers.submit(lambda: materialise(_per_customer(silver), "customers"))
        summaries = list(writers.map(lambda keys: materialise(_summary(silver, keys), "summary"), R.SUMMARIES))
        summed = replace(
            silver, summaries=dict(zip(R.SUMMARIES, summaries)), customer_summary=customers.result()
        )

    def publish(name: str, build: Builder) -> str:
        table = f"{catalog.gold}.{name}"
        frame, cut = build(summed), catalog.partition_transactions_by
        overwrite_table(frame, table, cut if {"transaction_id", *cut} <= set(frame.columns) else ())
        return table

    with ThreadPoolExecutor(WRITERS) as writers:
        return list(writers.map(lambda item: publish(*item), gold_tables(rules, catalog).items()))
