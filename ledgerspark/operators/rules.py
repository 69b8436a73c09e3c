"""Declared rules about rows, judged in one pass, and a gate before publication."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True, eq=False)
class Rule:
    """``broken`` holds for rows that break the rule; null counts as kept. ``allowed`` is the share of rows that may break it.

    A function that gives the condition can be declared before there is a session.
    """

    name: str
    broken: Column | Callable[[], Column]
    allowed: float = 0.0

    def condition(self) -> Column:
        return F.coalesce(self.broken if isinstance(self.broken, Column) else self.broken(), F.lit(False))


def required(column: str, allowed: float = 0.0) -> Rule:
    return Rule(f"{column} required", lambda: F.col(column).isNull(), allowed)


def within(column: str, low, high, allowed: float = 0.0) -> Rule:
    return Rule(f"{column} within {low} and {high}", lambda: ~F.col(column).between(low, high), allowed)


def one_of(column: str, values: Sequence, allowed: float = 0.0) -> Rule:
    return Rule(f"{column} one of {', '.join(map(str, values))}", lambda: ~F.col(column).isin(*values), allowed)


def matching(column: str, pattern: str, allowed: float = 0.0) -> Rule:
    return Rule(f"{column} matching {pattern}", lambda: ~F.col(column).rlike(pattern), allowed)


class RulesBroken(ValueError):
    """Rules that more rows break than they allow."""


def rule_report(df: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """``rule, row_count, violations, first_offender, last_offender, allowed, passed``, one row for each rule.

    Offenders are the least and the greatest ``key`` among the rows that break the rule. All rules are one aggregate, so the
    rows are read once and combined before they are shuffled, however many rules there are. A table without rows
    passes every rule.
    """
    names = [rule.name for rule in rules]
    if len(set(names)) < len(names):
        raise ValueError("two rules share a name")
    if not rules:
        raise ValueError("a report needs a rule")
    kept = df.select(F.col(key).alias("key"), F.array(*[r.condition() for r in rules]).alias("broken"))
    found = [F.count("*").alias("row_count")]
    for at in range(len(rules)):
        broken = F.col("broken")[at]
        offender = F.when(broken, F.col("key"))
        found.append(F.struct(F.count_if(broken), F.min(offender), F.max(offender)).alias(f"rule_{at}"))
    rows = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col(f"rule_{at}")["col1"].alias("violations"),
            F.col(f"rule_{at}")["col2"].alias("first_offender"),
            F.col(f"rule_{at}")["col3"].alias("last_offender"),
            F.lit(float(rule.allowed)).alias("allowed"),
        )
        for at, rule in enumerate(rules)
    ]
    listed = kept.agg(*found).select("row_count", F.explode(F.array(*rows)).alias("r")).select("row_count", "r.*")
    passed = F.col("violations") <= F.col("allowed") * F.col("row_count")
    return listed.select(
        "rule", "row_count", "violations", "first_offender", "last_offender", "allowed", passed.alias("passed")
    )


def enforce(df: DataFrame, rules: Sequence[Rule], key: str) -> DataFrame:
    """``df`` if it passes all rules; otherwise ``RulesBroken`` names those that fail, with their counts and first offenders."""
    told = F.format_string(
        "%s: %s of %s rows, first %s", "rule", "violations", "row_count", F.col("first_offender").cast("string")
    )
    failed = F.array_compact(F.collect_list(F.when(~F.col("passed"), told)))  # a text for each rule at most
    listed = rule_report(df, rules, key).agg(failed.alias("failed")).first()["failed"]
    if listed:
        raise RulesBroken("; ".join(listed))
    return df


def broken_rules(df: DataFrame, rules: Sequence[Rule], name: str = "broken_rules") -> DataFrame:
    """``df`` with the names of the rules that each row breaks, in the rules' order; an empty list for a sound row."""
    told = [F.when(rule.condition(), F.lit(rule.name)) for rule in rules]
    return df.withColumn(name, F.array_compact(F.array(*told)))
