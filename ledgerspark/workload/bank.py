"""The bank model over the given tables: raw (dirty) frames and the silver tables built from them.

Orders and line items become transactions, suppliers become branches, nations the gazetteer.
Every rule is a function of the row's own keys, so the oracle states the same rules in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerspark.config import CleaningRules, FraudRules, GoldRules, SegmentRules
from ledgerspark.operators.rules import matching, one_of, required, within
from ledgerspark.plans.gold import Silver
from ledgerspark.plans.silver import silver_branches, silver_customers, silver_transactions
from ledgerspark.schemas import BRANCHES, CUSTOMERS, TRANSACTIONS
from ledgerspark.scratch import scratch_path, small_sorts
from ledgerspark.sources.files import spread_scan

# Units per USD.
RATES = {"USD": "1.0000", "EUR": "0.9200", "GBP": "0.7900", "AUD": "1.5200"}
CURRENCIES = ["USD", "EUR", "GBP", "AUD"]

# Rules fitted to the given data's dates and totals; library defaults are not used here because
# they would select all rows or none.
CLEANING = CleaningRules(
    customer_fill={"join_date": "2000-01-01"}, join_date_range=("1995-06-01", "2001-12-31")
)
SEGMENTS = SegmentRules(as_of="2001-11-01", high_value_total=1_500_000)
FRAUD = FraudRules(velocity_above=2)
TIER_EDGES = (2500, 3500)
CHECKS = [
    required("channel", allowed=0.02),
    within("amount", 1000, 50000),
    one_of("currency", ["USD", "EUR", "GBP"], allowed=0.3),
    matching("channel", "^[A-Za-z]+$", allowed=0.5),
]
GOLD = GoldRules(segments=SEGMENTS, fraud=FRAUD, tier_edges=TIER_EDGES)


@dataclass(frozen=True)
class Bronze:
    customers: DataFrame
    branches: DataFrame
    transactions: DataFrame


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _id(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _pick(index: Column, values: list[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _every(key: Column, step: int, rest: int = 0) -> Column:
    return key % step == rest


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, and an older copy of some."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        k.alias("k"), "c_name", "c_mktsegment", F.explode(
            F.when(_every(k, 29), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        ).alias("age"),
    )
    k, age = F.col("k"), F.col("age")
    phone = F.format_string("(555) %03d-%04d", k % 1000, k % 10000)
    street = F.concat(k.cast("string"), F.lit(" Main St, "), F.lpad((k % 100000).cast("string"), 5, "0"))
    updated = F.lit("2001-01-02 00:00:00").cast("timestamp_ntz") - F.make_dt_interval(
        age.cast("int"), F.lit(0), (k % 1440).cast("int")
    )
    return rows.select(
        _id("C", k).alias("customer_id"),
        F.when(_every(k, 3), F.concat(F.lit("  "), "c_name")).otherwise(F.col("c_name")).alias("name"),
        F.when(_every(k, 11), "no-at-sign")
        .otherwise(F.concat(F.lit("user"), k, F.lit("@bank"), k % 5, F.lit(".example")))
        .alias("email"),
        F.when(_every(k, 13), "n/a").otherwise(phone).alias("phone"),
        F.when(_every(k, 71), F.lit(None).cast("string"))
        .when(_every(k, 17), "Main St")
        .when(_every(k, 19), "Main St 99999999999")
        .otherwise(street)
        .alias("address"),
        (F.lit(500) + k % 351 - age).cast("int").alias("credit_score"),
        F.when(
            ~_every(k, 53), F.date_add(F.lit("1995-01-01").cast("date"), ((k * 37) % 2500).cast("int"))
        ).alias("join_date"),
        updated.cast("timestamp").alias("last_update"),
        F.lower("c_mktsegment").alias("customer_type"),
    ).select(*CUSTOMERS.names)


def raw_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    k = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            _id("B", k).alias("branch_id"),
            F.col("s_name").alias("branch_name"),
            F.when(_every(k, 23, 5), F.lit(None).cast("string"))
            .when(_every(k, 4, 1), F.concat("n_name", F.lit("  ")))
            .otherwise(F.col("n_name"))
            .alias("location"),
            F.when(~_every(k, 31, 7), F.lower("r_name")).alias("timezone"),
            _pick(k % 4, CURRENCIES).alias("currency"),
        )
        .select(*BRANCHES.names)
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order; (order, line) repeats in the data, so ids do too."""
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    channel = {"A": "ATM", "N": " web", "R": "mobile "}
    kind = {"F": "withdrawal", "O": "deposit", "P": "transfer"}
    status = {"F": "completed", "O": "pending"}
    foreign = F.when(_every(F.col("l_partkey"), 5), 1).otherwise(0)
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("l_partkey") % 1440).cast("int"))

    def named(column: str, names: dict[str, str]) -> Column:
        chain = F
        for code, name in names.items():
            chain = chain.when(F.col(column) == code, name)
        return chain.otherwise(F.col(column))

    return (
        spread_scan(table(spark, sf_dir, "lineitem"))
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            _id("T", k).alias("transaction_id"),
            _id("C", F.col("o_custkey")).alias("customer_id"),
            _id("B", F.col("l_suppkey")).alias("branch_id"),
            F.when(~_every(k, 89), named("l_returnflag", channel)).alias("channel"),
            named("o_orderstatus", kind).alias("transaction_type"),
            F.when(~_every(k, 101), F.col("l_extendedprice")).alias("amount"),
            F.when(~_every(k, 97), _pick((F.col("l_suppkey") + foreign) % 4, CURRENCIES)).alias(
                "currency"
            ),
            F.date_format(
                F.col("l_shipdate").cast("timestamp_ntz") + minutes, "yyyy-MM-dd HH:mm:ss"
            ).alias("timestamp"),
            named("l_linestatus", status).alias("status"),
        )
        .select(*TRANSACTIONS.names)
    )


def dirty_lines(transactions: DataFrame) -> DataFrame:
    """Raw transactions as CSV lines, some with an amount that is no number, too many fields or too few."""
    k = F.substring("transaction_id", 2, 20).cast("bigint")
    fields = [F.when(_every(k, 50), "n/a").otherwise(F.col(c).cast("string")).alias(c) if c == "amount" else F.col(c) for c in transactions.columns]
    line = F.to_csv(F.struct(*fields), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    longer, shorter = F.concat(line, F.lit(",surplus")), F.substring_index(line, ",", 3)
    return transactions.select(F.when(_every(k, 70), longer).when(_every(k, 90), shorter).otherwise(line).alias("value"))


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw transactions in USD; small amounts and all hours of the day."""
    k = F.col("event_id")
    return spread_scan(table(spark, sf_dir, "events")).select(
        _id("T", k).alias("transaction_id"),
        _id("C", F.col("user_id")).alias("customer_id"),
        F.lit("B0").alias("branch_id"),
        F.col("event_type").alias("channel"),
        F.lit("payment").alias("transaction_type"),
        F.when(~_every(k, 101), F.col("value")).alias("amount"),
        F.when(~_every(k, 97), _pick(k % 4, CURRENCIES)).alias("currency"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.lit("completed").alias("status"),
    )


def event_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their value as the USD amount."""
    return spread_scan(table(spark, sf_dir, "events")).select(
        _id("C", F.col("user_id")).alias("customer_id"),
        F.col("event_type").alias("channel"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("value").alias("Amount_USD"),
    )


def rates(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{c}', CAST('{r}' AS DECIMAL(10,4)))" for c, r in RATES.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(currency, rate)")


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A made-up position per nation; some nations are missing."""
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").filter(~_every(k, 9, 4)).select(
        F.col("n_name").alias("location"),
        (k * 3125 / 1000 - 40).cast("double").alias("latitude"),
        (k * 7 - 90).cast("double").alias("longitude"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    return Bronze(
        raw_customers(spark, sf_dir), raw_branches(spark, sf_dir), raw_transactions(spark, sf_dir)
    )


SILVER_NAMES = ("customers", "branches", "transactions")


def build_silver(spark: SparkSession, sf_dir: str) -> str:
    """Write the three silver tables to a new folder and return it."""
    path = scratch_path(spark, "silver")
    raw = bronze(spark, sf_dir)
    frames = (
        silver_customers(raw.customers, CLEANING),
        silver_branches(raw.branches, gazetteer(spark, sf_dir), CLEANING),
        silver_transactions(raw.transactions, rates(spark), CLEANING),
    )
    with small_sorts(spark, table(spark, sf_dir, "lineitem").count()):
        for name, frame in zip(SILVER_NAMES, frames):
            frame.write.parquet(f"{path}/{name}")
    return path


_silver_paths: dict[tuple[str, str], str] = {}


def silver(spark: SparkSession, sf_dir: str) -> Silver:
    """The silver tables, written on first use in a session; gold queries read them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _silver_paths:
        _silver_paths[key] = build_silver(spark, sf_dir)
    return Silver(*[spark.read.parquet(f"{_silver_paths[key]}/{name}") for name in SILVER_NAMES])
