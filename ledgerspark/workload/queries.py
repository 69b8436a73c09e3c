"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ledgerspark.config import CatalogConfig, StreamConfig
from ledgerspark.functions import enrich as E
from ledgerspark.operators import audits, cleaning as C, joins as J, profiling as P, rollups as R, rules as Q
from ledgerspark.operators import windows as W
from ledgerspark.plans import fraud, segments as S
from ledgerspark.plans.gold import publish_gold
from ledgerspark.plans.incremental import GoldStore
from ledgerspark.schemas import CUSTOMERS, SILVER_TRANSACTIONS, TRANSACTIONS
from ledgerspark.scratch import materialise, scratch_path, small_sorts
from ledgerspark.sources.evolving import DELIVERY, SchemaStore, read_evolving
from ledgerspark.sources.files import good_rows, quarantined_rows, read_csv, read_csv_rescued, write_csv
from ledgerspark.sources.tables import bootstrap_catalog, overwrite_table, read_table
from ledgerspark.streaming.evolving import start_evolving
from ledgerspark.streaming.ingest import read_stream, stream_transaction_table, write_stream
from ledgerspark.streaming.silver import silver_transactions_stream
from ledgerspark.streaming.summary import latest_summary, start_summary, streaming_data_summary
from ledgerspark.streaming.upsert import read_daily_rollup, read_latest, start_daily_rollup, start_latest
from ledgerspark.workload import bank

Query = Callable[[SparkSession, str], DataFrame]


def _new_database(spark: SparkSession) -> str:
    name = f"run_{uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'database')}'")
    return name


def _new_catalog(spark: SparkSession) -> CatalogConfig:
    run = uuid4().hex
    catalog = CatalogConfig(
        bronze=f"bronze_{run}",
        silver=f"silver_{run}",
        gold=f"gold_{run}",
        location=scratch_path(spark, "catalog"),
    )
    bootstrap_catalog(spark, catalog)
    return catalog


def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(bank.raw_customers(spark, sf_dir), path)
    return read_csv(spark, path, CUSTOMERS)


def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(bank.raw_transactions(spark, sf_dir), path)
    return read_csv(spark, path, TRANSACTIONS)


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{_new_database(spark)}.branches_raw"
    overwrite_table(bank.raw_branches(spark, sf_dir), name)
    return read_table(spark, name)


def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice: the second refresh replaces the first."""
    name = f"{_new_database(spark)}.transactions_raw"
    raw = bank.raw_transactions(spark, sf_dir)
    overwrite_table(raw.select(*TRANSACTIONS.names), name)
    overwrite_table(raw, name)
    return read_table(spark, name)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same folder with one checkpoint: no file is taken twice."""
    path, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")
    write_csv(bank.raw_transactions(spark, sf_dir), path)
    name = f"{_new_database(spark)}.transactions_raw"
    for _ in range(2):
        stream_transaction_table(
            spark, path, TRANSACTIONS, name, checkpoint, available_now=True
        ).awaitTermination()
    return read_table(spark, name)


def _sorted_out(read: DataFrame) -> DataFrame:
    """Good rows with their amounts, and of the quarantined lines the ids they begin with."""
    good = good_rows(read).select("transaction_id", "amount", F.lit(False).alias("quarantined"))
    apart = quarantined_rows(read).select(
        F.substring_index("rescued_line", ",", 1).alias("transaction_id"),
        F.lit(None).cast("double").alias("amount"),
        F.lit(True).alias("quarantined"),
    )
    return good.unionByName(apart)


def rescued_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dirty")
    bank.dirty_lines(bank.raw_transactions(spark, sf_dir)).write.text(path)
    return _sorted_out(read_csv_rescued(spark, path, TRANSACTIONS, header=False))


def stream_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty files in two deliveries; good rows and quarantined lines of one table."""
    path, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")
    name = f"{_new_database(spark)}.transactions_raw"
    raw, config = bank.raw_transactions(spark, sf_dir), StreamConfig(header=False)
    part = F.pmod(F.xxhash64(*raw.columns), F.lit(2))
    for delivery in range(2):
        bank.dirty_lines(raw.filter(part == delivery)).write.mode("append").text(path)
        arriving = read_stream(spark, path, TRANSACTIONS, config, rescue=True)
        write_stream(arriving, name, checkpoint, config, available_now=True).awaitTermination()
    return _sorted_out(read_table(spark, name))


def stream_widening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries before 1995 without two columns, then in another order with all; the table widens for them."""
    path, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")
    database, raw = _new_database(spark), bank.raw_transactions(spark, sf_dir)
    name, store = f"{database}.transactions_raw", SchemaStore(spark, f"{database}.transactions_schemas")
    early = F.coalesce(F.col("timestamp") < "1995", F.lit(False))
    kinds = {f.name: f.dataType for f in TRANSACTIONS}
    for folder, rows in (
        ("narrow", raw.filter(early).drop("channel", "status")),
        ("wide", raw.filter(~early).select(*reversed(raw.columns))),
    ):
        write_csv(rows, f"{path}/{folder}")
        start_evolving(spark, path, kinds, name, checkpoint, store, available_now=True).awaitTermination()
    return read_evolving(spark, name).drop(DELIVERY)


def stream_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream whose schema has dates and timestamps."""
    path, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")
    write_csv(bank.raw_customers(spark, sf_dir), path)
    name = f"{_new_database(spark)}.customers_raw"
    arriving = read_stream(spark, path, CUSTOMERS)
    write_stream(arriving, name, checkpoint, available_now=True).awaitTermination()
    return read_table(spark, name)


def _with_checked_counts(profile: DataFrame, rows: DataFrame, relative_error: float = 0.05) -> DataFrame:
    """An approximate profile with, for its distinct counts, whether they are within four standard errors."""
    exact = P.exact_unique(rows).withColumnRenamed("unique_count", "__exact")
    truth = F.coalesce("__exact", F.lit(0))
    close = F.abs(F.col("unique_count") - truth) <= 4 * relative_error * truth
    return profile.join(exact, "column_name", "left").select(
        "column_name",
        "total_count",
        "non_null_count",
        "null_count",
        F.round("mean", 4).alias("mean"),
        F.round("stddev", 4).alias("stddev"),
        "min",
        "max",
        close.alias("unique_within_bound"),
    )


def profile_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact columns of the sketched profile, and its distinct counts held against exact ones."""
    raw = bank.raw_transactions(spark, sf_dir)
    return _with_checked_counts(P.data_summary(raw, approx=True), raw)


def median_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each approximate median's rank is within the sketch's error of the middle."""
    amounts = bank.silver(spark, sf_dir).transactions.select("channel", R.AMOUNT)
    return _placed_medians(amounts, R.median_approx(amounts), 10_000)


def _placed_medians(amounts: DataFrame, medians: DataFrame, parts: int) -> DataFrame:
    """Whether each median's rank is within one of so many parts of the rows from the middle."""
    placed = J.lookup_join(amounts, medians, ["channel"], "left", null_safe=True)
    rows, slack = F.count(R.AMOUNT), F.count(R.AMOUNT) / parts + 1
    upto = F.count_if(F.col(R.AMOUNT) <= F.col("median_amount_usd"))
    below = F.count_if(F.col(R.AMOUNT) < F.col("median_amount_usd"))
    within = (upto >= rows / 2 - slack) & (below <= rows / 2 + slack)
    return placed.groupBy("channel").agg(
        rows.alias("transaction_count"), within.alias("median_within_bound")
    )


def stream_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact columns of the running profile, and its distinct counts held against exact ones."""
    path = scratch_path(spark, "drops")
    write_csv(bank.raw_transactions(spark, sf_dir), path)
    summary = streaming_data_summary(read_stream(spark, path, TRANSACTIONS))
    out = scratch_path(spark, "summary")
    start_summary(
        summary, out, scratch_path(spark, "checkpoint"), available_now=True
    ).awaitTermination()
    return _with_checked_counts(latest_summary(summary, out), read_csv(spark, path, TRANSACTIONS))


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in two deliveries that overlap by a day; each is kept once."""
    path, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")
    events = bank.event_transactions(spark, sf_dir)
    deliveries = [
        events.filter(F.col("timestamp") < "2024-01-15 00:00:00"),
        events.filter(F.col("timestamp") >= "2024-01-14 00:00:00"),
    ]
    name = f"{_new_database(spark)}.cat_transactions"
    for delivery in deliveries:
        write_csv(delivery, path, mode="append")
        raw = read_stream(spark, path, TRANSACTIONS)
        silver = silver_transactions_stream(
            raw, bank.rates(spark), bank.CLEANING, StreamConfig(watermark="40 days")
        )
        write_stream(silver, name, checkpoint, available_now=True).awaitTermination()
    return read_table(spark, name)


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of transactions arrive in three deliveries, the latest ones not last; the stream is restarted for each."""
    path, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")
    name = f"{_new_database(spark)}.transactions_latest"
    with small_sorts(spark, bank.table(spark, sf_dir, "lineitem").count()):
        raw = materialise(bank.raw_transactions(spark, sf_dir), "raw")
    part = F.pmod(F.xxhash64(*raw.columns), F.lit(3))
    for delivery in range(3):
        write_csv(raw.filter(part == delivery), path, mode="append")
        arriving = read_stream(spark, path, TRANSACTIONS)
        start_latest(
            arriving, name, ["transaction_id"], "timestamp", checkpoint, buckets=8, available_now=True
        ).awaitTermination()
    return read_latest(spark, name)


def stream_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures per day and channel after three deliveries, the last one late; the stream is restarted for each."""
    path, checkpoint = scratch_path(spark, "drops"), scratch_path(spark, "checkpoint")
    name = f"{_new_database(spark)}.daily_by_channel"
    transactions = bank.silver(spark, sf_dir).transactions
    late, early = F.col("transaction_id").endswith("7"), F.col("timestamp") < "1996-01-01"
    for delivery in (~late & early, ~late & ~early, late):
        write_csv(transactions.filter(delivery), path, mode="append")
        arriving = read_stream(spark, path, SILVER_TRANSACTIONS)
        start_daily_rollup(
            arriving, name, ["channel"], checkpoint, StreamConfig(watermark="4000 days"), available_now=True
        ).awaitTermination()
    return read_daily_rollup(spark, name)


def catalog_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bootstrapped layers filled from the given tables: columns with types, and rows."""
    catalog = _new_catalog(spark)
    raw, silver = bank.bronze(spark, sf_dir), bank.silver(spark, sf_dir)
    filled = {
        f"{catalog.bronze}.customers_raw": raw.customers,
        f"{catalog.bronze}.branches_raw": raw.branches,
        f"{catalog.bronze}.transactions_raw": raw.transactions,
        f"{catalog.silver}.cat_customers": silver.customers,
        f"{catalog.silver}.cat_branches": silver.branches,
        f"{catalog.silver}.cat_transactions": silver.transactions,
    }
    parts = []
    for name, frame in filled.items():
        frame.write.insertInto(name, overwrite=True)
        stored = read_table(spark, name)
        columns = F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"))
                for c, t, _ in P.schema_report(stored)
            ]
        )
        layer, table = name.split(".")
        parts.append(
            stored.agg(F.count("*").alias("row_count")).select(
                F.lit(layer.split("_")[0]).alias("layer"),
                F.lit(table).alias("table_name"),
                F.inline(columns),
                "row_count",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _as_text(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DoubleType):
        value = F.floor(value * 10_000 + 0.5)
    elif isinstance(field.dataType, T.TimestampType):
        value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(value.cast("string"), F.lit("~"))


def _content(df: DataFrame) -> Column:
    """Aggregate: a sum over all rows of a hash of the row's values, columns by name; order does not count."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    row = F.md5(F.concat_ws("|", *[_as_text(f) for f in fields]))
    return F.coalesce(F.sum(F.conv(F.substring(row, 1, 8), 16, 10).cast("bigint")), F.lit(0))


def publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and content of every published table; of the approximate medians only the groups."""
    catalog = _new_catalog(spark)
    contents = []
    for name in publish_gold(bank.silver(spark, sf_dir), bank.GOLD, catalog):
        table = read_table(spark, name)
        if name.endswith(".median_table"):
            table = table.drop("median_amount_usd")
        contents.append(
            table.agg(
                F.lit(name.split(".")[1]).alias("table_name"),
                F.count("*").alias("row_count"),
                _content(table).alias("content_hash"),
            )
        )
    return reduce(DataFrame.unionByName, contents)


def _deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Most rows up to a day, then the rest: later ones, and late ones of all months before."""
    transactions = bank.silver(spark, sf_dir).transactions
    late = F.coalesce((F.col("timestamp") >= "1998-01-01") | F.col("transaction_id").endswith("7"), F.lit(True))
    return [transactions.filter(~late), transactions.filter(late)]


def incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and content of the tables published from two deliveries; of the approximate medians only the groups."""
    silver, store = bank.silver(spark, sf_dir), GoldStore(spark, _new_catalog(spark), bank.GOLD)
    written: list[str] = []
    for number, rows in enumerate(_deliveries(spark, sf_dir)):
        written = store.publish(silver.customers, silver.branches, store.add(f"delivery-{number}", rows))
    contents = []
    for name in written:
        table = read_table(spark, name).drop("period")
        if name.endswith(".median_table"):
            table = table.drop("median_amount_usd")
        contents.append(
            table.agg(
                F.lit(name.split(".")[1]).alias("table_name"),
                F.count("*").alias("row_count"),
                _content(table).alias("content_hash"),
            )
        )
    return reduce(DataFrame.unionByName, contents)


def _sketched(spark: SparkSession, sf_dir: str, family: str) -> GoldStore:
    store = GoldStore(spark, _new_catalog(spark), bank.GOLD, kept=(family,))
    for number, rows in enumerate(_deliveries(spark, sf_dir)):
        store.add(f"delivery-{number}", rows)
    return store


def sketched_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the rank of each median from stored sketches is within a hundredth of the middle."""
    amounts = bank.silver(spark, sf_dir).transactions.select("channel", R.AMOUNT)
    return _placed_medians(amounts, _sketched(spark, sf_dir, "medians").medians(), 100)


def sketched_uniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile from stored sketches, its distinct counts held against exact ones."""
    store = _sketched(spark, sf_dir, "uniques")
    rows = bank.silver(spark, sf_dir).transactions.select(*store.profiled)
    exact = P.exact_unique(rows).withColumnRenamed("unique_count", "__exact")
    close = F.abs(F.col("unique_count") - F.col("__exact")) <= 0.064 * F.col("__exact")
    return store.profile().join(exact, "column_name").select(
        "column_name", "total_count", "non_null_count", close.alias("unique_within_bound")
    )


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions fill the upper buckets, events the lower ones."""
    amounts = bank.silver(spark, sf_dir).transactions.select(R.AMOUNT)
    return R.amount_histogram(amounts.unionByName(bank.event_amounts(spark, sf_dir).select(R.AMOUNT)))


def joined_branch_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = bank.silver(spark, sf_dir)
    return J.join_customer_branch_transaction(s.customers, s.branches, s.transactions)


def full_outer_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions, a third of them under one key, and customers, each with those that match none of the other."""
    s = bank.silver(spark, sf_dir)
    third = F.substring("transaction_id", 2, 20).cast("bigint") % 3 == 0
    owner = F.when(third, "C1").when(F.col("customer_id").endswith("9"), "C0").otherwise(F.col("customer_id"))
    spending = s.transactions.select("transaction_id", R.AMOUNT, owner.alias("customer_id"))
    return J.full_outer([spending, s.customers.select("customer_id", "name")], ["customer_id"], rows_per_task=1000)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.clean_transactions(bank.raw_transactions(spark, sf_dir), bank.CLEANING)


def _on_raw_transactions(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(bank.raw_transactions(spark, sf_dir))


def _on_raw_customers(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(bank.raw_customers(spark, sf_dir))


def _on_transactions(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(bank.silver(spark, sf_dir).transactions)


def _on_silver(build: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: build(bank.silver(spark, sf_dir))


def _by(*keys: str) -> Query:
    return _on_transactions(lambda t: R.rollup(t, keys))


def _by_branch(attribute: str) -> Query:
    return _on_silver(
        lambda s: R.rollup_by_attribute(s.transactions, s.branches, "branch_id", attribute)
    )


def _scores(detect, flag: str) -> Query:
    return _on_transactions(
        lambda t: detect(t, bank.FRAUD).filter(F.col(flag).isNotNull()).select("transaction_id", flag)
    )


ORDER = ["timestamp", "transaction_id"]
POINT = ["transaction_id", "channel", "timestamp", "Amount_USD"]
BY_CHANNEL = ("Amount_USD", ["channel"], ORDER)


def queries() -> dict[str, Query]:
    return {
        "scan_csv": scan_csv,
        "scan_table": scan_table,
        "sink_overwrite": sink_overwrite,
        "sink_csv": sink_csv,
        "catalog_bootstrap": catalog_bootstrap,
        "publish_gold": publish,
        "incremental_gold": incremental_gold,
        "sketched_medians": sketched_medians,
        "sketched_uniques": sketched_uniques,
        "rescued_rows": rescued_rows,
        "stream_ingest": stream_ingest,
        "stream_rescued": stream_rescued,
        "stream_widening": stream_widening,
        "stream_customers": stream_customers,
        "stream_profile": stream_profile,
        "stream_silver": stream_silver,
        "stream_latest": stream_latest,
        "stream_rollup": stream_rollup,
        "dedup_any": _on_raw_transactions(
            lambda t: C.remove_duplicates(t, ["transaction_id"]).select("transaction_id")
        ),
        "fill_then_drop": _on_raw_transactions(
            lambda t: C.handle_missing_values(t, bank.CLEANING.transaction_fill)
        ),
        "cast_columns": _on_raw_customers(
            lambda c: C.validate_data_types(
                c.select("customer_id", "phone", "credit_score", "join_date"),
                {"phone": "bigint", "credit_score": "double", "join_date": "string"},
            )
        ),
        "trim_strings": _on_raw_customers(C.trim_whitespaces),
        "range_filter": _on_raw_transactions(
            lambda t: C.remove_invalid_values(t, {"amount": bank.CLEANING.amount_range})
        ),
        "uniqueness_violations": _on_raw_transactions(
            lambda t: C.uniqueness_violations(t, ["transaction_id"])
        ),
        "upper_strings": _on_raw_transactions(C.capitalize_string_data),
        "flag_anomalies": _on_raw_transactions(
            lambda t: C.flag_anomalies(
                t.select("transaction_id", "amount", "currency"),
                {"large": F.col("amount") > 100000, "no_currency": F.col("currency").isNull()},
            )
        ),
        "rule_report": _on_raw_transactions(lambda t: Q.rule_report(t, bank.CHECKS, "transaction_id")),
        "broken_rules": _on_raw_transactions(
            lambda t: Q.broken_rules(t, bank.CHECKS).select(
                "transaction_id", F.array_join("broken_rules", "; ").alias("broken_rules")
            )
        ),
        "dedup_latest": _on_raw_transactions(
            lambda t: C.clean_duplicate_transactions(t, ["transaction_id"], "timestamp")
        ),
        "clean_customers": _on_raw_customers(lambda c: C.clean_customers(c, bank.CLEANING)),
        "clean_branches": lambda spark, sf_dir: C.clean_branches(
            bank.raw_branches(spark, sf_dir), bank.CLEANING
        ),
        "clean_transactions": clean,
        "profile_exact": _on_raw_transactions(lambda t: P.data_summary(t, digits=4)),
        "profile_approx": profile_approx,
        "null_counts": _on_raw_transactions(P.null_counts),
        "format_dates": _on_raw_customers(
            lambda c: E.format_dates(
                c.select("customer_id", "join_date", "last_update"), ["join_date"], ["last_update"]
            )
        ),
        "date_parts": _on_raw_transactions(
            lambda t: E.extract_date_parts(t, "timestamp", Month=True, Day=True).select(
                "transaction_id", "year", "month", "day"
            )
        ),
        "phone_digits": _on_raw_customers(
            lambda c: E.format_phone_numbers(c.select("customer_id", "phone"), "phone")
        ),
        "email_domain": _on_raw_customers(
            lambda c: E.domain_extract(c, "email").select("customer_id", "domain")
        ),
        "postal_code": _on_raw_customers(
            lambda c: E.extract_pincode(c, "address", "postal_code").select(
                "customer_id", "postal_code"
            )
        ),
        "geo_lookup": lambda spark, sf_dir: E.add_coordinates(
            C.clean_branches(bank.raw_branches(spark, sf_dir), bank.CLEANING),
            bank.gazetteer(spark, sf_dir),
        ).select("branch_id", "location", "latitude", "longitude"),
        "currency_to_usd": lambda spark, sf_dir: E.convert_currency_to_usd(
            clean(spark, sf_dir), bank.rates(spark)
        ).select("transaction_id", "currency", "amount", "Amount_USD"),
        "missing_rates": lambda spark, sf_dir: E.count_missing_rates(
            clean(spark, sf_dir), bank.rates(spark).filter(F.col("currency").isin("USD", "EUR"))
        ),
        "silver_customers": _on_silver(lambda s: s.customers),
        "silver_branches": _on_silver(lambda s: s.branches),
        "silver_transactions": _on_silver(lambda s: s.transactions),
        "txn_with_location": _on_silver(
            lambda s: J.transaction_with_location(s.transactions, s.branches)
        ),
        "join_three": joined_branch_tables,
        "full_outer_flags": _on_transactions(
            lambda t: fraud.flagged_by_outer_joins(t, bank.FRAUD)
        ),
        "full_outer_skewed": full_outer_skewed,
        "monthly_counts": _on_transactions(R.monthly_counts),
        "customer_type_agg": _on_silver(
            lambda s: R.customer_type_totals(s.customers, s.transactions)
        ),
        "active_churned": _on_transactions(R.active_churned),
        "agg_customer": _by("customer_id"),
        "currency_analysis": _on_transactions(R.currency_analysis),
        "agg_branch": _by("branch_id"),
        "agg_location": _by_branch("location"),
        "agg_timezone": _by_branch("timezone"),
        "agg_currency": _by("currency"),
        "agg_channel": _by("channel"),
        "agg_txn_type": _by("transaction_type"),
        "agg_year_month": _by("year", "month"),
        "agg_date": _on_transactions(R.rollup_by_date),
        "agg_status": _by("status"),
        "agg_channel_type": _by("channel", "transaction_type"),
        "segment_counts": _on_silver(
            lambda s: S.segment_counts(S.segment_members(s.customers, s.transactions, bank.SEGMENTS))
        ),
        "value_tiers": lambda spark, sf_dir: R.value_tiers(
            bank.event_amounts(spark, sf_dir), *bank.TIER_EDGES
        ),
        "last_transaction": _on_transactions(R.last_transactions),
        "churn_status": _on_transactions(R.churn_status),
        "peak_offpeak": _on_transactions(R.peak_off_peak),
        "amount_histogram": histogram,
        "median_exact": _on_transactions(R.median_exact),
        "median_approx": median_approx,
        "percent_of_total": _on_transactions(R.percent_of_total),
        "recent_customers": _on_transactions(lambda t: S.recent_customers(t, bank.SEGMENTS)),
        "segment_high_value": _on_transactions(lambda t: S.high_value(t, bank.SEGMENTS)),
        "segment_new_user": _on_silver(lambda s: S.new_user(s.customers, bank.SEGMENTS)),
        "segment_inactive": _on_silver(
            lambda s: S.inactive(s.customers, s.transactions, bank.SEGMENTS)
        ),
        "segment_credit_risk": _on_silver(lambda s: S.credit_risk(s.customers, bank.SEGMENTS)),
        "segment_loyal": _on_silver(lambda s: S.loyal(s.customers, bank.SEGMENTS)),
        "customer_segmentation": _on_silver(
            lambda s: S.customer_segmentation(s.customers, s.transactions, bank.SEGMENTS)
        ),
        "fraud_pattern": _scores(fraud.detect_pattern_anomaly, "pattern_anomaly"),
        "fraud_unusual": _scores(fraud.detect_unusual_amount, "unusual_amount"),
        "fraud_watchlist": _scores(fraud.detect_watchlist_match, "watchlist_match"),
        "fraud_velocity": _scores(fraud.detect_velocity_check, "velocity_check"),
        "fraud_flags": _on_transactions(lambda t: fraud.fraud_flags(t, bank.FRAUD)),
        "last_txn_window": _on_transactions(
            lambda t: W.with_last_transaction(t.select("transaction_id", "customer_id", "timestamp"))
        ),
        "cumulative_sum": _on_transactions(
            lambda t: W.cumulative_sum(t.select(*POINT), *BY_CHANNEL, bucket=W.day_of("timestamp"))
        ),
        "rolling_avg_rows": _on_transactions(
            lambda t: W.rolling_average_rows(
                t.select(*POINT), *BY_CHANNEL, bucket=W.day_of("timestamp")
            )
        ),
        "rolling_avg_days": _on_transactions(
            lambda t: W.rolling_average_days(t, "Amount_USD", ["channel"])
        ),
        "sequential_ids": _on_transactions(
            lambda t: W.sequential_ids(t.select(*ORDER), ORDER, "sequence_id", "N").drop("timestamp")
        ),
        "audit_integrity": _on_silver(
            lambda s: audits.audit_integrity(s.customers, s.branches, s.transactions)
        ),
        "audit_currency": _on_silver(lambda s: audits.audit_currency(s.branches, s.transactions)),
        "audit_status_conflicts": _on_raw_transactions(audits.audit_status_conflicts),
    }
