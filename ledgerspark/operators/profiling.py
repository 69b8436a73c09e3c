"""Column profiles as long-form frames."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


STATS = ("non_null_count", "mean", "stddev", "min", "max")


def column_stats(name: str, kind: T.DataType) -> dict[str, Column]:
    """Aggregates of one column; all but the count are null for types that are not numeric."""
    numeric = isinstance(kind, T.NumericType)
    value = F.col(name).cast("double") if numeric else None
    stats = {"non_null_count": F.count(name)}
    for out, fn in (("mean", F.avg), ("stddev", F.stddev), ("min", F.min), ("max", F.max)):
        stats[out] = fn(value) if numeric else F.lit(None).cast("double")
    return stats


def approx_unique(name: str, relative_error: float) -> dict[str, Column]:
    return {"unique_count": F.approx_count_distinct(name, relative_error)}


def summarise(
    df: DataFrame, stats_of: Callable[[T.StructField], dict[str, Column]], stats: Sequence[str]
) -> DataFrame:
    """One aggregate over the frame, turned to one row per column."""
    aggregates = [F.count("*").alias("total_count")]
    for field in df.schema.fields:
        for stat, value in stats_of(field).items():
            aggregates.append(value.alias(f"{field.name}__{stat}"))
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}__{s}`").alias(s) for s in stats])
        for c in df.columns
    ]
    nulls = (F.col("total_count") - F.col("non_null_count")).alias("null_count")
    long = df.agg(*aggregates).select("total_count", F.inline(F.array(*rows)))
    rest = [s for s in stats if s != "non_null_count"]
    return long.select("column_name", "total_count", "non_null_count", nulls, *rest)


def exact_unique(df: DataFrame) -> DataFrame:
    """Distinct non-null values per column.

    Columns are stacked into (column, value) pairs that combine on the map side, so a row of the
    shuffle is one value and not the whole width of the table.
    """
    texts = [_as_text(field) for field in df.schema.fields]
    pairs = df.select(F.posexplode(F.array(*texts)).alias("place", "value"))
    distinct = pairs.filter(F.col("value").isNotNull()).distinct()
    name = F.get(F.array(*[F.lit(c) for c in df.columns]), F.col("place"))
    return distinct.groupBy(name.alias("column_name")).agg(F.count("*").alias("unique_count"))


def exact_summary(df: DataFrame) -> DataFrame:
    """Counts, distinct values and moments per column, all from one shuffle.

    Columns are stacked into (column, value) pairs and counted per pair, nulls too; everything else
    follows from those counts. Deviations are taken from the mean, which is one number per column.
    """
    fields = df.schema.fields
    numeric = F.get(F.array(*[F.lit(isinstance(f.dataType, T.NumericType)) for f in fields]), F.col("place"))
    value = F.when(numeric, F.col("value").try_cast("double"))
    pairs = (
        df.select(F.posexplode(F.array(*[_as_text(f) for f in fields])).alias("place", "value"))
        .groupBy("place", "value")
        .agg(F.count("*").alias("n"))
    )
    there = F.when(F.col("value").isNotNull(), F.col("n"))
    counts = pairs.groupBy("place").agg(
        F.sum("n").alias("total_count"),
        F.sum(there).alias("non_null_count"),
        F.count("value").alias("unique_count"),
        F.try_divide(F.sum(value * F.col("n")), F.sum(there)).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    # One row per column, so what is broadcast is as bounded as the schema.
    centred = pairs.join(F.broadcast(counts.select("place", "mean")), "place")
    squares = centred.groupBy("place").agg(
        F.sum((value - F.col("mean")) ** 2 * F.col("n")).alias("__squares")
    )
    columns = df.sparkSession.range(0, len(fields), 1, 1).select(F.col("id").cast("int").alias("place"))
    known = columns.join(F.broadcast(counts), "place", "left").join(F.broadcast(squares), "place", "left")
    number = {c: F.coalesce(c, F.lit(0)) for c in ("total_count", "non_null_count", "unique_count")}
    spread = F.sqrt(F.col("__squares") / (F.col("non_null_count") - 1))
    return known.withColumns(number).select(
        F.get(F.array(*[F.lit(f.name) for f in fields]), F.col("place")).alias("column_name"),
        "total_count",
        "non_null_count",
        (F.col("total_count") - F.col("non_null_count")).alias("null_count"),
        "unique_count",
        "mean",
        F.when(F.col("non_null_count") > 1, spread).alias("stddev"),
        "min",
        "max",
    )


def _as_text(field: T.StructField) -> Column:
    """A value as text that tells equal from different; -0.0 and 0.0 are one value."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        value = value.cast("double") + F.lit(0.0)
    return value.cast("string")


def data_summary(
    df: DataFrame, approx: bool = False, relative_error: float = 0.05, digits: int | None = None
) -> DataFrame:
    """Rows, non-nulls, nulls and distinct values per column; moments of the numeric ones.

    Exact distinct counts shuffle the distinct values of every column; ``approx`` keeps one
    fixed-size sketch per column. Either reads the frame once.
    """

    def stats_of(field: T.StructField) -> dict[str, Column]:
        stats = column_stats(field.name, field.dataType)
        return {**stats, **approx_unique(field.name, relative_error)}

    summary = summarise(df, stats_of, [*STATS, "unique_count"]) if approx else exact_summary(df)
    moments = [F.round(c, digits).alias(c) if digits is not None else c for c in STATS[1:3]]
    return summary.select(
        "column_name",
        "total_count",
        "non_null_count",
        "null_count",
        F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
        *moments,
        "min",
        "max",
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls of every column."""
    return df.agg(
        *[F.coalesce(F.sum(F.col(c).isNull().cast("bigint")), F.lit(0)).alias(c) for c in df.columns]
    )


def schema_report(df: DataFrame) -> list[tuple[str, str, bool]]:
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
