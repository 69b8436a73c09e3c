"""Tables that widen: a column that first comes with a later delivery is added, and earlier rows have null in it.

The table's schema is kept in versions, each added once. Files are never rewritten for a new column.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ledgerspark.sources.tables import columns_ddl, overwrite_partitions

DELIVERY = "delivery"

# Types whose values all have their place in the types beside them.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp", "timestamp_ntz"),
}


def _fits(arriving: T.DataType, known: T.DataType) -> bool:
    a, b = arriving.simpleString(), known.simpleString()
    return a == b or a == "void" or b in WIDER.get(a, ()) or (b == "string" and not isinstance(arriving, (T.ArrayType, T.MapType, T.StructType)))


def widened(known: T.StructType, arriving: T.StructType) -> T.StructType:
    """``known`` followed by the columns of ``arriving`` that it lacks.

    Names count without case. A column that arrives with a type whose values would not all keep their meaning in the known
    one is refused, and so are two columns of one name.
    """
    kept = {f.name.lower(): f for f in known}
    added: list[T.StructField] = []
    for field in arriving:
        own = kept.get(field.name.lower())
        if own is None:
            added.append(T.StructField(field.name, T.StringType() if field.dataType == T.NullType() else field.dataType))
        elif not _fits(field.dataType, own.dataType):
            raise ValueError(f"{field.name} is {own.dataType.simpleString()} and arrives as {field.dataType.simpleString()}")
    if len({f.name.lower() for f in arriving}) < len(arriving):
        raise ValueError("two columns share a name")
    return T.StructType([*known.fields, *added])


def read_evolving(spark: SparkSession, table: str) -> DataFrame:
    """The table with the columns it has now; a session does not see by itself what another one, as a stream's, has added."""
    spark.catalog.refreshTable(table)
    return spark.read.table(table)


class SchemaStore:
    """The versions of a schema in a table of its own, with one writer at a time."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name = spark, name

    def versions(self) -> DataFrame:
        """``version, schema`` (as JSON), from 1."""
        return read_evolving(self.spark, self.name)

    def current(self) -> tuple[int, T.StructType]:
        """The last version; 0 and no columns before the first."""
        if not self.spark.catalog.tableExists(self.name):
            return 0, T.StructType()
        last = self.versions().agg(F.max(F.struct("version", "schema")).alias("last")).first()["last"]
        return (last["version"], T.StructType.fromJson(json.loads(last["schema"]))) if last else (0, T.StructType())

    def widen(self, arriving: T.StructType) -> T.StructType:
        """The schema with the columns of ``arriving``, which is a new version if any of them is new."""
        version, known = self.current()
        schema = widened(known, arriving)
        if len(schema) > len(known):
            row = self.spark.range(1).select(F.lit(version + 1).alias("version"), F.lit(schema.json()).alias("schema"))
            row.write.mode("append").format("parquet").saveAsTable(self.name)
        return schema


def aligned(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with the columns of ``schema``, in its order and types; null in those they lack."""
    own = {c.lower(): c for c in rows.columns}
    return rows.select(
        *[
            (F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def deliver(rows: DataFrame, table: str, store: SchemaStore, delivery: int) -> None:
    """Add a numbered delivery to ``table``, which gets the columns that it lacks.

    A delivery is a partition: one that comes again replaces its former self, other files are left as they are. Nothing is
    written of one that does not fit the schema. A delivery without rows adds its columns only.
    """
    if DELIVERY in [c.lower() for c in rows.columns]:
        raise ValueError(f"{DELIVERY} is the table's own column")
    spark, schema = rows.sparkSession, store.widen(rows.schema)
    if spark.catalog.tableExists(table):
        have = {c.lower() for c in read_evolving(spark, table).columns}
        lacking = T.StructType([f for f in schema if f.name.lower() not in have])
        if len(lacking):
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns_ddl(lacking)})")
    placed = aligned(rows, schema).withColumn(DELIVERY, F.lit(delivery).cast("bigint"))
    overwrite_partitions(placed, table, [DELIVERY])


def read_delivery(spark: SparkSession, files: str | Sequence[str], kinds: Mapping[str, T.DataType]) -> DataFrame:
    """CSV files under one header, whose names say which column is which.

    Columns have the types of ``kinds``, others are text. A file with another header is refused when it is read.
    """
    paths = [files] if isinstance(files, str) else list(files)
    known = {name.lower(): kind for name, kind in kinds.items()}
    names = spark.read.option("header", True).csv(paths).columns  # reads one line
    schema = T.StructType([T.StructField(n, known.get(n.lower(), T.StringType())) for n in names])
    return spark.read.csv(paths, schema=schema, header=True, enforceSchema=False)
