"""From raw documents to token ids: clean, filter, deduplicate, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspark.llm import bpe, dedup, mixing, quality, toxicity
from ledgerspark.llm.common import ship_package
from ledgerspark.llm.queries import table, vocabulary_path
from ledgerspark.scratch import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 for toxicity."""
    return toxicity.keep_clean(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more for quality."""
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    ship_package(spark)
    return dedup.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, with its whole text, shard by shard in shuffled order."""
    ship_package(spark)
    return mixing.shuffled_shards(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the digest of what they decode to."""
    ship_package(spark)
    coded = bpe.encode_documents(docs, vocabulary_path())
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: The classifiers and the mix's draws can't be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
