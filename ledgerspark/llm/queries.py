"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspark.llm import (
    ann, bpe, dedup, html_text, mixing, negatives, quality, secret_scan, sharding, topk, toxicity, url_filter, whitening
)
from ledgerspark.llm.common import held_out, ship_package

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the pre-tokenizer that belongs to the file of ranks.
RANKS_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path() -> str:
    """The given tokenizer's file, which every executor has."""
    try:
        import public_tokenizers
    except ImportError:
        return TOKENIZER
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def ranks_path() -> str:
    """The given vocabulary's file of ranks, which every executor has."""
    try:
        import public_tokenizers
    except ImportError:
        return RANKS
    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a 3 : 1 : 2 mix of 150% of all words takes of every document."""
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    taken = F.aggregate("copies", F.lit(0).cast("bigint"), lambda sum_, c: sum_ + c["words"])
    shards = F.transform("copies", lambda c: c["shard"]).alias("shards")  # of each copy, in the order of the passes
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), shards)


def _judged(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return _judged(quality.score_quality(docs, model), 0.3)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op4_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search_every_hundredth(table(spark, sf_dir, "embeddings"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search_every_fiftieth(table(spark, sf_dir, "embeddings"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract_text(pages, html_text.fit_on_pages(pages))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return _judged(toxicity.score_toxicity(docs, model), 0.5)


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine_every_hundredth(table(spark, sf_dir, "embeddings"))


def op12_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.span_digests(secret_scan.find_secrets(docs, ranks_path(), RANKS_PATTERN))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_quality": op2_quality,
        "op3_bpe": op3_bpe,
        "op4_shard_by_bytes": op4_shard_by_bytes,
        "op5_exact_top_k": op5_exact_top_k,
        "op6_nearest_neighbours": op6_nearest_neighbours,
        "op7_near_duplicates": op7_near_duplicates,
        "op8_main_text": op8_main_text,
        "op9_toxicity": op9_toxicity,
        "op10_url_rules": op10_url_rules,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_whiten_embeddings": op12_whiten_embeddings,
        "op13_secret_scan": op13_secret_scan,
    }


URLS_SQL = """
WITH parts AS (
    SELECT page_id,
        CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) END AS rest
    FROM pages
), urls AS (
    SELECT page_id,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), numbered AS (
    SELECT row_number() OVER () AS id, * FROM urls
), best AS (
    SELECT id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
    FROM numbered JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM numbered LEFT JOIN best USING (id)
"""


TOP_K_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score
FROM scores
QUALIFY rank <= 10
"""


NEGATIVES_SQL = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
    FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM scores
    WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express."""
    return {"op5_exact_top_k": TOP_K_SQL, "op10_url_rules": URLS_SQL, "op11_hard_negatives": NEGATIVES_SQL}
