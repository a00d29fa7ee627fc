"""The queries of the corpus operators: thin views of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .cws import fingerprint
from .embed_join import near_duplicates
from .langid import identify
from .mixing import mix
from .packing import pack
from .pii import scan_personal
from .quality import score_quality
from .secrets import scan_secrets
from .simhash import simhash_groups
from .substrings import remove_repeats


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_personal(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return kept.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_pii, op2_embedding_near_dedup, op3_packing, op4_substring_dedup, op5_quality, op6_fingerprints, op7_mixing, op8_simhash_near_dedup, op9_language_id, op10_secrets)
}

#: op7 again in DuckDB: the same keys, but the plain prefix sum over each whole source in place of buckets.
OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, length(text) AS chars,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
k AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, sha256(coalesce(text, '')))), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0)
         / greatest(0.05, CASE WHEN coalesce(chars, 0) / greatest(size, 1) / 6.0 > 1
             THEN 1 / (coalesce(chars, 0) / greatest(size, 1) / 6.0) ELSE coalesce(chars, 0) / greatest(size, 1) / 6.0 END) AS key
  FROM d),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM d GROUP BY source),
c AS (SELECT *, 3 * source_size AS cap, (3 * source_size) / weight AS ratio FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM c WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         least(cap::DOUBLE, coalesce((SELECT arg_min(level, ratio) FROM l WHERE ratio >= level) * weight, cap::DOUBLE)) AS target
  FROM l),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 0 END AS whole FROM t),
p AS (
  SELECT k.doc_id, k.size, b.source_size, b.target, b.whole, round(b.target)::BIGINT - b.whole * b.source_size AS budget,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS LAST, k.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (whole * size + least(size, greatest(0, budget - ahead)))::BIGINT AS taken FROM p
"""

ORACLE_SQL: dict[str, str] = {"op7_mixing": OP7_SQL}
