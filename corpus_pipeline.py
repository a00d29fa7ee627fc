"""A corpus pipeline: each stage works on the Parquet table that the stage before it left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graphloom.llm.common import discard, put, table
from graphloom.llm.langid import keep_identified
from graphloom.llm.mixing import apply_mix
from graphloom.llm.packing import pack
from graphloom.llm.secrets import redact_secrets
from graphloom.llm.simhash import drop_near_copies


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the table itself teaches; the others go."""
    return keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, and one row of each document."""
    return drop_near_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them replaced by their kind."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return apply_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 1024 tokens."""
    return pack(docs)


STAGES = [("language", language), ("near_copies", near_copies), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]

#: Prototypes, fingerprints and tokens are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all sequences; a stage's table goes as soon as the next one's is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        path = put(out, name)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            discard(spark, before)
        before = path
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
