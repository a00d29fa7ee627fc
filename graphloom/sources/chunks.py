"""Text chunks and the annotation tables that stand for models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Input tables that replace calls to models, by the part of the plan that needs them.
ANNOTATIONS = {
    "ner": "chunk_id string, ord long, label string, text string, start int, end int",
    "tokens": "chunk_id string, i int, text string, lemma string, dep string, head int, sent_id int, sent_text string",
    "responses": "chunk_id string, mode string, run_idx int, attempt int, batch_no int, body string, error_code string",
    "rewrites": "chunk_id string, rewritten string",
    "sentences": "chunk_id string, sent_idx int, start int, end int",
    "verdicts": "folder_id string, ord struct<layer:int,pattern:int,doc:long,line:int,match:int>, allowed boolean",
    "adjudications": "a_uid string, b_uid string, answer string",
}


class MissingAnnotations(ValueError):
    """A plan needs annotation tables that were not given."""


def require(given: dict[str, DataFrame], *names: str) -> None:
    """Fail before planning, not halfway through a job."""
    if missing := [n for n in names if given.get(n) is None]:
        raise MissingAnnotations("missing annotation tables: " + "; ".join(f"{n} ({ANNOTATIONS[n]})" for n in missing))


def read_chunks(df: DataFrame, folder: str = "folder_id", chunk: str = "chunk_id", text: str = "content") -> DataFrame:
    """(folder_id, chunk_id, text) with null text as '' (S01); other columns (such as an order) stay."""
    rest = [c for c in df.columns if c not in (folder, chunk, text)]
    return df.select(F.col(folder).alias("folder_id"), F.col(chunk).alias("chunk_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *rest)


def lines_as_chunks(documents: DataFrame) -> DataFrame:
    """Chunks of a document table: one per line, in the folder of its source.

    The order of chunks is (doc_id, line_no), given here once and never derived from physical order.
    """
    lines = documents.select("source", "doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "text"))
    return lines.select(F.col("source").alias("folder_id"), F.concat_ws("#", "doc_id", "line_no").alias("chunk_id"), "doc_id", "line_no", "text")


def inline_chunk(spark: SparkSession, text: str) -> DataFrame:
    """One chunk for a preview."""
    return spark.createDataFrame([("preview", "sample", 0, 0, text)], "folder_id string, chunk_id string, doc_id long, line_no int, text string")


def folder_status(folders: DataFrame, chunks: DataFrame) -> DataFrame:
    """(folder_id, status, error_message, n_chunks): a folder without chunks failed, one without finds did not."""
    counts = chunks.groupBy("folder_id").agg(F.count("*").alias("n_chunks"))
    n = F.coalesce("n_chunks", F.lit(0).cast("long"))
    return folders.select("folder_id").distinct().join(counts, "folder_id", "left").select(
        "folder_id",
        F.when(n == 0, "failed").otherwise("ok").alias("status"),
        F.when(n == 0, F.concat(F.lit("no chunks in folder "), "folder_id")).alias("error_message"),
        n.alias("n_chunks"),
    )
