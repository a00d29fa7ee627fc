"""Sinks: whole partitions replaced, rows upserted by key, statements written, summaries reported."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.text import digest
from .scratch import discard, put

log = logging.getLogger(__name__)


def replace_folders(df: DataFrame, path: str, folders: DataFrame | None = None, partition: str = "folder_id") -> None:
    """Write df; of what is there only the processed folders are replaced (S06). Running it again changes nothing.

    ``folders`` (None: those in df) has one row per processed folder: one that is not in df had nothing to be written,
    and what it held before goes. Only such folders come to the driver, one by one.
    """
    spark = df.sparkSession
    if folders is not None:
        empty = folders.select(partition).distinct().join(df.select(partition).distinct(), partition, "left_anti")
        name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        for (folder,) in empty.toLocalIterator():
            discard(spark, f"{path}/{name(partition, folder)}")
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def upsert(current: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """Rows of both tables, one per key: the new one where there is one, of several the last by ``order``."""
    last = Window.partitionBy(*key).orderBy(F.col("__new").desc(), F.col(order).desc())
    both = current.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    return both.withColumn("__rank", F.row_number().over(last)).where("__rank = 1").drop("__rank", "__new")


def resolve_written(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges both of whose ends were written.

    Rows meet by digests of the uids, so that of an edge only what is wanted of it is shuffled beside 16 bytes an end.
    """
    columns, known = edges.columns, entities.where("entity_uid is not null").select(*(c.alias(n) for c, n in zip(digest("entity_uid"), ("__h1", "__h2"), strict=True)))
    for end in ("src", "dst"):
        uid = f"{end}_entity_uid"
        edges = edges.where(F.col(uid).isNotNull()).withColumns(dict(zip((f"__{end}1", f"__{end}2"), digest(uid), strict=True)))
    for end in ("src", "dst"):
        edges = edges.join(known.hint("shuffle_hash"), (F.col(f"__{end}1") == F.col("__h1")) & (F.col(f"__{end}2") == F.col("__h2")), "left_semi")
    return edges.select(*columns)


def write_statements(statements: DataFrame, writer: Callable[[Iterator[Row]], None]) -> int:
    """Hand the statements to a writer, all nodes before any edge (S13); returns how many there were.

    They are made once, and stay written until all are handed over.
    """
    spark, path = statements.sparkSession, put(statements, "statements")
    made = spark.read.schema(statements.schema).parquet(path)
    for kind in (0, 1):
        made.where(F.col("kind") == kind).foreachPartition(writer)
    count = made.count()
    discard(spark, path)
    return count


def folder_payloads(status: DataFrame, summary: DataFrame, usage: DataFrame | None = None) -> DataFrame:
    """What a caller is told of each folder: its state, for those that did not fail the summary, and usage if any.

    Fields of a failed folder are null, so that JSON leaves them out; no mention, edge or text is among them.
    """
    done = summary.join(status.where("status <> 'failed'").select("folder_id"), "folder_id", "left_semi")
    out = status.drop("n_chunks").join(done, "folder_id", "left")
    if usage is not None:
        calls = F.array_sort(F.collect_list(F.struct("model", "calls", "input_tokens", "output_tokens")))
        out = out.join(usage.groupBy("folder_id").agg(calls.alias("usage")), "folder_id", "left")
    return out


def write_summary(summary: DataFrame, path: str, send: Callable[[dict], None] | None = None) -> None:
    """One JSON line per folder, fields of a failed folder left out.

    ``send`` gets the same thin payloads; its errors are logged and never fail the job, and no text is logged (H09).
    """
    summary.write.mode("overwrite").option("ignoreNullFields", "true").json(path)
    if send is not None:
        for row in summary.select(F.to_json(F.struct("*"))).toLocalIterator():
            try:
                send(json.loads(row[0]))
            except Exception as error:  # noqa: BLE001
                log.warning("a summary was not delivered: %s", type(error).__name__)
