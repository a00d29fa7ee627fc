"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import discard, put

#: Links that one task spans; it remembers their nodes.
TASK_LINKS = 500_000


def _spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the components of all batches: each node with another one of its component."""
    number: dict = {}
    above: list[int] = []
    schema = None
    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = number.setdefault(u, len(number)), number.setdefault(v, len(number))
            above.extend(range(len(above), len(number)))
            while above[x] != x:
                above[x] = x = above[above[x]]
            while above[y] != y:
                above[y] = y = above[above[y]]
            if x != y:
                above[max(x, y)] = min(x, y)
    names = list(number)
    kept = [k for k, up in enumerate(above) if up != k]
    for first in range(0, len(kept), 10_000):
        part = kept[first : first + 10_000]
        yield pa.record_batch([pa.array([names[k] for k in part], schema.field(0).type), pa.array([names[above[k]] for k in part], schema.field(1).type)], schema=schema)


def spanning(links: DataFrame, a: str, b: str) -> DataFrame:
    """Links with the same components, no more than nodes in a task: neighbouring nodes are dealt to a task, where many
    links between few nodes come down to a forest. Worth its one shuffle where links are many times the nodes."""
    spark = links.sparkSession
    found = links.where((F.col(a) != F.col(b))).select(a, b)
    path = put(found, "all-links")
    found = spark.read.schema(found.schema).parquet(path)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-found.count() // TASK_LINKS))
    out = found.repartitionByRange(tasks, a).mapInArrow(_spanned, found.schema)
    path, whole = put(out, "forest"), path
    discard(spark, whole)
    return spark.read.schema(found.schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the least node of the component of each node that has a link.

    Links are unordered pairs of nodes of any orderable type; loops, nulls and repeats do not matter. Each round is
    written to the shared folder in place of the one before, so a lost executor never replays earlier rounds, and
    only a count and a checksum reach the driver.
    """
    spark = links.sparkSession
    start = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct()
    path = put(start, "links")
    seen = None
    while True:
        edges = spark.read.schema(start.schema).parquet(path)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        # Stars never make more edges than there were, so their number bounds the next table.
        after = put(_small_star(_large_star(edges)), "stars", state[0])
        discard(spark, path)
        path = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v")).distinct()
