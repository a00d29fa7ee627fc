"""Entity candidates: how they are found, filtered, merged and named.

Order decides ties, so candidates carry one sortable column ``ord`` of (layer, pattern, document, line, match).
"""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import PRONOUNS, entity_uid, isin_valid, lei_valid, nth_occurrence, strip
from ..ontology import Pack, small

#: Where spans overlap, the higher layer stays.
PRECEDENCE = {"regex": 3, "spacy": 2, "llm": 1}
ORD = "ord struct<layer:int,pattern:int,doc:long,line:int,match:int>"
CANDIDATES = f"folder_id string, chunk_id string, {ORD}, surface_form string, entity_type string, layer string, span_start int, span_end int, confidence double"


def _ord(layer: int, pattern, match: str) -> Column:
    return F.struct(F.lit(layer).alias("layer"), F.lit(pattern).cast("int").alias("pattern") if isinstance(pattern, int) else F.col(pattern).cast("int").alias("pattern"), F.col("doc_id").cast("long").alias("doc"), F.col("line_no").cast("int").alias("line"), F.col(match).cast("int").alias("match"))


def _finditer(patterns: list[tuple[int, str]], text_at: int):
    """All matches of all patterns in one pass over each text; linear in its length."""
    compiled = [(n, re.compile(p)) for n, p in patterns]

    def run(batches):
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(text_at).to_pylist()):
                for n, pattern in compiled:
                    for k, m in enumerate(pattern.finditer(text or "")):
                        rows.append(row)
                        found.append((n, k, m.start(), m.end(), m[0]))
            columns = [c.take(pa.array(rows, pa.int64())) for i, c in enumerate(batch.columns) if i != text_at]
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string())
            more = [pa.array(c, t) for c, t in zip(zip(*found, strict=True) if found else [[]] * 5, types, strict=True)]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.record_batch([*columns, *more], names=[*names, "pattern_idx", "match_idx", "span_start", "span_end", "surface_form"])

    return run


def find_patterns(chunks: DataFrame, patterns: list[tuple[int, str]]) -> DataFrame:
    """Non-overlapping matches of each pattern in each chunk, offsets in code points.

    Patterns are Python's; a zero-width match is a match.
    """
    slim = chunks.select("folder_id", "chunk_id", "doc_id", "line_no", "text")
    schema = "folder_id string, chunk_id string, doc_id long, line_no int, pattern_idx int, match_idx int, span_start int, span_end int, surface_form string"
    return slim.select("folder_id", "chunk_id", F.col("doc_id").cast("long"), F.col("line_no").cast("int"), "text").mapInArrow(_finditer(patterns, 4), schema)


def regex_entities(chunks: DataFrame, pack: Pack) -> DataFrame:
    """Candidates of the pack's patterns, those with a checksum only where it holds."""
    found = find_patterns(chunks, [(i, p["pattern"]) for i, p in enumerate(pack.regex_patterns)])
    if not pack.regex_patterns:
        return found.select(*_columns(0, F.lit(None).cast("string"), "regex", F.lit(1.0)))
    kind = F.element_at(F.array(*[F.lit(p["entity_type"]) for p in pack.regex_patterns]), F.col("pattern_idx") + 1)
    valid = F.lit(True)
    for check, holds in (("lei", lei_valid), ("isin", isin_valid)):
        marked = [i for i, p in enumerate(pack.regex_patterns) if p.get("checksum") == check]
        if marked:
            valid &= ~F.col("pattern_idx").isin(*marked) | holds(F.col("surface_form"))
    return found.where(valid).select(*_columns(0, kind, "regex", F.lit(1.0)))


def _columns(layer: int, kind: Column, name: str, confidence: Column, pattern="pattern_idx", match="match_idx") -> list[Column]:
    return [F.col("folder_id"), F.col("chunk_id"), _ord(layer, pattern, match).alias("ord"), F.col("surface_form"), kind.alias("entity_type"), F.lit(name).alias("layer"), F.col("span_start"), F.col("span_end"), confidence.cast("double").alias("confidence")]


def map_labels(annotations: DataFrame, chunks: DataFrame, pack: Pack) -> DataFrame:
    """Annotations whose label the pack maps to a type; others are not produced, nor counted."""
    labels = small(pack.label_table(annotations.sparkSession), len(pack.labels()))
    found = annotations.join(labels, "label").join(chunks.select("folder_id", "chunk_id", "doc_id", "line_no"), "chunk_id")
    found = found.select("folder_id", "chunk_id", "doc_id", "line_no", F.col("ord").alias("match_idx"), F.col("text").alias("surface_form"), F.col("type").alias("__type"), F.col("start").cast("int").alias("span_start"), F.col("end").cast("int").alias("span_end"))
    return found.select(*_columns(1, F.col("__type"), "spacy", F.lit(1.0), pattern=0))


def without_pronouns(candidates: DataFrame) -> DataFrame:
    """E07."""
    return candidates.where(~F.lower(strip(F.col("surface_form"))).isin(*PRONOUNS))


def closed_vocabulary(candidates: DataFrame, pack: Pack, entity_types: tuple[str, ...] = (), threshold: float = 0.0) -> DataFrame:
    """Known types, of the wanted ones (none named: all), at or above the threshold."""
    known = candidates.where(F.col("entity_type").isin(*pack.parents))
    if entity_types:
        known = known.where(F.col("entity_type").isin(*entity_types))
    return known.where(~(F.col("confidence") < threshold))


def unmapped_counts(candidates: DataFrame, pack: Pack) -> DataFrame:
    """(folder_id, unmapped_type_count): candidates of types the pack does not know."""
    unknown = ~F.coalesce(F.col("entity_type").isin(*pack.parents), F.lit(False))
    return candidates.groupBy("folder_id").agg(F.count_if(unknown).alias("unmapped_type_count"))


def screened(candidates: DataFrame, verdicts: DataFrame, key: str = "ord") -> DataFrame:
    """Candidates not blocked; verdicts of another number than candidates in a folder are not trusted.

    ``verdicts`` has (folder_id, key, allowed), one row per candidate.
    """
    asked = candidates.groupBy("folder_id").agg(F.count("*").alias("__asked"))
    told = verdicts.groupBy("folder_id").agg(F.count("*").alias("__told"))
    trusted = asked.join(told, "folder_id").where("__asked = __told").select("folder_id")
    blocked = verdicts.where("not allowed").join(trusted, "folder_id", "left_semi").select("folder_id", key)
    return candidates.join(blocked, ["folder_id", key], "left_anti")


def occurrence_index(candidates: DataFrame) -> DataFrame:
    """Running number of equal mentions without a span in a chunk; 0 for those with one."""
    same = Window.partitionBy("folder_id", "chunk_id", "entity_type", "surface_form", F.col("span_start").isNull()).orderBy("ord")
    return candidates.withColumn("occurrence_idx", F.when(F.col("span_start").isNull(), F.row_number().over(same) - 1).otherwise(0))


def _greedy(key_at: list[int], start_at: int, end_at: int):
    """Rows come by chunk, then precedence: keep what overlaps nothing kept. Kept spans are disjoint, so bisection
    finds the only neighbours that can overlap, and a chunk of n candidates costs n log n."""

    def run(batches):
        chunk, kept = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in key_at), strict=True))
            keep = []
            for key, a, b in zip(keys, batch.column(start_at).to_pylist(), batch.column(end_at).to_pylist(), strict=True):
                if key != chunk:
                    chunk, kept = key, []
                if a is None or b is None:
                    keep.append(True)
                    continue
                at = bisect.bisect_left(kept, (b,))
                free = at == 0 or kept[at - 1][1] <= a
                if free:
                    bisect.insort(kept, (a, b))
                keep.append(free)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def merge_layers(candidates: DataFrame) -> DataFrame:
    """Of overlapping spans in a chunk the one of higher precedence stays, then the earlier start, then order.

    Repeats without a span are numbered on the way (A02): one shuffle by chunk serves both, none where candidates lie
    by chunk already.
    """
    rank = F.lit(0)
    for layer, weight in PRECEDENCE.items():
        rank = F.when(F.col("layer") == layer, weight).otherwise(rank)
    numbered = occurrence_index(candidates.repartition("chunk_id"))
    columns = numbered.columns
    ranked = numbered.withColumn("__rank", -rank).sortWithinPartitions("folder_id", "chunk_id", "__rank", F.col("span_start").asc_nulls_last(), "ord")
    at = [columns.index(c) for c in ("folder_id", "chunk_id", "span_start", "span_end")]
    return ranked.select(*columns).mapInArrow(_greedy(at[:2], at[2], at[3]), numbered.schema)


def entity_records(candidates: DataFrame, pack: Pack, model_id: str | None = None) -> DataFrame:
    """Rows of the entity table (A03, E19); a model is named only for mentions it made."""
    return candidates.select(
        "folder_id", "ord",
        entity_uid(F.col("folder_id"), F.col("chunk_id"), F.col("entity_type"), F.col("surface_form"), F.col("span_start"), F.col("occurrence_idx")).alias("entity_uid"),
        "entity_type", "surface_form", F.col("chunk_id").alias("source_chunk_id"), "span_start", "span_end", "occurrence_idx", "confidence",
        F.col("layer").alias("extractor"), F.lit(pack.name).alias("ontology_pack"), F.lit(pack.version).alias("ontology_version"),
        F.when(F.col("layer") == "llm", F.lit(model_id)).alias("model_id"), F.lit("staged").alias("stage"),
    )


def top_entities(entities: DataFrame, n: int = 10) -> DataFrame:
    """The n (20 at most) most frequent (type, surface) of each folder, first seen first among equals."""
    counts = entities.groupBy("folder_id", "entity_type", "surface_form").agg(F.count("*").alias("mention_count"), F.min("ord").alias("__first"))
    place = Window.partitionBy("folder_id").orderBy(F.col("mention_count").desc(), "__first")
    return counts.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= max(0, min(n, 20))).drop("__first")


def folder_summary(status: DataFrame, entities: DataFrame, edges: DataFrame, counters: list[DataFrame] = (), n: int = 10, pack: Pack | None = None, votes: int = 1) -> DataFrame:
    """One row per folder that did not fail, also where nothing was found in it.

    ``status`` has (folder_id, status); ``counters`` are further (folder_id, count) tables, missing folders count 0.
    """
    out = status.where("status <> 'failed'").select("folder_id")
    found = entities.groupBy("folder_id").agg(F.count("*").alias("entity_count"), F.count_distinct("entity_type").alias("distinct_types"))
    for table in (found, edges.groupBy("folder_id").agg(F.count("*").alias("edge_count")), *counters):
        out = out.join(table, "folder_id", "left")
    item = "array<struct<entity_type:string,surface_form:string,mention_count:bigint>>"
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "entity_type", "surface_form", "mention_count"))), lambda x: F.struct(x["entity_type"].alias("entity_type"), x["surface_form"].alias("surface_form"), x["mention_count"].alias("mention_count")))
    out = out.fillna(0).join(top_entities(entities, n).groupBy("folder_id").agg(listed.alias("top_entities")), "folder_id", "left")
    named = {"ontology_pack": pack and pack.name, "ontology_version": pack and pack.version}
    out = out.withColumn("top_entities", F.coalesce("top_entities", F.array().cast(item)))
    return out.withColumns({k: F.lit(v).cast("string") for k, v in named.items()} | {"self_consistency_votes": F.lit(votes)})


def spans_of(items: DataFrame, chunks: DataFrame) -> DataFrame:
    """Items (chunk_id, surface, item) with the span of the matching occurrence of their surface.

    One shuffle of the items by chunk serves their numbering, their texts and what follows by chunk.
    """
    seen = Window.partitionBy("chunk_id", "surface").orderBy("item")
    placed = items.repartition("chunk_id").withColumn("__k", F.row_number().over(seen) - 1).join(chunks.select("folder_id", "chunk_id", "doc_id", "line_no", F.col("text").alias("__text")), "chunk_id")
    start = nth_occurrence(F.col("__text"), F.col("surface"), F.col("__k"))
    placed = placed.withColumn("span_start", start).withColumn("span_end", F.col("span_start") + F.char_length("surface"))
    return placed.drop("__text", "__k")
