"""The canonical graph: edges between canonical entities, kept up to date batch by batch, and its export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import digest, identifier
from ..functions.udfs import sorted_json
from ..sources.scratch import materialize

TRIPLE = ["src_canonical_id", "relation_type", "dst_canonical_id"]
EVIDENCE = 3


def contributing(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Mention edges both of whose ends are canonicalized, with the canonical ids."""
    done = entities.where("canonical_id is not null").select("entity_uid", "canonical_id")
    for end in ("src", "dst"):
        edges = edges.join(done.select(F.col("entity_uid").alias(f"{end}_entity_uid"), F.col("canonical_id").alias(f"{end}_canonical_id")), f"{end}_entity_uid")
    return edges


def _ends(rows: DataFrame, kind: str, name: str) -> DataFrame:
    return rows.select(F.col(f"src_{kind}").alias(name)).union(rows.select(F.col(f"dst_{kind}"))).distinct()


def affected_triples(edges: DataFrame, entities: DataFrame, batch: DataFrame) -> DataFrame:
    """Distinct triples with a mention edge that starts or ends at a mention of the batch (J10); ``batch`` has entity_uid.

    Edges are narrowed to those of the batch before anything else is joined, and entities to the ends of those.
    """
    own = batch.select("entity_uid").distinct()
    near = edges.select("src_entity_uid", "relation_type", "dst_entity_uid")
    for end in ("src", "dst"):
        near = near.join(own.select(F.col("entity_uid").alias(f"{end}_entity_uid"), F.lit(True).alias(f"__{end}")), f"{end}_entity_uid", "left")
    near = materialize(near.where("__src or __dst").drop("__src", "__dst"), "near")
    known = entities.where("canonical_id is not null").join(_ends(near, "entity_uid", "entity_uid"), "entity_uid", "left_semi")
    return contributing(near, known).select(*TRIPLE).distinct()


def history(edges: DataFrame, entities: DataFrame, triples: DataFrame) -> DataFrame:
    """All mention edges of some triples, with the canonical ids of their ends.

    Only mentions of the entities in the triples, then only edges between those, are joined.
    """
    own = entities.where("canonical_id is not null").select("entity_uid", "canonical_id").join(_ends(triples, "canonical_id", "canonical_id"), "canonical_id", "left_semi")
    return contributing(edges, own).join(triples, TRIPLE, "left_semi")


#: Ends of edges are broadcast, not shuffled for, where so many distinct mentions stand at that end at most.
END_ROWS = 500_000


def _resolved(edges: DataFrame, ends: DataFrame) -> DataFrame:
    """Edges with ``src`` and ``dst``, what ``ends`` has of the mentions at their ends: (__h1, __h2, end).

    Edges travel with digests of their uids, once for each end. Where an end has few distinct mentions, those of
    ``ends`` are looked up in place and the edges stay where they are.
    """
    for end in ("src", "dst"):
        edges = edges.withColumns(dict(zip((f"__{end}1", f"__{end}2"), digest(f"{end}_entity_uid"), strict=True)))
    edges = edges.where("src_entity_uid is not null and dst_entity_uid is not null").drop("src_entity_uid", "dst_entity_uid")
    counted = edges.agg(*[F.approx_count_distinct(f"__{end}1").alias(end) for end in ("src", "dst")]).first()
    for end in sorted(("src", "dst"), key=lambda x: counted[x]):
        on = [f"__{end}1", f"__{end}2"]
        own = ends.select(F.col("__h1").alias(on[0]), F.col("__h2").alias(on[1]), F.col("end").alias(end))
        if counted[end] <= END_ROWS:
            own = F.broadcast(own.join(edges.select(*on).distinct(), on, "left_semi"))
        else:
            own = own.hint("shuffle_hash")
        edges = edges.join(own, on).drop(*on)
    return edges


def canonical_edges(edges: DataFrame, entities: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """Canonical edges out of all mention edges both of whose ends are canonicalized (J11, C11), or of those only that
    ``batch`` touches (J10): triples with a mention edge that starts or ends at one of its entity_uid, over all history.

    Canonical ids are numbered, and names come back when there is one row per triple. An edge counts for a triple of
    the batch only between two entities of which one has a mention in the batch; others are left out before any of
    them are grouped.
    """
    done = entities.where("canonical_id is not null and entity_uid is not null").select("entity_uid", "canonical_id")
    if batch is None:
        done = done.withColumn("__own", F.lit(True))
    else:
        done = done.join(batch.select("entity_uid", F.lit(True).alias("__own")).distinct(), "entity_uid", "left").withColumn("__own", F.coalesce("__own", F.lit(False)))
    done = materialize(done.select(*(c.alias(n) for c, n in zip(digest("entity_uid"), ("__h1", "__h2"), strict=True)), "canonical_id", "__own"), "done")
    nodes = materialize(done.groupBy("canonical_id").agg(F.bool_or("__own").alias("__near")).withColumn("no", F.monotonically_increasing_id()), "nodes")
    ends = materialize(done.join(nodes, "canonical_id").select("__h1", "__h2", F.struct("no", "__near", "__own").alias("end")), "ends")
    rows = _resolved(edges.select("folder_id", "ord", "relation_type", "src_entity_uid", "dst_entity_uid", "confidence", "evidence_text"), ends)
    rows = rows.where("src.__near or dst.__near").select("folder_id", "ord", F.col("src.no").alias("src_no"), "relation_type", F.col("dst.no").alias("dst_no"), "confidence", "evidence_text", F.expr("src.__own or dst.__own").alias("__own"))
    found = _aggregated(materialize(rows, "history"), ["src_no", "relation_type", "dst_no"], "ord", F.bool_or("__own").alias("__own")).where("__own").drop("__own")
    for end in ("src", "dst"):
        found = found.join(nodes.select(F.col("no").alias(f"{end}_no"), F.col("canonical_id").alias(f"{end}_canonical_id")), f"{end}_no")
    return found.select(*TRIPLE, "support_count", "confidence", "evidence_text")


def aggregate_edges(rows: DataFrame, order: str = "ord") -> DataFrame:
    """One row per triple (C11): number of folders, highest confidence, the three best pieces of evidence.

    Evidence goes by confidence (none counts as 0), then order, and is not deduplicated; empty ones do not count.
    A rank limit keeps three rows per triple on every side of the shuffle, so no triple is ever gathered whole.
    """
    return _aggregated(rows, TRIPLE, order)


def _aggregated(rows: DataFrame, triple: list[str], order: str, *more: Column) -> DataFrame:
    # Folders of a triple meet first, so that the count of distinct ones needs no second pass.
    by_folder = rows.groupBy(*triple, F.nullif("folder_id", F.lit("")).alias("__folder")).agg(F.max("confidence").alias("confidence"), *more)
    totals = by_folder.groupBy(*triple).agg(F.count("__folder").cast("int").alias("support_count"), F.max("confidence").alias("confidence"), *more)
    given = F.coalesce("confidence", F.lit(0.0))
    place = F.row_number().over(Window.partitionBy(*triple).orderBy(given.desc(), order, "evidence_text"))
    best = rows.where("evidence_text <> ''").select(*triple, "confidence", order, "evidence_text").withColumn("__place", place).where(F.col("__place") <= EVIDENCE)
    best = best.groupBy(*triple).agg(F.transform(F.array_sort(F.collect_list(F.struct("__place", "evidence_text"))), lambda x: x["evidence_text"]).alias("evidence_text"))
    return totals.join(best, triple, "left").withColumn("evidence_text", F.coalesce("evidence_text", F.array().cast("array<string>")))


def refresh_edges(current: DataFrame, edges: DataFrame, entities: DataFrame, batch: DataFrame) -> DataFrame:
    """The canonical edges after a batch: affected triples anew over all history, the others as they were.

    A triple that lost all its rows stays; edges are never deleted here. ``batch`` has the entity_uid of each mention
    that the batch canonicalized.
    """
    new = materialize(canonical_edges(edges, entities, batch), "edges")
    return current.join(new, TRIPLE, "left_anti").select(*new.columns).unionByName(new)


def export_nodes(entities: DataFrame, index: DataFrame, folders: list[str] | None = None) -> DataFrame:
    """One node per canonical entity with its folders and number of mentions.

    No folders, or an empty list, means all; the number counts mentions of the chosen folders only.
    """
    own = entities.where("stage = 'canonicalized'")
    if folders:
        own = own.where(F.col("folder_id").isin(*folders))
    counts = own.groupBy("canonical_id").agg(F.array_sort(F.collect_set("folder_id")).alias("folder_ids"), F.count("*").alias("mention_count"))
    return counts.join(index.select("canonical_id", "entity_type", "normalized_form"), "canonical_id")


def export_edges(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Edges in the columns of the export (X02), of a node set those with either end in it.

    ``dangling`` tells where the other end is not in the set: a store that lacks it will not find the edge.
    """
    out = edges.select(*TRIPLE, "support_count", F.col("confidence").cast("double").alias("confidence"), F.coalesce("evidence_text", F.array().cast("array<string>")).alias("evidence_text"))
    if nodes is None:
        return out.withColumn("dangling", F.lit(False))
    for end in ("src", "dst"):
        ids = nodes.select(F.col("canonical_id").alias(f"{end}_canonical_id"), F.lit(True).alias(f"__{end}"))
        out = out.join(ids, f"{end}_canonical_id", "left")
    there = {end: F.coalesce(f"__{end}", F.lit(False)) for end in ("src", "dst")}
    return out.where(there["src"] | there["dst"]).withColumn("dangling", ~(there["src"] & there["dst"])).select(*TRIPLE, "support_count", "confidence", "evidence_text", "dangling")


def node_statements(nodes: DataFrame) -> DataFrame:
    """Idempotent statements for nodes (X04, X06). Parameters are JSON."""
    # The statements' wording is the interface of the graph store.
    text = F.concat(F.lit("MERGE (n:`"), identifier(F.col("entity_type"), "Entity"), F.lit("` {canonical_id: $canonical_id}) SET n.entity_type = $entity_type, n.normalized_form = $normalized_form, n.provenance = $provenance"))
    provenance = sorted_json(F.to_json(F.struct("folder_ids", "mention_count")))
    params = F.to_json(F.struct("canonical_id", "entity_type", "normalized_form", provenance.alias("provenance")))
    return nodes.select(F.lit(0).alias("kind"), F.col("canonical_id").alias("key"), text.alias("cypher"), params.alias("params"))


def edge_statements(edges: DataFrame) -> DataFrame:
    # Fixed values, as above.
    text = F.concat(F.lit("MATCH (a {canonical_id: $src}), (b {canonical_id: $dst}) MERGE (a)-[r:`"), identifier(F.col("relation_type"), "RELATED_TO"), F.lit("`]->(b) SET r.support_count = $support_count, r.confidence = $confidence, r.evidence_text = $evidence_text"))
    params = F.to_json(F.struct(F.col("src_canonical_id").alias("src"), F.col("dst_canonical_id").alias("dst"), "support_count", "confidence", "evidence_text"), {"ignoreNullFields": "false"})
    return edges.select(F.lit(1).alias("kind"), F.concat_ws("|", *TRIPLE).alias("key"), text.alias("cypher"), params.alias("params"))


def export_statements(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """All statements; (kind, key) is their order, nodes before edges."""
    return node_statements(nodes).union(edge_statements(edges))


def export_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """What was put in, and how many of the edges dangle."""
    n = nodes.agg(F.count("*").alias("node_count"))
    return n.join(edges.agg(F.count("*").alias("relationship_count"), F.count_if("dangling").alias("dangling_count")))
