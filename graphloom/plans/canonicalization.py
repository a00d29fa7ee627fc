"""Canonicalization of a batch of folders against the index so far."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ontology import load_pack
from ..operators import canon, graph
from ..sources.scratch import materialize


@dataclass(frozen=True)
class Batch:
    entities: DataFrame
    index: DataFrame
    refresh: Callable[[], DataFrame]
    counts: DataFrame

    @cached_property
    def edges(self) -> DataFrame:
        """The canonical edges, brought up to date when they are first asked for."""
        return self.refresh()


def canonicalize(entities: DataFrame, mention_edges: DataFrame | Callable[[], DataFrame], index: DataFrame, edges: DataFrame | Callable[[], DataFrame], folders: list[str] | None, adjudications: DataFrame | None = None, policy: str = "fail", fuzzy: bool = True, floor: float = canon.FLOOR, ceiling: float = canon.CEILING) -> Batch:
    """All tables after the batch of folders (None: all). Only staged mentions of the folders are clustered; entities of earlier batches are
    met again by their exact key. Doing a batch over changes nothing: nothing of it is staged any more.

    Where nobody is asked (no adjudications, policy ``reject``), ambiguous pairs all come apart, and only pairs at the
    ceiling are looked for. Edges are the last thing to be refreshed, and only if somebody wants them; those so far, and
    those of mentions, may come as functions.
    """
    mentions = materialize(canon.with_forms(canon.staged(entities, folders).drop("normalized_form", "canonical_id")), "mentions")
    pack = load_pack(canon.batch_pack(mentions, None))
    if fuzzy:
        least = ceiling if adjudications is None and policy == "reject" else floor
        pairs = materialize(canon.fuzzy_pairs(canon.distinct_forms(mentions), least, ceiling), "pairs")
        clustered = materialize(canon.clusters(mentions, canon.adjudicated(pairs, mentions, adjudications, policy)), "clustered")
    else:
        clustered = canon.exact_clusters(mentions)
    resolved = materialize(canon.resolve_or_mint(canon.canonical_clusters(clustered, pack), index), "resolved")
    after = materialize(canon.promoted(entities, clustered, resolved), "entities")

    def refresh() -> DataFrame:
        return graph.refresh_edges(edges() if callable(edges) else edges, mention_edges() if callable(mention_edges) else mention_edges, after, clustered)

    return Batch(after, canon.extended_index(index, resolved), refresh, canon.batch_counts(resolved))


def empty_index(spark) -> DataFrame:
    return spark.createDataFrame([], "canonical_id string, canonical_key string, entity_type string, normalized_form string")


def empty_edges(spark) -> DataFrame:
    return spark.createDataFrame([], "src_canonical_id string, relation_type string, dst_canonical_id string, support_count int, confidence double, evidence_text array<string>")


def export(entities: DataFrame, index: DataFrame, edges: DataFrame, folders: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(statements, counts) of the graph, or of what the folders touch."""
    nodes = graph.export_nodes(entities, index, folders)
    out = graph.export_edges(edges, nodes if folders else None)
    return graph.export_statements(nodes, out.drop("dangling")), graph.export_counts(nodes, out)


def dangling(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("dangling"))
