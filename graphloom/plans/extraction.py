"""Extraction of all folders in one plan; a folder is a grouping key, not a job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..ontology import load_pack
from ..operators import entities as ent
from ..operators import pairs as prs
from ..operators import relations as rel
from ..sources.chunks import folder_status, inline_chunk, require
from ..sources.scratch import materialize
from ..sources.sinks import folder_payloads


@dataclass(frozen=True)
class Extraction:
    entities: DataFrame
    status: DataFrame
    relate: Callable[[], DataFrame]
    connect: Callable[[DataFrame], DataFrame]
    summarize: Callable[[DataFrame, DataFrame], DataFrame]

    @cached_property
    def relations(self) -> DataFrame:
        """Validated relations, found when they, edges or summaries are first asked for."""
        return self.relate()

    @cached_property
    def edges(self) -> DataFrame:
        return self.connect(self.relations)

    @cached_property
    def summary(self) -> DataFrame:
        return self.summarize(self.relations, self.edges)

    def payloads(self, usage: DataFrame | None = None) -> DataFrame:
        """One thin row per folder."""
        return folder_payloads(self.status, self.summary, usage)


def extract(chunks: DataFrame, settings: Settings | None = None, annotations: dict[str, DataFrame] | None = None, folders: DataFrame | None = None) -> Extraction:
    """Entities, edges, summaries and states of every folder of (folder_id, chunk_id, doc_id, line_no, text).

    Annotations are tables (see ``sources.chunks.ANNOTATIONS``); those that the settings need must be there. A folder
    without chunks, or with a request that no attempt answered well, is failed; others do not notice.

    Relations are looked for only where they or what follows from them is wanted.
    """
    settings, given = settings or Settings(engine="rules", pack="commerce"), annotations or {}
    settings.check()
    require(given, *settings.needs())
    pack = load_pack(settings.pack)
    status = folder_status(chunks if folders is None else folders, chunks)
    if settings.coref_enabled and settings.engine == "llm":
        chunks = rel.apply_rewrites(chunks, given["rewrites"])

    responses = None
    found = ent.regex_entities(chunks, pack)
    if settings.engine == "spacy":
        found = found.unionByName(ent.map_labels(given["ner"], chunks, pack))
    if settings.engine == "llm":
        responses = materialize(rel.first_valid(given["responses"]), "responses")
        failed = responses.where("failed").join(chunks.select("chunk_id", "folder_id"), "chunk_id").select("folder_id").distinct()
        status = _failed(status, failed)
        # Answers on chunks of failed folders go where answers meet their chunks.
        chunks = chunks.join(failed, "folder_id", "left_anti")
        found = found.join(failed, "folder_id", "left_anti").unionByName(rel.parse_entities(responses.where("mode = 'generate'"), chunks))
    if settings.coref_enabled:
        found = ent.without_pronouns(found)
    # Texts are scanned once; everything further on starts from what was found in them.
    found = materialize(found, "candidates")
    unmapped = ent.unmapped_counts(found, pack)
    kept = ent.closed_vocabulary(found, pack, settings.entity_types, settings.confidence_threshold)
    if given.get("verdicts") is not None:
        kept = ent.screened(kept, given["verdicts"])
    mentions = materialize(ent.merge_layers(kept), "mentions")
    entities = ent.entity_records(mentions, pack, settings.model_id)

    def relate() -> DataFrame:
        return materialize(rel.validate(_relations(settings, pack, chunks, mentions, responses, given), chunks, pack), "relations")

    def connect(valid: DataFrame) -> DataFrame:
        return materialize(rel.merge_edges(rel.build_edges(valid.where("grounded"), entities)), "edges")

    def summarize(valid: DataFrame, edges: DataFrame) -> DataFrame:
        return ent.folder_summary(status, entities, edges, [unmapped, rel.ungrounded_counts(valid)], settings.top_n, pack, settings.votes)

    return Extraction(entities, status, relate, connect, summarize)


def _relations(settings, pack, chunks, mentions, responses, given) -> DataFrame:
    out = prs.rule_relations(given["tokens"], pack) if settings.rules_relations_enabled else prs.rule_relations(chunks, _bare(pack))
    if settings.relations_enabled and responses is not None:
        mode = settings.relation_strategy
        if mode == "classify":
            pairs = rel.plan_batches(prs.candidate_pairs(mentions, given["sentences"], pack))
            found = rel.parse_labels(responses.where("mode = 'classify'"), pairs)
        else:
            found = rel.parse_relations(responses.where(F.col("mode") == mode), "llm" if mode == "generate" else "llm-entity-scoped")
        out = out.unionByName(rel.vote(found, settings.votes) if settings.votes > 1 else found.where("run_idx = 1"))
    return out


def _bare(pack):
    from dataclasses import replace

    return replace(pack, dep_patterns=())


def _failed(status: DataFrame, failed: DataFrame) -> DataFrame:
    marked = status.join(failed.withColumn("__failed", F.lit(True)), "folder_id", "left")
    bad = F.coalesce("__failed", F.lit(False))
    return marked.select("folder_id", F.when(bad, "failed").otherwise(F.col("status")).alias("status"), F.when(bad, "no attempt was well formed").otherwise(F.col("error_message")).alias("error_message"), "n_chunks")


def preview(spark, text: str, settings: Settings | None = None) -> tuple[DataFrame, DataFrame]:
    """Entities and relations of one text; nothing is written."""
    out = extract(inline_chunk(spark, text), settings)
    return preview_entities(out.entities), preview_relations(out.edges, out.entities)


def preview_entities(entities: DataFrame) -> DataFrame:
    return entities.select("entity_type", "surface_form", "span_start", "span_end", "confidence", "extractor")


def preview_relations(edges: DataFrame, entities: DataFrame) -> DataFrame:
    """Edges with the surfaces of their ends."""
    for end in ("src", "dst"):
        edges = edges.join(entities.select(F.col("entity_uid").alias(f"{end}_entity_uid"), F.col("surface_form").alias(f"{end}_surface")), f"{end}_entity_uid", "left")
    return edges.select("relation_type", "src_surface", "dst_surface", "confidence", "evidence_text")
