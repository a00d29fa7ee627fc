"""Queries of prompts, of what is checked before a run, of sinks and of the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import ConfigError, Settings
from ..ontology import PackError, load_pack, parse_pack
from ..operators import graph
from ..operators import relations as rel
from ..sources import scratch, sinks
from ..sources.chunks import lines_as_chunks
from ..streaming.folders import extract_stream
from . import extraction as ext
from . import inputs as inp
from .canonical import _BATCHES, _graph
from .inputs import chunks, table

PACK = inp.PACK
MODES = ("generate", "entity_scoped", "classify")
SETTINGS = {
    "nothing given": ({}, True), "clamped": ({"votes": 9, "top_n": 99}, True), "voted rules": ({"engine": "rules", "votes": 3}, False), "voted rules, no relations": ({"engine": "rules", "votes": 3, "relations_enabled": False}, True),
    "no such engine": ({"engine": "magic"}, False), "no such strategy": ({"relation_strategy": "guess"}, False), "unknown name": ({"colour": 1}, False), "pairs without a model": ({"engine": "spacy", "relation_strategy": "classify"}, False),
}
_TYPE, _RELATION = {"type": "A", "parent": None}, {"type": "r", "domain": ["A"], "range": ["A"]}
_DEP = {"relation_type": "r", "src_node": "a", "dst_node": "b", "pattern": [{"RIGHT_ID": "a"}, {"LEFT_ID": "a", "REL_OP": ">", "RIGHT_ID": "b"}]}
_GOOD = {"version": "1", "entity_types": [_TYPE], "relations": [_RELATION], "dep_patterns": [_DEP]}
PACKS = {
    "good": ({}, True), "no version": ({"version": ""}, False), "no types": ({"entity_types": []}, False), "a type twice": ({"entity_types": [_TYPE, _TYPE]}, False), "unknown parent": ({"entity_types": [{"type": "A", "parent": "Z"}]}, False),
    "a circle": ({"entity_types": [{"type": "A", "parent": "B"}, {"type": "B", "parent": "A"}]}, False), "a relation twice": ({"relations": [_RELATION, _RELATION]}, False), "unknown end": ({"relations": [{**_RELATION, "domain": ["Z"]}]}, False),
    "a pattern": ({"regex_patterns": [{"entity_type": "A", "pattern": "x+"}]}, True), "broken pattern": ({"regex_patterns": [{"entity_type": "A", "pattern": "("}]}, False), "unknown checksum": ({"regex_patterns": [{"entity_type": "A", "pattern": "x", "checksum": "crc"}]}, False),
    "loose tree": ({"dep_patterns": [{**_DEP, "dst_node": "z"}]}, False), "tree of no relation": ({"dep_patterns": [{**_DEP, "relation_type": "z"}]}, False),
}


def _accepts(call, error) -> bool:
    try:
        call()
    except error:
        return False
    return True


def settings_checks(spark, sf_dir):
    """Which settings are refused before anything is planned."""
    return spark.createDataFrame([(k, _accepts(lambda: Settings.of(options), ConfigError)) for k, (options, _) in SETTINGS.items()], "given string, accepted boolean")


def pack_checks(spark, sf_dir):
    """Which packs are refused."""
    return spark.createDataFrame([(k, _accepts(lambda: parse_pack(_GOOD | change), PackError)) for k, (change, _) in PACKS.items()], "given string, accepted boolean")


def tool_schemas(spark, sf_dir):
    """What a model may choose from in each mode."""
    rows = []
    for mode in MODES:
        for listed, array in load_pack(PACK).tool_schema(mode)["properties"].items():
            rows += [(mode, f"{listed}.{field}", value) for field, kind in array["items"]["properties"].items() for value in kind.get("enum", ())]
    return spark.createDataFrame(rows, "mode string, field string, choice string")


def generate_prompts(spark, sf_dir):
    out = rel.generate_prompts(chunks(spark, sf_dir), load_pack(PACK), 2)
    return out.select("chunk_id", "run_idx", F.sha2("system", 256).alias("system_digest"), F.sha2("user", 256).alias("user_digest"))


def rewrite_prompts(spark, sf_dir):
    return rel.rewrite_prompts(chunks(spark, sf_dir)).select("chunk_id", F.sha2("user", 256).alias("user_digest"))


def pair_prompts(spark, sf_dir):
    out = rel.pair_prompts(rel.plan_batches(ext._pairs(spark, sf_dir)), chunks(spark, sf_dir))
    return out.select("chunk_id", "batch_no", F.sha2("user", 256).alias("user_digest"))


def cacheable_models(spark, sf_dir):
    """Models by name, with and without the prefix of a region."""
    n = F.col("event_id")
    model = F.concat(F.when(n % 3 == 0, "eu.").when(n % 3 == 1, "global.").otherwise(""), F.when(n % 2 == 0, "vendor.large-").otherwise("vendor.small-"), (n % 5).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", rel.cacheable(model, ["vendor.large", "vendor.small-4"]).alias("cacheable"))


def statements_written(spark, sf_dir):
    """Statements as a writer gets them: how many, and how many of either kind."""
    seen = [spark.sparkContext.accumulator(0) for _ in range(2)]

    def write(rows):
        for r in rows:
            seen[r.kind].add(1)

    n = sinks.write_statements(graph.export_statements(*_graph(spark, sf_dir)), write)
    return spark.createDataFrame([(n, seen[0].value, seen[1].value)], "n_statements long, n_nodes long, n_edges long")


def summary_sink(spark, sf_dir):
    """One JSON line per folder, read back; fields of a failed folder are not there."""
    told = ext.folder_state(spark, sf_dir).drop("top_entities")
    path = scratch.put(told.limit(0), "summary")
    sinks.write_summary(told, path)
    lines = spark.read.text(path)
    return lines.select(F.get_json_object("value", "$.folder_id").alias("folder_id"), F.get_json_object("value", "$.status").alias("status"), F.get_json_object("value", "$.entity_count").cast("long").alias("entity_count"), F.contains("value", F.lit("edge_count")).alias("told"))


def stream_extract(spark, sf_dir):
    """Documents as a stream of files, extracted by patterns micro-batch by micro-batch, then read back."""
    docs = table(spark, sf_dir, "documents")
    docs = spark.readStream.schema(docs.schema).parquet(scratch.put(docs, "arriving"))
    out = scratch.put(spark.range(0), "stream")
    extract_stream(lines_as_chunks(docs), f"{out}/tables", f"{out}/state", Settings(engine="rules", pack=PACK)).awaitTermination()
    return spark.read.parquet(f"{out}/tables/entities").select("folder_id", "entity_uid", "entity_type", "surface_form", "span_start", "span_end")


QUERIES = {f.__name__: f for f in (settings_checks, pack_checks, tool_schemas, generate_prompts, rewrite_prompts, pair_prompts, cacheable_models, statements_written, summary_sink, stream_extract)}

# --- DuckDB -----------------------------------------------------------------------------------------------------


def _values(cases: dict) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{k}', {str(ok).lower()})" for k, (_, ok) in cases.items()) + ") t(given, accepted)"


def _guided() -> str:
    pack = load_pack(PACK)
    kinds = ", ".join(f"({i}, '{t['type']}', {inp._or_null(t.get('parent'))}, '{t['guidance']}')" for i, t in enumerate(pack.entity_types))
    ends = ", ".join(f"({i}, '{r['type']}', {inp.sql_list(tuple(r['domain']))}, {inp.sql_list(tuple(r['range']))}, '{r['guidance']}')" for i, r in enumerate(pack.relations))
    return f"""
kinds(n, type, parent, guidance) AS (VALUES {kinds}), ties(n, type, dom, rng, guidance) AS (VALUES {ends}),
told AS (SELECT 'List the entities and relations in the text by calling the tool.' || chr(10) || chr(10) || 'Entity types:' || chr(10) ||
  (SELECT string_agg('- ' || type || CASE WHEN parent IS NULL THEN '' ELSE ' (a kind of ' || parent || ')' END || ': ' || guidance, chr(10) ORDER BY n) FROM kinds) || chr(10) || 'Relation types:' || chr(10) ||
  (SELECT string_agg('- ' || type || ': ' || array_to_string(dom, ' | ') || ' -> ' || array_to_string(rng, ' | ') || '. ' || guidance, chr(10) ORDER BY n) FROM ties) AS system)"""


_R = "WITH RECURSIVE "
_START = f"'{rel.DATA_ONLY}' || chr(10) || chr(10)"
_TASK = "Rewrite the current text: put the full name for every word that clearly stands for a named thing, leave out what stands for nothing clear, change nothing else, and answer with the text alone."
ORACLE_SQL = {
    "settings_checks": _values(SETTINGS),
    "pack_checks": _values(PACKS),
    "tool_schemas": _R + inp.pack_values() + """,
m AS (SELECT unnest(['generate', 'entity_scoped']) AS mode)
SELECT mode, 'relations.type' AS field, relation_type AS choice FROM m, rels UNION ALL SELECT mode, f, type FROM m, types, (SELECT unnest(['relations.src_type', 'relations.dst_type']) AS f)
UNION ALL SELECT 'generate', 'entities.type', type FROM types UNION ALL SELECT 'classify', 'labels.relation_type', relation_type FROM rels UNION ALL SELECT 'classify', 'labels.relation_type', 'no_relation'""",
    "generate_prompts": "WITH" + inp.CHUNKS + "," + _guided() + f" SELECT chunk_id, run_idx, sha256(system) AS system_digest, sha256({_START} || 'TEXT:' || chr(10) || text) AS user_digest FROM chunks, told, (SELECT unnest([1, 2]) AS run_idx)",
    "rewrite_prompts": "WITH" + inp.CHUNKS + f""",
c AS (SELECT chunk_id, text, coalesce(string_agg(text, chr(10)) OVER (PARTITION BY folder_id ORDER BY doc_id, line_no ROWS BETWEEN {rel.PRIOR} PRECEDING AND 1 PRECEDING), '') AS context FROM chunks)
SELECT chunk_id, sha256({_START} || 'EARLIER TEXT:' || chr(10) || CASE WHEN context <> '' THEN context ELSE '(this is where the document begins)' END || chr(10) || chr(10) || '{_TASK}' || chr(10) || chr(10) || 'CURRENT TEXT:' || chr(10) || text) AS user_digest FROM c""",
    "pair_prompts": ext._PAIRS_WITH + f""",
l AS (SELECT b.chunk_id, n // 20 AS batch_no, n % 20 AS k, (n % 20) || '. ' || src_surface || ' (' || src_type || ') -> ' || dst_surface || ' (' || dst_type || ') in: ' || substr(text, sentence_start + 1, sentence_end - sentence_start) || '; one of: ' || replace(allowed, ',', ', ') || ', no_relation' AS line FROM batched b JOIN chunks USING (chunk_id))
SELECT chunk_id, batch_no, sha256({_START} || string_agg(line, chr(10) ORDER BY k)) AS user_digest FROM l GROUP BY chunk_id, batch_no""",
    "cacheable_models": "SELECT event_id, event_id % 2 = 0 OR event_id % 5 = 4 AS cacheable FROM events",
    "statements_written": _BATCHES + "SELECT n + e AS n_statements, n AS n_nodes, e AS n_edges FROM (SELECT (SELECT count(*) FROM nodes) AS n, (SELECT count(*) FROM cedges) AS e)",
    "summary_sink": f"SELECT folder_id, status, entity_count, status = 'ok' AS told FROM ({ext.ORACLE_SQL['folder_state']})",
    "stream_extract": _R + inp.CHUNKS + "," + inp._patterns() + ", found AS (SELECT folder_id, chunk_id, 0 AS o1, pattern_idx AS o2, doc_id AS o3, line_no AS o4, match_idx AS o5, surface_form, entity_type, 'regex' AS layer, span_start, span_start + length(surface_form) AS span_end FROM regex)" + inp.greedy("found") + " SELECT folder_id, sha256(folder_id || '|' || chunk_id || '|' || entity_type || '|' || surface_form || '|' || span_start || '|0') AS entity_uid, entity_type, surface_form, span_start, span_end FROM mentions",
}
