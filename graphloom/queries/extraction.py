"""Queries of the extraction operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as fx
from ..ontology import load_pack
from ..operators import entities as ent
from ..operators import pairs as prs
from ..operators import relations as rel
from ..plans.extraction import preview_entities, preview_relations
from ..sources.chunks import folder_status
from ..sources.scratch import materialize
from ..sources.sinks import folder_payloads
from . import inputs as inp
from .inputs import chunks, table

PACK = inp.PACK


def _ordered(df):
    """The parts of ``ord`` as columns."""
    return [F.col(f"ord.{c}").alias(f"ord_{c}") for c in ("layer", "pattern", "doc", "line", "match")]


def chunk_scan(spark, sf_dir):
    lines = chunks(spark, sf_dir)
    size = lines.groupBy("folder_id").agg(F.sum(F.char_length("text")).alias("n_chars"), F.count_if(F.col("text") == "").alias("n_empty"))
    folders = lines.select("folder_id").union(spark.createDataFrame([("nothing here",)], "folder_id string"))
    return folder_status(folders, lines).join(size, "folder_id", "left")


def regex_entities(spark, sf_dir):
    lines = chunks(spark, sf_dir)
    found = ent.regex_entities(lines, load_pack(PACK)).unionByName(ent.map_labels(inp.annotations(lines), lines, load_pack(PACK)))
    return found.select("folder_id", "chunk_id", "entity_type", "layer", F.col("ord.pattern").alias("pattern_idx"), F.col("ord.match").alias("match_idx"), "surface_form", "span_start", "span_end")


def checksum_lei(spark, sf_dir):
    body = F.concat(F.lit("ABCD"), F.lpad(F.col("o_orderkey").cast("string"), 14, "0"))
    check = 98 - (F.concat(fx.digits_of(body), F.lit("00")).cast("decimal(38,0)") % 97).cast("int")
    code = F.concat(body, F.lpad(((check + F.col("o_orderkey") % 2) % 100).cast("string"), 2, "0"))
    return table(spark, sf_dir, "orders").select("o_orderkey", code.alias("code")).withColumn("valid", fx.lei_valid(F.col("code")))


def checksum_isin(spark, sf_dir):
    code = F.concat(F.lit("US"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), (F.col("p_partkey") % 10).cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", code.alias("code")).withColumn("valid", fx.isin_valid(F.col("code")))


def label_mapping(spark, sf_dir):
    lines = chunks(spark, sf_dir)
    return ent.map_labels(inp.annotations(lines), lines, load_pack(PACK)).select("chunk_id", "surface_form", "entity_type", "span_start", "span_end", F.col("ord.match").alias("match_idx"))


def closed_vocab(spark, sf_dir):
    kept = ent.closed_vocabulary(inp.candidates(spark, sf_dir), load_pack(PACK), ("Organization", "Place", "Code"), 0.6)
    return kept.select("chunk_id", *_ordered(kept), "surface_form", "entity_type", "layer")


def unmapped_count(spark, sf_dir):
    return ent.unmapped_counts(inp.candidates(spark, sf_dir), load_pack(PACK))


def pronoun_filter(spark, sf_dir):
    words = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", " ")).alias("pos", "surface_form"))
    return ent.without_pronouns(words)


def guardrail_screen(spark, sf_dir):
    # Counts, verdicts and the rows themselves start from one scan of the texts.
    found = materialize(ent.closed_vocabulary(inp.candidates(spark, sf_dir), load_pack(PACK)), "candidates")
    verdicts = found.where((F.col("folder_id") != "src3") | (F.col("ord.match") > 0)).select("folder_id", "ord", (F.col("ord.match") % 5 != 0).alias("allowed"))
    kept = ent.screened(found, verdicts)
    return kept.select("folder_id", "chunk_id", *_ordered(kept), "surface_form")


def layer_merge(spark, sf_dir):
    kept = inp.mentions(spark, sf_dir)
    return kept.select("chunk_id", *_ordered(kept), "surface_form", "entity_type", "layer", "span_start", "span_end", "occurrence_idx")


def entity_uids(spark, sf_dir):
    return inp.entities(spark, sf_dir).select("folder_id", "entity_uid", "entity_type", "surface_form", "source_chunk_id", "span_start", "span_end", "occurrence_idx", "extractor", "model_id", "ontology_pack", "stage")


def top_entities(spark, sf_dir):
    return ent.top_entities(inp.entities(spark, sf_dir), 10)


def _answers(spark, sf_dir):
    return rel.first_valid(inp.responses(spark, sf_dir))


def _relations(spark, sf_dir):
    return rel.parse_relations(_answers(spark, sf_dir))


def _plain(df):
    """``ord`` of a model's relations as a number."""
    return df.withColumn("ord", F.col("ord")[0])


def _parsed(spark, sf_dir):
    """(mentions that the model listed itself, voted relations of all runs, validated); answers are read once."""
    lines, pack = chunks(spark, sf_dir), load_pack(PACK)
    answers = materialize(_answers(spark, sf_dir), "answers")
    entities = ent.entity_records(ent.merge_layers(rel.parse_entities(answers, lines)), pack, "made-up")
    return entities, rel.validate(rel.vote(rel.parse_relations(answers), inp.RUNS), lines, pack)


def _edge_rows(spark, sf_dir):
    """Grounded relations that two of three runs agree on, between mentions that the model listed itself."""
    entities, valid = _parsed(spark, sf_dir)
    return rel.build_edges(valid.where("grounded"), entities)


def _llm_entities(spark, sf_dir):
    return ent.entity_records(ent.merge_layers(rel.parse_entities(_answers(spark, sf_dir), chunks(spark, sf_dir))), load_pack(PACK), "made-up")


def _folders(spark, sf_dir):
    """States of all folders, of one in whose only chunk nothing is found, and of one without chunks."""
    quiet = spark.createDataFrame([("quiet", "quiet#0", -1, 0, "nothing notable here")], "folder_id string, chunk_id string, doc_id long, line_no int, text string")
    lines = chunks(spark, sf_dir).unionByName(quiet)
    return folder_status(lines.select("folder_id").union(spark.createDataFrame([("nothing here",)], "folder_id string")), lines)


def _summary(spark, sf_dir, status):
    entities, valid = _parsed(spark, sf_dir)
    entities, valid = materialize(entities, "entities"), materialize(valid, "relations")
    edges = rel.merge_edges(rel.build_edges(valid.where("grounded"), entities))
    out = ent.folder_summary(status, entities, edges, [rel.ungrounded_counts(valid)], 5, load_pack(PACK), inp.RUNS)
    top = F.array_join(F.transform("top_entities", lambda x: F.concat_ws(":", x["entity_type"], x["surface_form"], x["mention_count"].cast("string"))), ";")
    return out.withColumn("top_entities", top)


def folder_summary(spark, sf_dir):
    """Every folder that did not fail, the empty one too."""
    return _summary(spark, sf_dir, _folders(spark, sf_dir))


def folder_state(spark, sf_dir):
    """What callers are told of every folder."""
    # A row for each folder, which the summary and the payloads both start from.
    status = materialize(_folders(spark, sf_dir), "status")
    return folder_payloads(status, _summary(spark, sf_dir, status))


def llm_parse_entities(spark, sf_dir):
    found = rel.parse_entities(rel.first_valid(inp.responses(spark, sf_dir)), chunks(spark, sf_dir))
    return found.select("chunk_id", F.col("ord.match").alias("item"), "entity_type", "surface_form", "confidence", "span_start", "span_end")


def llm_parse_relations(spark, sf_dir):
    return _plain(_relations(spark, sf_dir))


def entity_scoped_parse(spark, sf_dir):
    """Calls for chunks with two mentions or more, and what they answered."""
    scoped = rel.scoped_requests(_llm_entities(spark, sf_dir)).select("chunk_id", "n_entities")
    found = _plain(rel.parse_relations(_answers(spark, sf_dir), "llm-entity-scoped"))
    return found.join(scoped, "chunk_id").select("chunk_id", "run_idx", "ord", "relation_type", "src_surface", "dst_surface", "confidence", "extractor", "n_entities")


def _sentences(lines):
    """Sentences of a line: up to and including each full stop."""
    found = ent.find_patterns(lines, [(0, r"[^.]*\.|[^.]+")])
    return found.select("chunk_id", F.col("match_idx").alias("sent_idx"), F.col("span_start").alias("start"), F.col("span_end").alias("end"))


def _pairs(spark, sf_dir):
    lines = chunks(spark, sf_dir)
    found = ent.map_labels(inp.annotations(lines), lines, load_pack(PACK))
    return prs.candidate_pairs(found, _sentences(lines), load_pack(PACK))


def candidate_pairs(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    return pairs.select("chunk_id", "sent_idx", F.col("src_ord.match").alias("src"), F.col("dst_ord.match").alias("dst"), "src_surface", "src_type", "dst_surface", "dst_type", F.array_join("allowed", ",").alias("allowed"), F.col("sentence.start").alias("sentence_start"), F.col("sentence.end").alias("sentence_end"))


def classify_parse(spark, sf_dir):
    """Pairs in calls of twenty; the answer picks the first choice of every even pair, and invents some."""
    # Questions and answers are about the same calls: their pairs are found once.
    calls = materialize(rel.gather_calls(rel.plan_batches(_pairs(spark, sf_dir))), "calls")

    def item(p):
        n = p["pair_index"]
        label = F.when(n % 2 == 0, F.element_at(p["allowed"], 1)).when(n % 3 == 0, F.lit("invented")).otherwise(F.lit("no_relation"))
        return F.concat(F.lit('{"pair_index":'), n.cast("string"), F.lit(',"relation_type":"'), label, F.lit('","evidence":"'), p["src_surface"], F.lit('"}'))

    body = F.concat(F.lit('{"labels":['), F.array_join(F.transform("pairs", item), ","), F.lit("]}"))
    answers = calls.select("chunk_id", F.lit("classify").alias("mode"), F.lit(1).alias("run_idx"), "batch_no", body.alias("body"))
    return rel.parse_labels(answers, calls).drop("run_idx").withColumn("ord", F.col("ord")[0] * rel.BATCH + F.col("ord")[1])


def coref_apply(spark, sf_dir):
    lines = chunks(spark, sf_dir)
    rewrites = lines.where("line_no % 3 <> 2").select("chunk_id", F.when(F.col("line_no") % 3 == 0, F.lit("  \t ")).otherwise(F.concat(F.lit("They: "), F.col("text"))).alias("rewritten"))
    return rel.apply_rewrites(lines, rewrites).select("chunk_id", "text")


def evidence_grounding(spark, sf_dir):
    valid = _plain(rel.validate(_relations(spark, sf_dir), chunks(spark, sf_dir), load_pack(PACK)))
    return valid.select("chunk_id", "run_idx", "ord", "relation_type", "evidence_text", "grounded")


def relation_validate(spark, sf_dir):
    valid = rel.validate(_relations(spark, sf_dir), chunks(spark, sf_dir), load_pack(PACK))
    return rel.ungrounded_counts(valid).join(valid.where("grounded").groupBy("folder_id").agg(F.count("*").alias("n_valid")), "folder_id", "left")


def edge_build(spark, sf_dir):
    return _edge_rows(spark, sf_dir).select("folder_id", "chunk_id", F.col("ord.run").alias("run_idx"), F.col("ord.item")[0].alias("ord"), "edge_uid", "relation_type", "src_entity_uid", "dst_entity_uid", "confidence", "evidence_text", "extractor")


edge_uids = edge_build


def edge_merge(spark, sf_dir):
    """Edges of the model, of rules and of a second model between groups of mentions of a folder, merged."""
    rows = _edge_rows(spark, sf_dir)
    keyed = materialize(rows.withColumn("src_entity_uid", F.substring("src_entity_uid", 1, 1)).withColumn("dst_entity_uid", F.substring("dst_entity_uid", 1, 1)), "keyed")
    item = F.col("ord.item")
    rules = keyed.where(item[0] == 0).withColumn("extractor", F.lit("rules")).withColumn("confidence", F.lit(1.0)).withColumn("evidence_text", F.col("relation_type")).withColumn("ord", F.col("ord").withField("layer", F.lit(0)))
    other = keyed.where(item[0] == 1).withColumn("extractor", F.lit("llm-classify")).withColumn("ord", F.col("ord").withField("item", F.array(item[0], F.lit(2))))
    merged = rel.merge_edges(keyed.unionByName(rules).unionByName(other))
    return merged.select("folder_id", "relation_type", "src_entity_uid", "dst_entity_uid", "confidence", F.sha2("evidence_text", 256).alias("evidence_digest"), "extractor", F.concat_ws("#", "ord.doc", "ord.line").alias("first_chunk"))


def self_consistency_vote(spark, sf_dir):
    return _plain(rel.vote(_relations(spark, sf_dir), inp.RUNS))


def _tokens(spark, sf_dir):
    """Parse trees of three shapes, one per order: who supplies what, who works at a firm, who is where."""
    shape = F.col("o_orderkey") % 3
    words = {0: ("acme supplies parts", [(1, "supply", "ROOT", 1), (0, "acme", "nsubj", 1), (2, "parts", "dobj", 1)]), 1: ("ann works at acme", [(1, "work", "ROOT", 1), (0, "ann", "nsubj", 1), (2, "at", "prep", 1), (3, "acme", "pobj", 2)]), 2: ("bob is paris", [(1, "be", "ROOT", 1), (0, "bob", "nsubj", 1), (2, "paris", "attr", 1)])}
    tokens = None
    orders = table(spark, sf_dir, "orders")
    for k, (sentence, tree) in words.items():
        rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(sentence.split()[i]).alias("text"), F.lit(lemma).alias("lemma"), F.lit(dep).alias("dep"), F.lit(head).alias("head")) for i, lemma, dep, head in tree])
        own = orders.where(shape == k).select(F.col("o_orderkey").cast("string").alias("chunk_id"), F.inline(rows)).withColumn("sent_id", F.lit(0)).withColumn("sent_text", F.lit(sentence))
        tokens = own if tokens is None else tokens.unionByName(own)
    return tokens


def _dep(k):
    def query(spark, sf_dir):
        pack = load_pack(PACK)
        return prs.match_pattern(_tokens(spark, sf_dir), pack.dep_patterns[k], pack, k).drop("ord", "run_idx")

    return query


dep_match_svo, dep_match_prep, dep_match_copula = _dep(0), _dep(1), _dep(2)


def preview(spark, sf_dir):
    from ..config import Settings
    from ..plans.extraction import extract
    from ..sources.chunks import inline_chunk

    out = extract(inline_chunk(spark, "Write to sales@acme.example.com about order 12345678, not 12."), Settings(engine="rules", pack=PACK))
    return preview_entities(out.entities)


def preview_edges(spark, sf_dir):
    entities, valid = _parsed(spark, sf_dir)
    entities = materialize(entities, "entities")
    return preview_relations(rel.merge_edges(rel.build_edges(valid.where("grounded"), entities)), entities)


def request_plan(spark, sf_dir):
    """Calls per chunk: one for each run of the generate mode, one for twenty pairs of the classify mode."""
    runs = rel.requests(chunks(spark, sf_dir), inp.RUNS).groupBy("chunk_id").agg(F.count("*").alias("n_generate"))
    batches = rel.plan_batches(_pairs(spark, sf_dir)).groupBy("chunk_id").agg(F.count_distinct("batch_no").alias("n_classify"))
    return runs.join(batches, "chunk_id", "left").fillna(0)


def scoped_prompts(spark, sf_dir):
    out = rel.scoped_prompts(_llm_entities(spark, sf_dir), chunks(spark, sf_dir))
    return out.select("chunk_id", "n_entities", F.sha2("user", 256).alias("user_digest"))


def tool_inputs(spark, sf_dir):
    """Raw responses read back: those that stopped for another reason, or called another tool, give nothing."""
    events = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"n":'), F.col("event_id").cast("string"), F.lit("}")).alias("body"))
    stop = F.when(F.col("event_id") % 3 == 0, "end_turn").otherwise("tool_use")
    name = F.when(F.col("event_id") % 5 == 0, "other").otherwise("extract")
    raw = F.concat(F.lit('{"stopReason":"'), stop, F.lit('","output":{"message":{"content":[{"text":"t'), F.col("event_id").cast("string"), F.lit('"},{"toolUse":{"name":"'), name, F.lit('","input":'), F.col("body"), F.lit("}}]}}}"))
    return events.select("event_id", rel.tool_input(raw, "extract").alias("input"), rel.first_text(raw).alias("first_text"))


def usage_rollup(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    usage = events.select(F.col("event_type").alias("folder_id"), F.concat(F.lit("model-"), (F.col("user_id") % 3).cast("string")).alias("model"), F.struct((F.col("event_id") % 1000).alias("input_tokens"), (F.col("event_id") % 77).alias("output_tokens")).alias("quantity"))
    return rel.usage_totals(usage)


def attempts(spark, sf_dir):
    """Requests answered by the first or the second attempt, or by none; some first attempts failed hard."""
    asked = inp.responses(spark, sf_dir).where((F.col("attempt") == 1) | ~F.col("chunk_id").endswith("3"))
    code = F.when((F.col("attempt") == 1) & F.col("chunk_id").endswith("1"), "Throttled").when((F.col("attempt") == 1) & F.col("chunk_id").endswith("2"), "ModelErrorException")
    out = rel.first_valid(asked.withColumn("error_code", code))
    return out.select("chunk_id", "run_idx", "failed")


QUERIES = {
    f: globals()[f]
    for f in (
        "chunk_scan", "regex_entities", "checksum_lei", "checksum_isin", "label_mapping", "closed_vocab", "unmapped_count", "pronoun_filter", "guardrail_screen", "layer_merge",
        "entity_uids", "edge_uids", "top_entities", "folder_summary", "folder_state", "llm_parse_entities", "llm_parse_relations", "entity_scoped_parse", "classify_parse", "coref_apply",
        "evidence_grounding", "relation_validate", "edge_build", "edge_merge", "self_consistency_vote", "candidate_pairs", "dep_match_svo", "dep_match_prep", "dep_match_copula",
        "preview", "preview_edges", "request_plan", "scoped_prompts", "tool_inputs", "usage_rollup", "attempts",
    )
}

# --- DuckDB -----------------------------------------------------------------------------------------------------

_ORD = "o1 AS ord_layer, o2 AS ord_pattern, o3 AS ord_doc, o4 AS ord_line, o5 AS ord_match"
_SPACES = r"[\s\x1c-\x1f]+"
_LLM_ENTITIES = rf""",
listed AS (
  SELECT folder_id, chunk_id, doc_id, line_no, unnest([0, 1]) AS item, unnest([ta, tb]) AS entity_type, unnest([a, b]) AS surface_form, unnest([0.8, 0.7])::DOUBLE AS confidence, text, a = b AS same FROM worded),
placed AS (
  SELECT *, CASE WHEN item = 1 AND same THEN
      CASE WHEN instr(substr(text, instr(text, surface_form) + 1), surface_form) > 0 THEN instr(text, surface_form) + instr(substr(text, instr(text, surface_form) + 1), surface_form) - 1 END
    ELSE instr(text, surface_form) - 1 END AS span_start FROM listed),
llm_all AS (SELECT *, span_start + length(surface_form) AS span_end FROM placed),
llm_entities AS (
  SELECT *, sha256(folder_id || '|' || chunk_id || '|' || entity_type || '|' || surface_form || '|' || span_start || '|0') AS entity_uid
  FROM llm_all e
  WHERE item = 0 OR NOT EXISTS (SELECT 1 FROM llm_all o WHERE o.chunk_id = e.chunk_id AND o.item = 0
        AND o.span_start < e.span_end AND e.span_start < o.span_end AND (o.span_start, 0) < (e.span_start, 1))),
llm_kept AS (
  SELECT * FROM llm_entities e WHERE item = 1 OR NOT EXISTS (SELECT 1 FROM llm_all o WHERE o.chunk_id = e.chunk_id AND o.item = 1
        AND o.span_start < e.span_end AND e.span_start < o.span_end AND o.span_start < e.span_start))"""
_VALID = "," + inp.pack_values() + rf""",
legal AS (
  SELECT r.*, c.doc_id, c.line_no, c.text, contains(trim(regexp_replace(c.text, '{_SPACES}', ' ', 'g')), trim(regexp_replace(r.evidence_text, '{_SPACES}', ' ', 'g'))) AS grounded
  FROM relations r JOIN allowed USING (relation_type, src_type, dst_type) JOIN chunks c USING (chunk_id)),
voted AS (
  SELECT chunk_id, folder_id, doc_id, line_no, relation_type, src_surface, src_type, dst_surface, dst_type, min((run_idx, ord))[1] AS run_idx, min((run_idx, ord))[2] AS ord,
         count(DISTINCT run_idx) / 3::DOUBLE AS confidence, arg_min(evidence_text, (run_idx, ord)) AS evidence_text, arg_min(grounded, (run_idx, ord)) AS grounded, 'llm' AS extractor
  FROM legal GROUP BY chunk_id, folder_id, doc_id, line_no, relation_type, src_surface, src_type, dst_surface, dst_type HAVING count(DISTINCT run_idx) >= 2)"""
_EDGES = _LLM_ENTITIES + _VALID + """,
firsts AS (SELECT chunk_id, entity_type, surface_form, arg_min(entity_uid, item) AS entity_uid FROM llm_kept GROUP BY ALL),
edge_rows AS (
  SELECT l.folder_id, l.chunk_id, l.doc_id, l.line_no, l.run_idx, l.ord, l.relation_type, s.entity_uid AS src_entity_uid, d.entity_uid AS dst_entity_uid, l.confidence, l.evidence_text, l.extractor,
         sha256(l.folder_id || '|' || l.relation_type || '|' || s.entity_uid || '|' || d.entity_uid) AS edge_uid
  FROM voted l JOIN firsts s ON s.chunk_id = l.chunk_id AND s.entity_type = l.src_type AND s.surface_form = l.src_surface
               JOIN firsts d ON d.chunk_id = l.chunk_id AND d.entity_type = l.dst_type AND d.surface_form = l.dst_surface
  WHERE l.grounded)"""
_R = "WITH RECURSIVE "
_EDGE_SQL = _R + inp.RESPONSES + _EDGES + " SELECT folder_id, chunk_id, run_idx, ord, edge_uid, relation_type, src_entity_uid, dst_entity_uid, confidence, evidence_text, extractor FROM edge_rows"
_PAIRS = r""",
cut AS (SELECT chunk_id, string_split(replace(text, '.', '.' || chr(1)), chr(1)) AS parts FROM chunks),
sents AS (
  SELECT chunk_id, i - 1 AS sent_idx, length(array_to_string(parts[1:i - 1], '')) AS s, length(array_to_string(parts[1:i], '')) AS e
  FROM (SELECT chunk_id, parts, unnest(generate_series(1, len(parts))) AS i FROM cut)),
held AS (SELECT m.chunk_id, m.match_idx, m.surface_form, m.entity_type, s.sent_idx, s.s, s.e FROM mapped m JOIN sents s ON s.chunk_id = m.chunk_id AND s.s <= m.span_start AND m.span_start < s.e),
choices AS (SELECT src_type, dst_type, array_to_string(list_sort(list(relation_type)), ',') AS allowed FROM allowed GROUP BY ALL),
pairs AS (
  SELECT a.chunk_id, a.sent_idx, a.match_idx AS src, b.match_idx AS dst, a.surface_form AS src_surface, a.entity_type AS src_type, b.surface_form AS dst_surface, b.entity_type AS dst_type, allowed, a.s AS sentence_start, a.e AS sentence_end
  FROM held a JOIN held b ON a.chunk_id = b.chunk_id AND a.sent_idx = b.sent_idx AND a.match_idx <> b.match_idx JOIN choices c ON c.src_type = a.entity_type AND c.dst_type = b.entity_type),
batched AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY src, dst) - 1 AS n FROM pairs)"""
_PAIRS_WITH = _R + inp.CHUNKS + "," + inp.NER + "," + inp.pack_values() + _PAIRS


def _dep_sql(k: int, rel_type: str, src: str, src_type: str, dst: str, dst_type: str, sentence: str) -> str:
    return f"SELECT o_orderkey::VARCHAR AS chunk_id, '{rel_type}' AS relation_type, '{src}' AS src_surface, '{src_type}' AS src_type, '{dst}' AS dst_surface, '{dst_type}' AS dst_type, 1.0::DOUBLE AS confidence, '{sentence}' AS evidence_text, 'rules' AS extractor FROM orders WHERE o_orderkey % 3 = {k}"


_TOP = "row_number() OVER (PARTITION BY folder_id ORDER BY mention_count DESC, first)"
_PRONOUNS = ", ".join(f"'{p}'" for p in fx.PRONOUNS)
ORACLE_SQL = {
    "chunk_scan": "WITH" + inp.CHUNKS + " SELECT folder_id, 'ok' AS status, NULL::VARCHAR AS error_message, count(*) AS n_chunks, sum(length(text))::BIGINT AS n_chars, count(*) FILTER (text = '') AS n_empty FROM chunks GROUP BY folder_id UNION ALL SELECT 'nothing here', 'failed', 'no chunks in folder nothing here', 0, NULL, NULL",
    "regex_entities": "WITH" + inp.CHUNKS + "," + inp._patterns() + "," + inp.NER + " SELECT folder_id, chunk_id, entity_type, 'regex' AS layer, pattern_idx, match_idx, surface_form, span_start, span_start + length(surface_form) AS span_end FROM regex UNION ALL SELECT folder_id, chunk_id, entity_type, 'spacy', pattern_idx, match_idx, surface_form, span_start, span_start + length(surface_form) FROM mapped",
    "checksum_lei": "WITH b AS (SELECT o_orderkey, 'ABCD' || lpad(o_orderkey::VARCHAR, 14, '0') AS body FROM orders), c AS (SELECT o_orderkey, body || lpad(((98 - (('10111213' || substr(body, 5) || '00')::HUGEINT % 97) + o_orderkey % 2) % 100)::VARCHAR, 2, '0') AS code FROM b) SELECT o_orderkey, code, " + inp.LEI_VALID.format(code="code") + " AS valid FROM c",
    "checksum_isin": "WITH c AS (SELECT p_partkey, 'US' || lpad(p_partkey::VARCHAR, 9, '0') || (p_partkey % 10) AS code FROM part) SELECT p_partkey, code, " + inp.ISIN_VALID.format(code="code") + " AS valid FROM c",
    "label_mapping": "WITH" + inp.CHUNKS + "," + inp.NER + " SELECT chunk_id, surface_form, entity_type, span_start, span_start + length(surface_form) AS span_end, match_idx FROM mapped",
    "closed_vocab": "WITH" + inp.CANDIDATES + f" SELECT chunk_id, {_ORD}, surface_form, entity_type, layer FROM candidates WHERE entity_type IN ('Organization', 'Place', 'Code') AND confidence >= 0.6",
    "unmapped_count": "WITH" + inp.CANDIDATES + " SELECT folder_id, count(*) FILTER (entity_type = 'Gadget') AS unmapped_type_count FROM candidates GROUP BY folder_id",
    "pronoun_filter": f"SELECT * FROM (SELECT conv_id, turn, generate_subscripts(string_split(text, ' '), 1) - 1 AS pos, unnest(string_split(text, ' ')) AS surface_form FROM conversations) WHERE lower(regexp_replace(surface_form, '^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$', '', 'g')) NOT IN ({_PRONOUNS})",
    "guardrail_screen": "WITH" + inp.CANDIDATES + f", n AS (SELECT folder_id, count(*) FILTER (o5 = 0) AS z FROM known GROUP BY folder_id) SELECT folder_id, chunk_id, {_ORD}, surface_form FROM known JOIN n USING (folder_id) WHERE o5 % 5 <> 0 OR (folder_id = 'src3' AND z > 0)",
    "layer_merge": _R + inp.MENTIONS + f" SELECT chunk_id, {_ORD}, surface_form, entity_type, layer, span_start, span_end, occurrence_idx FROM mentions",
    "entity_uids": _R + inp.ENTITIES + f" SELECT folder_id, entity_uid, entity_type, surface_form, chunk_id AS source_chunk_id, span_start, span_end, occurrence_idx, layer AS extractor, CASE WHEN layer = 'llm' THEN 'made-up' END AS model_id, '{PACK}' AS ontology_pack, 'staged' AS stage FROM entities",
    "edge_uids": _EDGE_SQL,
    "top_entities": _R + inp.MENTIONS + f", c AS (SELECT folder_id, entity_type, surface_form, count(*) AS mention_count, min((o1, o2, o3, o4, o5)) AS first FROM mentions GROUP BY ALL) SELECT folder_id, entity_type, surface_form, mention_count, {_TOP} AS rank FROM c QUALIFY rank <= 10",
    "folder_summary": _R + inp.RESPONSES + _EDGES + f"""
, c AS (SELECT folder_id, entity_type, surface_form, count(*) AS mention_count, min((doc_id, line_no, item)) AS first FROM llm_kept GROUP BY ALL),
t AS (SELECT *, {_TOP} AS rank FROM c QUALIFY rank <= 5)
SELECT f.folder_id, coalesce(e.entity_count, 0) AS entity_count, coalesce(e.distinct_types, 0) AS distinct_types, coalesce(x.edge_count, 0) AS edge_count, coalesce(t.top_entities, '') AS top_entities, coalesce(u.n, 0) AS ungrounded_relation_count,
       '{PACK}' AS ontology_pack, '{load_pack(PACK).version}' AS ontology_version, 3 AS self_consistency_votes
FROM (SELECT DISTINCT folder_id FROM chunks UNION ALL SELECT 'quiet') f
LEFT JOIN (SELECT folder_id, count(*) AS entity_count, count(DISTINCT entity_type) AS distinct_types FROM llm_kept GROUP BY folder_id) e USING (folder_id)
LEFT JOIN (SELECT folder_id, count(DISTINCT (relation_type, src_entity_uid, dst_entity_uid)) AS edge_count FROM edge_rows GROUP BY folder_id) x USING (folder_id)
LEFT JOIN (SELECT folder_id, string_agg(entity_type || ':' || surface_form || ':' || mention_count, ';' ORDER BY rank) AS top_entities FROM t GROUP BY folder_id) t USING (folder_id)
LEFT JOIN (SELECT folder_id, count(*) FILTER (NOT grounded) AS n FROM voted GROUP BY folder_id) u USING (folder_id)""",
    "llm_parse_entities": "WITH" + inp.RESPONSES + _LLM_ENTITIES + " SELECT chunk_id, item, entity_type, surface_form, confidence, span_start, span_end FROM llm_all",
    "llm_parse_relations": "WITH" + inp.RESPONSES + " SELECT chunk_id, run_idx, ord, relation_type, src_surface, src_type, dst_surface, dst_type, confidence, evidence_text, extractor FROM relations",
    "entity_scoped_parse": "WITH" + inp.RESPONSES + _LLM_ENTITIES + ", n AS (SELECT chunk_id, count(*) AS n_entities FROM llm_kept GROUP BY chunk_id HAVING count(*) >= 2) SELECT chunk_id, run_idx, ord, relation_type, src_surface, dst_surface, confidence, 'llm-entity-scoped' AS extractor, n_entities FROM relations JOIN n USING (chunk_id)",
    "classify_parse": _PAIRS_WITH + " SELECT chunk_id, (n // 20) * 20 + n % 20 AS ord, split_part(allowed, ',', 1) AS relation_type, src_surface, src_type, dst_surface, dst_type, 1.0::DOUBLE AS confidence, src_surface AS evidence_text, 'llm-classify' AS extractor FROM batched WHERE (n % 20) % 2 = 0",
    "coref_apply": "WITH" + inp.CHUNKS + r" SELECT chunk_id, CASE WHEN line_no % 3 = 1 THEN regexp_replace('They: ' || text, '[\s\x1c-\x1f]+$', '') ELSE text END AS text FROM chunks",
    "evidence_grounding": _R + inp.RESPONSES + _VALID + " SELECT chunk_id, run_idx, ord, relation_type, evidence_text, grounded FROM legal",
    "relation_validate": _R + inp.RESPONSES + _VALID + " SELECT folder_id, count(*) FILTER (NOT grounded) AS ungrounded_relation_count, nullif(count(*) FILTER (grounded), 0) AS n_valid FROM (SELECT l.folder_id, l.grounded FROM legal l) GROUP BY folder_id",
    "edge_build": _EDGE_SQL,
    "edge_merge": _R + inp.RESPONSES + _EDGES + """
, k AS (SELECT folder_id, relation_type, substr(src_entity_uid, 1, 1) AS src_entity_uid, substr(dst_entity_uid, 1, 1) AS dst_entity_uid, confidence, evidence_text, extractor, doc_id, line_no, run_idx, ord, 1 AS layer, 0 AS part FROM edge_rows),
u AS (SELECT * FROM k UNION ALL SELECT * REPLACE ('rules' AS extractor, 1.0 AS confidence, relation_type AS evidence_text, 0 AS layer) FROM k WHERE ord = 0 UNION ALL SELECT * REPLACE ('llm-classify' AS extractor, 2 AS part) FROM k WHERE ord = 1),
ev AS (SELECT folder_id, relation_type, src_entity_uid, dst_entity_uid, evidence_text, min((layer, run_idx, doc_id, line_no, ord, part)) AS first FROM u WHERE evidence_text <> '' GROUP BY ALL),
j AS (SELECT folder_id, relation_type, src_entity_uid, dst_entity_uid, string_agg(evidence_text, '; ' ORDER BY first) AS joined FROM ev GROUP BY ALL)
SELECT folder_id, relation_type, src_entity_uid, dst_entity_uid, max(confidence) AS confidence, sha256(any_value(joined)) AS evidence_digest,
       array_to_string(list_sort(list(DISTINCT extractor), 'ASC').list_filter(lambda x: x = 'rules') || list_sort(list(DISTINCT extractor)).list_filter(lambda x: x = 'llm') || list_sort(list(DISTINCT extractor)).list_filter(lambda x: x NOT IN ('rules', 'llm')), '+') AS extractor,
       arg_min(doc_id || '#' || line_no, (layer, run_idx, doc_id, line_no, ord, part)) AS first_chunk
FROM u JOIN j USING (folder_id, relation_type, src_entity_uid, dst_entity_uid) GROUP BY folder_id, relation_type, src_entity_uid, dst_entity_uid""",
    "self_consistency_vote": "WITH" + inp.RESPONSES + " SELECT chunk_id, min((run_idx, ord))[1] AS run_idx, min((run_idx, ord))[2] AS ord, relation_type, src_surface, src_type, dst_surface, dst_type, count(DISTINCT run_idx) / 3::DOUBLE AS confidence, arg_min(evidence_text, (run_idx, ord)) AS evidence_text, 'llm' AS extractor FROM relations GROUP BY chunk_id, relation_type, src_surface, src_type, dst_surface, dst_type HAVING count(DISTINCT run_idx) >= 2",
    "candidate_pairs": _PAIRS_WITH + " SELECT * FROM pairs",
    "dep_match_svo": _dep_sql(0, "supplies", "acme", "Organization", "parts", "Organization", "acme supplies parts"),
    "dep_match_prep": _dep_sql(1, "works_for", "ann", "Person", "acme", "Organization", "ann works at acme"),
    "dep_match_copula": _dep_sql(2, "located_in", "bob", "Agent", "paris", "Place", "bob is paris"),
    "preview": "SELECT * FROM (VALUES ('Email', 'sales@acme.example.com', 9, 31, 1.0::DOUBLE, 'regex'), ('Code', '12345678', 44, 52, 1.0, 'regex')) t(entity_type, surface_form, span_start, span_end, confidence, extractor)",
    "preview_edges": _R + inp.RESPONSES + _EDGES + ", m AS (SELECT folder_id, relation_type, src_entity_uid, dst_entity_uid, max(confidence) AS confidence, string_agg(DISTINCT evidence_text, '; ') AS evidence_text FROM edge_rows GROUP BY ALL) SELECT relation_type, s.surface_form AS src_surface, d.surface_form AS dst_surface, m.confidence, m.evidence_text FROM m LEFT JOIN llm_kept s ON s.entity_uid = src_entity_uid LEFT JOIN llm_kept d ON d.entity_uid = dst_entity_uid",
    "request_plan": _PAIRS_WITH + " SELECT chunk_id, 3::BIGINT AS n_generate, coalesce(n_classify, 0) AS n_classify FROM chunks LEFT JOIN (SELECT chunk_id, count(DISTINCT n // 20) AS n_classify FROM batched GROUP BY chunk_id) USING (chunk_id)",
    "scoped_prompts": _R + inp.RESPONSES + _LLM_ENTITIES + f""", l AS (SELECT chunk_id, count(*) AS n_entities, string_agg('- "' || surface_form || '" (' || entity_type || ')', chr(10) ORDER BY item) AS lines FROM llm_kept GROUP BY chunk_id HAVING count(*) >= 2)
SELECT chunk_id, n_entities, sha256('{rel.DATA_ONLY}' || chr(10) || chr(10) || 'ENTITIES:' || chr(10) || lines || chr(10) || chr(10) || 'TEXT:' || chr(10) || text) AS user_digest FROM l JOIN chunks USING (chunk_id)""",
    "tool_inputs": "SELECT event_id, CASE WHEN event_id % 3 <> 0 AND event_id % 5 <> 0 THEN '{\"n\":' || event_id || '}' END AS input, 't' || event_id AS first_text FROM events",
    "usage_rollup": "SELECT event_type AS folder_id, 'model-' || (user_id % 3) AS model, count(*) AS calls, sum(event_id % 1000)::BIGINT AS input_tokens, sum(event_id % 77)::BIGINT AS output_tokens FROM events GROUP BY ALL",
    "attempts": "WITH" + inp.RESPONSES + " SELECT chunk_id, run_idx, (doc_id % 5 = 0 AND ends_with(chunk_id, '3')) OR ends_with(chunk_id, '1') AS failed FROM answers",
}

ORACLE_SQL["folder_state"] = f"""
SELECT f.folder_id, CASE WHEN f.folder_id = 'nothing here' THEN 'failed' ELSE 'ok' END AS status, CASE WHEN f.folder_id = 'nothing here' THEN 'no chunks in folder nothing here' END AS error_message, s.* EXCLUDE (folder_id)
FROM (SELECT DISTINCT source AS folder_id FROM documents UNION ALL SELECT unnest(['nothing here', 'quiet'])) f LEFT JOIN ({ORACLE_SQL["folder_summary"]}) s USING (folder_id)"""
