"""Inputs of the queries, derived from the driver's tables twice: as DataFrames, and as CTEs for DuckDB.

Lines of documents are chunks, sources are folders. What models would have said is made up from capitalized words by
rules of arithmetic, so that either engine makes up the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..ontology import load_pack
from ..operators import entities as ent
from ..sources.chunks import lines_as_chunks

PACK = "commerce"
CAPITALIZED = "[A-Z][a-z]{5,}"
TWO_WORDS = "[A-Z][a-z]{3,} [a-z]+"
LABELS = ("PERSON", "ORG", "GPE", "PRODUCT", "MISC")
LLM_TYPES = ("Organization", "Person", "Place", "Gadget")
TYPES = ("Organization", "Person", "Place")
RELATIONS = ("supplies", "works_for", "located_in", "related_to")
RUNS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_as_chunks(table(spark, sf_dir, "documents"))


def pick(values: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def annotations(lines: DataFrame) -> DataFrame:
    """ner: every capitalized word, labelled by its length."""
    found = ent.find_patterns(lines, [(0, CAPITALIZED)])
    return found.select("chunk_id", F.col("match_idx").cast("long").alias("ord"), pick(LABELS, F.char_length("surface_form")).alias("label"), F.col("surface_form").alias("text"), F.col("span_start").alias("start"), F.col("span_end").alias("end"))


def llm_candidates(lines: DataFrame) -> DataFrame:
    """Two words as one mention; every third has no span, and one type is none of the pack's."""
    found = ent.find_patterns(lines, [(0, TWO_WORDS)])
    length = F.char_length("surface_form")
    spanned = F.col("match_idx") % 3 != 0
    return found.select(
        "folder_id", "chunk_id", ent._ord(2, 0, "match_idx").alias("ord"), "surface_form", pick(LLM_TYPES, length).alias("entity_type"), F.lit("llm").alias("layer"),
        F.when(spanned, F.col("span_start")).alias("span_start"), F.when(spanned, F.col("span_end")).alias("span_end"), (F.lit(0.5) + (length % 5) / 10).alias("confidence"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = chunks(spark, sf_dir)
    pack = load_pack(PACK)
    return ent.regex_entities(lines, pack).unionByName(ent.map_labels(annotations(lines), lines, pack)).unionByName(llm_candidates(lines))


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged candidates of known types with confidence of at least 0.6."""
    return ent.merge_layers(ent.closed_vocabulary(candidates(spark, sf_dir), load_pack(PACK), threshold=0.6))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ent.entity_records(mentions(spark, sf_dir), load_pack(PACK), "made-up")


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[\x00-\x1f]", " "), r"\\", r"\\\\"), '"', r'\\"'), F.lit('"'))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers on chunks with two capitalized words or more, for each of three runs.

    Every fifth document's first attempt is malformed; every seventh document has no list of relations.
    """
    # What a line says is put into words once, not for each of its answers; capitalized words are looked for once.
    found = F.filter(F.array(F.regexp_extract_all("text", F.lit(f"({CAPITALIZED})"))), lambda c: F.size(c) >= 2)
    lines = chunks(spark, sf_dir).select("chunk_id", "doc_id", "line_no", "text", F.explode(found).alias("caps"))
    a, b = F.col("caps")[0], F.col("caps")[1]
    la, lb = F.char_length(a), F.char_length(b)
    ta, tb = pick(TYPES, la), pick(TYPES, lb)
    evidence = _quoted(F.when(F.col("line_no") % 6 == 5, F.lit("not in the text")).otherwise(F.substring("text", 1, 40)))

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    none = F.col("doc_id") % 7 == 0
    head = text('{"entities":[{"type":"', ta, '","surface":"', a, '","confidence":0.8},{"type":"', tb, '","surface":"', b, '"},{"surface":"x"}],"relations":')
    first = text('","src":"', a, '","src_type":"', ta, '","dst":"', b, '","dst_type":"', tb, '","confidence":"0.9","evidence":', F.col("__evidence"), "}")
    second = text('{"type":"related_to","src":"', b, '","src_type":"', tb, '","dst":"', a, '","dst_type":"', ta, '","evidence":', F.col("__evidence"), "}")
    lines = lines.withColumn("__evidence", evidence).select(
        "chunk_id", "doc_id", (la + lb).alias("__n"),
        F.when(none, text(head, '"none"}')).otherwise(text(head, '[{"type":"')).alias("__before"), F.when(none, "").otherwise(text(first, ",", second, "]}")).alias("__after"),
    )
    lines = lines.withColumn("run_idx", F.explode(F.array(*map(F.lit, range(1, RUNS + 1)))))
    n = F.col("__n") + F.when((F.col("doc_id") + F.col("run_idx")) % 4 == 0, 1).otherwise(0)
    body = text(F.col("__before"), F.when(none, "").otherwise(pick(RELATIONS, n)), F.col("__after"))
    bad = (F.col("doc_id") % 5 == 0) & (F.col("attempt") == 1)
    out = lines.withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2))))
    return out.select("chunk_id", F.lit("generate").alias("mode"), "run_idx", "attempt", F.lit(0).alias("batch_no"), F.when(bad, "{not json").otherwise(body).alias("body"), F.lit(None).cast("string").alias("error_code"))


# --- the same for DuckDB --------------------------------------------------------------------------------------


def sql_list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


CHUNKS = """
chunks AS (
  SELECT source AS folder_id, doc_id || '#' || (i - 1) AS chunk_id, doc_id, i - 1 AS line_no, line AS text
  FROM (SELECT source, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents))"""


def scan(name: str, pattern: str, pattern_idx: int = 0) -> str:
    """Matches of a pattern with offsets: marks around each match, then the lengths between marks."""
    return f"""
{name} AS (
  SELECT folder_id, chunk_id, doc_id, line_no, {pattern_idx} AS pattern_idx, k - 1 AS match_idx,
         (head + coalesce(sum(length(seg) - 1) OVER (PARTITION BY chunk_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::INT AS span_start,
         split_part(seg, chr(2), 1) AS surface_form
  FROM (SELECT folder_id, chunk_id, doc_id, line_no, length(parts[1]) AS head, unnest(parts[2:]) AS seg, generate_subscripts(parts[2:], 1) AS k
        FROM (SELECT *, string_split(regexp_replace(text, '({pattern})', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS parts FROM chunks)
        WHERE len(parts) > 1))"""


def _patterns() -> str:
    pack = load_pack(PACK)
    scans = [scan(f"p{i}", p["pattern"], i) for i, p in enumerate(pack.regex_patterns)]
    valid = {"lei": LEI_VALID, "isin": ISIN_VALID}
    union = " UNION ALL ".join(
        f"SELECT *, '{p['entity_type']}' AS entity_type FROM p{i}" + (f" WHERE {valid[p['checksum']].format(code='surface_form')}" if p.get("checksum") else "")
        for i, p in enumerate(pack.regex_patterns)
    )
    return ",".join(scans) + f",\nregex AS ({union})"


_EXPANDED = "array_to_string(list_transform(string_split({code}, ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE (ascii(upper(c)) - 55)::VARCHAR END), '')"
LEI_VALID = "(regexp_full_match({code}, '[A-Za-z0-9]{{20}}') AND ((substr(" + _EXPANDED + ", 1, 20)::HUGEINT % 97)::VARCHAR || substr(" + _EXPANDED + ", 21))::HUGEINT % 97 = 1)"
ISIN_VALID = (
    "(regexp_full_match({code}, '[A-Za-z0-9]{{12}}') AND list_sum(list_transform(string_split(reverse(" + _EXPANDED + "), ''), "
    "lambda c, i: CASE WHEN i % 2 = 1 THEN c::INT WHEN c::INT * 2 > 9 THEN c::INT * 2 - 9 ELSE c::INT * 2 END)) % 10 = 0)"
)

NER = scan("caps", CAPITALIZED) + f""",
ner AS (SELECT *, {sql_list(LABELS)}[(length(surface_form) % 5 + 1)::INT] AS label FROM caps),
labels_map AS (SELECT unnest(['PERSON', 'ORG', 'SUPPLIER', 'CUSTOMER', 'GPE', 'PRODUCT']) AS label,
                      unnest(['Person', 'Organization', 'Supplier', 'Customer', 'Place', 'Product']) AS entity_type),
mapped AS (SELECT n.*, m.entity_type FROM ner n JOIN labels_map m USING (label))"""

CANDIDATES = CHUNKS + "," + _patterns() + "," + NER + "," + scan("two", TWO_WORDS) + f""",
candidates AS (
  SELECT folder_id, chunk_id, 0 AS o1, pattern_idx AS o2, doc_id AS o3, line_no AS o4, match_idx AS o5, surface_form, entity_type, 'regex' AS layer, span_start, span_start + length(surface_form) AS span_end, 1.0::DOUBLE AS confidence FROM regex
  UNION ALL
  SELECT folder_id, chunk_id, 1, 0, doc_id, line_no, match_idx, surface_form, entity_type, 'spacy', span_start, span_start + length(surface_form), 1.0 FROM mapped
  UNION ALL
  SELECT folder_id, chunk_id, 2, 0, doc_id, line_no, match_idx, surface_form, {sql_list(LLM_TYPES)}[(length(surface_form) % 4 + 1)::INT], 'llm',
         CASE WHEN match_idx % 3 <> 0 THEN span_start END, CASE WHEN match_idx % 3 <> 0 THEN span_start + length(surface_form) END, 0.5::DOUBLE + (length(surface_form) % 5) / 10::DOUBLE FROM two),
known AS (SELECT * FROM candidates WHERE entity_type <> 'Gadget')"""

def greedy(source: str) -> str:
    """Greedy choice of spans, one candidate of each chunk at a time."""
    return f""",
kept0 AS (
  SELECT *, CASE WHEN span_start IS NULL THEN row_number() OVER (PARTITION BY chunk_id, entity_type, surface_form, span_start IS NULL ORDER BY o1, o2, o3, o4, o5) - 1 ELSE 0 END AS occurrence_idx
  FROM {source}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY CASE layer WHEN 'regex' THEN 3 WHEN 'spacy' THEN 2 ELSE 1 END DESC, span_start, o1, o2, o3, o4, o5) AS rn
  FROM kept0 WHERE span_start IS NOT NULL),
greedy AS (
  SELECT chunk_id, 0::BIGINT AS rn, []::INT[] AS ss, []::INT[] AS es, NULL::BOOLEAN AS keep FROM (SELECT DISTINCT chunk_id FROM ranked)
  UNION ALL
  SELECT g.chunk_id, r.rn,
         CASE WHEN free THEN list_append(g.ss, r.span_start::INT) ELSE g.ss END, CASE WHEN free THEN list_append(g.es, r.span_end::INT) ELSE g.es END, free
  FROM greedy g JOIN ranked r ON r.chunk_id = g.chunk_id AND r.rn = g.rn + 1,
       LATERAL (SELECT len(list_filter(g.ss, lambda s, i: s < r.span_end AND r.span_start < g.es[i])) = 0 AS free)),
mentions AS (
  SELECT r.* EXCLUDE (rn) FROM ranked r JOIN greedy g ON g.chunk_id = r.chunk_id AND g.rn = r.rn AND g.keep
  UNION ALL SELECT * FROM kept0 WHERE span_start IS NULL)"""


MENTIONS = CANDIDATES + greedy("(SELECT * FROM known WHERE confidence >= 0.6)")

ENTITIES = MENTIONS + """,
entities AS (
  SELECT *, sha256(folder_id || '|' || chunk_id || '|' || entity_type || '|' || surface_form || '|' || coalesce(span_start::VARCHAR, '') || '|' || occurrence_idx) AS entity_uid FROM mentions)"""

_TYPE = sql_list(TYPES)
RESPONSES = CHUNKS + rf""",
two_caps AS (SELECT *, regexp_extract_all(text, '{CAPITALIZED}') AS caps FROM chunks),
worded AS (
  SELECT *, caps[1] AS a, caps[2] AS b, {_TYPE}[(length(caps[1]) % 3 + 1)::INT] AS ta, {_TYPE}[(length(caps[2]) % 3 + 1)::INT] AS tb,
         CASE WHEN line_no % 6 = 5 THEN 'not in the text' ELSE substr(text, 1, 40) END AS evidence,
         length(caps[1]) + length(caps[2]) AS n
  FROM two_caps WHERE len(caps) >= 2),
runs AS (SELECT unnest([1, 2, 3]) AS run_idx),
answers AS (
  SELECT chunk_id, folder_id, run_idx, doc_id,
    to_json(struct_pack(
      entities := [struct_pack(type := ta, surface := a, confidence := '0.8'), struct_pack(type := tb, surface := b, confidence := NULL), struct_pack(type := NULL, surface := 'x', confidence := NULL)],
      relations := CASE WHEN doc_id % 7 = 0 THEN NULL ELSE [
        struct_pack(type := {sql_list(RELATIONS)}[((n + CASE WHEN (doc_id + run_idx) % 4 = 0 THEN 1 ELSE 0 END) % 4 + 1)::INT], src := a, src_type := ta, dst := b, dst_type := tb, confidence := '0.9', evidence := regexp_replace(evidence, '[\x00-\x1f]', ' ', 'g')),
        struct_pack(type := 'related_to', src := b, src_type := tb, dst := a, dst_type := ta, confidence := NULL, evidence := regexp_replace(evidence, '[\x00-\x1f]', ' ', 'g'))] END)) AS body
  FROM worded, runs),
relations AS (
  SELECT chunk_id, folder_id, run_idx, (i - 1) AS ord, r->>'type' AS relation_type, r->>'src' AS src_surface, r->>'src_type' AS src_type, r->>'dst' AS dst_surface, r->>'dst_type' AS dst_type,
         coalesce((r->>'confidence')::DOUBLE, 0.6) AS confidence, r->>'evidence' AS evidence_text, 'llm' AS extractor
  FROM (SELECT chunk_id, folder_id, run_idx, unnest(json_extract(body, '$.relations[*]')) AS r, generate_subscripts(json_extract(body, '$.relations[*]'), 1) AS i FROM answers)
  WHERE r->>'type' <> '' AND r->>'evidence' <> '')"""


def closure_values() -> str:
    pack = load_pack(PACK)
    rows = [f"('{t}', '{a}', {d + 1})" for t in pack.parents for d, a in enumerate(pack.ancestors(t))]
    return "closure(type, ancestor, depth) AS (VALUES " + ", ".join(rows) + ")"


def pack_values() -> str:
    """The pack as its author wrote it; hierarchy and legal pairs are left to SQL."""
    pack = load_pack(PACK)
    types = ", ".join(f"('{t['type']}', {_or_null(t.get('parent'))}, {i})" for i, t in enumerate(pack.entity_types))
    ends = ", ".join(f"('{r['type']}', {sql_list(tuple(r['domain']))}, {sql_list(tuple(r['range']))})" for r in pack.relations)
    return f"""
types(type, parent, decl_idx) AS (VALUES {types}),
rels(relation_type, dom, rng) AS (VALUES {ends}),
up AS (SELECT type, parent AS ancestor, 1 AS depth FROM types WHERE parent IS NOT NULL
       UNION ALL SELECT u.type, t.parent, u.depth + 1 FROM up u JOIN types t ON t.type = u.ancestor WHERE t.parent IS NOT NULL),
selfup AS (SELECT type, type AS ancestor FROM types UNION ALL SELECT type, ancestor FROM up),
allowed AS (
  SELECT DISTINCT r.relation_type, s.type AS src_type, d.type AS dst_type
  FROM rels r JOIN selfup s ON list_contains(r.dom, s.ancestor) JOIN selfup d ON list_contains(r.rng, d.ancestor))"""


def _or_null(x: str | None) -> str:
    return "NULL" if x is None else f"'{x}'"
