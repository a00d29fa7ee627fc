"""Queries of canonicalization, export and the scorers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import Settings
from ..functions import text as fx
from ..ontology import load_pack
from ..operators import canon, graph, quality
from ..operators import entities as ent
from ..operators import relations as rel
from ..plans import canonicalization as plan
from ..plans.extraction import extract
from ..sources import scratch, sinks
from ..sources.scratch import materialize
from . import inputs as inp
from .inputs import chunks, pick, table

PACK = inp.PACK
PART_TYPES = ("Product", "Organization", "Gadget")


def mentions(spark, sf_dir):
    """Names of suppliers, parts and customers as staged mentions of four folders.

    A supplier is named by its name, again with a legal form, and twice by a trade name: of even keys the second
    spelling lacks a letter and is certainly the same, of odd ones it is another word and doubtful.
    """
    s, p, c = (table(spark, sf_dir, t) for t in ("supplier", "part", "customer"))

    def rows(df, key, tag, base, kind, surface):
        k = F.col(key).cast("long")
        return df.select(
            F.concat(F.lit("f"), (k % 4).cast("string")).alias("folder_id"), (k + base).alias("ord"), F.sha2(F.concat(F.lit(tag), k.cast("string")), 256).alias("entity_uid"),
            kind.alias("entity_type"), surface.alias("surface_form"), F.lit("staged").alias("stage"), F.lit(PACK).alias("ontology_pack"),
        )

    trade = lambda name: F.concat(F.lit("K"), F.col("s_suppkey").cast("string"), name)
    first = rows(s, "s_suppkey", "s", 0, F.lit("Supplier"), F.col("s_name"))
    again = rows(s, "s_suppkey", "t", 10_000_000, F.when(F.col("s_suppkey") % 3 == 0, "Organization").otherwise("Supplier"), F.concat(F.upper("s_name"), F.lit(", Inc.")))
    parts = rows(p, "p_partkey", "p", 20_000_000, pick(PART_TYPES, F.col("p_partkey")), F.concat("p_name", F.lit(" Co")))
    buyers = rows(c, "c_custkey", "c", 30_000_000, F.lit("Customer"), F.when(F.col("c_custkey") % 10 == 0, "The Group").otherwise(F.col("c_name")))
    named = rows(s, "s_suppkey", "u", 40_000_000, F.lit("Organization"), trade(F.lit(" Northern Trading Partners")))
    spelled = rows(s, "s_suppkey", "v", 50_000_000, F.lit("Supplier"), trade(F.when(F.col("s_suppkey") % 2 == 0, " Northern Tradin Partners").otherwise(" Southern Trading Partners")))
    return first.unionByName(again).unionByName(parts).unionByName(buyers).unionByName(named).unionByName(spelled)


def mention_edges(spark, sf_dir):
    """Who supplies which part, by lines of orders; some confidences and evidences are missing."""
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("f"), (k % 4).cast("string")).alias("folder_id"), (k * 8 + n).alias("ord"), F.lit("supplies").alias("relation_type"),
        F.sha2(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")), 256).alias("src_entity_uid"), F.sha2(F.concat(F.lit("p"), F.col("l_partkey").cast("string")), 256).alias("dst_entity_uid"),
        F.when(k % 11 != 0, F.col("l_discount")).alias("confidence"), F.when(k % 7 == 0, "").otherwise(F.concat_ws("-", "l_returnflag", k.cast("string"), n.cast("string"))).alias("evidence_text"),
    )


def normalize_surface(spark, sf_dir):
    return mentions(spark, sf_dir).select("entity_uid", fx.normalize_surface(F.col("surface_form")).alias("normalized_form"))


def block_keys(spark, sf_dir):
    return canon.with_forms(mentions(spark, sf_dir)).groupBy("block").agg(F.count("*").alias("n_mentions"), F.count_distinct("normalized_form").alias("n_forms"))


def _exact(spark, sf_dir):
    return canon.exact_clusters(canon.with_forms(mentions(spark, sf_dir)))


def exact_clusters(spark, sf_dir):
    return _exact(spark, sf_dir).groupBy("cluster_id").agg(F.min("normalized_form").alias("normalized_form"), F.count("*").alias("n_mentions"), F.min("ord").alias("first_ord")).drop("cluster_id")


def reconcile_type(spark, sf_dir):
    found = canon.canonical_clusters(_exact(spark, sf_dir), load_pack(PACK))
    return found.select("normalized_form", "entity_type", "canonical_key", "n_mentions")


def _worded(spark, sf_dir):
    """Pairs of words from documents as mentions; those that begin alike share a block."""
    found = ent.find_patterns(chunks(spark, sf_dir), [(0, inp.TWO_WORDS)])
    return found.select("folder_id", F.struct("doc_id", "line_no", "match_idx").alias("ord"), F.sha2(F.concat_ws("|", "chunk_id", "match_idx"), 256).alias("entity_uid"), F.lit("Organization").alias("entity_type"), "surface_form")


def fuzzy_pairs(spark, sf_dir):
    return canon.fuzzy_pairs(canon.distinct_forms(canon.with_forms(_worded(spark, sf_dir))))


def fuzzy_clusters(spark, sf_dir):
    """Ambiguous pairs are decided by the length of the two forms: even is yes."""
    own = materialize(canon.with_forms(_worded(spark, sf_dir)), "mentions")
    pairs = materialize(canon.fuzzy_pairs(canon.distinct_forms(own)), "pairs")
    answers = canon.questions(pairs, own).select("a_uid", "b_uid", F.when((F.char_length("form_a") + F.char_length("form_b")) % 2 == 0, " Yes.").otherwise("no").alias("answer"))
    clustered = canon.clusters(own, canon.adjudicated(pairs, own, answers, "reject"))
    return clustered.groupBy("cluster_id").agg(F.min_by("normalized_form", "ord").alias("normalized_form"), F.count("*").alias("n_mentions"), F.count_distinct("normalized_form").alias("n_forms")).drop("cluster_id")


def _batches(spark, sf_dir):
    """Folders f0 and f1, then f2 and f3; nobody is asked about doubtful pairs."""
    entities = mentions(spark, sf_dir)
    edges = mention_edges(spark, sf_dir)
    first = plan.canonicalize(entities, edges, plan.empty_index(spark), plan.empty_edges(spark), ["f0", "f1"], policy="reject")
    second = plan.canonicalize(first.entities, edges, first.index, lambda: first.edges, ["f2", "f3"], policy="reject")
    return first, second


def resolve_or_mint(spark, sf_dir):
    first, second = _batches(spark, sf_dir)
    known = first.index.select("canonical_key", F.lit(1).alias("batch"))
    return second.index.join(known, "canonical_key", "left").select("canonical_key", "canonical_id", "entity_type", "normalized_form", F.coalesce("batch", F.lit(2)).alias("batch"))


def canonicalize_batch(spark, sf_dir):
    return _batches(spark, sf_dir)[1].entities.select("entity_uid", "canonical_id", "normalized_form", "stage")


def batch_counts(spark, sf_dir):
    first, second = _batches(spark, sf_dir)
    return first.counts.withColumn("batch", F.lit(1)).union(second.counts.withColumn("batch", F.lit(2)))


def _flat(edges):
    return edges.withColumn("evidence_text", F.array_join("evidence_text", "; "))


def canonical_edges(spark, sf_dir):
    """All edges aggregated at once."""
    second = _batches(spark, sf_dir)[1]
    return _flat(graph.canonical_edges(mention_edges(spark, sf_dir), second.entities))


def incremental_edges(spark, sf_dir):
    """The same table, kept up to date batch by batch."""
    return _flat(_batches(spark, sf_dir)[1].edges)


def partition_replace(spark, sf_dir):
    """Two writes of all folders, one of a folder with half its rows, one of a folder without any: the others stay."""
    rows = mentions(spark, sf_dir).select("folder_id", "entity_uid", "surface_form")
    path = scratch.put(rows.limit(0), "replaced")
    only = lambda folder: spark.createDataFrame([(folder,)], "folder_id string")
    sinks.replace_folders(rows, path)
    sinks.replace_folders(rows, path)
    sinks.replace_folders(rows.where("folder_id = 'f1' and entity_uid < '8'"), path, only("f1"))
    sinks.replace_folders(rows.where("folder_id = 'nothing'"), path, only("f2"))
    return spark.read.parquet(path).select("folder_id", "entity_uid", "surface_form")


def upsert_rows(spark, sf_dir):
    rows = mentions(spark, sf_dir).select("entity_uid", "surface_form", "ord")
    new = rows.where("ord % 3 = 0").withColumn("surface_form", F.upper("surface_form")).withColumn("ord", F.col("ord") + 1)
    return sinks.upsert(rows, new.unionByName(new.withColumn("ord", F.col("ord") + 1)), ["entity_uid"], "ord")


def resolved_edges(spark, sf_dir):
    """Edges both of whose ends are mentions of the first two folders."""
    written = mentions(spark, sf_dir).where("folder_id in ('f0', 'f1')")
    return sinks.resolve_written(mention_edges(spark, sf_dir), written).groupBy("folder_id").agg(F.count("*").alias("n_edges"))


def _graph(spark, sf_dir, folders=None):
    second = _batches(spark, sf_dir)[1]
    nodes = graph.export_nodes(second.entities, second.index, folders)
    return nodes, graph.export_edges(second.edges, nodes if folders else None)


def export_nodes(spark, sf_dir):
    return _graph(spark, sf_dir)[0].withColumn("folder_ids", F.array_join("folder_ids", ","))


def export_edges(spark, sf_dir):
    return _flat(_graph(spark, sf_dir, ["f0"])[1])


def export_statements(spark, sf_dir):
    nodes, edges = _graph(spark, sf_dir)
    return graph.export_statements(nodes, edges).select("kind", "key", "cypher", F.get_json_object("params", "$.provenance").alias("provenance"), F.get_json_object("params", "$.support_count").alias("support_count"))


def export_counts(spark, sf_dir):
    return graph.export_counts(*_graph(spark, sf_dir, ["f0"]))


def graph_build(spark, sf_dir):
    """From documents to the nodes of the graph: extraction with patterns and responses, one batch of all folders."""
    found = extract(chunks(spark, sf_dir), Settings(engine="llm", pack=PACK), {"responses": inp.responses(spark, sf_dir)})
    batch = plan.canonicalize(found.entities, lambda: found.edges, plan.empty_index(spark), plan.empty_edges(spark), None, policy="reject")
    nodes = graph.export_nodes(batch.entities, batch.index)
    return nodes.select("canonical_id", "entity_type", "normalized_form", F.array_join("folder_ids", ",").alias("folder_ids"), "mention_count")


def _gold(spark, sf_dir):
    found = ent.find_patterns(chunks(spark, sf_dir), [(0, inp.CAPITALIZED)])
    return found.withColumn("entity_type", pick(inp.TYPES, F.char_length("surface_form")))


def span_f1(spark, sf_dir):
    found = _gold(spark, sf_dir)
    return quality.span_f1(found.where("match_idx % 7 <> 0"), found.where("match_idx % 5 <> 0"), ["chunk_id", "span_start", "span_end", "entity_type"])


def edge_stability(spark, sf_dir):
    relations = rel.parse_relations(rel.first_valid(inp.responses(spark, sf_dir)))
    return quality.run_stability(relations, spark.range(1, inp.RUNS + 1).select(F.col("id").cast("int").alias("run_idx")))


def cluster_prf(spark, sf_dir):
    """Clusters by form against clusters by the last digit of the mention's number."""
    own = canon.with_forms(mentions(spark, sf_dir))
    return quality.cluster_prf(own.select(F.col("normalized_form").alias("predicted"), F.concat(F.col("block"), (F.col("ord") % 100).cast("string")).alias("gold")))


def relaxed_entity_f1(spark, sf_dir):
    """Every third predicted surface lacks its last letter, every fourth is another type's."""
    found = _gold(spark, sf_dir).select("chunk_id", F.col("match_idx").alias("ord"), "entity_type", "surface_form")
    predicted = found.withColumn("surface_form", F.when(F.col("ord") % 3 == 0, F.substring("surface_form", 1, 5)).otherwise(F.lower("surface_form"))).withColumn("entity_type", F.when(F.col("ord") % 4 == 0, "Place").otherwise(F.col("entity_type")))
    return quality.relaxed_entity_f1(predicted, found)


def relation_f1(spark, sf_dir):
    relations = rel.parse_relations(rel.first_valid(inp.responses(spark, sf_dir)))
    return quality.relation_f1(relations.where("run_idx = 2"), relations.where("run_idx = 1"))


def pack_closure(spark, sf_dir):
    return load_pack(PACK).closure_table(spark)


def pack_allowed(spark, sf_dir):
    return load_pack(PACK).allowed_table(spark)


QUERIES = {
    f: globals()[f]
    for f in (
        "normalize_surface", "block_keys", "exact_clusters", "reconcile_type", "fuzzy_pairs", "fuzzy_clusters", "resolve_or_mint", "canonicalize_batch", "batch_counts", "canonical_edges",
        "incremental_edges", "partition_replace", "upsert_rows", "resolved_edges", "export_nodes", "export_edges", "export_statements", "export_counts", "span_f1", "edge_stability", "cluster_prf",
        "relaxed_entity_f1", "relation_f1", "pack_closure", "pack_allowed", "graph_build",
    )
}

# --- DuckDB -----------------------------------------------------------------------------------------------------

_LEGAL = ", ".join(f"'{x}'" for x in fx.LEGAL_FORMS)
_FORM = rf"array_to_string(list_filter(string_split_regex(regexp_replace(lower(surface_form), '[^a-z0-9\s]', ' ', 'g'), '\s+'), lambda t: t <> '' AND t NOT IN ({_LEGAL})), ' ')"
_MENTIONS = rf"""
raw AS (
  SELECT 'f' || (s_suppkey % 4) AS folder_id, s_suppkey::BIGINT AS ord, sha256('s' || s_suppkey) AS entity_uid, 'Supplier' AS entity_type, s_name AS surface_form FROM supplier
  UNION ALL SELECT 'f' || (s_suppkey % 4), s_suppkey + 10000000, sha256('t' || s_suppkey), CASE WHEN s_suppkey % 3 = 0 THEN 'Organization' ELSE 'Supplier' END, upper(s_name) || ', Inc.' FROM supplier
  UNION ALL SELECT 'f' || (p_partkey % 4), p_partkey + 20000000, sha256('p' || p_partkey), {inp.sql_list(PART_TYPES)}[(p_partkey % 3 + 1)::INT], p_name || ' Co' FROM part
  UNION ALL SELECT 'f' || (c_custkey % 4), c_custkey + 30000000, sha256('c' || c_custkey), 'Customer', CASE WHEN c_custkey % 10 = 0 THEN 'The Group' ELSE c_name END FROM customer
  UNION ALL SELECT 'f' || (s_suppkey % 4), s_suppkey + 40000000, sha256('u' || s_suppkey), 'Organization', 'K' || s_suppkey || ' Northern Trading Partners' FROM supplier
  UNION ALL SELECT 'f' || (s_suppkey % 4), s_suppkey + 50000000, sha256('v' || s_suppkey), 'Supplier', 'K' || s_suppkey || CASE WHEN s_suppkey % 2 = 0 THEN ' Northern Tradin Partners' ELSE ' Southern Trading Partners' END FROM supplier),
mentions AS (
  SELECT *, {_FORM} AS form FROM raw)"""
_EDGES = """
medges AS (
  SELECT 'f' || (l_orderkey % 4) AS folder_id, l_orderkey * 8 + l_linenumber AS ord, 'supplies' AS relation_type, sha256('s' || l_suppkey) AS src_uid, sha256('p' || l_partkey) AS dst_uid,
         CASE WHEN l_orderkey % 11 <> 0 THEN l_discount END AS confidence, CASE WHEN l_orderkey % 7 = 0 THEN '' ELSE l_returnflag || '-' || l_orderkey || '-' || l_linenumber END AS evidence
  FROM lineitem)"""
# The longest piece of x that stands in y, the first of several, as {k: length, i: place}.
_LONGEST = "list_filter(flatten(list_transform(range(least(length(x), length(y)), 0, -1), lambda k: list_transform(range(1, length(x) - k + 2), lambda i: {k: k, i: i}))), lambda p: contains(y, substr(x, p.i, p.k)))[1]"


def _scored(name: str, mentions: str, floor: float) -> str:
    """``{name}_scored``: pairs of forms of a block whose similarity is at least the floor, in the order of their mentions.

    The similarity takes out the longest common piece, then does the same on both sides of it. Two strings of n
    characters in all have 2 m of them matched, so at most n (1 - floor) unmatched, an even number where both are
    of one length.
    """
    return f"""
{name}_forms AS (SELECT form, split_part(form, ' ', 1) AS block, length(form) AS n, min(ord) AS low, max(ord) AS high FROM {mentions} WHERE form <> '' GROUP BY form),
{name}_close AS (
  SELECT a.block, a.form AS form_a, b.form AS form_b, a.n + b.n AS n FROM {name}_forms a JOIN {name}_forms b ON a.block = b.block AND a.form <> b.form AND a.low < b.high
  WHERE (abs(a.n - b.n) <= (a.n + b.n) * (1 - {floor}) + 1e-9) AND ((a.n + b.n) * (1 - {floor}) >= 2 - 1e-9 OR a.n <> b.n)),
{name}_parts(form_a, form_b, x, y, m) AS (
  SELECT form_a, form_b, form_a, form_b, 0 FROM {name}_close
  UNION ALL
  SELECT form_a, form_b, unnest([substr(x, 1, best.i - 1), substr(x, best.i + best.k)]), unnest([substr(y, 1, j - 1), substr(y, j + best.k)]), unnest([best.k, 0])
  FROM (SELECT *, instr(y, substr(x, best.i, best.k)) AS j FROM (SELECT *, {_LONGEST} AS best FROM {name}_parts WHERE x <> '' AND y <> '') WHERE best IS NOT NULL)),
{name}_scored AS (SELECT any_value(block) AS block, form_a, form_b, 2 * sum(m) / any_value(n) AS score FROM {name}_parts JOIN {name}_close USING (form_a, form_b) GROUP BY form_a, form_b HAVING score >= {floor})"""


def _fuzzy(name: str, mentions: str, floor: float, accepted: str = "true") -> str:
    """``{name}_own``: mentions with the least form of their cluster."""
    return _scored(name, mentions, floor) + f""",
{name}_links AS (SELECT form_a AS x, form_b AS y FROM {name}_scored WHERE {accepted} UNION SELECT form_b, form_a FROM {name}_scored WHERE {accepted}),
{name}_reach(form, other) AS (SELECT DISTINCT form, form FROM {mentions} UNION SELECT r.form, l.y FROM {name}_reach r JOIN {name}_links l ON r.other = l.x),
{name}_own AS (SELECT m.*, c.cluster FROM {mentions} m JOIN (SELECT form, min(other) AS cluster FROM {name}_reach GROUP BY form) c USING (form))"""


def _types(name: str, mentions: str) -> str:
    """``{name}``: form, type and key of each cluster of the mentions, a table or query with cluster."""
    return f"""
{name}_seen AS (SELECT cluster, entity_type, min(ord) AS first FROM {mentions} GROUP BY ALL),
{name} AS (
  SELECT f.*, coalesce(b.best, f.first_type) AS entity_type, coalesce(b.best, f.first_type) || '|' || f.form AS canonical_key
  FROM (SELECT cluster, arg_min(form, ord) AS form, arg_min(entity_type, ord) AS first_type, count(*) AS n_mentions FROM {mentions} GROUP BY cluster) f
  LEFT JOIN (SELECT s.cluster, arg_min(s.entity_type, t.decl_idx) AS best FROM {name}_seen s JOIN types t ON t.type = s.entity_type
             WHERE NOT EXISTS (SELECT 1 FROM {name}_seen o JOIN up u ON u.type = o.entity_type WHERE o.cluster = s.cluster AND u.ancestor = s.entity_type) GROUP BY s.cluster) b USING (cluster))"""


_R = "WITH RECURSIVE "
_ID = "substr(sha256({0}), 1, 8) || '-' || substr(sha256({0}), 9, 4) || '-' || substr(sha256({0}), 13, 4) || '-' || substr(sha256({0}), 17, 4) || '-' || substr(sha256({0}), 21, 12)"
_BATCHES = _R + inp.pack_values() + "," + _MENTIONS + ", m1 AS (SELECT * FROM mentions WHERE folder_id IN ('f0', 'f1')), m2 AS (SELECT * FROM mentions WHERE folder_id IN ('f2', 'f3'))," + ",".join(_fuzzy(f"m{k}", f"m{k}", canon.CEILING) + "," + _types(f"b{k}", f"m{k}_own") for k in (1, 2)) + "," + _EDGES + f""",
ents AS (
  SELECT m.* REPLACE (b.form AS form), {_ID.format("canonical_key")} AS canonical_id, canonical_key, b.entity_type AS canonical_type
  FROM (SELECT 1 AS batch, * FROM m1_own UNION ALL SELECT 2, * FROM m2_own) m JOIN (SELECT 1 AS batch, * FROM b1 UNION ALL SELECT 2, * FROM b2) b ON b.cluster = m.cluster AND b.batch = m.batch),
rows_ AS (
  SELECT e.*, s.canonical_id AS src_canonical_id, d.canonical_id AS dst_canonical_id FROM medges e JOIN ents s ON s.entity_uid = e.src_uid JOIN ents d ON d.entity_uid = e.dst_uid),
cedges AS (
  SELECT src_canonical_id, relation_type, dst_canonical_id, count(DISTINCT nullif(folder_id, ''))::INT AS support_count, max(confidence) AS confidence,
         coalesce(array_to_string((list(evidence ORDER BY -coalesce(confidence, 0), ord, evidence) FILTER (evidence <> ''))[1:3], '; '), '') AS evidence_text
  FROM rows_ GROUP BY ALL),
nodes AS (SELECT canonical_id, any_value(canonical_type) AS entity_type, any_value(form) AS normalized_form, string_agg(DISTINCT folder_id, ',' ORDER BY folder_id) AS folder_ids, count(*) AS mention_count FROM ents GROUP BY canonical_id),
n0 AS (SELECT DISTINCT canonical_id FROM ents WHERE folder_id = 'f0'),
e0 AS (SELECT c.*, NOT (s.canonical_id IS NOT NULL AND d.canonical_id IS NOT NULL) AS dangling FROM cedges c LEFT JOIN n0 s ON s.canonical_id = src_canonical_id LEFT JOIN n0 d ON d.canonical_id = dst_canonical_id WHERE s.canonical_id IS NOT NULL OR d.canonical_id IS NOT NULL)
"""
_WORDED = inp.CHUNKS + "," + inp.scan("two", inp.TWO_WORDS) + f", worded_forms AS (SELECT *, {_FORM} AS form, (doc_id, line_no, match_idx) AS ord FROM two)"
_EDGE_COLUMNS = "src_canonical_id, relation_type, dst_canonical_id, support_count, confidence, evidence_text"
_PRF = """
SELECT round(p, 4) AS precision, round(r, 4) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 4) AS f1, tp, fp, fn
FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1.0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 1.0 END AS r FROM counts)"""
_NAME = "regexp_replace(entity_type, '[^A-Za-z0-9_]', '_', 'g')"
ORACLE_SQL = {
    "normalize_surface": "WITH" + _MENTIONS + " SELECT entity_uid, form AS normalized_form FROM mentions",
    "block_keys": "WITH" + _MENTIONS + " SELECT 'tok:' || split_part(form, ' ', 1) AS block, count(*) AS n_mentions, count(DISTINCT form) AS n_forms FROM mentions GROUP BY 1",
    "exact_clusters": "WITH" + _MENTIONS + " SELECT form AS normalized_form, count(*) AS n_mentions, min(ord) AS first_ord FROM mentions GROUP BY form",
    "reconcile_type": _R + inp.pack_values() + "," + _MENTIONS + ", own AS (SELECT *, form AS cluster FROM mentions)," + _types("b", "own") + " SELECT form AS normalized_form, entity_type, canonical_key, n_mentions FROM b",
    "fuzzy_pairs": _R + _WORDED + "," + _scored("w", "worded_forms", canon.FLOOR) + f" SELECT 'tok:' || block AS block, form_a, form_b, score, CASE WHEN score >= {canon.CEILING} THEN 'accept' ELSE 'ambiguous' END AS verdict FROM w_scored",
    "fuzzy_clusters": _R + _WORDED + "," + _fuzzy("w", "worded_forms", canon.FLOOR, f"score >= {canon.CEILING} OR (length(form_a) + length(form_b)) % 2 = 0") + " SELECT arg_min(form, ord) AS normalized_form, count(*) AS n_mentions, count(DISTINCT form) AS n_forms FROM w_own GROUP BY cluster",
    "resolve_or_mint": _BATCHES + f"SELECT canonical_key, {_ID.format('canonical_key')} AS canonical_id, entity_type, form AS normalized_form, 1 AS batch FROM b1 UNION ALL SELECT canonical_key, {_ID.format('canonical_key')}, entity_type, form, 2 FROM b2 WHERE canonical_key NOT IN (SELECT canonical_key FROM b1)",
    "canonicalize_batch": _BATCHES + "SELECT entity_uid, canonical_id, form AS normalized_form, 'canonicalized' AS stage FROM ents",
    "batch_counts": _BATCHES + "SELECT (SELECT count(*) FROM b1) AS minted_count, 0 AS merged_count, 1 AS batch UNION ALL SELECT count(*) FILTER (canonical_key NOT IN (SELECT canonical_key FROM b1)), count(*) FILTER (canonical_key IN (SELECT canonical_key FROM b1)), 2 FROM b2",
    "canonical_edges": _BATCHES + f"SELECT {_EDGE_COLUMNS} FROM cedges",
    "incremental_edges": _BATCHES + f"SELECT {_EDGE_COLUMNS} FROM cedges",
    "partition_replace": "WITH" + _MENTIONS + " SELECT folder_id, entity_uid, surface_form FROM mentions WHERE folder_id <> 'f2' AND (folder_id <> 'f1' OR entity_uid < '8')",
    "upsert_rows": "WITH" + _MENTIONS + " SELECT entity_uid, CASE WHEN ord % 3 = 0 THEN upper(surface_form) ELSE surface_form END AS surface_form, CASE WHEN ord % 3 = 0 THEN ord + 2 ELSE ord END AS ord FROM mentions",
    "resolved_edges": "WITH" + _MENTIONS + "," + _EDGES + ", w AS (SELECT entity_uid FROM mentions WHERE folder_id IN ('f0', 'f1')) SELECT folder_id, count(*) AS n_edges FROM medges WHERE src_uid IN (FROM w) AND dst_uid IN (FROM w) GROUP BY folder_id",
    "export_nodes": _BATCHES + "SELECT * FROM nodes",
    "export_edges": _BATCHES + f"SELECT {_EDGE_COLUMNS}, dangling FROM e0",
    "export_statements": _BATCHES + f"""
SELECT 0 AS kind, canonical_id AS key, 'MERGE (n:`' || {_NAME} || '` {{canonical_id: $canonical_id}}) SET n.entity_type = $entity_type, n.normalized_form = $normalized_form, n.provenance = $provenance' AS cypher,
  '{{"folder_ids": [' || array_to_string(list_transform(string_split(folder_ids, ','), lambda x: '"' || x || '"'), ', ') || '], "mention_count": ' || mention_count || '}}' AS provenance, NULL::VARCHAR AS support_count FROM nodes
UNION ALL SELECT 1, src_canonical_id || '|' || relation_type || '|' || dst_canonical_id, 'MATCH (a {{canonical_id: $src}}), (b {{canonical_id: $dst}}) MERGE (a)-[r:`' || relation_type || '`]->(b) SET r.support_count = $support_count, r.confidence = $confidence, r.evidence_text = $evidence_text', NULL, support_count::VARCHAR FROM cedges""",
    "export_counts": _BATCHES + "SELECT (SELECT count(*) FROM n0) AS node_count, count(*) AS relationship_count, count(*) FILTER (dangling) AS dangling_count FROM e0",
    "span_f1": "WITH" + inp.CHUNKS + "," + inp.scan("caps", inp.CAPITALIZED) + ", counts AS (SELECT count(*) FILTER (match_idx % 7 <> 0 AND match_idx % 5 <> 0) AS tp, count(*) FILTER (match_idx % 7 <> 0 AND match_idx % 5 = 0) AS fp, count(*) FILTER (match_idx % 7 = 0 AND match_idx % 5 <> 0) AS fn FROM caps)" + _PRF,
    "edge_stability": "WITH" + inp.RESPONSES + r""",
keyed AS (SELECT DISTINCT run_idx, (chunk_id, relation_type, src_type, lower(src_surface), dst_type, lower(dst_surface)) AS key FROM relations),
sizes AS (SELECT r.run_idx, count(k.key) AS n FROM runs r LEFT JOIN keyed k ON k.run_idx = r.run_idx GROUP BY ALL),
jac AS (SELECT a.run_idx AS i, b.run_idx AS j, a.n + b.n AS total, (SELECT count(*) FROM keyed x JOIN keyed y USING (key) WHERE x.run_idx = a.run_idx AND y.run_idx = b.run_idx) AS shared FROM sizes a JOIN sizes b ON a.run_idx < b.run_idx),
mean AS (SELECT round(avg(CASE WHEN total - shared = 0 THEN 1.0 ELSE shared / (total - shared) END), 4) AS m FROM jac)
SELECT (SELECT count(*) FROM sizes) AS num_runs, (SELECT round(avg(n), 4) FROM sizes) AS count_mean, (SELECT round(var_pop(n), 4) FROM sizes) AS count_variance, m AS mean_pairwise_jaccard, round(1 - m, 4) AS instability FROM mean""",
    "cluster_prf": "WITH" + _MENTIONS + """,
own AS (SELECT form AS p, 'tok:' || split_part(form, ' ', 1) || (ord % 100) AS g FROM mentions),
pairs AS (SELECT (SELECT coalesce(sum(n * (n - 1) // 2), 0) FROM (SELECT count(*) AS n FROM own GROUP BY p, g)) AS b, (SELECT coalesce(sum(n * (n - 1) // 2), 0) FROM (SELECT count(*) AS n FROM own GROUP BY p)) AS pp, (SELECT coalesce(sum(n * (n - 1) // 2), 0) FROM (SELECT count(*) AS n FROM own GROUP BY g)) AS gg),
counts AS (SELECT b::BIGINT AS tp, (pp - b)::BIGINT AS fp, (gg - b)::BIGINT AS fn FROM pairs)""" + _PRF,
    "pack_closure": _R + inp.pack_values() + " SELECT type, ancestor, depth FROM up",
    "pack_allowed": _R + inp.pack_values() + " SELECT relation_type, src_type, dst_type FROM allowed",
}

_WHOLE = inp.RESPONSES + "," + inp._patterns() + "," + inp.pack_values() + f""",
listed AS (SELECT folder_id, chunk_id, doc_id, line_no, unnest([0, 1]) AS item, unnest([ta, tb]) AS entity_type, unnest([a, b]) AS surface_form, text, a = b AS same FROM worded),
llm AS (
  SELECT *, CASE WHEN item = 1 AND same THEN nullif(instr(substr(text, instr(text, surface_form) + 1), surface_form), 0) + instr(text, surface_form) - 1 ELSE instr(text, surface_form) - 1 END AS span_start FROM listed),
candidates AS (
  SELECT folder_id, chunk_id, 0 AS o1, pattern_idx AS o2, doc_id AS o3, line_no AS o4, match_idx AS o5, surface_form, entity_type, 'regex' AS layer, span_start, span_start + length(surface_form) AS span_end FROM regex
  UNION ALL SELECT folder_id, chunk_id, 1, 0, doc_id, line_no, item, surface_form, entity_type, 'llm', span_start, span_start + length(surface_form) FROM llm)""" + inp.greedy("candidates") + f""",
formed AS (SELECT *, {_FORM} AS form, row_number() OVER (ORDER BY o1, o2, o3, o4, o5) AS ord FROM mentions),""" + _fuzzy("g", "formed", canon.CEILING) + "," + _types("b", "g_own") + f"""
SELECT {_ID.format("canonical_key")} AS canonical_id, b.entity_type, b.form AS normalized_form, string_agg(DISTINCT folder_id, ',' ORDER BY folder_id) AS folder_ids, count(*) AS mention_count
FROM g_own JOIN b USING (cluster) GROUP BY b.form, b.entity_type, canonical_key"""
ORACLE_SQL["graph_build"] = _R + _WHOLE
