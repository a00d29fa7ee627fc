"""Operators on hand-made rows; the cases are those that decide what an operator means."""

from __future__ import annotations

import difflib
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.config import ConfigError, Settings
from graphloom.functions import text as fx
from graphloom.functions.udfs import fold_text, ratio_of
from graphloom.ontology import PackError, available_packs, load_pack, parse_pack
from graphloom.operators import canon, graph, quality
from graphloom.operators import entities as ent
from graphloom.operators import pairs as prs
from graphloom.operators import relations as rel
from graphloom.plans import canonicalization as plan
from graphloom.plans.extraction import extract, preview
from graphloom.sources import chunks as src
from graphloom.sources import sinks


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items()) or "x int"
    row = tuple(values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("out")).first()["out"]


CANDIDATE = ent.CANDIDATES


def candidate(layer, start, end, surface="x", kind="Person", chunk="c", order=0, folder="f", confidence=1.0):
    return (folder, chunk, (0, 0, 0, 0, order), surface, kind, layer, start, end, confidence)


def commerce():
    return load_pack("commerce")


# --- packs ------------------------------------------------------------------------------------------------------


def test_packs_load():
    assert available_packs() == ["commerce", "general"]
    pack = commerce()
    assert pack.ancestors("Supplier") == ["Organization", "Agent"] and pack.is_descendant("Supplier", "Agent") and not pack.is_descendant("Agent", "Agent")
    assert pack.allowed("supplies", "Supplier", "Product") and not pack.allowed("supplies", "Person", "Product") and not pack.allowed("nothing", "Person", "Place")
    assert pack.labels()["PERSON"] == "Person" and pack.knows("Place") and not pack.knows("Gadget")
    assert "works_for" in pack.vocabulary_text()
    with pytest.raises(PackError):
        load_pack("no-such-pack")


def test_tool_schemas():
    pack = commerce()
    made = pack.tool_schema()
    assert made["properties"]["entities"]["items"]["properties"]["type"]["enum"] == sorted(pack.parents)
    assert list(pack.tool_schema("entity_scoped")["properties"]) == ["relations"]
    labels = pack.tool_schema("classify", ["works_for", "supplies", "works_for"])["properties"]["labels"]["items"]["properties"]
    assert labels["relation_type"]["enum"] == ["supplies", "works_for", "no_relation"]
    with pytest.raises(PackError):
        pack.tool_schema("guess")


TYPE = {"type": "A"}
DEP = {"relation_type": "r", "src_node": "a", "dst_node": "b", "pattern": [{"RIGHT_ID": "a"}, {"LEFT_ID": "a", "REL_OP": ">", "RIGHT_ID": "b"}]}
RELATION = {"type": "r", "domain": ["A"], "range": ["A"]}


@pytest.mark.parametrize(
    "broken",
    [
        {"version": ""}, {"entity_types": []}, {"entity_types": [TYPE, TYPE]}, {"entity_types": [{"type": "A", "parent": "Z"}]},
        {"entity_types": [{"type": "A", "parent": "B"}, {"type": "B", "parent": "A"}]}, {"relations": [RELATION, RELATION]}, {"relations": [{"type": "r", "domain": ["Z"], "range": ["A"]}]},
        {"regex_patterns": [{"entity_type": "Z", "pattern": "x"}]}, {"regex_patterns": [{"entity_type": "A", "pattern": "("}]}, {"regex_patterns": [{"entity_type": "A", "pattern": "x", "checksum": "crc"}]},
        {"dep_patterns": [{**DEP, "relation_type": "z"}]}, {"dep_patterns": [{**DEP, "dst_node": "z"}]}, {"dep_patterns": [{**DEP, "pattern": DEP["pattern"][::-1]}]},
        {"dep_patterns": [{**DEP, "pattern": [{"RIGHT_ID": "a"}, {"LEFT_ID": "z", "REL_OP": ">", "RIGHT_ID": "b"}]}]}, {"dep_patterns": [{**DEP, "pattern": [{"RIGHT_ID": "a"}, {"LEFT_ID": "a", "REL_OP": ">", "RIGHT_ID": "a"}]}]},
    ],
)
def test_bad_packs(broken):
    good = {"version": "1", "entity_types": [TYPE], "relations": [RELATION], "dep_patterns": [DEP]}
    parse_pack(good)
    with pytest.raises(PackError):
        parse_pack(good | broken)


def test_pack_tables(spark):
    pack = commerce()
    allowed = {tuple(r) for r in pack.allowed_table(spark).collect()}
    assert ("works_for", "Person", "Supplier") in allowed and ("works_for", "Supplier", "Person") not in allowed
    assert ("Supplier", "Agent", 2) in {tuple(r) for r in pack.closure_table(spark).collect()}


# --- settings ---------------------------------------------------------------------------------------------------


def test_settings():
    s = Settings.of({"votes": 9, "top_n": 99, "confidence_threshold": "0.5", "entity_types": ["A"]})
    assert (s.votes, s.top_n, s.confidence_threshold, s.entity_types) == (5, 20, 0.5, ("A",))
    for bad in ({"engine": "magic"}, {"relation_strategy": "guess"}, {"engine": "spacy", "votes": 3}, {"engine": "spacy", "relation_strategy": "classify"}, {"colour": 1}):
        with pytest.raises(ConfigError):
            Settings.of(bad)


# --- expressions ------------------------------------------------------------------------------------------------


def plain_lei(code):
    return bool(re.fullmatch("[A-Za-z0-9]{20}", code)) and int("".join(c if c.isdigit() else str(ord(c.upper()) - 55) for c in code)) % 97 == 1


def plain_isin(code):
    if not re.fullmatch("[A-Za-z0-9]{12}", code):
        return False
    digits = "".join(c if c.isdigit() else str(ord(c.upper()) - 55) for c in code)[::-1]
    return sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits)) % 10 == 0


def test_checksums(spark):
    rng = random.Random(1)
    leis, isins = [], []
    for _ in range(60):
        body = "".join(rng.choice("ABCXYZ0189") for _ in range(18))
        leis += [body + f"{k:02}" for k in rng.sample(range(100), 8)] + [next(body + f"{k:02}" for k in range(2, 99) if plain_lei(body + f"{k:02}"))]
        isins += ["US" + "".join(rng.choice("ABC019") for _ in range(9)) + str(k) for k in range(10)]
    for codes, native, plain in ((leis + ["", "short", "A" * 21], fx.lei_valid, plain_lei), (isins + ["", "US", "U" * 13], fx.isin_valid, plain_isin)):
        got = spark.createDataFrame([(c,) for c in codes] + [(None,)], "code string").select("code", native(F.col("code")).alias("ok")).collect()
        assert all(r.ok == (r.code is not None and plain(r.code)) for r in got) and any(r.ok for r in got)


def test_occurrences(spark):
    for text, part, k, want in (("aaaaaa", "aa", 2, 2), ("abcabc", "bc", 1, 4), ("abc", "x", 0, None), ("abc", "a", 1, None), ("éé a é", "é", 2, 5), ("abc", "", 0, None), ("xa", "a", 3, None)):
        assert one(spark, fx.nth_occurrence(F.col("t"), F.col("p"), F.col("k")), t=text, p=part, k=k) == want


def test_grounding(spark):
    for evidence, text, want in (("a b", "x a\t b y", True), ("A b", "a b", False), ("", "a", False), ("  \t", "a", True), ("a b", "a\n\n b", True), ("a\x1cb", "a b", True)):
        assert one(spark, fx.grounded(F.col("e"), F.col("t")), e=evidence, t=text) is want
    assert one(spark, fx.grounded(F.lit(None).cast("string"), F.lit("a"))) is False


def test_uids(spark):
    want = hashlib.sha256(b"f|c|Person|Ann||0").hexdigest()
    assert one(spark, fx.entity_uid(F.lit("f"), F.lit("c"), F.lit("Person"), F.lit("Ann"), F.lit(None).cast("int"), F.lit(0))) == want
    assert one(spark, fx.edge_uid(F.lit("f"), F.lit("r"), F.lit("a"), F.lit("b"))) == hashlib.sha256(b"f|r|a|b").hexdigest()


def test_identifiers(spark):
    for name, want in (("Legal Entity", "Legal_Entity"), ("9lives", "_9lives"), ("", "X"), ("a-b", "a_b"), ("é", "_")):
        assert one(spark, fx.identifier(F.col("n"), "X"), n=name) == want


def plain_form(surface):
    folded = re.sub(r"[^a-z0-9\s]", " ", fold_text(surface).lower())
    return " ".join(t for t in folded.split() if t not in fx.LEGAL_FORMS)


def test_normal_forms(spark):
    surfaces = ["Zeta Corp.", "Zéta  Corporation", "The Group", "Group", "ﬁne Ltd", "Ünit-7 GmbH", "", "漢字", "A&B Co", "Straße AG", "\tTab\nInc"]
    got = spark.createDataFrame([(s,) for s in surfaces], "s string").select("s", fx.normalize_surface(F.col("s")).alias("n")).collect()
    assert all(r.n == plain_form(r.s) for r in got)
    assert plain_form("Zéta Corporation") == "zeta" and plain_form("Group") == ""


def test_pronouns(spark):
    rows = spark.createDataFrame([("It",), (" they ",), ("The Company",), ("Ann",), ("Italy",)], "surface_form string")
    assert {r[0] for r in ent.without_pronouns(rows).collect()} == {"Ann", "Italy"}


# --- entities ---------------------------------------------------------------------------------------------------


def chunk_rows(spark, texts, folder="f"):
    return spark.createDataFrame([(folder, f"c{k}", 0, k, t) for k, t in enumerate(texts)], "folder_id string, chunk_id string, doc_id long, line_no int, text string")


def test_pattern_scan_is_finditer(spark):
    texts = ["call 1234 or 56789", "é 😀 1234", "", "99999 99999"]
    got = ent.find_patterns(chunk_rows(spark, texts), [(0, r"\b[0-9]{4,}\b"), (3, "[a-z]+")]).collect()
    want = {(f"c{k}", n, i, m.start(), m.end(), m[0]) for k, t in enumerate(texts) for n, p in ((0, r"\b[0-9]{4,}\b"), (3, "[a-z]+")) for i, m in enumerate(re.finditer(p, t))}
    assert {(r.chunk_id, r.pattern_idx, r.match_idx, r.span_start, r.span_end, r.surface_form) for r in got} == want


def test_checksums_gate_patterns(spark):
    good = next(c for k in range(10) if plain_isin(c := f"US037833100{k}"))
    bad = good[:-1] + str((int(good[-1]) + 1) % 10)
    found = {(r.entity_type, r.surface_form) for r in ent.regex_entities(chunk_rows(spark, [f"{good} {bad} a@b.co"]), commerce()).collect()}
    assert ("SecurityCode", good) in found and ("SecurityCode", bad) not in found and ("Email", "a@b.co") in found


def test_vocabulary(spark):
    rows = spark.createDataFrame([candidate("llm", 0, 1, kind=k, confidence=c) for k, c in (("Gadget", 1.0), ("Place", 1.0), ("Person", 0.2), ("Person", 0.5))], CANDIDATE)
    assert [r.entity_type for r in ent.closed_vocabulary(rows, commerce(), ("Person",), 0.5).collect()] == ["Person"]
    assert ent.closed_vocabulary(rows, commerce()).count() == 3
    assert ent.unmapped_counts(rows, commerce()).first()["unmapped_type_count"] == 1


def test_screen_distrusts_wrong_shape(spark):
    rows = spark.createDataFrame([candidate("llm", k, k + 1, order=k, folder=f) for f in "ab" for k in range(3)], CANDIDATE)
    verdicts = rows.select("folder_id", "ord", (F.col("ord.match") != 1).alias("allowed")).where("folder_id = 'a' or ord.match < 2")
    kept = {(r.folder_id, r.ord.match) for r in ent.screened(rows, verdicts).collect()}
    assert kept == {("a", 0), ("a", 2), ("b", 0), ("b", 1), ("b", 2)}


def plain_merge(rows):
    order = sorted(range(len(rows)), key=lambda k: (-ent.PRECEDENCE.get(rows[k][5], 0), 2**30 if rows[k][6] is None else rows[k][6], rows[k][2]))
    kept = []
    for k in order:
        a, b = rows[k][6], rows[k][7]
        if a is None or all(rows[j][6] is None or not (a < rows[j][7] and rows[j][6] < b) for j in kept):
            kept.append(k)
    return {rows[k][2][4] for k in kept}


def test_merge_precedence(spark):
    rows = [candidate(*x, order=k) for k, x in enumerate((("llm", 0, 16), ("spacy", 0, 4), ("regex", 0, 9), ("llm", 20, 24), ("llm", None, None), ("llm", None, None)))]
    assert {r.ord.match for r in ent.merge_layers(spark.createDataFrame(rows, CANDIDATE)).collect()} == {2, 3, 4, 5}


def test_merge_against_brute_force(spark):
    rng = random.Random(4)
    rows, want = [], set()
    for c in range(40):
        own = []
        for _ in range(rng.randrange(25)):
            a = rng.randrange(40)
            spans = (a, a + rng.randrange(0, 9)) if rng.random() < 0.9 else (None, None)
            own.append(candidate(rng.choice(["regex", "spacy", "llm", "odd"]), *spans, chunk=f"c{c}", order=len(rows) + len(own)))
        want |= plain_merge(own)
        rows += own
    got = ent.merge_layers(spark.createDataFrame(rows, CANDIDATE).repartition(5)).collect()
    assert {r.ord.match for r in got} == want and len(got) == len(want)


def test_occurrence_index(spark):
    rows = [candidate("llm", None, None, "Ann", order=0), candidate("llm", None, None, "Ann", order=1), candidate("llm", 3, 4, "Ann", order=2), candidate("llm", None, None, "Ann", "Place", order=3), candidate("llm", None, None, "Ann", order=4)]
    got = {r.ord.match: r.occurrence_idx for r in ent.occurrence_index(spark.createDataFrame(rows, CANDIDATE)).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 0, 4: 2}


def test_top_entities(spark):
    rows = [("f", k, "Person", s) for k, s in enumerate("bbaacccd")]
    got = ent.top_entities(spark.createDataFrame(rows, "folder_id string, ord int, entity_type string, surface_form string"), 3).orderBy("rank").collect()
    assert [(r.surface_form, r.mention_count) for r in got] == [("c", 3), ("b", 2), ("a", 2)]
    many = spark.createDataFrame([("f", k, "Person", str(k)) for k in range(30)], "folder_id string, ord int, entity_type string, surface_form string")
    assert ent.top_entities(many, 100).count() == 20 and ent.top_entities(many, -1).count() == 0


# --- relations --------------------------------------------------------------------------------------------------

RESPONSE = "chunk_id string, mode string, run_idx int, attempt int, batch_no int, body string, error_code string"


def test_attempts(spark):
    rows = [("a", "generate", 1, 1, 0, "{bad", None), ("a", "generate", 1, 2, 0, '{"entities":[]}', None), ("b", "generate", 1, 1, 0, "{}", "throttled"), ("b", "generate", 1, 3, 0, "{}", None), ("c", "generate", 1, 1, 0, '{"x":1}', None), ("c", "generate", 1, 2, 0, "{}", None)]
    got = {r.chunk_id: r for r in rel.first_valid(spark.createDataFrame(rows, RESPONSE)).collect()}
    hard = [("d", "generate", 1, 1, 0, None, "Throttled"), ("d", "generate", 1, 2, 0, "{}", None), ("e", "generate", 1, 1, 0, None, "ModelErrorException"), ("e", "generate", 1, 2, 0, "{}", None)]
    assert {r.chunk_id: r.failed for r in rel.first_valid(spark.createDataFrame(hard, RESPONSE)).collect()} == {"d": True, "e": False}
    assert got["a"].body == '{"entities":[]}' and got["b"].failed and got["c"].body == '{"x":1}'


def test_parsing(spark):
    body = '{"entities":[{"type":"Person","surface":"Ann","confidence":"0.9"},{"type":"Person","surface":"Ann"},{"surface":"x"},{"type":"Person","surface":""}],"relations":"none"}'
    rows = spark.createDataFrame([("c0", "generate", 1, 0, body)], "chunk_id string, mode string, run_idx int, batch_no int, body string")
    found = rel.parse_entities(rows, chunk_rows(spark, ["Ann met Ann"])).orderBy("ord").collect()
    assert [(r.surface_form, r.confidence, r.span_start, r.span_end) for r in found] == [("Ann", 0.9, 0, 3), ("Ann", 0.7, 8, 11)]
    assert rel.parse_relations(rows).count() == 0
    body = '{"relations":[{"type":"r","src":"a","dst":"b","evidence":"e"},{"type":"r","src":"a","dst":"b"},{"type":"","evidence":"e"}]}'
    got = rel.parse_relations(rows.withColumn("body", F.lit(body))).collect()
    assert len(got) == 1 and (got[0].confidence, got[0].src_type) == (0.6, "")


def relation_rows(spark, rows):
    return spark.createDataFrame(rows, "ord long, run_idx int, relation_type string, src_surface string, src_type string, dst_surface string, dst_type string, chunk_id string, confidence double, evidence_text string, extractor string")


def test_votes(spark):
    def row(o, run, dst, extractor="llm"):
        return (o, run, "works_for", "Ann", "Person", dst, "Organization", "c", 0.4, f"e{o}", extractor)

    three = relation_rows(spark, [row(0, 1, "A"), row(1, 2, "A"), row(2, 3, "A"), row(3, 1, "B"), row(4, 2, "C"), row(5, 2, "C"), row(6, 1, "R", "rules")])
    got = {r.dst_surface: (r.confidence, r.evidence_text) for r in rel.vote(three, 3).collect()}
    assert got == {"A": (1.0, "e0"), "R": (0.4, "e6")}
    assert {r.dst_surface: r.confidence for r in rel.vote(relation_rows(spark, [row(0, 1, "A")]), 2).collect()} == {"A": 0.5}


def test_validation(spark):
    rows = [(0, 1, "works_for", "Ann", "Person", "Acme", "Supplier", "c0", 1.0, "Ann works", "llm"), (1, 1, "works_for", "Ann", "Person", "Acme", "Supplier", "c0", 1.0, "not there", "llm"), (2, 1, "works_for", "Acme", "Supplier", "Ann", "Person", "c0", 1.0, "Ann works", "llm"), (3, 1, "works_for", "Ann", "Person", "Acme", "Supplier", "c0", 1.0, None, "rules")]
    valid = rel.validate(relation_rows(spark, rows), chunk_rows(spark, ["Ann  works at Acme"]), commerce())
    assert {r.ord: r.grounded for r in valid.collect()} == {0: True, 1: False, 3: True}
    assert rel.ungrounded_counts(valid).first()["ungrounded_relation_count"] == 1


def test_edges_attach_to_first_mention(spark):
    entities = spark.createDataFrame([("f", 2, "u2", "Person", "Ann", "c"), ("f", 1, "u1", "Person", "Ann", "c"), ("f", 3, "u3", "Organization", "Acme", "c")], "folder_id string, ord int, entity_uid string, entity_type string, surface_form string, source_chunk_id string")
    rows = relation_rows(spark, [(0, 1, "works_for", "Ann", "Person", "Acme", "Organization", "c", 1.0, "e", "llm"), (1, 1, "works_for", "Bob", "Person", "Acme", "Organization", "c", 1.0, "e", "llm")]).withColumn("folder_id", F.lit("f")).withColumn("place", F.col("ord"))
    got = rel.build_edges(rows, entities).collect()
    assert [(r.src_entity_uid, r.dst_entity_uid) for r in got] == [("u1", "u3")]


def test_edge_merge(spark):
    schema = "folder_id string, chunk_id string, ord int, edge_uid string, relation_type string, src_entity_uid string, dst_entity_uid string, confidence double, evidence_text string, extractor string"
    rows = [("f", "c", 0, "u", "r", "a", "b", 0.7, "one", "llm"), ("f", "c", 1, "u", "r", "a", "b", 1.0, "two", "rules"), ("f", "c", 2, "u", "r", "a", "b", 0.1, "one", "llm-classify"), ("f", "c", 3, "u", "r", "a", "b", 0.1, "", "llm"), ("f", "c", 4, "v", "r", "x", "y", 0.5, None, "llm"), ("f", "c", 5, "w", "r", "x", "z", 0.5, "e", "rules"), ("f", "c", 6, "w", "r", "x", "z", 0.6, "e", "rules")]
    got = {r.edge_uid: r for r in rel.merge_edges(spark.createDataFrame(rows, schema)).collect()}
    assert (got["u"].confidence, got["u"].evidence_text, got["u"].extractor) == (1.0, "one; two", "rules+llm+llm-classify")
    assert (got["v"].confidence, got["v"].evidence_text, got["v"].extractor) == (0.5, None, "llm")
    assert (got["w"].confidence, got["w"].evidence_text, got["w"].extractor) == (0.6, "e", "rules")
    silent = [("f", "c", 1, "u", "r", "a", "b", 0.1, None, "llm"), ("f", "c", 0, "u", "r", "a", "b", 0.2, "", "llm")]
    assert rel.merge_edges(spark.createDataFrame(silent, schema)).first()["evidence_text"] == ""  # that of the first row


def test_evidence_comes_in_order_of_documents(spark):
    """Rules first, then the model; by document as a number, not as text."""
    lines = spark.createDataFrame([("f", f"{k}#0", k, 0, f"Ann Acme evidence {k}") for k in range(12)], "folder_id string, chunk_id string, doc_id long, line_no int, text string")
    found = [([0], 1, "works_for", "Ann", "Person", "Acme", "Organization", f"{k}#0", 0.5, f"evidence {k}", "llm") for k in (2, 10, 11)] + [([0, 1, 0], 1, "works_for", "Ann", "Person", "Acme", "Organization", "9#0", 1.0, "by a rule", "rules")]
    schema = "ord array<int>, run_idx int, relation_type string, src_surface string, src_type string, dst_surface string, dst_type string, chunk_id string, confidence double, evidence_text string, extractor string"
    valid = rel.validate(spark.createDataFrame(found, schema), lines, commerce()).where("grounded")
    edges = valid.select("folder_id", F.col("place").alias("ord"), F.lit("e").alias("edge_uid"), "relation_type", F.lit("a").alias("src_entity_uid"), F.lit("b").alias("dst_entity_uid"), "confidence", "evidence_text", "extractor")
    assert rel.merge_edges(edges).first()["evidence_text"] == "by a rule; evidence 2; evidence 10; evidence 11"


def test_rewrites(spark):
    lines = chunk_rows(spark, ["one", "two", "three"])
    given = spark.createDataFrame([("c0", "   "), ("c1", "TWO")], "chunk_id string, rewritten string")
    assert {r.chunk_id: r.text for r in rel.apply_rewrites(lines, given).collect()} == {"c0": "one", "c1": "TWO", "c2": "three"}
    assert {r.chunk_id: r.context for r in rel.prior_text(lines).collect()} == {"c0": "", "c1": "one", "c2": "one\ntwo"}
    assert {r.chunk_id: r.context for r in rel.prior_text(lines, 1).collect()} == {"c0": "", "c1": "one", "c2": "two"}


def test_prompts(spark):
    lines = chunk_rows(spark, ["one", "two"])
    made = {r.chunk_id: r for r in rel.generate_prompts(lines, commerce(), 2).where("run_idx = 2").collect()}
    assert made["c0"].user == rel.DATA_ONLY + "\n\nTEXT:\none" and "works_for" in made["c0"].system
    rewrites = {r.chunk_id: r.user for r in rel.rewrite_prompts(lines).collect()}
    assert rewrites["c0"].endswith("CURRENT TEXT:\none") and "\none\n" in rewrites["c1"]
    raw = '{"stopReason":"tool_use","output":{"message":{"content":[{"toolUse":{"name":"a","input":{"x":[1]}}}]}}}'
    assert one(spark, rel.tool_input(F.col("r"), "a"), r=raw) == '{"x":[1]}' and one(spark, rel.tool_input(F.col("r"), "b"), r=raw) is None
    assert one(spark, rel.tool_input(F.col("r"), "a"), r=raw.replace("tool_use", "max_tokens")) is None and one(spark, rel.first_text(F.col("r")), r=raw) == ""


def test_pairs(spark):
    rows = [candidate("spacy", 0, 3, "Ann", "Person", "c0", 0), candidate("spacy", 10, 14, "Acme", "Supplier", "c0", 1), candidate("spacy", 20, 24, "Acme", "Supplier", "c0", 2), candidate("spacy", None, None, "Bob", "Person", "c0", 3), candidate("spacy", 0, 3, "Cyd", "Person", "c1", 4)]
    spans = spark.createDataFrame([("c0", 0, 0, 15), ("c0", 1, 16, 30)], "chunk_id string, sent_idx int, start int, end int")
    pairs = prs.candidate_pairs(spark.createDataFrame(rows, CANDIDATE), spans, commerce())
    got = {(r.src_surface, r.dst_surface, tuple(r.allowed)) for r in pairs.collect()}
    assert got == {("Ann", "Acme", ("related_to", "works_for")), ("Acme", "Ann", ("related_to",))}
    batched = rel.plan_batches(pairs, 1)
    assert sorted((r.batch_no, r.pair_index) for r in batched.collect()) == [(0, 0), (1, 0)]
    prompts = rel.pair_prompts(rel.plan_batches(pairs), chunk_rows(spark, ["Ann is at Acme. x Acme"])).first()["user"]
    assert "Ann is at Acme." in prompts and "no_relation" in prompts and "\n0. " in prompts and prompts.startswith(rel.DATA_ONLY)
    answers = spark.createDataFrame([("c0", "classify", 1, 0, '{"labels":[{"pair_index":0,"relation_type":"works_for","evidence":"e"},{"pair_index":1,"relation_type":"works_for","evidence":"e"},{"pair_index":7,"relation_type":"related_to","evidence":"e"},{"pair_index":"1","relation_type":"related_to"},{"pair_index":"x","relation_type":"related_to","evidence":"e"}]}')], "chunk_id string, mode string, run_idx int, batch_no int, body string")
    chosen = rel.parse_labels(answers, rel.plan_batches(pairs)).collect()
    assert [(r.src_surface, r.relation_type, r.confidence, r.extractor) for r in chosen] == [("Ann", "works_for", 1.0, "llm-classify")]


TOKEN = "chunk_id string, i int, text string, lemma string, dep string, head int, sent_id int, sent_text string"


def test_dependency_patterns(spark):
    trees = {
        "s": [(1, "supplies", "supply", "ROOT", 1), (0, "Acme", "acme", "nsubj", 1), (2, "bolts", "bolt", "dobj", 1), (3, "nuts", "nut", "obj", 1)],
        "w": [(1, "works", "work", "ROOT", 1), (0, "Ann", "ann", "nsubj", 1), (2, "at", "at", "prep", 1), (3, "Acme", "acme", "pobj", 2)],
        "l": [(1, "is", "be", "ROOT", 1), (0, "Bob", "bob", "nsubj", 1), (2, "Paris", "paris", "attr", 1)],
    }
    rows = [(c, i, t, lemma, d, h, 0, "sentence") for c, tree in trees.items() for i, t, lemma, d, h in tree]
    got = {(r.chunk_id, r.relation_type, r.src_surface, r.dst_surface) for r in prs.rule_relations(spark.createDataFrame(rows, TOKEN), commerce()).collect()}
    assert got == {("s", "supplies", "Acme", "bolts"), ("s", "supplies", "Acme", "nuts"), ("w", "works_for", "Ann", "Acme"), ("l", "located_in", "Bob", "Paris")}
    odd = {"relation_type": "supplies", "src_node": "a", "dst_node": "b", "pattern": [{"RIGHT_ID": "a"}, {"LEFT_ID": "a", "REL_OP": ">>", "RIGHT_ID": "b"}]}
    with pytest.raises(PackError):
        prs.match_pattern(spark.createDataFrame(rows, TOKEN), odd, commerce())


def test_usage(spark):
    rows = spark.createDataFrame([("f", "m", (10, 2)), ("f", "m", (5, None))], "folder_id string, model string, quantity struct<input_tokens:long,output_tokens:long>")
    assert tuple(rel.usage_totals(rows).first()) == ("f", "m", 2, 15, 2)
    assert one(spark, rel.cacheable(F.col("m"), ["vendor.large"]), m="us.vendor.large-2") is True
    assert one(spark, rel.cacheable(F.col("m"), ["vendor.large"]), m="vendor.small") is False


# --- runs -------------------------------------------------------------------------------------------------------


def test_extraction_end_to_end(spark):
    lines = chunk_rows(spark, ["Ann works at Acme Works.", "mail sales@acme.example.com"])
    body = '{"entities":[{"type":"Person","surface":"Ann"},{"type":"Organization","surface":"Acme Works"},{"type":"Gadget","surface":"mail"}],"relations":[{"type":"works_for","src":"Ann","src_type":"Person","dst":"Acme Works","dst_type":"Organization","evidence":"Ann works at Acme Works."},{"type":"works_for","src":"Ann","src_type":"Person","dst":"Acme Works","dst_type":"Organization","evidence":"made up"}]}'
    responses = spark.createDataFrame([("c0", "generate", 1, 1, 0, "oops", None), ("c0", "generate", 1, 2, 0, body, None), ("z0", "generate", 1, 1, 0, "oops", None)], RESPONSE)
    both = lines.unionByName(spark.createDataFrame([("g", "z0", 1, 0, "nothing")], lines.schema))
    folders = spark.createDataFrame([("f",), ("g",), ("h",)], "folder_id string")
    runs = [extract(both, Settings(engine="llm", pack="commerce"), {"responses": responses}, folders) for _ in range(2)]
    tables = [sorted(map(str, r.entities.collect())) + sorted(map(str, r.edges.collect())) for r in runs]
    assert tables[0] == tables[1]
    out = runs[0]
    assert {(r.entity_type, r.surface_form) for r in out.entities.collect()} == {("Person", "Ann"), ("Organization", "Acme Works"), ("Email", "sales@acme.example.com")}
    assert [(r.relation_type, r.evidence_text) for r in out.edges.collect()] == [("works_for", "Ann works at Acme Works.")]
    row = {r.folder_id: r for r in out.summary.collect()}["f"]
    assert (row.entity_count, row.edge_count, row.unmapped_type_count, row.ungrounded_relation_count) == (3, 1, 1, 1)
    assert {r.folder_id: r.status for r in out.status.collect()} == {"f": "ok", "g": "failed", "h": "failed"}
    usage = rel.usage_totals(spark.createDataFrame([("f", "m", (10, 2))], "folder_id string, model string, quantity struct<input_tokens:long,output_tokens:long>"))
    told = {r.folder_id: r for r in out.payloads(usage).collect()}
    assert told["f"].entity_count == 3 and told["f"].usage[0].input_tokens == 10 and told["g"].entity_count is None and set(told) == {"f", "g", "h"}
    with pytest.raises(src.MissingAnnotations):
        extract(lines, Settings(engine="llm", pack="commerce"))
    with pytest.raises(src.MissingAnnotations, match="sentences"):
        extract(lines, Settings(engine="llm", pack="commerce", relation_strategy="classify"), {"responses": responses})


def test_folders_without_finds_are_told(spark):
    lines = spark.createDataFrame([("f", "c0", 0, 0, "mail a@b.co"), ("g", "c1", 1, 0, "nothing notable here")], "folder_id string, chunk_id string, doc_id long, line_no int, text string")
    told = {r.folder_id: r for r in extract(lines, Settings(engine="rules", pack="commerce")).payloads().collect()}
    assert (told["g"].status, told["g"].entity_count, told["g"].edge_count, told["g"].distinct_types, told["g"].top_entities) == ("ok", 0, 0, 0, [])
    assert (told["f"].entity_count, told["f"].ontology_pack, told["f"].ontology_version, told["f"].self_consistency_votes) == (1, "commerce", commerce().version, 1)


def test_documented_verdicts_screen(spark):
    lines = chunk_rows(spark, ["mail a@b.co and 12345"])
    found = ent.regex_entities(lines, commerce())
    rows = [(r.folder_id, tuple(r.ord), r.entity_type != "Email") for r in found.collect()]
    out = extract(lines, Settings(engine="rules", pack="commerce"), {"verdicts": spark.createDataFrame(rows, src.ANNOTATIONS["verdicts"])})
    assert [r.surface_form for r in out.entities.collect()] == ["12345"]


def test_preview(spark):
    entities, relations = preview(spark, "write to a@b.co", Settings(engine="rules", pack="commerce"))
    assert [r.surface_form for r in entities.collect()] == ["a@b.co"] and relations.count() == 0


# --- canonicalization -------------------------------------------------------------------------------------------

MENTION = "folder_id string, ord long, entity_uid string, entity_type string, surface_form string, stage string, ontology_pack string"


def mention_rows(spark, rows):
    return spark.createDataFrame([(f, k, f"u{k}", t, s, "staged", "commerce") for k, (f, t, s) in enumerate(rows)], MENTION)


def test_reconciled_types(spark):
    rows = [("Agent", 0, 0), ("Organization", 0, 1), ("Supplier", 0, 2), ("Place", 1, 3), ("Person", 1, 4), ("Zzz", 2, 5), ("Yyy", 2, 6), ("Zzz", 3, 7), ("Place", 3, 8)]
    df = spark.createDataFrame(rows, "entity_type string, cluster_id long, ord long")  # any type will do for an id
    assert {r.cluster_id: r.entity_type for r in canon.reconciled_types(df, commerce()).collect()} == {0: "Supplier", 1: "Person", 2: "Zzz", 3: "Place"}
    assert {r.cluster_id: r.entity_type for r in canon.reconciled_types(df, None).collect()} == {0: "Agent", 1: "Place", 2: "Zzz", 3: "Zzz"}


def plain_clusters(surfaces, floor, ceiling, yes):
    forms = [plain_form(s) for s in surfaces]
    root = list(range(len(forms)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(forms)):
        for j in range(i + 1, len(forms)):
            if forms[i].split(" ")[0] != forms[j].split(" ")[0]:
                continue
            score = difflib.SequenceMatcher(None, forms[i], forms[j]).ratio()
            if forms[i] == forms[j] or score >= ceiling or (score >= floor and yes(surfaces[i], surfaces[j])):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(forms)):
        groups.setdefault(find(i), set()).add(f"u{i}")
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("seed", range(3))
def test_clusters_against_brute_force(spark, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(canon, "BLOCK_CHUNK", [2000, 5, 3][seed])
    stems = ["acme", "beta", "gamma ray", "Group", "tide"]
    tails = ["north", "norths", "north 1", "south", "soth", "tide", "diet", "corp", "", "works of the north", "works of north"]
    surfaces = [f"{rng.choice(stems)} {rng.choice(tails)} {rng.choice(['', '', 'Ltd', 'x'])}" for _ in range(70)]
    yes = lambda a, b: (len(a) + len(b)) % 2 == 0
    found = canon.with_forms(mention_rows(spark, [("f", "Person", s) for s in surfaces]))
    pairs = canon.fuzzy_pairs(canon.distinct_forms(found))
    answers = spark.createDataFrame([(f"u{i}", f"u{j}", "Yes, the same" if yes(surfaces[i], surfaces[j]) else "no") for i in range(70) for j in range(i + 1, 70)], "a_uid string, b_uid string, answer string")
    groups = {}
    for r in canon.clusters(found, canon.adjudicated(pairs, found, answers)).collect():
        groups.setdefault(r.cluster_id, set()).add(r.entity_uid)
    assert {frozenset(g) for g in groups.values()} == plain_clusters(surfaces, canon.FLOOR, canon.CEILING, yes)


def test_ambiguity_needs_answers(spark):
    found = canon.with_forms(mention_rows(spark, [("f", "Person", "acme north west"), ("f", "Person", "acme north wast")]))
    assert canon.FLOOR <= ratio_of("acme north west", "acme north wast") < canon.CEILING
    pairs = canon.fuzzy_pairs(canon.distinct_forms(found))
    with pytest.raises(canon.AdjudicationError):
        canon.adjudicated(pairs, found, None)
    none = spark.createDataFrame([], "a_uid string, b_uid string, answer string")
    with pytest.raises(canon.AdjudicationError):
        canon.adjudicated(pairs, found, none)
    assert canon.adjudicated(pairs, found, none, "reject").count() == 0
    asked = canon.questions(pairs, found).select("a_uid", "b_uid").collect()
    assert [tuple(r) for r in asked] == [("u0", "u1")]
    given = spark.createDataFrame([("u0", "u1", " Yes")], "a_uid string, b_uid string, answer string")
    assert [tuple(r) for r in canon.adjudicated(pairs, found, given).collect()] == [("acme north west", "acme north wast")]


def test_forms_are_asked_once(spark):
    """However many mentions two forms have, they are one question, and one answer settles it."""
    found = canon.with_forms(mention_rows(spark, [("f", "Person", "acme north west")] * 5 + [("f", "Person", "acme north wast")] * 5))
    pairs = canon.fuzzy_pairs(canon.distinct_forms(found))
    assert [tuple(r) for r in canon.questions(pairs, found).select("a_uid", "b_uid").collect()] == [("u0", "u9")]
    given = spark.createDataFrame([("u2", "u7", "y"), ("u7", "u2", "y"), ("u3", "gone", "y")], "a_uid string, b_uid string, answer string")
    assert len({r.cluster_id for r in canon.clusters(found, canon.adjudicated(pairs, found, given)).collect()}) == 1


def test_cluster_gives_its_form(spark):
    """Every mention of a fuzzy cluster gets the form of the first, as it gets the id."""
    entities = mention_rows(spark, [("f", "Organization", "Acme Northern Trading Partners"), ("f", "Supplier", "Acme Northern Tradin Partners")])
    edges = spark.createDataFrame([], "folder_id string, ord long, edge_uid string, relation_type string, src_entity_uid string, dst_entity_uid string, confidence double, evidence_text string")
    done = plan.canonicalize(entities, edges, plan.empty_index(spark), plan.empty_edges(spark), None)
    assert {(r.normalized_form, r.stage) for r in done.entities.collect()} == {("acme northern trading partners", "canonicalized")}
    assert [(r.entity_type, r.normalized_form) for r in done.index.collect()] == [("Supplier", "acme northern trading partners")]


def test_forms_of_one_length_that_must_be_equal_are_not_paired(spark):
    """Numbered names are of one length: at the ceiling none has a partner, however many there are."""
    names = [f"customer {k:09d}" for k in range(50)]
    forms = spark.createDataFrame([(f, k, k) for k, f in enumerate(names)], "normalized_form string, min_ord long, max_ord long").withColumn("block", F.lit("tok:customer"))
    assert canon._keyed(forms, canon.CEILING).count() == 0
    more = forms.union(spark.createDataFrame([("customer 00000004", 60, 60, "tok:customer")], "normalized_form string, min_ord long, max_ord long, block string"))
    pairs = canon.fuzzy_pairs(more, canon.CEILING).collect()
    assert {(r.form_a, r.form_b) for r in pairs} == {(n, "customer 00000004") for n in names if any(n[:i] + n[i + 1 :] == "customer 00000004" for i in range(len(n)))}


def test_history_is_narrowed_before_it_is_joined(spark):
    """Edges and entities of history meet the batch in semi-joins first."""
    entities = spark.createDataFrame([("u", "c")], "entity_uid string, canonical_id string")
    edges = spark.createDataFrame([("f", 0, "r", "u", "u", 0.5, "e")], "folder_id string, ord long, relation_type string, src_entity_uid string, dst_entity_uid string, confidence double, evidence_text string")
    triples = graph.affected_triples(edges, entities, spark.createDataFrame([("u",)], "entity_uid string"))
    rows = graph.history(edges, entities, triples)
    assert [r.src_canonical_id for r in rows.collect()] == ["c"]
    # In the plan, the nearest join above every scan of entities is a semi-join.
    plan_lines = rows._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scans = [k for k, line in enumerate(plan_lines) if "LogicalRDD [entity_uid" in line]
    assert scans
    for k in scans:
        above, at = [], depth(plan_lines[k])
        for line in reversed(plan_lines[:k]):
            if depth(line) < at:
                at = depth(line)
                above.append(line)
        assert "LeftSemi" in next(line for line in above if "Join" in line)
    assert graph.affected_triples(edges, entities, spark.createDataFrame([("v",)], "entity_uid string")).count() == 0


def test_batches(spark):
    entities = mention_rows(spark, [("f", "Supplier", "Acme Ltd"), ("g", "Organization", "ACME"), ("g", "Supplier", "acme inc"), ("h", "Place", "Acme"), ("f", "Person", "Group"), ("f", "Place", "Holdings")])
    edges = spark.createDataFrame([("f", 0, "e0", "r", "u0", "u4", 0.5, "one"), ("g", 1, "e1", "r", "u2", "u4", None, "two"), ("g", 2, "e2", "r", "u2", "u4", 0.9, "")], "folder_id string, ord long, edge_uid string, relation_type string, src_entity_uid string, dst_entity_uid string, confidence double, evidence_text string")
    first = plan.canonicalize(entities, edges, plan.empty_index(spark), plan.empty_edges(spark), ["f"])
    assert tuple(first.counts.first()) == (2, 0)  # the two empty forms are one entity
    assert [(r.support_count, r.confidence, r.evidence_text) for r in first.edges.collect()] == [(1, 0.5, ["one"])]
    second = plan.canonicalize(first.entities, edges, first.index, first.edges, ["g"])
    assert tuple(second.counts.first()) == (0, 1)
    assert [(r.support_count, r.confidence, r.evidence_text) for r in second.edges.collect()] == [(2, 0.9, ["one", "two"])]
    again = plan.canonicalize(second.entities, edges, second.index, second.edges, ["g"])
    assert tuple(again.counts.first()) == (0, 0)
    assert sorted(map(str, again.entities.collect())) == sorted(map(str, second.entities.select(*again.entities.columns).collect()))
    third = plan.canonicalize(again.entities, edges, again.index, again.edges, ["h"])
    assert tuple(third.counts.first()) == (1, 0)  # another type is another key
    assert {r.stage for r in third.entities.collect()} == {"canonicalized"}
    statements, counts = plan.export(third.entities, third.index, third.edges, ["h"])
    assert tuple(counts.first()) == (1, 0, 0) and statements.count() == 1
    statements, counts = plan.export(third.entities, third.index, third.edges)
    rows = statements.orderBy("kind", "key").collect()
    assert [r.kind for r in rows] == [0, 0, 0, 1] and tuple(counts.first()) == (3, 1, 0)
    assert rows[-1].cypher.startswith("MATCH (a {canonical_id: $src}), (b {canonical_id: $dst}) MERGE (a)-[r:`r`]->(b)")


def test_edges_are_refreshed_only_when_asked_for(spark, monkeypatch):
    entities = mention_rows(spark, [("f", "Supplier", "Acme Ltd"), ("g", "Place", "Paris")])
    calls = []
    monkeypatch.setattr(graph, "refresh_edges", lambda *a: calls.append(a) or a[0])
    batch = plan.canonicalize(entities, None, plan.empty_index(spark), lambda: "so far", None)
    assert batch.counts.first().minted_count == 2 and not calls
    assert batch.edges == batch.edges == "so far" and len(calls) == 1


def test_edges_do_not_travel_with_their_uids(spark, monkeypatch):
    """However ends are looked up, nulls and strangers find nothing, and no shuffle of edges holds a uid."""
    rows = [("f", k, "r", s, d, 0.5, "e") for k, (s, d) in enumerate([("u", "v"), ("v", "w"), ("w", "w"), ("u", "z"), (None, "u"), ("w", None)])]
    edges = spark.createDataFrame(rows, "folder_id string, ord long, relation_type string, src_entity_uid string, dst_entity_uid string, confidence double, evidence_text string")
    entities = spark.createDataFrame([("u", "c1"), ("v", "c1"), ("w", "c2"), (None, "c3"), ("z", None)], "entity_uid string, canonical_id string")
    for most in (500_000, 0):
        monkeypatch.setattr(graph, "END_ROWS", most)
        found = {(r.src_canonical_id, r.dst_canonical_id) for r in graph.canonical_edges(edges, entities).collect()}
        assert found == {("c1", "c1"), ("c1", "c2"), ("c2", "c2")}
        near = graph.canonical_edges(edges, entities, spark.createDataFrame([("v",)], "entity_uid string"))
        assert {(r.src_canonical_id, r.dst_canonical_id) for r in near.collect()} == {("c1", "c1"), ("c1", "c2")}
    kept = sinks.resolve_written(edges, entities.select("entity_uid"))
    assert sorted(r.ord for r in kept.collect()) == [0, 1, 2, 3]
    plan_lines = kept.groupBy("folder_id").count()._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert not [x for x in plan_lines if "Join" in x and "entity_uid" in x]


def test_edge_aggregation(spark):
    rows = [("f", k, "a", "r", "b", c, e) for k, (c, e) in enumerate([(0.1, "p"), (0.9, "q"), (None, "r"), (0.9, "s"), (0.5, "q"), (0.95, "")])] + [("", 9, "a", "r", "b", None, None), ("g", 10, "x", "r", "y", None, None)]
    got = {r.src_canonical_id: r for r in graph.aggregate_edges(spark.createDataFrame(rows, "folder_id string, ord long, src_canonical_id string, relation_type string, dst_canonical_id string, confidence double, evidence_text string")).collect()}
    assert (got["a"].support_count, got["a"].confidence, got["a"].evidence_text) == (1, 0.95, ["q", "s", "q"])
    assert (got["x"].support_count, got["x"].confidence, got["x"].evidence_text) == (1, None, [])


def test_dangling_edges(spark):
    edges = spark.createDataFrame([("a", "r", "b", 1, None, None), ("a", "r", "z", 1, 0.5, ["e"]), ("y", "r", "z", 1, 0.5, ["e"])], "src_canonical_id string, relation_type string, dst_canonical_id string, support_count int, confidence double, evidence_text array<string>")
    nodes = spark.createDataFrame([("a",), ("b",)], "canonical_id string")
    assert {(r.dst_canonical_id, r.dangling, tuple(r.evidence_text)) for r in graph.export_edges(edges, nodes).collect()} == {("b", False, ()), ("z", True, ("e",))}


# --- sinks ------------------------------------------------------------------------------------------------------


def test_folder_replacement(spark, tmp_path):
    rows = spark.createDataFrame([("f", 1), ("f", 2), ("g", 3)], "folder_id string, x int")
    for _ in range(2):
        sinks.replace_folders(rows, str(tmp_path / "t"))
    sinks.replace_folders(rows.where("x = 1"), str(tmp_path / "t"))
    assert sorted(r.x for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 3]
    odd = spark.createDataFrame([("a=b/c: d%", 4), (None, 5)], rows.schema)
    sinks.replace_folders(odd, str(tmp_path / "t"))
    folders = spark.createDataFrame([("f",), ("a=b/c: d%",), (None,), ("never there",)], "folder_id string")
    sinks.replace_folders(rows.where("x = 2"), str(tmp_path / "t"), folders)
    assert sorted(r.x for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [2, 3]


def test_summary_and_statements(spark, tmp_path):
    summary = spark.createDataFrame([("f", "ok", 3), ("g", "failed", None)], "folder_id string, status string, entity_count int")
    sent = []

    def send(payload):
        sent.append(payload)
        raise OSError("no network")

    sinks.write_summary(summary, str(tmp_path / "s"), send)
    assert sorted(map(str, sent)) == sorted(map(str, [{"folder_id": "f", "status": "ok", "entity_count": 3}, {"folder_id": "g", "status": "failed"}]))
    out = str(tmp_path / "statements")

    def write(rows):
        for r in rows:
            with open(out, "a") as f:
                f.write(f"{r.kind}\n")

    statements = spark.createDataFrame([(1, "k", "c", "{}"), (0, "k", "c", "{}")], "kind int, key string, cypher string, params string").coalesce(1)
    assert sinks.write_statements(statements, write) == 2
    assert open(out).read().split() == ["0", "1"]


# --- scorers ----------------------------------------------------------------------------------------------------


def test_span_scores(spark):
    df = lambda rows: spark.createDataFrame(rows, "c string, s int, e int")
    gold, found = df([("1", 0, 5), ("1", 9, 12), ("2", 0, 3)]), df([("1", 0, 5), ("1", 9, 12), ("1", 9, 12), ("1", 20, 25)])
    assert tuple(quality.span_f1(found, gold, ["c", "s", "e"]).first()) == (0.6667, 0.6667, 0.6667, 2, 1, 1)
    assert tuple(quality.span_f1(df([]), df([]), ["c", "s", "e"]).first()) == (1.0, 1.0, 1.0, 0, 0, 0)


def test_relaxed_scores(spark):
    schema = "chunk_id string, ord int, entity_type string, surface_form string"
    gold = spark.createDataFrame([("a", 0, "P", "Ann Smith"), ("a", 1, "P", "Bob"), ("b", 0, "O", "Acme Corporation")], schema)
    found = spark.createDataFrame([("a", 0, "P", "ann  smith"), ("a", 1, "P", "Ann Smith"), ("b", 0, "O", "Acme Corporatio"), ("c", 0, "P", "Cyd")], schema)
    got = {r.kind: (r.tp, r.fp, r.fn) for r in quality.relaxed_entity_f1(found, gold).collect()}
    assert got == {"P": (1, 2, 1), "O": (1, 0, 0), "(all)": (2, 2, 1)}


def test_cluster_scores_against_pairs(spark):
    rng = random.Random(2)
    for _ in range(3):
        rows = [(f"p{rng.randrange(4)}", f"g{rng.randrange(4)}") for _ in range(30)]
        same = [(a[0] == b[0], a[1] == b[1]) for i, a in enumerate(rows) for b in rows[:i]]
        r = quality.cluster_prf(spark.createDataFrame(rows, "predicted string, gold string")).first()
        assert (r.tp, r.fp, r.fn) == (sum(p and g for p, g in same), sum(p and not g for p, g in same), sum(g and not p for p, g in same))


def test_stability(spark):
    row = lambda run, dst: (0, run, "r", "Ann", "P", dst, "P", "c", 1.0, "e", "llm")
    rows = relation_rows(spark, [row(1, "A"), row(1, "B"), row(2, "a "), row(2, "C")])
    runs = spark.createDataFrame([(1,), (2,), (3,), (4,)], "run_idx int")
    r = quality.run_stability(rows, runs).first()
    assert (r.num_runs, r.count_mean, r.mean_pairwise_jaccard) == (4, 1.0, round((1 / 3 + 1) / 6, 4))


# --- odds and ends ----------------------------------------------------------------------------------------------


def test_relaxed_scores_take_chunks_as_they_come(spark):
    """Chunks of a partition are scored one after the other, not as groups of their own; counts are those of the plain way."""
    rng = random.Random(3)
    words = ["Northern", "Norther", "northern", "Southern", "Southen", "East"]
    rows = lambda n: [(f"c{rng.randrange(12)}", k, rng.choice("AB"), rng.choice(words)) for k in range(n)]
    gold, found = rows(120), rows(100)
    want = {}
    left = list(gold)
    for c, _, kind, surface in found:
        hit = next((g for g in left if (g[0], g[2]) == (c, kind) and quality.surface_matches(g[3], surface)), None)
        want.setdefault(kind, [0, 0, 0])[0 if hit else 1] += 1
        if hit:
            left.remove(hit)
    for g in left:
        want.setdefault(g[2], [0, 0, 0])[2] += 1
    schema = "chunk_id string, ord int, entity_type string, surface_form string"
    out = quality.relaxed_entity_f1(spark.createDataFrame(found, schema), spark.createDataFrame(gold, schema))
    assert {r.kind: [r.tp, r.fp, r.fn] for r in out.collect() if r.kind != "(all)"} == want
    assert "CoGroup" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_prompts_of_a_chunk_are_written_in_slices(spark, monkeypatch):
    monkeypatch.setattr(rel, "SLICE", 1)
    lines = chunk_rows(spark, ["Ann is at Acme. x Acme", "other"])
    schema = "chunk_id string, batch_no int, pair_index int, src_surface string, src_type string, dst_surface string, dst_type string, sentence struct<sent_idx:int,start:int,end:int>, allowed array<string>"
    pairs = spark.createDataFrame([("c0", n, k, "Ann", "Person", "Acme", "Supplier", (0, 0, 15), ["works_for"]) for n in range(3) for k in range(3)], schema)
    out = rel.pair_prompts(pairs, lines)
    rows = out.collect()
    assert sorted(r.batch_no for r in rows) == [0, 1, 2]
    for r in rows:
        assert r.user.split("\n")[2:] == [f"{k}. Ann (Person) -> Acme (Supplier) in: Ann is at Acme.; one of: works_for, no_relation" for k in range(3)]
    assert "__slice" in next(x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x)


def test_texts_are_scanned_once(spark):
    """What is compared with itself further on starts from what was found, not from the texts again."""
    from graphloom.queries import extraction

    for query, step in ((extraction.guardrail_screen, "MapInArrow"), (extraction.preview_edges, "parse_json")):
        out = query(spark, "/root/testdata/sf0.001")
        assert step not in out._jdf.queryExecution().optimizedPlan().toString()


def test_sources(spark):
    from graphloom.config import lookup

    rows = spark.createDataFrame([("f", "c", None, 7), ("f", "d", "text", 8)], "folder_id string, chunk_id string, content string, n int")
    assert [tuple(r) for r in src.read_chunks(rows).orderBy("n").collect()] == [("f", "c", "", 7), ("f", "d", "text", 8)]
    lines = src.lines_as_chunks(spark.createDataFrame([("s", 1, "a\n\nb"), ("s", 2, None)], "source string, doc_id long, text string"))
    assert sorted((r.chunk_id, r.text) for r in lines.collect()) == [("1#0", "a"), ("1#1", ""), ("1#2", "b"), ("2#0", "")]
    assert lookup(spark, "graphloom.absent", "x") == "x" and lookup(spark, "spark.sql.session.timeZone") == "UTC"
    spark.conf.set("graphloom.blank", "  ")
    assert lookup(spark, "graphloom.blank", "y") == "y"


def test_masks_bound_the_similarity(spark):
    rng = random.Random(7)
    forms = ["".join(rng.choice("aab b1c") for _ in range(rng.randrange(1, 14))) for _ in range(40)]
    rows = canon.with_masks(spark.createDataFrame([(f,) for f in forms], "normalized_form string"))
    a, b = rows.select(F.col("normalized_form").alias("x"), F.col("masks").alias("a")), rows.select(F.col("normalized_form").alias("y"), F.col("masks").alias("b"))
    for r in a.crossJoin(b).select("x", "y", canon._missing("a", "b").alias("ab"), canon._missing("b", "a").alias("ba")).collect():
        most = min(len(r.x) - r.ab, len(r.y) - r.ba)
        assert ratio_of(r.x, r.y) <= 2 * most / (len(r.x) + len(r.y)) + 1e-12


def test_keys_lose_no_pair(spark):
    rng = random.Random(8)
    forms = {"".join(rng.choice("ab1 2") for _ in range(rng.randrange(1, 30))).strip() or "a" for _ in range(60)}
    for form in list(forms)[:30]:
        at = rng.randrange(len(form))
        forms |= {form[:at] + form[at + 1 :] or "b", form[:at] + "z" + form[at:], form[::-1]}
    forms = sorted(f for f in forms if f == f.strip())
    frame = spark.createDataFrame([("tok:x", f, k, k, 1) for k, f in enumerate(forms)], "block string, normalized_form string, min_ord int, max_ord int, n_mentions int")
    for floor in (0.8, 0.93, 0.95, 0.97):
        got = {(r.form_a, r.form_b): r.score for r in canon.fuzzy_pairs(frame, floor).collect()}
        assert got == {(a, b): ratio_of(a, b) for i, a in enumerate(forms) for b in forms[i + 1 :] if ratio_of(a, b) >= floor}


def test_upsert_and_resolve(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "k string, n int, v string")
    new = spark.createDataFrame([("a", 1, "y"), ("a", 2, "z"), ("c", 0, "w")], "k string, n int, v string")
    assert sorted(tuple(r) for r in sinks.upsert(old, new, ["k"], "n").collect()) == [("a", 2, "z"), ("b", 1, "x"), ("c", 0, "w")]
    edges = spark.createDataFrame([("u", "v"), ("u", "z")], "src_entity_uid string, dst_entity_uid string")
    written = spark.createDataFrame([("u",), ("v",), ("v",)], "entity_uid string")
    assert [tuple(r) for r in sinks.resolve_written(edges, written).collect()] == [("u", "v")]


def test_statements_carry_sorted_json(spark):
    nodes = spark.createDataFrame([("id", "Legal Entity", "acme", ["g", "f"], 2)], "canonical_id string, entity_type string, normalized_form string, folder_ids array<string>, mention_count long")
    row = graph.node_statements(nodes).select("cypher", F.get_json_object("params", "$.provenance").alias("p")).first()
    assert "`Legal_Entity`" in row.cypher and row.p == '{"folder_ids": ["g", "f"], "mention_count": 2}'


def test_many_ratios_are_those_of_difflib():
    from graphloom.functions import similar

    rng = random.Random(11)
    texts = ["", "a", "aa", "é", "né", "x" * 150, "x" * 149 + "y"]
    texts += ["".join(rng.choice("ab c") for _ in range(rng.randrange(1, 14))) for _ in range(60)]
    texts += ["with " + "".join(rng.choice("aeinorst") for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    forms = similar.Forms(texts)
    n = len(texts)
    for floor in (0.6, 0.8, 0.95):
        i, j = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n), indexing="ij"))
        exact = [ratio_of(texts[x], texts[y]) for x, y in zip(i, j, strict=True)]
        got = similar.ratios(forms, forms, i, j, floor)
        assert all(g == e if e >= floor else g < floor for g, e in zip(got, exact, strict=True))
        for cut in (1 << 17, 64):  # taken together, and each run on its own
            similar.PAIRS, before = cut, similar.PAIRS
            try:
                runs = np.array([[0, 40], [40, 43], [43, n]])
                met = {(x, y) for a, b in similar.close(forms, forms, runs, runs, floor) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
            finally:
                similar.PAIRS = before
            run = np.searchsorted([40, 43], np.arange(n), side="right")
            assert met >= {(x, y) for x, y, e in zip(i.tolist(), j.tolist(), exact, strict=True) if x < y and run[x] == run[y] and e >= floor}


def test_fuzzy_pairs_come_once_in_few_shuffled_columns(spark):
    """Similar forms have several keys in common; pairs are not made distinct afterwards, and rows carry no masks."""
    forms = ["acme a", "acme b", "acme ab", "acmeab", "acme", "acme ba"]
    rows = [(f.split()[0], f, (k, 0), (k, 0)) for k, f in enumerate(forms)]
    frame = spark.createDataFrame(rows, "block string, normalized_form string, min_ord struct<a:long,b:int>, max_ord struct<a:long,b:int>")
    found = canon.fuzzy_pairs(frame, 0.8)
    got = [(r.form_a, r.form_b, r.score) for r in found.collect()]
    want = [(a, b, ratio_of(a, b)) for i, a in enumerate(forms) for b in forms[i + 1 :] if a.split()[0] == b.split()[0] and ratio_of(a, b) >= 0.8]
    assert sorted(got) == sorted(want) and len(want) > 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "masks" not in plan and "Aggregate" not in plan.split("MapInArrow")[0]


def test_links_come_down_to_a_forest(spark):
    from graphloom.operators.components import components, spanning

    links = [(f"{g}{i:02d}", f"{g}{j:02d}") for g in "abc" for i in range(30) for j in range(30)]
    frame = spark.createDataFrame(links, "x string, y string").repartition(4)
    forest = spanning(frame, "x", "y")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert forest.count() <= 3 * 29 * tasks and forest.count() < len(links) / 2
    assert {r.node: r.root for r in components(forest, "x", "y").collect()} == {x: f"{x[0]}00" for x, _ in links}
    assert spanning(frame.where("x = y"), "x", "y").count() == 0


def test_answers_are_shuffled_without_uids(spark):
    own = spark.createDataFrame([(f"u{k}", k, f"f{k}") for k in range(4)], "entity_uid string, ord long, normalized_form string")
    told = spark.createDataFrame([("u0", "u1", " Yes"), ("u1", "u2", "no"), ("u3", "u2", "yes"), ("u0", "u9", "yes"), ("u0", "u3", None), (None, "u1", "yes"), ("u1", "u2", "y")], "a_uid string, b_uid string, answer string")
    found = canon.answered(told, own)
    assert {(r.form_a, r.form_b, r.yes) for r in found.collect()} == {("f0", "f1", True), ("f1", "f2", True)}
    pairs = spark.createDataFrame([("f0", "f1", "ambiguous"), ("f2", "f3", "ambiguous"), ("f1", "f3", "accept")], "form_a string, form_b string, verdict string")
    assert {tuple(r) for r in canon.adjudicated(pairs, own, told, "reject").collect()} == {("f0", "f1"), ("f1", "f3")}
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert joins and not any("uid" in line for line in joins)


def test_relations_wait_until_they_are_wanted(spark, monkeypatch):
    """A graph of nodes alone validates no relation, merges no edge and shuffles no uid of the batch."""
    lines = spark.createDataFrame([("f", "1#0", 1, 0, "Order 12345678 of sales@acme.example.com")], "folder_id string, chunk_id string, doc_id long, line_no int, text string")
    asked = []
    for name in ("validate", "merge_edges"):
        monkeypatch.setattr(rel, name, lambda *a, f=getattr(rel, name), n=name: asked.append(n) or f(*a))
    out = extract(lines, Settings(engine="rules", pack="commerce"))
    batch = plan.canonicalize(out.entities, lambda: out.edges, plan.empty_index(spark), plan.empty_edges(spark), None, policy="reject")
    assert batch.entities.where("canonical_id is not null").count() == batch.entities.count() > 0 and asked == []
    assert out.summary.count() == 1 and batch.edges.count() == 0 and asked == ["validate", "merge_edges"]
    own = spark.createDataFrame([("u", "staged"), (None, "staged"), ("w", "staged")], "entity_uid string, stage string")
    clustered = spark.createDataFrame([("u", "c"), (None, "c")], "entity_uid string, cluster_id string")
    found = canon.promoted(own, clustered, spark.createDataFrame([("c", "id", "form")], "cluster_id string, canonical_id string, normalized_form string"))
    assert {(r.entity_uid, r.stage, r.canonical_id) for r in found.collect()} == {("u", "canonicalized", "id"), (None, "staged", None), ("w", "staged", None)}


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(chunk_id")


def test_pairs_are_made_where_mentions_meet_sentences(spark, monkeypatch):
    """Pairs of a chunk are found, numbered and gathered behind the two shuffles that mentions and sentences need."""
    monkeypatch.setattr(prs, "small", lambda table, rows: F.broadcast(table))
    rng, kinds = random.Random(5), ("Person", "Supplier", "Organization", "Place", "Code")
    rows = [candidate("spacy", s, s + 1, f"w{s}", kinds[rng.randrange(5)], f"c{c}", s) for c in range(3) for s in rng.sample(range(60), 25)]
    spans = [(f"c{c}", k, k * 10, k * 10 + 10) for c in range(3) for k in (0, 1, 2, 4)] + [("c0", 5, 0, 5), ("c9", 0, 0, 60), ("c1", None, 50, 60)]
    held = {(r[1], r[7]): min((s for s in spans if s[0] == r[1] and s[1] is not None and s[2] <= r[6] < s[3]), default=None) for r in rows for r in [(*r[:6], r[6], r[6])]}
    pack = commerce()
    relations = [r["type"] for r in pack.relations]
    want = {}
    for a in rows:
        for b in rows:
            x, y = held[a[1], a[6]], held[b[1], b[6]]
            choices = tuple(sorted(r for r in relations if pack.allowed(r, a[4], b[4])))
            if a[1] == b[1] and a is not b and x is not None and x == y and choices:
                want.setdefault(a[1], []).append((a[6], b[6], x[1:], choices))
    found = prs.candidate_pairs(spark.createDataFrame(rows, CANDIDATE), spark.createDataFrame(spans, "chunk_id string, sent_idx int, start int, end int"), pack)
    got = [(r.chunk_id, r.src_span.start, r.dst_span.start, tuple(r.sentence), tuple(r.allowed)) for r in found.collect()]
    assert sorted(got) == sorted((c, *p) for c, ps in want.items() for p in ps) and len(got) > 30
    calls = rel.gather_calls(rel.plan_batches(found, 4))
    assert _exchanges(calls) == 2
    assert sorted((r.chunk_id, r.batch_no, [p.src_surface + p.dst_surface for p in r.pairs]) for r in calls.collect()) == sorted(
        (c, n, [f"w{a}w{b}" for a, b, *_ in sorted(ps)[n * 4 : n * 4 + 4]]) for c, ps in want.items() for n in range(-(-len(ps) // 4))
    )


def test_labels_are_looked_up_in_their_call(spark):
    """Answers and calls are shuffled, not labels and pairs; odd indices choose nothing, gaps between numbers do no harm."""
    schema = "chunk_id string, batch_no int, pair_index int, src_surface string, src_type string, dst_surface string, dst_type string, allowed array<string>"
    pairs = spark.createDataFrame([("c", 0, 3, "d", "P", "e", "P", ["r"]), ("c", 0, 0, "a", "P", "b", "P", ["q", "r"]), ("c", 1, 0, "x", "P", "y", "P", None)], schema)
    labels = ",".join(f'{{"pair_index":{i},"relation_type":"{t}","evidence":"{e}"}}' for i, t, e in (("0", "r", "1"), ('"3"', "r", "2"), ("1", "r", "3"), ("-1", "r", "4"), ("null", "r", "5"), ("3", "q", "6"), ("3", "no_relation", "7"), ("0", "q", ""), ("0", "q", "8")))
    answers = spark.createDataFrame([("c", 2, 0, f'{{"labels":[{labels}]}}'), ("c", 1, 1, '{"labels":[{"pair_index":0,"relation_type":"r","evidence":"9"}]}'), ("c", 1, 7, f'{{"labels":[{labels}]}}'), ("c", 3, 0, '{"labels":"none"}')], "chunk_id string, run_idx int, batch_no int, body string")
    want = {("c", 2, (0, 0), "r", "a", "b", "1"), ("c", 2, (0, 1), "r", "d", "e", "2"), ("c", 2, (0, 8), "q", "a", "b", "8")}
    for given in (pairs, rel.gather_calls(pairs)):
        chosen = rel.parse_labels(answers, given)
        assert {(r.chunk_id, r.run_idx, tuple(r.ord), r.relation_type, r.src_surface, r.dst_surface, r.evidence_text) for r in chosen.collect()} == want
        plan = chosen._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Generate posexplode") < plan.index("Join Inner")


def test_sentences_of_a_line(spark):
    from graphloom.queries.extraction import _sentences

    texts = ["One. Two.", "a..b", "", ".", "no stop", "é\U0001f600. x\r. ", "." * 3]
    got = [(r.chunk_id, r.sent_idx, r.start, r.end) for r in _sentences(chunk_rows(spark, texts)).collect()]
    want = []
    for c, text in enumerate(texts):
        at = 0
        for k, part in enumerate(p for p in re.split(r"(?<=\.)", text) if p):
            want.append((f"c{c}", k, at, at + len(part)))
            at += len(part)
    assert sorted(got) == sorted(want)
    assert "MapInArrow" in _sentences(chunk_rows(spark, texts))._jdf.queryExecution().optimizedPlan().toString()


def test_one_shuffle_by_chunk_serves_votes_and_spans(spark, monkeypatch):
    monkeypatch.setattr(rel, "small", lambda table, rows: F.broadcast(table))
    lines = chunk_rows(spark, ["Ann met Ann at Acme", "Ann left"])
    told = lambda chunk, run, surface, kind="Person": (chunk, run, f'{{"entities":[{{"type":"{kind}","surface":"Ann"}},{{"type":"{kind}","surface":"Ann"}},{{"type":"{kind}","surface":"{surface}"}}],"relations":[{{"type":"related_to","src":"Ann","src_type":"Person","dst":"{surface}","dst_type":"Person","evidence":"Ann"}}]}}')
    rows = [told("c0", 1, "Acme"), told("c0", 2, "Acme"), told("c0", 3, "Bob"), told("c1", 1, "Cyd"), told("c1", 3, "left")]
    answers = spark.createDataFrame(rows, "chunk_id string, run_idx int, body string")
    valid = rel.validate(rel.vote(rel.parse_relations(answers), 3), lines, commerce())
    found = ent.merge_layers(rel.parse_entities(answers, lines))
    for made in (valid, found):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(") == _exchanges(made) == 2
    assert [(r.chunk_id, r.dst_surface, r.confidence, r.grounded) for r in valid.collect()] == [("c0", "Acme", 2 / 3, True)]
    assert {(r.chunk_id, r.surface_form, r.span_start, r.occurrence_idx) for r in found.collect()} == {("c0", "Ann", 0, 0), ("c0", "Ann", 8, 0), ("c0", "Acme", 15, 0), ("c1", "Ann", 0, 0), ("c1", "Ann", None, 0), ("c1", "Cyd", None, 0)}


def test_lines_are_put_into_words_and_counted_once(spark):
    """Texts are gone through before answers are made of them, and not again for what callers are told."""
    from graphloom.queries import extraction as ext
    from graphloom.queries import inputs as inp

    plan = inp.responses(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" in plan and plan.rindex("Generate explode([1,2,3])") < plan.index("regexp_replace") and plan.count("regexp_extract_all") == 1
    told = ext.folder_state(spark, "/root/testdata/sf0.001")
    assert "Generate posexplode" not in told._jdf.queryExecution().optimizedPlan().toString()
