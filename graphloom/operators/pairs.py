"""Pairs of mentions that a relation could join, and relations read off parse trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ontology import Pack, PackError, small


def sentence_of(mentions: DataFrame, spans: DataFrame, position: str = "span_start") -> DataFrame:
    """Mentions with the first sentence that holds their start (J05); those without are dropped.

    ``spans`` has (chunk_id, sent_idx, start, end). Sentences of a chunk travel as one array, so nothing is joined
    by range.
    """
    listed = spans.groupBy("chunk_id").agg(F.array_sort(F.collect_list(F.struct("sent_idx", "start", "end"))).alias("__spans"))
    at = F.col(position)
    held = F.filter("__spans", lambda s: (s["start"] <= at) & (at < s["end"]))
    # Exploded, so that the sentences of a chunk are gone through once for each mention.
    joined = mentions.join(listed, "chunk_id")
    return joined.select(*mentions.columns, F.explode(F.slice(held, 1, 1)).alias("sentence"))


def candidate_pairs(mentions: DataFrame, spans: DataFrame, pack: Pack) -> DataFrame:
    """Ordered pairs of mentions of one sentence with the relations the pack allows between them.

    Mentions of a sentence are gathered where those of its chunk already are, and paired there: nothing is shuffled for
    the pairs, nor placed once for each side. What follows by chunk needs no shuffle either.
    """
    # Only types that can be a source or a target at all are gathered on that side.
    table = pack.allowed_table(mentions.sparkSession)
    ends = F.explode(F.array(*(F.struct(F.col(f"{end}_type").alias("entity_type"), F.lit(end == "src").alias("src"), F.lit(end == "dst").alias("dst")) for end in ("src", "dst"))))
    roles = table.select(ends.alias("e")).groupBy("e.entity_type").agg(F.bool_or("e.src").alias("__src"), F.bool_or("e.dst").alias("__dst"))
    placed = sentence_of(mentions, spans).where("sentence.sent_idx is not null and ord is not null").join(small(roles, len(pack.parents)), "entity_type")

    def side(end: str) -> Column:
        span = F.struct(F.col("span_start").alias("start"), F.col("span_end").alias("end"))
        more = [F.col("sentence")] if end == "src" else []
        item = F.struct(F.col("entity_type").alias("type"), F.col("ord"), F.col("surface_form").alias("surface"), span.alias("span"), *more)
        return F.collect_list(F.when(F.col(f"__{end}"), item)).alias(f"__{end}s")

    held = placed.groupBy("chunk_id", F.col("sentence.sent_idx").alias("sent_idx")).agg(side("src"), side("dst"))
    both = held.select("chunk_id", "sent_idx", F.explode("__srcs").alias("s"), "__dsts").select("chunk_id", "sent_idx", "s", F.explode("__dsts").alias("d")).where("s.ord != d.ord")
    choices = table.groupBy("src_type", "dst_type").agg(F.array_sort(F.collect_list("relation_type")).alias("allowed"))
    paired = both.select(F.col("s.type").alias("src_type"), F.col("d.type").alias("dst_type"), "chunk_id", "sent_idx", "s.sentence", *(F.col(f"{x}.{c}").alias(f"{end}_{c}") for x, end in (("s", "src"), ("d", "dst")) for c in ("ord", "surface", "span")))
    return paired.join(small(choices, len(pack.parents) ** 2), ["src_type", "dst_type"])


def _attributes(token: dict, alias: str) -> Column:
    holds = F.lit(True)
    for name, wanted in (token.get("RIGHT_ATTRS") or {}).items():
        if name not in ("LEMMA", "DEP"):
            raise PackError(f"no such token attribute: {name}")
        column = F.col(f"{alias}.{name.lower()}")
        values = wanted["IN"] if isinstance(wanted, dict) else [wanted]
        holds &= column.isin(*values)
    return holds


def match_pattern(tokens: DataFrame, dep: dict, pack: Pack, pattern_idx: int = 0) -> DataFrame:
    """Relations where a pattern of tokens fits a parse tree.

    ``ord`` is the number of the pattern and those of the tokens it took. Each further token is one join of the token table with itself on the chunk and the head; a token is never its
    own head's dependent.
    """
    pattern = dep["pattern"]
    found = None
    for token in pattern:
        own = token["RIGHT_ID"]
        side = tokens.alias(own).where(_attributes(token, own))
        if found is None:
            found = side
            continue
        left = token["LEFT_ID"]
        if token["REL_OP"] == ">":
            linked = F.col(f"{own}.head") == F.col(f"{left}.i")
        elif token["REL_OP"] == "<":
            linked = F.col(f"{left}.head") == F.col(f"{own}.i")
        else:
            raise PackError(f"no such token relation: {token['REL_OP']}")
        found = found.join(side, (F.col(f"{own}.chunk_id") == F.col(f"{left}.chunk_id")) & linked & (F.col(f"{own}.i") != F.col(f"{left}.i")))
    relation = next(r for r in pack.relations if r["type"] == dep["relation_type"])
    src, dst = dep["src_node"], dep["dst_node"]
    place = F.array(F.lit(pattern_idx), *[F.col(f"{t['RIGHT_ID']}.i") for t in pattern])
    return found.select(
        F.col(f"{src}.chunk_id").alias("chunk_id"), F.lit(1).alias("run_idx"), place.alias("ord"), F.lit(dep["relation_type"]).alias("relation_type"), F.col(f"{src}.text").alias("src_surface"), F.lit(relation["domain"][0]).alias("src_type"),
        F.col(f"{dst}.text").alias("dst_surface"), F.lit(relation["range"][0]).alias("dst_type"), F.lit(1.0).alias("confidence"), F.col(f"{src}.sent_text").alias("evidence_text"), F.lit("rules").alias("extractor"),
    )


def rule_relations(tokens: DataFrame, pack: Pack) -> DataFrame:
    """All patterns of the pack, each on its own even where they share a relation."""
    out = None
    for k, dep in enumerate(pack.dep_patterns):
        one = match_pattern(tokens, dep, pack, k)
        out = one if out is None else out.unionByName(one)
    if out is None:
        return tokens.sparkSession.createDataFrame([], "chunk_id string, run_idx int, ord array<int>, relation_type string, src_surface string, src_type string, dst_surface string, dst_type string, confidence double, evidence_text string, extractor string")
    return out
