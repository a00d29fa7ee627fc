"""From mentions to canonical entities: normal forms, blocks, fuzzy pairs, clusters, and an index that outlives batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.similar import ALPHABET, DEPTH, paired
from ..functions.text import block_key, canonical_key, digest, normalize_surface
from ..ontology import Pack
from ..sources.scratch import materialize
from .components import components, spanning

FLOOR, CEILING = 0.80, 0.95
#: Forms of a block are paired in chunks of so many, so that no block is one task.
BLOCK_CHUNK = 2000


class AdjudicationError(ValueError):
    """An ambiguous pair that nobody decides."""


def with_forms(mentions: DataFrame) -> DataFrame:
    """C01 and C03; a missing surface has an empty form."""
    return mentions.withColumn("normalized_form", normalize_surface(F.coalesce("surface_form", F.lit("")))).withColumn("block", block_key(F.col("normalized_form")))


def distinct_forms(mentions: DataFrame) -> DataFrame:
    """One row per form with the first and last mention of it; equal forms always belong together."""
    return mentions.groupBy("block", "normalized_form").agg(F.min("ord").alias("min_ord"), F.max("ord").alias("max_ord"), F.count("*").alias("n_mentions"))


#: A task compares so many pairs of forms.
TASK_PAIRS = 20_000_000
#: Signatures of a form at most; with more, pairs meet so often that a block is better compared as it is.
SIGNATURES = 3


_COUNTS = f"transform(sequence(0, {len(ALPHABET) - 1}), c -> char_length(normalized_form) - char_length(replace(normalized_form, substring('{ALPHABET}', c + 1, 1), '')))"


def with_masks(forms: DataFrame) -> DataFrame:
    """Forms with ``counts`` of each character and ``masks``: bit c of mask k tells whether character c comes more than k
    times."""
    last = len(ALPHABET) - 1
    mask = f"aggregate(sequence(0, {last}), 0L, (m, c) -> m | if(counts[c] > k, shiftleft(1L, c), 0L))"
    return forms.withColumn("counts", F.expr(_COUNTS)).withColumn("masks", F.expr(f"transform(sequence(0, {DEPTH - 1}), k -> {mask})"))


def _keyed(forms: DataFrame, floor: float) -> DataFrame:
    """Forms with ``key``, once for each key, and ``role``: similar forms of a block have a key in common, and roles of
    0 both or of 1 and 2. ``earlier`` are the keys before it, so that a pair with several in common counts at the first.

    Of two strings of n characters in all at most n (1 - floor) are unmatched. If the alphabet falls into more groups
    than that, then in one of them both strings have the same characters, as often. A block whose longest form would
    need more than ``SIGNATURES`` groups has one key for all.

    In a block where only one character may be unmatched, a similar form is the other without one of its characters:
    keys are the form itself (role 1) and what it is without each of them (role 2), as far as the block has forms of
    such a length.
    """
    named = forms.where("normalized_form <> ''")
    most = F.max(F.char_length("normalized_form")) * (2 * (1 - floor)) + 1e-9
    longest = named.groupBy("block").agg((F.floor(most) + 1).cast("int").alias("__groups"), F.collect_set(F.char_length("normalized_form")).alias("__lengths"))
    signature = f"transform(array({_COUNTS}), counts -> transform(sequence(0, __groups - 1), g -> xxhash64(g, filter(counts, (x, c) -> c % __groups = g))))[0]"
    without = "array_distinct(transform(sequence(1, char_length(normalized_form)), i -> xxhash64(concat(substring(normalized_form, 1, i - 1), substring(normalized_form, i + 1)))))"
    one = f"""concat(if(array_contains(__lengths, char_length(normalized_form) + 1), array(struct(xxhash64(normalized_form) as key, 1 as role)), array()),
        if(array_contains(__lengths, char_length(normalized_form) - 1), transform({without}, k -> struct(k as key, 2 as role)), array()))"""
    one = f"transform({one}, k -> struct(k.key as key, k.role as role, cast(array() as array<bigint>) as earlier))"
    several = f"transform(array({signature}), s -> transform(s, (k, g) -> struct(k as key, 0 as role, slice(s, 1, g) as earlier)))[0]"
    whole = "array(struct(0L as key, 0 as role, cast(array() as array<bigint>) as earlier))"
    keys = F.expr(f"case when __groups <= 2 then {one} when __groups > {SIGNATURES} then {whole} else {several} end")
    return named.join(longest, "block").withColumn("__key", F.explode(keys)).select("*", "__key.key", "__key.role", "__key.earlier").drop("__groups", "__lengths", "__key")


def _missing(a: str, b: str):
    """At least so many characters of a, repeats counted, have no partner in b."""
    return F.expr(" + ".join(f"bit_count({a}[{k}] & ~{b}[{k}])" for k in range(DEPTH)))


def fuzzy_pairs(forms: DataFrame, floor: float = FLOOR, ceiling: float = CEILING) -> DataFrame:
    """(block, form_a, form_b, score, verdict) of different forms of a block that are not certain to be apart.

    The similarity depends on the order of its arguments, and a pair is compared in the order of its mentions; if
    mentions of both forms come in either order, both are computed and either may accept.

    The similarity is twice the matched characters over all characters, and no more match than both strings have,
    nor any without a partner. Pairs that this keeps below the floor are not aligned, and where the floor is high most
    are not even made. A group of rows is two chunks of a block, or one, and is compared as arrays; tasks get equal
    shares of the pairs, and none needs more memory than two chunks and a slice of their pairs.
    """
    forms = materialize(forms.select("block", "normalized_form", "min_ord", "max_ord"), "forms")
    named = materialize(_keyed(forms, floor), "keyed")
    sizes = named.groupBy("block", "key").agg(F.count("*").alias("__n")).where("__n > 1")
    work = sizes.agg(F.sum(F.col("__n").cast("double") ** 2)).first()[0] or 0.0
    spark = named.sparkSession
    tasks = int(min(20_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), work / TASK_PAIRS)))
    chunked = named.join(sizes.select("block", "key", F.ceil(F.col("__n") / BLOCK_CHUNK).cast("int").alias("__chunks")), ["block", "key"]).withColumn("__own", F.pmod(F.xxhash64("normalized_form"), F.col("__chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1)).alias("__other")
    met = chunked.select("*", other)
    ends = [F.least("__own", "__other"), F.greatest("__own", "__other")]
    leaves = _whole_numbers(named.schema["min_ord"].dataType)
    earlier, low, high = [f"e{k}" for k in range(SIGNATURES - 1)], [f"l{k}" for k in range(len(leaves))], [f"h_{k}" for k in range(len(leaves))]
    rows = met.select(
        F.xxhash64("block", "key", *ends).alias("h1"), F.xxhash64(F.lit(1), "block", "key", *ends).alias("h2"), F.when(F.col("__own") == F.col("__other"), 2).when(F.col("__own") < F.col("__other"), 0).otherwise(1).alias("side"), "block", F.col("normalized_form").alias("form"), "role", "min_ord", "max_ord",
        *(F.get("earlier", F.lit(k)).alias(c) for k, c in enumerate(earlier)), *(F.col(f"min_ord{x}").cast("long").alias(c) for x, c in zip(leaves, low, strict=True)), *(F.col(f"max_ord{x}").cast("long").alias(c) for x, c in zip(leaves, high, strict=True)),
    )
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in ("block", "form_a", "form_b")), T.StructField("score", T.DoubleType()), T.StructField("a_min", named.schema["min_ord"].dataType), T.StructField("b_max", named.schema["max_ord"].dataType)])
    found = rows.repartition(tasks, "h1", "h2").sortWithinPartitions("h1", "h2", "side").mapInArrow(paired(floor, earlier, low, high), schema)
    # Direction (a, b) occurs if some mention of a comes before some mention of b.
    scored = found.where((F.col("form_a") != F.col("form_b")) & (F.col("a_min") < F.col("b_max"))).drop("a_min", "b_max")
    return scored.withColumn("verdict", F.when(F.col("score") >= ceiling, "accept").otherwise("ambiguous"))


def _whole_numbers(kind: T.DataType, path: str = "") -> list[str]:
    """Paths of the fields of a type that is ordered as whole numbers one after another; none if it is of another kind."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return [path]
    if not isinstance(kind, T.StructType):
        return []
    found = [_whole_numbers(f.dataType, f"{path}.{f.name}") for f in kind.fields]
    return [x for part in found for x in part] if all(found) else []


def questions(pairs: DataFrame, mentions: DataFrame) -> DataFrame:
    """(a_uid, b_uid, form_a, form_b): what to ask about ambiguous pairs, once for a pair of forms and its direction.

    The first mention of one form and the last of the other stand for all; the first comes before the last.
    """
    ends = mentions.groupBy("normalized_form").agg(F.min_by("entity_uid", "ord").alias("a_uid"), F.max_by("entity_uid", "ord").alias("b_uid"))
    asked = pairs.where("verdict = 'ambiguous'").select("form_a", "form_b")
    for end in ("a", "b"):
        asked = asked.join(ends.select(F.col("normalized_form").alias(f"form_{end}"), f"{end}_uid"), f"form_{end}")
    return asked.select("a_uid", "b_uid", "form_a", "form_b")


def answered(adjudications: DataFrame, mentions: DataFrame) -> DataFrame:
    """(form_a, form_b, yes): answers (a_uid, b_uid, answer) on mentions as answers on their forms; one that begins
    with y settles the pair. Answers on mentions that are not of the batch, or come in the wrong order, do not count.

    They meet by digests of the uids, so that an answer is 33 bytes when it is shuffled.
    """
    ends = mentions.select(*(c.alias(n) for c, n in zip(digest("entity_uid"), ("__h1", "__h2"), strict=True)), "ord", "normalized_form")
    told = adjudications.where("answer is not null and a_uid is not null and b_uid is not null")
    told = told.select(F.lower(F.trim("answer")).startswith("y").alias("__yes"), *(c.alias(f"{end}{k}") for end in ("a", "b") for k, c in enumerate(digest(f"{end}_uid"))))
    for end in ("a", "b"):
        known = ends.select(F.col("__h1").alias(f"{end}0"), F.col("__h2").alias(f"{end}1"), F.col("ord").alias(f"{end}_ord"), F.col("normalized_form").alias(f"form_{end}"))
        told = told.join(known, [f"{end}0", f"{end}1"]).drop(f"{end}0", f"{end}1")
    return told.where("a_ord < b_ord").groupBy("form_a", "form_b").agg(F.bool_or("__yes").alias("yes"))


def adjudicated(pairs: DataFrame, mentions: DataFrame, adjudications: DataFrame | None, policy: str = "fail") -> DataFrame:
    """Accepted links (form_a, form_b) out of fuzzy pairs, ambiguous ones by the answers given for mentions.

    A pair of forms without an answer fails the batch, or under the policy ``reject`` counts as no. Answers meet
    pairs of forms, so the work grows with the answers, not with the pairs of mentions behind two forms.
    """
    accepted = pairs.where("verdict = 'accept'").select("form_a", "form_b")
    doubtful = pairs.where("verdict = 'ambiguous'").select("form_a", "form_b")
    if adjudications is None:
        if policy == "fail" and not doubtful.isEmpty():
            raise AdjudicationError("there are ambiguous pairs and no adjudications")
        return accepted
    told = answered(adjudications, mentions)
    if policy != "fail":
        return accepted.union(doubtful.join(told.where("yes"), ["form_a", "form_b"], "left_semi"))
    settled = materialize(doubtful.join(told, ["form_a", "form_b"], "left"), "adjudicated")
    if not settled.where("yes is null").isEmpty():
        raise AdjudicationError("an ambiguous pair has no answer")
    return accepted.union(settled.where("yes").select("form_a", "form_b"))


def clusters(mentions: DataFrame, links: DataFrame) -> DataFrame:
    """Mentions with ``cluster_id``: the least form of the cluster, the same for every mention of it (C07). Clusters are
    components of forms; types play no part."""
    roots = components(spanning(links, "form_a", "form_b"), "form_a", "form_b")
    own = mentions.join(roots, F.col("normalized_form") == F.col("node"), "left")
    return own.withColumn("cluster_id", F.coalesce("root", "normalized_form")).drop("node", "root")


def exact_clusters(mentions: DataFrame) -> DataFrame:
    """The equality band alone: mentions of one form are one cluster."""
    return mentions.withColumn("cluster_id", F.col("normalized_form"))


def _most_specific(pack: Pack | None, types: str, first: str) -> Column:
    """Of an array of types the most specific known one, the first declared of several, else the first seen."""
    if pack is None:
        return F.col(first)
    declared = F.create_map(*[F.lit(x) for i, t in enumerate(pack.entity_types) for x in (t["type"], i)])
    above = F.create_map(*[x for t in pack.parents for x in (F.lit(t), F.array(*map(F.lit, pack.ancestors(t))).cast("array<string>"))])
    general = F.flatten(F.transform(types, lambda t: F.coalesce(F.element_at(above, t), F.array().cast("array<string>"))))
    ranked = F.transform(F.filter(types, lambda t: F.element_at(declared, t).isNotNull() & ~F.array_contains(general, t)), lambda t: F.struct(F.element_at(declared, t), t.alias("type")))
    return F.coalesce(F.array_min(ranked)["type"], F.col(first))


def _typed(clustered: DataFrame, pack: Pack | None, *more: Column) -> DataFrame:
    """One aggregate per cluster: a cluster has as many types as a vocabulary at most, so they are looked at together."""
    found = clustered.groupBy("cluster_id").agg(F.collect_set("entity_type").alias("__types"), F.min_by("entity_type", "ord").alias("__first"), *more)
    return found.withColumn("entity_type", _most_specific(pack, "__types", "__first")).drop("__types", "__first")


def reconciled_types(clustered: DataFrame, pack: Pack | None) -> DataFrame:
    """(cluster_id, entity_type)."""
    return _typed(clustered, pack)


def canonical_clusters(clustered: DataFrame, pack: Pack | None) -> DataFrame:
    """(cluster_id, entity_type, normalized_form, n_mentions, canonical_key): the form is that of the first mention."""
    out = _typed(clustered, pack, F.min_by("normalized_form", "ord").alias("normalized_form"), F.count("*").alias("n_mentions"))
    return out.withColumn("canonical_key", canonical_key(F.col("entity_type"), F.col("normalized_form")))


def resolve_or_mint(found: DataFrame, index: DataFrame) -> DataFrame:
    """Clusters with ``canonical_id`` and ``minted``: whether their key is new to the index.

    New ids derive from the key, so a rerun mints the same ones.
    """
    there = index.select("canonical_key", F.col("canonical_id").alias("__known"))
    digest = F.sha2("canonical_key", 256)
    new = F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return found.join(there, "canonical_key", "left").withColumn("minted", F.col("__known").isNull()).withColumn("canonical_id", F.coalesce("__known", new)).drop("__known")


def extended_index(index: DataFrame, resolved: DataFrame) -> DataFrame:
    columns = ["canonical_id", "canonical_key", "entity_type", "normalized_form"]
    return index.select(*columns).unionByName(resolved.where("minted").select(*columns).distinct())


def batch_counts(resolved: DataFrame) -> DataFrame:
    """Clusters minted and merged; both count clusters, not mentions."""
    return resolved.agg(F.count_if("minted").alias("minted_count"), F.count_if(~F.col("minted")).alias("merged_count"))


def promoted(entities: DataFrame, clustered: DataFrame, resolved: DataFrame) -> DataFrame:
    """The entity table with the batch's rows canonicalized (C10): each gets the id and the form of its cluster.

    Rows meet by digests of their uids, so that of those of the batch no uid is shuffled.
    """
    named = resolved.select("cluster_id", F.col("canonical_id").alias("__id"), F.col("normalized_form").alias("__form"))
    keys = ["__h1", "__h2"]
    given = clustered.where("entity_uid is not null").select(*(c.alias(n) for c, n in zip(digest("entity_uid"), keys, strict=True)), "cluster_id").join(named, "cluster_id").drop("cluster_id")
    old = {c: F.col(f"e.{c}") if c in entities.columns else F.lit(None).cast("string") for c in ("canonical_id", "normalized_form")}
    rest = [F.col(f"e.{c}") for c in entities.columns if c not in ("stage", *old)]
    joined = entities.withColumns(dict(zip(keys, digest("entity_uid"), strict=True))).alias("e").join(given, keys, "left")
    stage = F.when(F.col("__id").isNotNull(), "canonicalized").otherwise(F.col("e.stage"))
    return joined.select(*rest, stage.alias("stage"), F.coalesce("__id", old["canonical_id"]).alias("canonical_id"), F.coalesce("__form", old["normalized_form"]).alias("normalized_form"))


def staged(entities: DataFrame, folders: list[str] | None) -> DataFrame:
    """Mentions of a batch that wait to be canonicalized (S09); None means all folders."""
    waiting = entities.where(F.col("stage") == "staged")
    return waiting if folders is None else waiting.where(F.col("folder_id").isin(*folders))


def batch_pack(entities: DataFrame, folders: list[str] | None, default: str = "general") -> str:
    """The pack of the batch's first staged row that names one."""
    row = staged(entities, folders).agg(F.min_by("ontology_pack", F.when(F.col("ontology_pack").isNotNull(), F.col("ord")))).first()
    return row[0] or default
