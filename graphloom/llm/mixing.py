"""Mixing sources to target weights with DataFrame functions only.

Every document draws the key -ln(u) / w of Efraimidis and Spirakis, u a uniform number fixed by its id and the seed
and w its quality weight. A source whose target is e times its size and a rest gives e complete epochs; for the rest
its documents are taken in order of their keys until the prefix sum of words reaches the budget, the last one in part.

No source is sorted in one task: keys fall into buckets, sums of buckets are prefix-summed over the buckets, and only
documents of one bucket of one source are sorted against each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A target stops at so many times the size of its source.
EPOCHS = 3
#: Buckets of keys at least, and rows of a bucket of one source on average at most.
BUCKETS = 4096
BUCKET_ROWS = 20_000
#: A typical word has so many characters; documents far from it weigh less.
WORD_CHARS = 6.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def quality_weight(size: Column, chars: Column) -> Column:
    """Between 0.05 and 1: how near the mean length of a word (with its space) is to a usual one."""
    mean = chars / F.greatest(size, F.lit(1)) / F.lit(WORD_CHARS)
    return F.greatest(F.lit(0.05), F.when(mean > 1, 1 / mean).otherwise(mean))


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """In (0, 1), from the first 48 bits of a digest of the id, or of the text where there is no id."""
    name = F.coalesce(doc_id.cast("string"), F.sha2(F.coalesce(text, F.lit("")), 256))
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), name), 256)
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) of a table (source, source_size), one row per source.

    Pouring the excess of capped sources over the others by weight, again and again, ends where every source has
    min(cap, level * weight) with one common level: with sources in order of cap / weight, the level is the rest
    of the total over the rest of the weights at the first source that its cap does not bind.
    """
    every = Window.partitionBy(F.lit(0))
    place = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * epochs)
    order = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("total", F.sum("source_size").over(every))
        .withColumn("rest", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("others", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.col("rest") / F.col("others"))
        .withColumn("free", F.col("cap") / F.col("weight") >= F.col("level"))
    )
    level = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(every)["level"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return rows.select("source", "source_size", target.alias("target"))


def draw(docs: DataFrame, seed: int) -> DataFrame:
    """docs with ``__size`` and ``__key``; the size is a column of its own, so that texts are scanned once."""
    sized = docs.withColumn("__size", word_count(F.col("text")))
    weight = quality_weight(F.col("__size"), F.coalesce(F.char_length("text"), F.lit(0)))
    return sized.withColumn("__key", -F.ln(uniform(F.col("doc_id"), F.col("text"), seed)) / weight)


def _shares(docs: DataFrame, weights: tuple[int, ...], epochs: int, seed: int, buckets: int | None) -> DataFrame:
    slim = materialize(draw(docs, seed).select("doc_id", "source", F.col("__size").alias("size"), F.col("__key").alias("key")), "mix")
    if buckets is None:
        buckets = max(BUCKETS, slim.count() // BUCKET_ROWS)
    slim = slim.withColumn("bucket", F.floor((1 - F.exp(-F.col("key") / 4)) * buckets).cast("int"))
    plans = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs)
    plans = plans.withColumn("whole", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(epochs).cast("long"))).otherwise(F.lit(0).cast("long")))
    plans = plans.withColumn("budget", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))
    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = slim.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
    sums = sums.withColumn("before", F.coalesce(F.sum("held").over(up_to), F.lit(0).cast("long"))).drop("held")
    sums = sums.alias("s").join(plans.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source"))).select("s.source", "bucket", "before", "source_size", "target", "whole", "budget")
    inside = Window.partitionBy("source", "bucket").orderBy("key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = slim.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))
    joined = placed.alias("d").join(sums.alias("b"), F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.bucket") == F.col("b.bucket")))
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("long"), F.col("budget") - F.col("before") - F.col("ahead")))
    return joined.select("doc_id", F.col("d.source").alias("source"), "key", "size", "source_size", "target", "whole", part.alias("part"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = 7, buckets: int | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    ``taken`` counts words with repeats; the sum over a source is its target rounded to a whole number. Null text
    has size 0, a null source is a source (the last), rows without a doc_id draw by their text, repeated rows draw one
    key, equal keys go by id and size. An empty table gives no rows; columns beyond doc_id, source and text are ignored.

    There is one row per source in one task to share out the total; documents are sorted within a bucket of a source.
    """
    shares = _shares(docs, weights, epochs, seed, buckets)
    return shares.select("doc_id", "source", "size", "source_size", "target", (F.col("whole") * F.col("size") + F.col("part")).alias("taken"))


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = 7, buckets: int | None = None) -> DataFrame:
    """The documents of the mix, in the columns of docs: one row for each complete time a document is taken.

    A document of which only the first m words are taken comes once more with just those words, joined by single
    spaces; documents that the mix leaves out go. doc_id must be unique and not null; null and blank texts are never
    taken; an empty table gives no rows.

    What a source takes beyond its complete epochs ends at one document, the cut. One row per source (its epochs
    and its cut) therefore settles every document, and texts meet those rows by source, without a shuffle where
    that written table is small enough to broadcast.
    """
    shares = _shares(docs, weights, epochs, seed, buckets)
    cut = F.max(F.when(F.col("part") > 0, F.struct("key", "doc_id", "part"))).alias("__cut")
    cuts = materialize(shares.groupBy(F.col("source").alias("__source")).agg(F.max("whole").cast("int").alias("__whole"), cut), "cuts")
    drawn = draw(docs, seed).join(cuts, F.col("source").eqNullSafe(F.col("__source")))
    # The cut names a document by its id: keys are settled by ids, and arithmetic is never compared with itself.
    at_cut = F.col("doc_id") == F.col("__cut.doc_id")
    before = F.struct(F.col("__key"), F.col("doc_id")) < F.struct(F.col("__cut.key"), F.col("__cut.doc_id"))
    part = F.when(at_cut, F.col("__cut.part")).when(before, F.col("__size")).otherwise(F.lit(0).cast("long"))
    drawn = drawn.withColumn("__part", F.coalesce(part, F.lit(0).cast("long")))
    whole = F.col("__whole") + F.when(F.col("__part") == F.col("__size"), 1).otherwise(0)
    rest = F.when(F.col("__part") < F.col("__size"), F.col("__part")).otherwise(F.lit(0).cast("long"))
    # A filter on the size would be pushed down and scan the text again; no copies do the same.
    copies = F.array_repeat(F.lit(0).cast("long"), F.when(F.col("__size") > 0, whole).otherwise(0))
    rows = drawn.withColumn("__words", F.explode(F.when(rest > 0, F.concat(copies, F.array(rest))).otherwise(copies)))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    out = {c: F.col(f"`{c}`") for c in docs.columns}
    out["text"] = F.when(F.col("__words") > 0, F.array_join(F.slice(words, F.lit(1), F.col("__words").cast("int")), " ")).otherwise(F.col("text"))
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("__words") > 0, F.char_length(out["text"]).cast("long")).otherwise(F.col("n_chars"))
    return rows.select(*[x.alias(c) for c, x in out.items()])
