"""Scorers of extraction and clustering."""

from __future__ import annotations

import difflib
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse

RELAXED = 0.85


def _scores(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """Precision and recall are 1 over nothing, F1 then 0; all rounded to four places."""
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(1.0)
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(1.0)
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return [F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(f, 4).alias("f1"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn")]


def span_f1(predicted: DataFrame, gold: DataFrame, key: list[str]) -> DataFrame:
    """Exact agreement of two sets of spans (Q01)."""
    both = predicted.select(*key, F.lit(1).alias("p"), F.lit(0).alias("g")).union(gold.select(*key, F.lit(0), F.lit(1))).groupBy(*key).agg(F.max("p").alias("p"), F.max("g").alias("g"))
    counts = both.agg(*[F.count_if((F.col("p") == p) & (F.col("g") == g)).alias(n) for n, p, g in (("tp", 1, 1), ("fp", 1, 0), ("fn", 0, 1))])
    return counts.select(*_scores(F.col("tp"), F.col("fp"), F.col("fn")))


def _plain(surface: str) -> str:
    return " ".join(surface.lower().split())


@lru_cache(maxsize=100_000)
def _close(a: str, b: str, floor: float) -> bool:
    """Whether the similarity reaches the floor; its bounds, cheaper by far, go first."""
    if 2.0 * min(len(a), len(b)) < floor * (len(a) + len(b)) - 1e-9:
        return False
    matcher = difflib.SequenceMatcher(None, a, b)
    return matcher.quick_ratio() >= floor and matcher.ratio() >= floor


def surface_matches(gold: str, predicted: str, floor: float = RELAXED) -> bool:
    """Equal but for case and white space, or similar enough (Q02)."""
    a, b = _plain(gold), _plain(predicted)
    return a == b or _close(a, b, floor)


_MATCHED = "kind string, tp long, fp long, fn long"


def _greedy(same: list[str], near: list[str], kind: str):
    """One to one within a chunk, predictions in order, each taking the first gold row that is left and fits.

    Rows come by chunk, gold first, then in order; one chunk at a time is held, and a partition gives one row a kind.
    """
    at = same.index(kind)

    def run(batches):
        chunk, left = object(), {}
        counts: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])

        def close() -> None:
            for key, rows in left.items():
                counts[key[at]][2] += len(rows)
            left.clear()

        for batch in batches:
            column = {c: batch.column(c).to_pylist() for c in ("chunk_id", "__gold", *same, *near)}
            keys, surfaces = (zip(*(column[c] for c in names), strict=True) for names in (same, near))
            for own, gold, key, surface in zip(column["chunk_id"], column["__gold"], keys, surfaces, strict=True):
                if own != chunk:
                    close()
                    chunk = own
                plain = [_plain(x) for x in surface]
                if gold:
                    left.setdefault(key, []).append(plain)
                    continue
                rows = left.get(key, [])
                hit = next((i for i, g in enumerate(rows) if all(x == y or _close(x, y, RELAXED) for x, y in zip(g, plain, strict=True))), None)
                counts[key[at]][1 if hit is None else 0] += 1
                if hit is not None:
                    del rows[hit]
        close()
        columns = zip(*counts.values(), strict=True) if counts else ([], [], [])
        yield pa.record_batch([pa.array(list(counts), pa.string()), *(pa.array(list(c), pa.int64()) for c in columns)], names=["kind", "tp", "fp", "fn"])

    return run


def _relaxed(predicted: DataFrame, gold: DataFrame, same: list[str], near: list[str], kind: str) -> DataFrame:
    own = ["chunk_id", "ord", *same, *near]
    both = gold.select(*own, F.lit(True).alias("__gold")).union(predicted.select(*own, F.lit(False)))
    rows = both.repartition("chunk_id").sortWithinPartitions("chunk_id", F.col("__gold").desc(), "ord").drop("ord")
    parts = rows.mapInArrow(_greedy(same, near, kind), _MATCHED)
    per_type = parts.groupBy("kind").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    total = per_type.agg(*[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in ("tp", "fp", "fn")]).select(F.lit(None).cast("string").alias("kind"), "tp", "fp", "fn")
    return per_type.union(total).select(F.coalesce("kind", F.lit("(all)")).alias("kind"), *_scores(F.col("tp"), F.col("fp"), F.col("fn")))


def relaxed_entity_f1(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """Micro scores and one row per type (Q03); both have (chunk_id, ord, entity_type, surface_form)."""
    return _relaxed(predicted, gold, ["entity_type"], ["surface_form"], "entity_type")


def relation_f1(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """Types of relation and ends exact, both surfaces relaxed (Q04)."""
    return _relaxed(predicted, gold, ["relation_type", "src_type", "dst_type"], ["src_surface", "dst_surface"], "relation_type")


def edge_key(prefix: list[str] = ("chunk_id", "relation_type", "src_type"), surfaces: tuple[str, str] = ("src_surface", "dst_surface")) -> Column:
    """Identity of a relation but for case and white space (Q06)."""
    normal = [F.lower(collapse(F.col(s))) for s in surfaces]
    return F.struct(*prefix, normal[0].alias("src"), "dst_type", normal[1].alias("dst"))


def run_stability(relations: DataFrame, runs: DataFrame) -> DataFrame:
    """Mean Jaccard similarity of the edge sets of all pairs of runs (Q05); two empty runs are alike.

    ``runs`` has run_idx. Shared edges are counted by a join on the edge, sizes by run, so no set is ever gathered.
    """
    edges = relations.select("run_idx", edge_key().alias("key")).distinct()
    sizes = runs.select("run_idx").distinct().join(edges.groupBy("run_idx").agg(F.count("*").alias("n")), "run_idx", "left").fillna(0)
    a, b = edges.select(F.col("run_idx").alias("i"), "key"), edges.select(F.col("run_idx").alias("j"), "key")
    shared = a.join(b, "key").where("i < j").groupBy("i", "j").agg(F.count("*").alias("both"))
    i, j = sizes.select(F.col("run_idx").alias("i"), F.col("n").alias("n_i")), sizes.select(F.col("run_idx").alias("j"), F.col("n").alias("n_j"))
    pairs = i.join(j, F.col("i") < F.col("j")).join(shared, ["i", "j"], "left")
    both = F.coalesce("both", F.lit(0))
    union = F.col("n_i") + F.col("n_j") - both
    mean = pairs.agg(F.round(F.avg(F.when(union == 0, 1.0).otherwise(both / union)), 4).alias("mean_pairwise_jaccard"))
    counts = sizes.agg(F.count("*").alias("num_runs"), F.round(F.avg("n"), 4).alias("count_mean"), F.round(F.var_pop("n"), 4).alias("count_variance"))
    return counts.join(mean).withColumn("instability", F.round(1 - F.col("mean_pairwise_jaccard"), 4))


def cluster_prf(assigned: DataFrame) -> DataFrame:
    """Pairwise scores of (mention, predicted, gold), from counts instead of pairs (Q07)."""
    def pairs(*by: str) -> DataFrame:
        n = F.col("n")
        return assigned.groupBy(*by).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(n * (n - 1) / 2), F.lit(0.0)).cast("long").alias("_".join(by)))

    counts = pairs("predicted", "gold").join(pairs("predicted")).join(pairs("gold"))
    tp = F.col("predicted_gold")
    return counts.select(*_scores(tp, F.col("predicted") - tp, F.col("gold") - tp))


