"""Document quality by hierarchical empirical Bayes.

A logistic classifier on the words of a text and its make-up gives each document log odds of being good. Hosts and the
paths below them have rates of their own, from labelled documents: a host's posterior is shrunk toward the global rate,
a path's toward its host, the stronger the fewer labels there are and the less the groups of that level differ (the
prior strength is the method-of-moments estimate of a beta distribution); sites without labels have the rate of the
level above. Text and site are separate evidence, each counted once: the posterior odds are those of the text times
those of the path against the global rate.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, materialize

#: Labelled documents used for fitting, at most about so many (each kept by a digest of its id).
FIT = 6000
KEEP = 0.5
#: Words and their shapes fall into so many classes each.
HASHED = 256
STATISTICS = 11
FEATURES = STATISTICS + 2 * HASHED
#: Letters, digits and the rest by class; white space never occurs in a word.
_SHAPES = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUNS = re.compile(rb"(.)\1+", re.DOTALL)


class WordClasses(WordHashes):
    """The class of a word and that of its shape (what kinds of characters follow each other), as one number."""

    def __missing__(self, word: bytes) -> int:
        own = super().__missing__(word)
        shape = xxhash.xxh64_intdigest(_RUNS.sub(rb"\1", word.translate(_SHAPES)))
        value = self[word] = own % HASHED * HASHED + shape % HASHED
        return value


def features(text: str, known: WordClasses) -> np.ndarray:
    """Statistics of a whole text, each bounded, then the shares of its words in each class and each class of shapes."""
    data = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    n, words, lines = max(1, len(data)), data.split(), data.split(b"\n")
    m = max(1, len(words))
    upper, lower, digits = counts[65:91].sum(), counts[97:123].sum() + counts[128:].sum(), counts[48:58].sum()
    space = counts[9:14].sum() + counts[32]
    out = np.zeros(FEATURES, dtype=np.float32)
    out[:STATISTICS] = (
        1.0, min(np.log1p(m) / 10, 2), upper / max(1, upper + lower), digits / n, space / n, (len(data) - upper - lower - digits - space) / n, len(set(words)) / m, sum(a == b for a, b in zip(words, words[1:])) / m,
        min(len(data) / m, 30) / 10, min(len(lines) / m, 1), (len(lines) - len(set(lines))) / len(lines),
    )
    if words:
        classes = known.of(words).astype(np.int64)
        out[STATISTICS : STATISTICS + HASHED] = np.bincount(classes // HASHED, minlength=HASHED) / m
        out[STATISTICS + HASHED :] = np.bincount(classes % HASHED, minlength=HASHED) / m
    return out


def _measure(batches):
    known = WordClasses()
    for batch in batches:
        rows = [features(x or "", known).tobytes() for x in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(rows, pa.binary())], names=["doc_id", "features"])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 3e-3, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, centre, scale) of a ridge logistic regression by Newton's method; all zero without both classes."""
    if not len(y) or y.min() == y.max():
        weights = np.zeros(FEATURES)
        if len(y):
            weights[0] = 4.0 if y[0] else -4.0
        return weights, np.zeros(FEATURES), np.ones(FEATURES)
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    centre[0], scale[0] = 0, 1
    z = (x - centre) / scale
    w = np.zeros(FEATURES)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge * np.eye(FEATURES)
        step = np.linalg.solve(hess, z.T @ (p - y) / len(y) + ridge * w)
        w -= step * min(1.0, 3 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w, centre, scale


def _score(model):
    weights, centre, scale = model

    def run(batches):
        known = WordClasses()
        for batch in batches:
            texts, parts = batch.column(3).to_pylist(), [np.empty(0)]
            for at in range(0, len(texts), 256):
                x = np.array([features(t or "", known) for t in texts[at : at + 256]]).reshape(-1, FEATURES)
                parts.append(np.clip((x - centre) / scale @ weights, -12, 12))
            logit = np.concatenate(parts)
            yield pa.record_batch([*(batch.column(k) for k in range(3)), pa.array(logit)], names=["doc_id", "host", "path", "evidence"])

    return run


def strength(mean: Column, n: Column, group_mean: Column) -> Column:
    """Pseudo-documents of the prior: m (1 - m) / variance - 1, variance of group means beyond that of sampling."""
    noise = F.avg(mean * (1 - mean) / n)
    spread = F.greatest(F.avg(F.pow(group_mean - mean, 2)) - noise, F.lit(1e-4))
    return F.least(F.greatest(F.avg(mean * (1 - mean)) / spread - 1, F.lit(1.0)), F.lit(1000.0))


def _logit(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.ln(safe / (1 - safe))


def site_rates(sites: DataFrame) -> tuple[float, DataFrame, DataFrame]:
    """(global rate, (host, host_rate), (host, path, path_rate)) of (host, path, quality), one row per labelled document.

    One half where nothing is labelled.
    """
    paths = materialize(sites.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("quality").alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    total = hosts.agg((F.sum("host_good") / F.sum("host_n")).alias("rate")).first()["rate"]
    total = 0.5 if total is None else float(total)
    one = F.lit(total)
    host_k = hosts.agg(strength(one, F.col("host_n"), F.col("host_good") / F.col("host_n")).alias("k")).first()["k"] or 1.0
    hosts = hosts.withColumn("host_rate", (F.col("host_good") + host_k * one) / (F.col("host_n") + host_k)).select("host", "host_rate")
    paths = paths.alias("p").join(hosts.alias("h"), F.col("p.host").eqNullSafe(F.col("h.host"))).select("p.host", "path", "n", "good", "host_rate")
    path_k = paths.agg(strength(F.col("host_rate"), F.col("n"), F.col("good") / F.col("n")).alias("k")).first()["k"] or 1.0
    return total, hosts, paths.select("host", "path", ((F.col("good") + path_k * F.col("host_rate")) / (F.col("n") + path_k)).alias("path_rate"))


def score_quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", keep: float = KEEP, fit_rows: int = FIT) -> DataFrame:
    """One row per document: doc_id, evidence (log odds of its text), host_rate, path_rate, quality, keep.

    ``labels`` has (doc_id, quality 0 or 1); rows without either, or without a document, are ignored. Null text counts
    as empty, null hosts and paths are groups of their own, repeated rows count as often as they come; without
    labels of both classes the text says nothing or always the same; an empty table gives no rows. Columns beyond
    doc_id, text, host and path are ignored.

    The classifier is fitted to a bounded sample of labelled rows; site rates come from all labels, and every document
    is scored. Groups meet documents in joins on host and path after partial aggregation, never in one task.
    """
    known = materialize(labels.where("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("int").alias("quality")).distinct(), "labels")
    share = min(1.0, fit_rows / max(1, known.count()))
    some = materialize(known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30) < share), "labelled")
    # Counted, the sample is known to be small, and texts need not be shuffled to meet it.
    chosen = F.broadcast(some) if some.count() <= 4 * fit_rows else some
    rows = docs.select("doc_id", "text").join(chosen, "doc_id", "left_semi").mapInArrow(_measure, "doc_id long, features binary").join(chosen, "doc_id").select("features", "quality").collect()
    model = fit(np.array([np.frombuffer(r[0], np.float32) for r in rows], dtype=np.float64).reshape(-1, FEATURES), np.array([r[1] for r in rows], dtype=np.float64))

    site = [F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path")]
    total, hosts, paths = site_rates(docs.select("doc_id", *site).join(known, "doc_id").select("host", "path", "quality"))
    scored = docs.select(F.col("doc_id").cast("long"), *site, "text").mapInArrow(_score(model), "doc_id long, host string, path string, evidence double")
    scored = scored.alias("d").join(hosts.alias("h"), F.col("d.host").eqNullSafe(F.col("h.host")), "left")
    scored = scored.join(paths.alias("p"), F.col("d.host").eqNullSafe(F.col("p.host")) & F.col("d.path").eqNullSafe(F.col("p.path")), "left")
    host_rate = F.coalesce("host_rate", F.lit(total))
    path_rate = F.coalesce("path_rate", host_rate)
    quality = 1 / (1 + F.exp(-(F.col("evidence") + _logit(path_rate) - _logit(F.lit(total)))))
    return scored.select("doc_id", "evidence", host_rate.alias("host_rate"), path_rate.alias("path_rate"), quality.alias("quality"), (quality >= keep).alias("keep"))
