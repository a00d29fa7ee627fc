"""Language identification with hyperdimensional profiles.

Every letter has a random bipolar vector. A trigram binds its letters, the first two permuted (rolled) by their
place; a text bundles (adds up) its trigrams, a language the texts it was learned from. Prediction is the language
prototype of the largest cosine.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM = 1024
#: Letters share so many item vectors; those below 1024 (Latin, Greek, Cyrillic in part) have one each.
ITEMS = 4096
#: Expected number of learning documents per language at most; larger languages are sampled by a digest of the id.
LEARN = 4000
#: Partial prototypes are gathered from so many tasks.
LEARN_TASKS = 16
#: Trigrams whose vectors a worker remembers.
REMEMBERED = 40_000
#: Characters whose trigrams are counted at once.
SLICE = 1 << 20


@functools.cache
def _letters() -> np.ndarray:
    """Item number of each code point; 0 for all that is no letter."""
    out = np.zeros(0x110000, dtype=np.int64)
    for code in range(0x110000):
        if chr(code).isalpha():
            out[code] = code if code < 1024 else 1024 + (code * 0x9E3779B1 >> 7) % (ITEMS - 1024)
    return out


@functools.cache
def _items() -> np.ndarray:
    return np.random.default_rng(20).choice(np.array([-1, 1], dtype=np.int8), size=(ITEMS, DIM))


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter trigrams of a text and their counts: case folded, with one blank before, after and for each run of
    other characters."""
    parts, before = [np.zeros(1, dtype=np.int64)], 0
    for at in range(0, len(text), SLICE):
        codes = np.frombuffer(text[at : at + SLICE].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        items = _letters()[np.minimum(codes, 0x10FFFF)]
        parts.append(items[(items != 0) | (np.concatenate(([before], items[:-1])) != 0)])
        before = items[-1]
    items = np.concatenate(parts if before == 0 and len(parts) > 1 else [*parts, parts[0]])
    found = []
    for at in range(0, len(items) - 2, SLICE):
        part = items[at : at + SLICE + 2]
        found.append(np.unique((part[:-2] * ITEMS + part[1:-1]) * ITEMS + part[2:], return_counts=True))
    if not found or len(items) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if len(found) == 1:
        return found[0]
    keys, where = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return keys, np.bincount(where, weights=np.concatenate([c for _, c in found])).astype(np.int64)


class Vectors:
    """Vectors of trigrams, made when first met."""

    def __init__(self):
        self.rows = np.empty((1024, DIM), dtype=np.int8)
        self.keys = np.empty(0, dtype=np.int64)  # sorted
        self.at = np.empty(0, dtype=np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """keys: sorted, distinct."""
        missing = np.setdiff1d(keys, self.keys, assume_unique=True)
        if len(missing):
            if len(self.keys) + len(missing) > REMEMBERED:
                self.__init__()
                missing = keys
            first, need = len(self.keys), len(self.keys) + len(missing)
            if need > len(self.rows):
                self.rows = np.concatenate([self.rows, np.empty((max(need, 2 * len(self.rows)) - len(self.rows), DIM), np.int8)])
            a, b, c = missing // (ITEMS * ITEMS), missing // ITEMS % ITEMS, missing % ITEMS
            items = _items()
            self.rows[first:need] = np.roll(items[a], 2, axis=1) * np.roll(items[b], 1, axis=1) * items[c]
            keys_, at = np.concatenate([self.keys, missing]), np.concatenate([self.at, np.arange(first, need)])
            order = np.argsort(keys_, kind="stable")
            self.keys, self.at = keys_[order], at[order]
        return self.rows[self.at[np.searchsorted(self.keys, keys)]]


def bundles(texts: list[str], vectors: Vectors) -> np.ndarray:
    """[texts, DIM] sums of trigram vectors; a row of zeros for a text without letters."""
    return _bundled([trigrams(x) for x in texts], vectors)


def _bundled(found: list[tuple[np.ndarray, np.ndarray]], vectors: Vectors) -> np.ndarray:
    out = np.zeros((len(found), DIM), dtype=np.float64)
    for at in range(0, len(found), 64):
        part = found[at : at + 64]
        keys = np.unique(np.concatenate([k for k, _ in part]))
        for low in range(0, len(keys), REMEMBERED // 4):
            some = keys[low : low + REMEMBERED // 4]
            counts = np.zeros((len(part), len(some)), dtype=np.float32)
            for row, (k, c) in enumerate(part):
                mine = (k >= some[0]) & (k <= some[-1])
                counts[row, np.searchsorted(some, k[mine])] = c[mine]
            out[at : at + 64] += counts @ vectors.of(some).astype(np.float32)
    return out


def remainder(doc_id, modulus: int = 4):
    """crc32 of the id as text, modulo; ids that are null are never held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def _partials(batches):
    vectors, sums = Vectors(), {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for at in range(0, len(texts), 64):
            rows = bundles([x or "" for x in texts[at : at + 64]], vectors)
            norms = np.linalg.norm(rows, axis=1, keepdims=True)
            rows = rows / np.where(norms > 0, norms, 1)
            for lang, row in zip(langs[at : at + 64], rows, strict=True):
                sums[lang] = sums.get(lang, 0) + row
    yield pa.record_batch([pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["lang", "bundle"])


def learn(docs: DataFrame, per_language: int = LEARN) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes from rows (doc_id, text, lang), lang not null.

    At most about ``per_language`` documents of a language are used (each kept with the chance that makes it so, by
    a digest of its id); the driver gets one bundle per language and task, whatever the size of the input.
    """
    known = docs.where("lang is not null")
    counts = known.groupBy("lang").count().collect()  # as many rows as prototypes
    if not counts:
        return [], np.zeros((0, DIM))
    share = F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, per_language / r["count"]))]), F.col("lang"))
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(draw < share).select("text", "lang")
    sums: dict[str, np.ndarray] = {}
    for lang, bundle in sample.repartition(LEARN_TASKS).mapInArrow(_partials, "lang string, bundle binary").collect():
        sums[lang] = sums.get(lang, 0) + np.frombuffer(bundle)
    langs = sorted(k for k, v in sums.items() if np.any(v))
    if not langs:
        return [], np.zeros((0, DIM))
    rows = np.array([sums[x] for x in langs])
    return langs, rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _predict(langs: list[str], prototypes: np.ndarray):
    def run(batches):
        vectors = Vectors()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            names, scores = [], []
            for at in range(0, len(texts), 64):
                rows = bundles([x or "" for x in texts[at : at + 64]], vectors)
                norms = np.linalg.norm(rows, axis=1)
                cosines = rows @ prototypes.T / np.where(norms > 0, norms, 1)[:, None] if langs else np.zeros((len(rows), 1))
                best = cosines.argmax(axis=1)
                blank = (norms == 0) | (not langs)
                names += ["und" if b else langs[k] for k, b in zip(best, blank, strict=True)]
                scores += np.where(blank, 0, np.clip(cosines[np.arange(len(rows)), best], 0, 1)).tolist()
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, per_language: int = LEARN) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (cosine with the prototype, 0 to 1).

    Learns from the rows that are not held out and have a lang. A text that is null or has no letter gives ``und``
    with score 0, as does everything if no language can be learned; equal cosines go to the first language by name;
    repeated rows count as often as they come; an empty table gives no rows. Columns beyond doc_id, text and lang
    are ignored, and lang never enters a prediction.
    """
    held = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    langs, prototypes = learn(docs.where(~held).select("doc_id", "text", "lang"), per_language)
    rows = docs.select(F.col("doc_id").cast("long"), "text", held.alias("held_out"))
    return rows.mapInArrow(_predict(langs, prototypes), "doc_id long, held_out boolean, lang_pred string, score double")


#: A text of FULL trigrams or more is in a learned language if its cosine is at least KNOWN; of shorter ones less is
#: asked, in proportion. Measured: README.
KNOWN, FULL = 0.18, 100


def _keep(langs: list[str], prototypes: np.ndarray, threshold: float, text_at: int):
    def run(batches):
        vectors = Vectors()
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            keep = []
            for at in range(0, len(texts), 64):
                found = [trigrams(x or "") for x in texts[at : at + 64]]
                rows, n = _bundled(found, vectors), np.array([c.sum() for _, c in found])
                norms = np.linalg.norm(rows, axis=1)
                best = (rows @ prototypes.T).max(axis=1) if langs else np.zeros(len(rows))
                keep += ((norms > 0) & (best >= threshold * np.minimum(1, n / FULL) * norms)).tolist()
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def keep_identified(docs: DataFrame, threshold: float = KNOWN, per_language: int = LEARN) -> DataFrame:
    """The rows whose text is in a language that was learned: some letter, and a cosine of at least ``threshold`` (for
    texts of fewer than FULL trigrams of as much less as they are shorter).

    Null texts and those without a letter go, as do all if no language can be learned and the threshold is positive;
    null ids and repeated rows are judged like any other; an empty table gives no rows; columns stay as they are.
    """
    held = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False))
    langs, prototypes = learn(docs.where(~held).select("doc_id", "text", "lang"), per_language)
    return docs.mapInArrow(_keep(langs, prototypes, threshold, docs.columns.index("text")), docs.schema)
