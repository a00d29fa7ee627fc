"""Document fingerprints by improved consistent weighted sampling.

Terms are word shingles, weighted by how often they come. For sample k a term of weight w draws r, c ~ Gamma(2, 1) and
b ~ U(0, 1), fixed by term and k; t = floor(ln w / r + b) and ln a = ln c - r (t - b) - r. The term of least a is the
sample; two documents have the same (term, t) with a probability equal to their generalised Jaccard similarity.

The draws are made backwards. At weight 1, t is 0 and a = c exp(-r (1 - b)) is Exp(1). Given a, exp(r (1 - b)) - 1 is
Exp(1) / a, and r b is Exp(1) on its own. So a is drawn first, and for a term that comes once nothing else is
needed: the least a is the least of the uniform numbers behind it. Only repeated terms draw the rest.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, mix, rolling, text_bytes, wrapping

SHINGLE = 5
SAMPLES = 64
#: Bytes of text in a range of documents, on average, and ranges at most.
RANGE = 8 << 20
RANGES = 100_000
#: Terms that are drawn for at once.
_BLOCK = 1024
_TURN, _SPREAD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
with wrapping():
    _SEEDS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _SPREAD)[:, None]


def singles(hashes: np.ndarray) -> np.ndarray:
    """[SAMPLES, terms] 64 random bits of each sample and term, from the whole hash of the term."""
    with wrapping():
        x = hashes[None, :] ^ _SEEDS
        x *= _TURN
        x ^= x >> np.uint64(32)
        x *= _TURN
        x ^= x >> np.uint64(29)
        return x


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _exponential(bits: np.ndarray) -> np.ndarray:
    return -np.log1p(-_uniform(bits))


def draws(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a at weight 1, r, ln c, b), each [SAMPLES, terms]."""
    bits = singles(hashes)
    with wrapping():
        second, third = mix(bits + _SPREAD), mix(bits + _SPREAD * np.uint64(2))
    a, rest = _exponential(bits), _exponential(third)
    grown = 1 + _exponential(second) / a
    r = np.log(grown) + rest
    return a, r, np.log(a * grown), rest / r


def weighted(hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ln a, t) of each sample and term."""
    _, r, ln_c, b = draws(hashes)
    t = np.floor(np.log(weights) / r + b)
    return ln_c - r * (t - b) - r, t.astype(np.int64)


def terms(text: bytes, known: WordHashes, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and weights of the shingles of a text; a text of fewer words is one term, one without words has none."""
    words = known.of(text.lower().split())
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.sort(rolling(words, min(width, len(words))))
    first = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    at = np.flatnonzero(first)
    return hashes[at], np.diff(np.append(at, len(hashes)))


def shortened(hashes: np.ndarray, t: np.ndarray) -> np.ndarray:
    """16 bits of each sample (term, t)."""
    with wrapping():
        return (mix(hashes ^ mix(t.astype(np.uint64))) >> np.uint64(48)).astype(np.uint16)


def signature(text: bytes, known: WordHashes) -> np.ndarray:
    """SAMPLES numbers that stand for the samples; none for a text without words."""
    hashes, weights = terms(text, known)
    if not len(hashes):
        return np.empty(0, np.uint16)
    each = np.arange(SAMPLES)
    least, won, steps = np.full(SAMPLES, np.inf), np.zeros(SAMPLES, np.uint64), np.zeros(SAMPLES, np.int64)
    once, more = hashes[weights == 1], np.flatnonzero(weights > 1)
    if len(once):
        bits = np.full(SAMPLES, 2**64 - 1, dtype=np.uint64)
        for at in range(0, len(once), _BLOCK):
            part = once[at : at + _BLOCK]
            drawn = singles(part)
            best = drawn.argmin(axis=1)
            found = drawn[each, best]
            less = found <= bits
            bits, won = np.where(less, found, bits), np.where(less, part[best], won)
        least = np.log(_exponential(bits))
    for at in range(0, len(more), _BLOCK):
        part = more[at : at + _BLOCK]
        values, t = weighted(hashes[part], weights[part])
        best = values.argmin(axis=1)
        found = values[each, best]
        less = found < least
        least, won, steps = np.where(less, found, least), np.where(less, hashes[part[best]], won), np.where(less, t[each, best], steps)
    return shortened(won, steps)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float(np.mean(a == b))


def digest(sig: np.ndarray) -> str:
    """The signature as hex, 4 digits a sample; zeros for a text without words."""
    return sig.astype(">u2").tobytes().hex() if len(sig) else "0" * (4 * SAMPLES)


def edited(text: str, following: str) -> str:
    """The last half of a text replaced by as much of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _numbers(x) -> np.ndarray:
    return x.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def _ranged(bounds: np.ndarray):
    def run(batches):
        for batch in batches:
            ids = _numbers(batch.column(0))
            yield pa.record_batch([pa.array(ids), pa.array(np.searchsorted(bounds, ids, side="right").astype(np.int32))], names=["id", "range"])

    return run


def _deal(bounds: np.ndarray, firsts: dict[int, int]):
    """Each row to its range; the first row of a range also, as a guest, to the range before."""
    before, order = {}, sorted(firsts)
    for k, r in enumerate(order):
        before.setdefault(firsts[r], []).append((order[k - 1], 1 if k else 2))

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            ids = _numbers(batch.column(0))
            home = np.searchsorted(bounds, ids, side="right").tolist()
            rows = []
            for key, doc_id, r, text in zip(ids.tolist(), batch.column(0).to_pylist(), home, batch.column(1).to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                tie, data = xxhash.xxh64_intdigest(data) - 2**63, pack(data)
                rows.append((r, 0, key, tie, doc_id, data))
                rows += [(to, guest, key, tie, doc_id, data) for to, guest in before.get(key, ())]
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, types, strict=True)], names=["range", "guest", "key", "tie", "doc_id", "packed"])

    return run


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())


def _walk(batches):
    unpack, known = zstandard.ZstdDecompressor().decompress, WordHashes()
    last = None  # range, doc_id, text, signature of the row before
    for batch in batches:
        out = []
        for r, guest, doc_id, data in zip(*(batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "packed")), strict=True):
            if guest and (last is None or last[0] != r):
                continue  # a further copy of the first row
            text = unpack(data).decode("utf-8", "surrogatepass")
            sig = signature(text.encode("utf-8", "surrogatepass"), known)
            if last is not None and last[0] == r:
                _, own, body, old = last
                changed = edited(body, text)
                raw = changed.encode("utf-8", "surrogatepass")
                new = signature(raw, known)
                out.append((own, len(body), hashlib.sha256(raw).hexdigest(), digest(old), digest(new), likeness(old, new), likeness(old, sig)))
            last = None if guest else (r, doc_id, text, sig)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 7, _TYPES, strict=True)], names=[x.split()[0] for x in _OUT.split(", ")])


def fingerprint(docs: DataFrame, size: int = RANGE) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null text counts as empty; a text without words has fingerprint zero, which is like itself (1) and unlike
    any other (0). The next document is the one of the next higher doc_id (null is lowest; equal ids go by a digest
    of the text), after the last one the first, which may be the document itself. An empty table gives no rows;
    columns beyond doc_id and text are ignored.

    Documents go to ranges of ids whose bounds are quantiles; each range is one sorted partition, read as a stream,
    and a guest row brings it the first document of the next.
    """
    n = min(RANGES, max(1, -(-text_bytes(docs) // size)))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    cuts = ids.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], 10 * n)).first()[0] if n > 1 else []
    bounds = np.array(sorted(set(cuts or [])), dtype=np.int64)
    firsts = {r: first for r, first in ids.mapInArrow(_ranged(bounds), "id long, range int").groupBy("range").agg(F.min("id")).collect()}
    dealt = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_deal(bounds, firsts), "range int, guest int, key long, tie long, doc_id long, packed binary")
    placed = dealt.repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions("range", "guest", "key", "tie")
    return placed.select("range", "guest", "doc_id", "packed").mapInArrow(_walk, _OUT)
