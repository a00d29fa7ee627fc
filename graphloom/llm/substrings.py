"""Removal of passages that repeat anywhere in the corpus.

Every window of ``WIDTH`` words gets two Rabin-Karp hashes, 96 bits in all: among the 10^13 windows of 100 TB of text one
pair in a thousand such corpora collides. Documents are dealt to chunks; a chunk sorts the hashes of its windows and
sends each distinct one once, packed by hash range, with a bit telling whether it already met it twice. A range counts how often each hash comes and answers every chunk with one bit per hash, in the chunk's own sorted
order, so no position or document number ever travels. The chunk then reads the bits back onto its windows and merges
repeated windows into maximal intervals.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, rolling, second, text_bytes

WIDTH = 35
#: Bytes of text in a chunk, on average, at least.
CHUNK = 8 << 20
#: There are as many ranges as chunks. Chunks grow with the corpus so that one still sends this many hashes to a range.
SENT = 32
WORD_BYTES = 6
#: Partitions of a shuffle at most; beyond that a partition holds several chunks or ranges, one after another.
PARTITIONS = 100_000


def _squeeze(batches):
    """Texts travel compressed; chunks need them twice and nothing in between reads them."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = [pack((x or "").encode("utf-8", "surrogatepass")) for x in batch.column(2).to_pylist()]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], names=["chunk", "doc_id", "packed"])


def window_hashes(packed: list[bytes], width: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Number of words of each text, and the window hashes of all texts one after another, 64 bits and 32 bits of
    each. Words are not kept."""
    unpack = zstandard.ZstdDecompressor().decompress
    known, counts, high, low = WordHashes(), [], [np.empty(0, np.uint64)], [np.empty(0, np.uint32)]
    for x in packed:
        words = known.of(unpack(x).split())
        counts.append(len(words))
        high.append(rolling(words, width))
        low.append(second(words, width))
    return counts, np.concatenate(high), np.concatenate(low)


def _order(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): an order by both hashes, and where in it a new pair begins.

    Sorting by the first is enough unless windows agree in it and not in the second.
    """
    order = np.argsort(high)
    a, b = high[order], low[order]
    same = a[1:] == a[:-1]
    if (b[1:][same] != b[:-1][same]).any():
        order = np.lexsort((low, high))
        a, b = high[order], low[order]
        same = a[1:] == a[:-1]
    first = np.ones(len(order), dtype=bool)
    first[1:] = ~(same & (b[1:] == b[:-1]))
    return order, first


def squeeze_hashes(high: np.ndarray, low: np.ndarray) -> bytes:
    """Ascending hashes as the first, the steps between them in as few bytes as the largest needs, and the second hashes."""
    steps = np.diff(high)
    size = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    body = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size])
    return b"".join((bytes([size]), high[:1].astype("<u8").tobytes(), body.tobytes(), low.astype("<u4").tobytes()))


def stretch_hashes(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = blob[0]
    n = (len(blob) - 9 - 4) // (size + 4) + 1
    steps = np.zeros((n, 8), dtype=np.uint8)
    steps[1:, :size] = np.frombuffer(blob, np.uint8, (n - 1) * size, 9).reshape(-1, size)
    steps[0] = np.frombuffer(blob, np.uint8, 8, 1)
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64), np.frombuffer(blob, "<u4", n, 9 + (n - 1) * size)


@functools.lru_cache(maxsize=2)
def _edges(n: int) -> np.ndarray:
    return np.array([(k << 64) // n for k in range(1, n)], dtype=np.uint64)


def _ranges(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each of n equal hash ranges ends in a sorted array."""
    return np.append(np.searchsorted(hashes, _edges(n), side="left"), len(hashes))


def chunk_count(size: int, chunk: int = CHUNK) -> int:
    """Chunks, and ranges, for so many bytes of text."""
    return max(1, min(-(-size // chunk), math.isqrt(size // (WORD_BYTES * SENT)) + 1))


_SENT = pa.schema([("range", pa.int64()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("twice", pa.binary())])


def _send(width: int, n: int):
    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        _, high, low = window_hashes(table.column("packed").to_pylist(), width)
        order, first = _order(high, low)
        twice = np.diff(np.append(np.flatnonzero(first), len(order))) > 1
        high, low = high[order][first], low[order][first]
        rows, start = [], 0
        for k, end in enumerate(_ranges(high, n).tolist()):
            if end > start:
                rows.append((k, chunk, squeeze_hashes(high[start:end], low[start:end]), np.packbits(twice[start:end]).tobytes()))
            start = end
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, _SENT.types, strict=True)], schema=_SENT)

    return run


_REPLY = pa.schema([("chunk", pa.int64()), ("range", pa.int64()), ("n", pa.int64()), ("repeated", pa.binary())])


def repeats(blobs: list[tuple[np.ndarray, np.ndarray]], twice: list[np.ndarray]) -> list[np.ndarray]:
    """For each sorted list of distinct hashes, which of them another list holds too, or came twice in some list."""
    high, low = (np.concatenate(x) for x in zip(*blobs, strict=True))
    order, first = _order(high, low)
    starts = np.flatnonzero(first)
    many = np.diff(np.append(starts, len(order))) > 1
    many |= np.logical_or.reduceat(np.concatenate(twice)[order], starts)
    high, low = high[order][starts][many], low[order][starts][many]
    # Almost never do two repeated windows agree in the first hash alone.
    runs = np.diff(np.flatnonzero(np.concatenate(([True], high[1:] != high[:-1], [True])))).max() if len(high) else 0
    out = []
    for a, b in blobs:
        hit, at = np.zeros(len(a), dtype=bool), np.searchsorted(high, a)
        for step in range(runs):
            place = np.minimum(at + step, len(high) - 1)
            hit |= (high[place] == a) & (low[place] == b)
        out.append(hit)
    return out


def _count(table: pa.Table) -> pa.Table:
    blobs = [stretch_hashes(x) for x in table.column("hashes").to_pylist()]
    bits = [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(b)).astype(bool) for x, (b, _) in zip(table.column("twice").to_pylist(), blobs, strict=True)]
    replies = [np.packbits(x).tobytes() for x in repeats(blobs, bits)]
    return pa.table([table.column("chunk"), table.column("range"), pa.array([len(b) for b, _ in blobs], pa.int64()), pa.array(replies, pa.binary())], schema=_REPLY)


def intervals(repeated: np.ndarray, n_words: int, width: int) -> np.ndarray:
    """Whether each word lies in a repeated window."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    edge[: len(repeated)] += repeated
    edge[width : width + len(repeated)] -= repeated
    return np.cumsum(edge[:-1]) > 0


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()), ("removed", pa.string())])


def _apply(width: int, digest: bool):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        packed = docs.column("packed").to_pylist()
        counts, high, low = window_hashes(packed, width)
        unpack = zstandard.ZstdDecompressor().decompress
        flags = np.empty(0, bool)
        if replies.num_rows:
            parts = sorted(zip(*(replies.column(c).to_pylist() for c in ("range", "n", "repeated")), strict=True))
            flags = np.concatenate([np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n).astype(bool) for _, n, b in parts])
        order, first = _order(high, low)
        del high, low
        if np.count_nonzero(first) != len(flags):
            raise ValueError(f"{len(flags)} answers to {np.count_nonzero(first)} hashes")
        told = np.empty(len(order), dtype=bool)
        told[order] = flags[np.cumsum(first) - 1] if len(order) else False
        flags = told
        out, start = [], 0
        for doc_id, data, size in zip(docs.column("doc_id").to_pylist(), packed, counts, strict=True):
            n, w = max(0, size - width + 1), unpack(data).split()
            gone = intervals(flags[start : start + n], size, width)
            start += n
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).reshape(-1, 2)
            if len(edges):
                ends = [0, *edges.ravel().tolist(), len(w)]
                kept = [x for a, b in zip(ends[::2], ends[1::2], strict=True) for x in w[a:b]]
            else:
                kept = w
            text = b" ".join(kept)
            out.append((doc_id, len(w), len(w) - len(kept), hashlib.sha256(text).hexdigest().encode() if digest else text, ",".join(f"{a}:{b}" for a, b in edges.tolist())))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, _KEPT.types, strict=True)], schema=_KEPT)

    return run


def remove_repeats(docs: DataFrame, width: int = WIDTH, chunk: int = CHUNK, digest: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words left, joined by one space), removed
    (intervals of word positions, end exclusive, ``start:end`` joined by commas).

    With ``digest``, kept is the lowercase hex SHA-256 of that text. A window counts as repeated if its word sequence
    starts anywhere else, in the same document too, judged on the input. Null and blank text have no words; texts
    shorter than a window lose nothing; repeated rows are each other's copies and lose all windows; a null doc_id
    is kept; an empty table gives no rows; columns beyond doc_id and text are ignored.

    Two different windows count as equal if all 96 bits of their hashes agree. Rows are dealt to chunks by their place in
    the input, not by what they hold, so however many rows repeat, chunks are of one size.
    """
    n = chunk_count(text_bytes(docs), chunk)
    parts = min(n, PARTITIONS)
    dealt = docs.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).alias("chunk"), F.col("doc_id").cast("long"), "text")
    packed = dealt.mapInArrow(_squeeze, "chunk long, doc_id long, packed binary").repartition(parts, "chunk")
    sent = packed.groupBy("chunk").applyInArrow(_send(width, n), "range long, chunk long, hashes binary, twice binary").repartition(parts, "range")
    replies = sent.groupBy("range").applyInArrow(_count, "chunk long, range long, n long, repeated binary")
    kept = packed.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_apply(width, digest), "doc_id long, n_words long, n_removed long, kept binary, removed string")
    return kept.withColumn("kept", F.col("kept").cast("string"))
