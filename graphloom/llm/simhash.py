"""SimHash near-duplicates: 64-bit fingerprints compared bit-sliced.

Fingerprints within radius 2 agree on at least two of four 16-bit blocks, so each distinct fingerprint is filed under
its six pairs of blocks and only fingerprints of one file meet. A file is laid out vertically: plane b holds bit b of
64 fingerprints in one machine word, so one XOR compares one bit of 64 candidates, distances accumulate in bitwise
carry-save counters, and a block of 64 is abandoned once all its candidates exceed the radius.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import components
from .common import digits, materialize

SHINGLE = 3
RADIUS = 2
BLOCKS = 4
#: Files of more fingerprints than this are split into pairs of chunks, each its own unit of work.
FILE = 16_384
#: So many (fingerprint, block) comparisons are held at once.
HELD = 1 << 20


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, as a signed long; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= width:
        hashes = [xxhash.xxh64_digest(b" ".join(words), 42)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        digest = xxhash.xxh64_digest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[: -width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)]
    rows = np.frombuffer(b"".join(hashes), dtype=np.uint8).reshape(-1, 8)
    counts = sum(np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64) for part in np.array_split(rows, -(-len(rows) // 65536)))
    return int(np.packbits(2 * counts > len(rows)).view(">i8")[0])


def _fingerprints(batches):
    for batch in batches:
        values = [fingerprint(x or "") for x in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(values, pa.int64())], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every document; null text counts as empty."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def planes(fps: np.ndarray) -> np.ndarray:
    """[64, words]: bit b of fingerprint i stands in plane b, word i // 64, bit i % 64."""
    lanes = np.zeros(-(-len(fps) // 64) * 64, dtype="<u8")
    lanes[: len(fps)] = fps
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def within(vertical: np.ndarray, fps: np.ndarray, rows: np.ndarray, words: np.ndarray, lanes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compare fingerprint rows[x] with the lanes of block words[x]; returns what is left of (rows, words, lanes).

    lanes has a bit for each candidate that counts; a bit stays where the distance is at most radius.
    """
    digits_ = max(1, radius.bit_length())
    first = (1 << digits_) - 1 - radius  # so that the counter overflows at radius + 1
    ones = np.uint64(2**64 - 1)
    counters = [np.full(len(rows), ones if first >> k & 1 else 0, dtype=np.uint64) for k in range(digits_)]
    query = fps[rows]
    for b in range(64):
        flip = np.uint64(0) - (query >> np.uint64(b) & np.uint64(1))
        carry = vertical[b][words] ^ flip
        for k in range(digits_):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        lanes = lanes & ~carry
        if b % 8 == 7:
            alive = np.flatnonzero(lanes)
            if len(alive) < 0.75 * len(lanes):
                rows, words, lanes, query = rows[alive], words[alive], lanes[alive], query[alive]
                counters = [c[alive] for c in counters]
            if not len(rows):
                break
    alive = lanes != 0
    return rows[alive], words[alive], lanes[alive]


def _roots(n: int, pairs) -> np.ndarray:
    """Least linked index of each of n items, from an iterable of pair arrays."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
    return root


def linked(fps: np.ndarray, starts: np.ndarray, side: np.ndarray | None = None, radius: int = RADIUS) -> np.ndarray:
    """Root of each fingerprint among those of its own run (runs begin at ``starts``).

    With ``side``, only pairs of unlike sides are compared. Links are folded into a forest block by block and
    never listed.
    """
    n = len(fps)
    vertical = planes(fps)
    sides = None if side is None else planes(side.astype(np.uint64))[0]
    ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))

    def pairs():
        every = np.arange(n)
        for k in itertools.count():
            rows = every[(every + 1 < ends[every]) & ((every + 1) // 64 + k <= (ends[every] - 1) // 64)]
            if not len(rows):
                return
            every = rows
            for at in range(0, len(rows), HELD):
                r = rows[at : at + HELD]
                w = (r + 1) // 64 + k
                low = np.maximum(r + 1 - 64 * w, 0).astype(np.uint64)
                high = np.minimum(ends[r] - 64 * w, 64)
                ones = np.uint64(2**64 - 1)
                lanes = (ones << low) & (ones >> (64 - high).astype(np.uint64))
                if sides is not None:
                    lanes &= sides[w] ^ (np.uint64(0) - side[r].astype(np.uint64))
                r, w, lanes = within(vertical, fps, r, w, lanes, radius)
                for cut in range(0, len(r), 1 << 16):
                    bits = np.unpackbits(lanes[cut : cut + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                    x, lane = np.nonzero(bits)
                    yield r[cut + x], 64 * w[cut + x] + lane

    return _roots(n, pairs())


def _compare(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def solve(key, unit, side, fp):
        change = np.flatnonzero((key[1:] != key[:-1]) | (unit[1:] != unit[:-1])) + 1
        starts = np.concatenate(([0], change))
        size = np.diff(np.append(starts, len(fp)))
        keep = np.repeat(size > 1, size)
        if not keep.any():
            return pa.record_batch([pa.array([], pa.int64())] * 2, schema=schema)
        size = size[size > 1]
        starts = np.concatenate(([0], np.cumsum(size)[:-1]))
        fp, side = fp[keep], side[keep]
        crossed = side.any()
        root = linked(fp.astype(np.uint64), starts, side if crossed else None, radius)
        moved = np.flatnonzero(root != np.arange(len(fp)))
        return pa.record_batch([pa.array(fp[moved]), pa.array(fp[root[moved]])], schema=schema)

    def run(batches):
        held = None
        for batch in batches:
            key, unit, side, fp = (batch.column(i).to_numpy() for i in range(4))
            if held is not None:
                key, unit, side, fp = (np.concatenate(x) for x in zip(held, (key, unit, side, fp), strict=True))
            # Units with sides (chunk i against chunk j) and plain ones are solved apart.
            last = np.flatnonzero((key[1:] != key[:-1]) | (unit[1:] != unit[:-1]))
            if not len(last):
                held = key, unit, side, fp
                continue
            end = last[-1] + 1
            yield from parts(key[:end], unit[:end], side[:end], fp[:end])
            held = key[end:], unit[end:], side[end:], fp[end:]
        if held is not None:
            yield from parts(*held)

    def parts(key, unit, side, fp):
        two = unit % 2 == 1
        for of in (two, ~two):
            if of.any():
                yield solve(key[of], unit[of], side[of], fp[of])

    return run


def block_keys(fp: Column) -> Column:
    """The six pairs of 16-bit blocks of a fingerprint, each a long: which pair, then the 32 bits."""
    width = 64 // BLOCKS
    block = [F.shiftrightunsigned(fp, width * k).bitwiseAND(F.lit((1 << width) - 1)) for k in range(BLOCKS)]
    return F.array(*[F.lit(n << 32) + F.shiftleft(block[i], width) + block[j] for n, (i, j) in enumerate(itertools.combinations(range(BLOCKS), 2))])


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS, file: int = FILE) -> DataFrame:
    """Links (a, b) that span the components of a table of distinct fingerprints (column fp) under the radius.

    A file of more than ``file`` fingerprints is cut into c chunks, and each pair of chunks is compared on its own,
    so no task meets an unbounded file and no pair is lost.
    """
    if radius > BLOCKS - 2:
        raise ValueError(f"two of {BLOCKS} equal blocks are certain up to a radius of {BLOCKS - 2}")
    filed = distinct.select("fp", F.explode(block_keys(F.col("fp"))).alias("key"))
    large = filed.groupBy("key").count().where(F.col("count") > file).select("key", F.ceil(F.col("count") / file).cast("int").alias("chunks"))
    filed = filed.join(large, "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    # unit 2 * (i * chunks + j) of chunks i <= j, odd where i < j; side tells which of the two a row is in.
    unit = F.when(F.col("chunks") == 1, F.array(F.struct(F.lit(0).cast("long").alias("unit"), F.lit(0).alias("side")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("chunks") - 1),
            lambda other: F.struct(
                (2 * (F.least(other, own).cast("long") * F.col("chunks") + F.greatest(other, own)) + F.when(other == own, 0).otherwise(1)).alias("unit"),
                F.when(own > other, 1).otherwise(0).alias("side"),
            ),
        )
    )
    units = filed.select("key", "fp", F.inline(unit))
    return units.repartition("key", "unit").sortWithinPartitions("key", "unit").select("key", "unit", "side", "fp").mapInArrow(_compare(radius), "a long, b long").distinct()


def _classes(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, first, root) of each distinct fingerprint of (doc_id, fp): its least doc_id and the component it is in."""
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(fingerprint_links(least.select("fp"), radius), "a", "b")
    return least.join(roots, least["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the least doc_id reachable).

    Null and blank text have fingerprint zero and link like any other. Equal texts share a fingerprint and meet as
    one; a null doc_id is kept in the result but never names a component others could prefer (if nothing else is
    there the component is null). Repeated rows yield repeated rows; an empty table yields none; columns beyond
    doc_id and text are ignored.
    """
    marked = materialize(fingerprints(docs), "simhash")
    classes = _classes(marked, radius)
    named = classes.join(classes.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", digits(F.col("fp")).alias("fingerprint"), "component_id")


def _with_fingerprint(text_at: int):
    def run(batches):
        for batch in batches:
            values = [fingerprint(x or "") for x in batch.column(text_at).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(values, pa.int64())], names=[*batch.schema.names, "__fp"])

    return run


def drop_near_copies(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each group of documents: the one of the least doc_id that is not null, and of the least fingerprint
    where several texts share it. The columns of docs stay as they are.

    Null and blank texts are one group; a row that repeats stays once; of a group without any id one row stays. An
    empty table yields no rows; columns beyond doc_id and text are carried along and decide between rows that agree
    in both.

    What goes is a written table of known size: where it is small enough to broadcast, texts need no shuffle. Only
    rows whose id is null or repeats are looked at again, text by text.
    """
    marked = materialize(fingerprints(docs), "simhash")
    classes = _classes(marked, radius)
    place = F.struct(F.col("first").isNull().alias("none"), "first", "fp")
    keepers = classes.groupBy("root").agg(F.min(place).alias("keeper")).select(F.col("keeper.first").alias("keeper_id"), F.col("keeper.fp").alias("keeper_fp"))
    keepers = materialize(keepers, "keepers")
    again = materialize(marked.groupBy("doc_id").count().where("doc_id is null or count > 1").select("doc_id"), "again")
    stays = F.col("doc_id").eqNullSafe(F.col("keeper_id")) & (F.col("fp") == F.col("keeper_fp"))
    gone = marked.join(keepers, stays, "left_anti").select("doc_id").union(again).distinct()
    own = docs.where("doc_id is not null").join(materialize(gone, "copies"), "doc_id", "left_anti").select(*docs.columns)
    if again.isEmpty():
        return own
    schema = T.StructType([*docs.schema.fields, T.StructField("__fp", T.LongType())])
    same = F.col("d.doc_id").eqNullSafe(F.col("a.doc_id"))
    twice = docs.alias("d").join(again.alias("a"), same, "left_semi").mapInArrow(_with_fingerprint(docs.columns.index("text")), schema)
    twice = twice.join(keepers, F.col("doc_id").eqNullSafe(F.col("keeper_id")) & (F.col("__fp") == F.col("keeper_fp")), "left_semi")
    one = twice.groupBy("doc_id", "__fp").agg(F.min(F.struct(*docs.columns)).alias("__row"))
    return own.union(one.select(*[F.col("__row")[c].alias(c) for c in docs.columns]))
