"""Harmonic packing of tokenized documents into fixed-length training sequences.

Lengths fall into classes by reciprocal capacity: class k holds lengths in (C/(k+1), C/k], and k of them always
fit one sequence. A worker fills the sequences of each class with k pieces at a time and needs to know nothing of
other workers. Documents may be cut freely, so what is left of a document after whole sequences is first cut at
the exact reciprocal C/k, at most ``CUTS`` times; only the last piece of a document can leave padding.
"""

from __future__ import annotations

import base64
import bisect
import functools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import materialize

CAPACITY = 1024
SEPARATOR = 0
CUTS = 2
#: A cut must save so many tokens of padding.
SAVED = 16
#: Unfilled sequences of so many neighbouring input partitions are filled up together.
TAIL_GROUP = 16

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "class int, sequence long, offset long, part int, tail boolean, ord long"
)


@functools.cache
def _exact(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@functools.cache
def _special(path: str) -> tuple[str, ...]:
    """Strings that the tokenizer takes for tokens of their own, wherever they stand."""
    return tuple(x.content for x in _exact(path).get_added_tokens_decoder().values())


@functools.cache
def _fast(ranks: str) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def encode(text: str, vocabulary: str = "byte_bpe_50k") -> np.ndarray:
    """Token ids of ``byte_bpe_50k.json``; its merges as ranks give the same ids four times as fast.

    Texts that hold one of its special tokens, and those on which the fast library gives up (its recursion has a
    limit), go to the tokenizer itself.
    """
    path = public_tokenizers.path(f"{vocabulary}.json")
    if not any(x in text for x in _special(path)):
        try:
            return np.array(_fast(public_tokenizers.path(f"{vocabulary}.tiktoken")).encode_ordinary(text), dtype="<u4")
        except BaseException as error:
            if not isinstance(error, Exception) and type(error).__name__ != "PanicException":  # a Rust panic is no Exception
                raise
    return np.array(_exact(path).encode(text, add_special_tokens=False).ids, dtype="<u4")


def cut(length: int, capacity: int = CAPACITY, cuts: int = CUTS) -> list[int]:
    """Lengths of a document's pieces: whole sequences, then exact reciprocals, then the rest."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    for _ in range(cuts):
        if not rest or capacity // (capacity // rest) - rest < SAVED:
            break
        exact = capacity // -(-capacity // rest)  # the largest capacity // k that fits
        pieces.append(exact)
        rest -= exact
    return [*pieces, rest] if rest else pieces


def _pieces(capacity: int, cuts: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        open_: dict[int, list] = {}
        made = ordinal = 0
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or ""), np.uint32(SEPARATOR)).astype("<u4")
                start = 0
                for length in cut(len(ids), capacity, cuts):
                    k = capacity // length
                    held = open_.setdefault(k, [])
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    ordinal += 1
                    held.append([doc_id, start, length, crc, len(ids), k, 0, 0, part, False, ordinal])
                    start += length
                    if len(held) == k:
                        offset = 0
                        for row in held:
                            row[6:8] = made, offset
                            offset += row[2]
                        made += 1
                        out += held
                        open_[k] = []
            yield _rows(out)
        yield _rows([[*row[:9], True, row[10]] for held in open_.values() for row in held])

    return run


_ARROW = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[t]) for n, t in (x.split() for x in PIECES.split(", "))])


def _rows(rows: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_ARROW)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _ARROW.types, strict=True)], schema=_ARROW)


def fill(lengths: list[int], classes: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(sequence, offset) of each piece: k pieces of class k together, and what is left over by best fit, longest first."""
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    open_: dict[int, list[int]] = {}
    made = 0

    def close(rows: list[int]) -> None:
        nonlocal made
        offset = 0
        for n in rows:
            out[n] = made, offset
            offset += lengths[n]
        made += 1

    for n, k in enumerate(classes):
        held = open_.setdefault(k, [])
        held.append(n)
        if len(held) == k:
            close(open_.pop(k))
    room: list[tuple[int, int]] = []  # (room left, number), sorted
    bins: list[list[int]] = []
    for n in sorted((n for held in open_.values() for n in held), key=lambda n: (-lengths[n], n)):
        at = bisect.bisect_left(room, (lengths[n], -1))
        left, number = room.pop(at) if at < len(room) else (capacity, len(bins))
        if number == len(bins):
            bins.append([])
        bins[number].append(n)
        bisect.insort(room, (left - lengths[n], number))
    for rows in bins:
        close(rows)
    return out


_TAILS = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def _fill_tails(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("ord", "ascending")])
        placed = fill(table.column("length").to_pylist(), table.column("class").to_pylist(), capacity)
        first = (1 << 62) + (table.column("group")[0].as_py() << 32)
        columns = [table.column(n) for n in _TAILS.names[:5]]
        return pa.table([*columns, pa.array([first + s for s, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())], schema=_TAILS)

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, cuts: int = CUTS) -> DataFrame:
    """Place every token of every document in one sequence.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null text counts
    as empty and still yields its separator; a null doc_id is kept; repeated rows are packed once each; an empty
    table gives no rows. Columns beyond doc_id and text are ignored.

    Full sequences never leave the worker that made them. Pieces of unfilled ones (fewer than k per class and
    partition, so a bounded number) go on to groups of ``TAIL_GROUP`` partitions, which fill again by class and at
    last across classes.
    """
    pieces = materialize(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pieces(capacity, cuts), PIECES), "pieces")
    tails = pieces.where("tail").withColumn("group", F.floor(F.col("part") / TAIL_GROUP))
    tails = tails.groupBy("group").applyInArrow(_fill_tails(capacity), ", ".join(f"{n} long" for n in _TAILS.names))
    # A sequence is named by where it was filled: partition and number, or a high bit, group and number.
    local = F.shiftleft(F.col("part").cast("long"), 38) + F.col("sequence")
    return pieces.where("not tail").select(*_TAILS.names[:5], local.alias("sequence_id"), "offset").union(tails)
