"""Shared pieces of the corpus operators: tables, word rules, hashing helpers."""

from __future__ import annotations

import contextlib

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cleanup, discard, materialize, put  # noqa: F401

#: A word is a maximal run of anything but ASCII white space; ``bytes.split()`` splits on exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Total bytes of the text column; the number of partitions is derived from it."""
    return docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def digits(fp: Column) -> Column:
    """A long as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@contextlib.contextmanager
def wrapping():
    """64-bit arithmetic modulo 2**64 on purpose."""
    with np.errstate(over="ignore"):
        yield


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the whole word."""
    with wrapping():
        x = (x ^ (x >> np.uint64(30))) * _MIX[0]
        x = (x ^ (x >> np.uint64(27))) * _MIX[1]
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word seen, remembered up to a bound."""

    BOUND = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.array([self[w] for w in words], dtype=np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    with wrapping():
        out = np.empty(max(n, 1), dtype=np.uint64)
        out[0] = 1
        done = 1
        step = np.uint64(base)
        while done < n:
            k = min(done, n - done)
            out[done : done + k] = out[:k] * step
            step = step * step if k == done else step
            done += k
        return out[:n]


#: Odd, so invertible modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POW = {base: (powers(base, 4096), powers(pow(base, -1, 2**64), 4096)) for base in _BASES}


def rolling(words: np.ndarray, width: int, base: int = _BASES[0]) -> np.ndarray:
    """Rabin-Karp hash of each window of ``width`` consecutive word hashes (none if there are fewer words).

    Sum of word * base**position over prefixes; a difference of prefixes, moved back by the inverse power, is
    the hash of a window independent of where it starts.
    """
    n = len(words)
    if n < width:
        return np.empty(0, dtype=np.uint64)
    if len(_POW[base][0]) < n:
        size = 1 << int(n - 1).bit_length()
        _POW[base] = powers(base, size), powers(pow(base, -1, 2**64), size)
    up, down = _POW[base]
    with wrapping():
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * up[:n], out=sums[1:])
        return mix((sums[width:] - sums[: n - width + 1]) * down[: n - width + 1])


def second(words: np.ndarray, width: int) -> np.ndarray:
    """32 more bits for each window, of other word hashes and another base."""
    return (rolling(mix(words ^ np.uint64(_BASES[1])), width, _BASES[1]) >> np.uint64(32)).astype(np.uint32)
