"""Secret scan: known shapes of credentials, and strings that a tokenizer finds inefficient.

A vocabulary learned from text spends few tokens on words and many on random characters, so a long run of few
characters per token is likely a key. Digests and identifiers of known form are no secrets and are excluded.
"""

from __future__ import annotations

import functools
import hashlib
import re

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import _fast
from .spans import Cover, digest_text

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Greedy runs are maximal, so asking for the length up front finds the same matches.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
#: Words without which ASSIGN cannot match.
ASSIGNED = ("password", "passwd", "secret", "token", "api_key", "apikey")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
#: Characters per token below which a candidate counts as random.
RATIO = 2.2
#: Fixed forms that are no secrets: MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 digests, UUIDs, dates.
DIGEST = re.compile(r"(?i)(?:sha\d+[-=])?(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})=*\Z")
UUID = re.compile(r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\Z")
#: Identifiers: at least half of their letters lie in words, and words cost a token for three characters or more.
IDENTIFIER_WORD = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}")
WORD_RATIO = 3.0
LETTER = re.compile(r"[A-Za-z]")
NUMBER = re.compile(r"[0-9_/=+-]+\Z")
#: Runs without a digit are also judged by their words alone, in lower case and without separators.
SPELLED_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SPELLED_RATIO = 2.1
LETTERS = re.compile(r"[A-Za-z_/=+-]+\Z")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGNED):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def is_identifier(run: str, encode) -> bool:
    words = IDENTIFIER_WORD.findall(run)
    chars = sum(map(len, words))
    return 2 * chars >= len(LETTER.findall(run)) and chars >= WORD_RATIO * sum(len(encode(w.lower())) for w in words) > 0


def is_spelled(run: str, encode) -> bool:
    words = SPELLED_WORD.findall(run)
    return sum(map(len, words)) >= SPELLED_RATIO * sum(len(encode(w.lower())) for w in words)


#: Answers for runs of up to so many characters are remembered.
REMEMBERED = 128


def is_random(run: str, ratio: float, vocabulary: str) -> bool:
    """Few characters per token, and not a form that is known to be harmless."""
    return (_judged if len(run) <= REMEMBERED else _judged.__wrapped__)(run, ratio, vocabulary)


@functools.lru_cache(maxsize=20_000)
def _judged(run: str, ratio: float, vocabulary: str) -> bool:
    if NUMBER.match(run) or DIGEST.match(run) or UUID.match(run):
        return False
    encode = _fast(public_tokenizers.path(f"{vocabulary}.tiktoken")).encode_ordinary
    if len(run) >= ratio * len(encode(run)) or is_identifier(run, encode):
        return False
    return not (LETTERS.match(run) and is_spelled(run, encode))


def all_spans(text: str, ratio: float = RATIO, vocabulary: str = "byte_bpe_50k") -> tuple[list, list]:
    """(base spans, base spans and those of the token test), each by start, then kind.

    A run that overlaps a base span is already covered and adds nothing.
    """
    order = {k: i for i, k in enumerate(KINDS)}
    base = sorted(base_spans(text), key=lambda s: (s[0], order[s[2]]))
    more, cover = [], Cover(base)
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if cover.free(a, b) and is_random(m[0], ratio, vocabulary):
            more.append((a, b, "random"))
    return base, sorted(base + more, key=lambda s: (s[0], order[s[2]])) if more else base


_OUT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_random", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def _scan(ratio: float, vocabulary: str):
    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                base, every = all_spans(text or "", ratio, vocabulary)
                kinds = [k for _, _, k in every]
                rows.append((doc_id, *(kinds.count(k) for k in KINDS), hashlib.sha256(digest_text(base).encode()).hexdigest(), digest_text(every)))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, _OUT.types, strict=True)], schema=_OUT)

    return run


def scan_secrets(docs: DataFrame, ratio: float = RATIO, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    Spans are ``kind:start:end`` in code points, end exclusive. Null and empty texts have none; repeated rows and
    null ids are kept as they come; an empty table gives no rows; columns beyond doc_id and text are ignored.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _scan(ratio, vocabulary), "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    )


def _redact(text_at: int, chars_at: int | None, ratio: float, vocabulary: str):
    def clean(text: str) -> str:
        out, end = [], 0
        for a, b, kind in all_spans(text, ratio, vocabulary)[1]:
            if a >= end:
                out += [text[end:a], f"[{kind}]"]
            end = max(end, b)
        return "".join([*out, text[end:]])

    def run(batches):
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            new = [x if x is None else clean(x) for x in texts]
            columns = list(batch.columns)
            columns[text_at] = pa.array(new, batch.column(text_at).type)
            if chars_at is not None:
                columns[chars_at] = pa.array([n if x == y else len(y) for x, y, n in zip(texts, new, columns[chars_at].to_pylist(), strict=True)], columns[chars_at].type)
            yield pa.record_batch(columns, schema=batch.schema)

    return run


def redact_secrets(docs: DataFrame, ratio: float = RATIO, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """The documents with every secret replaced by its kind in brackets; n_chars follows the new text.

    No row goes and none is added: null and empty texts, null ids and repeated rows stay as they come, an empty table
    gives no rows, and columns beyond text and n_chars are not touched. A secret that begins inside another is part of
    what that one hides.
    """
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None
    return docs.mapInArrow(_redact(docs.columns.index("text"), chars, ratio, vocabulary), docs.schema)
