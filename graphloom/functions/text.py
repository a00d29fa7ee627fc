"""Text, checksum and identity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str.strip`` and ``\s`` see it.
SPACE = r"[\s\x1c-\x1f]"

# Words that are never an entity where pronouns are resolved.
PRONOUNS = [
    "it", "its", "he", "him", "his", "she", "her", "hers", "they", "them", "their", "theirs",
    "this", "that", "these", "those", "the company", "the group", "the fund", "the adviser", "the entity", "the firm",
]

# Legal forms that a normalized name leaves out.
LEGAL_FORMS = [
    "inc", "incorporated", "llc", "ltd", "limited", "corp", "corporation", "co", "company",
    "plc", "na", "sa", "ag", "gmbh", "lp", "llp", "bv", "nv", "spa", "srl", "pty", "group", "holdings",
]


def strip(text: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(text, f"(?U)^{SPACE}+|{SPACE}+$", "")


def collapse(text: Column) -> Column:
    """Runs of white space as one space, none at the ends; null stays null."""
    return F.trim(F.regexp_replace(text, f"(?U){SPACE}+", " "))


def digits_of(code: Column) -> Column:
    """Digits as they are, letters as 10 to 35."""
    return F.array_join(F.transform(F.split(code, ""), lambda c: F.when(c.rlike("^[0-9]$"), c).otherwise((F.ascii(F.upper(c)) - 55).cast("string"))), "")


def lei_valid(code: Column) -> Column:
    """20 characters whose expansion leaves 1 modulo 97."""
    rest = F.aggregate(F.split(digits_of(code), ""), F.lit(0), lambda a, c: (a * 10 + c.cast("int")) % 97)
    return F.coalesce(code.rlike("^[A-Za-z0-9]{20}$") & (rest == 1), F.lit(False))


def isin_valid(code: Column) -> Column:
    """12 characters whose expansion passes Luhn."""
    places = F.transform(F.split(F.reverse(digits_of(code)), ""), lambda c, i: (d := c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)) - F.when(d > 9, 9).otherwise(0))
    total = F.aggregate(places, F.lit(0), lambda a, x: a + x)
    return F.coalesce(code.rlike("^[A-Za-z0-9]{12}$") & (total % 10 == 0), F.lit(False))


def nth_occurrence(text: Column, part: Column, k: Column) -> Column:
    """0-based start of occurrence k (from 0, overlaps count) of part, or null."""
    # Once locate finds nothing it gives 0, which stays: -1 marks it, as locate from 1 would start anew.
    found = F.aggregate(F.sequence(F.lit(0), k.cast("int")), F.lit(0), lambda at, _: F.when(at < 0, at).otherwise(F.when((p := F.call_function("locate", part, text, at + 1)) > 0, p).otherwise(-1)))
    return F.when((found > 0) & (part != ""), found - 1)


def grounded(evidence: Column, text: Column) -> Column:
    """Whether evidence, white space aside, stands in text; missing or empty evidence never does."""
    return F.coalesce((evidence != "") & F.contains(collapse(text), collapse(evidence)), F.lit(False))


def entity_uid(folder: Column, chunk: Column, kind: Column, surface: Column, start: Column, occurrence: Column) -> Column:
    """SHA-256 of where and what a mention is (A03); parts are joined without escaping."""
    parts = [F.coalesce(x.cast("string"), F.lit("")) for x in (folder, chunk, kind, surface, start, occurrence)]
    return F.sha2(F.concat_ws("|", *parts), 256)


def edge_uid(folder: Column, relation: Column, src: Column, dst: Column) -> Column:
    """SHA-256 of folder, relation and both ends."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(x, F.lit("")) for x in (folder, relation, src, dst)]), 256)


def digest(column: str) -> list[Column]:
    """128 bits of a string in two numbers: a uid of 64 letters takes a quarter of the room when rows are shuffled by it."""
    return [F.xxhash64(column), F.xxhash64(F.lit(1), F.col(column))]


def _normal(folded: Column) -> Column:
    tokens = F.filter(F.split(F.regexp_replace(F.lower(folded), r"[^a-z0-9\s]", " "), r"\s+"), lambda t: (t != "") & ~t.isin(*LEGAL_FORMS))
    return F.array_join(tokens, " ")


def normalize_surface(surface: Column) -> Column:
    """Lower-case letters and digits, single spaces, no legal forms.

    ASCII needs no folding; only other names go through the Unicode decomposition in Python.
    """
    from .udfs import fold

    ascii_only = surface.rlike(r"^[\x00-\x7F]*$")
    return F.when(ascii_only, _normal(surface)).otherwise(_normal(fold(F.when(~ascii_only, surface))))


def normalize_ascii(surface: Column) -> Column:
    return _normal(surface)


def canonical_key(kind: Column, form: Column) -> Column:
    """C02."""
    return F.concat(kind, F.lit("|"), form)


def block_key(form: Column) -> Column:
    """First token of a form; all empty forms share a block."""
    return F.concat(F.lit("tok:"), F.split(form, " ")[0])


def identifier(name: Column, fallback: str) -> Column:
    """A label safe in a graph statement."""
    safe = F.regexp_replace(F.coalesce(name, F.lit("")), "[^A-Za-z0-9_]", "_")
    return F.when(safe == "", fallback).when(safe.rlike("^[0-9]"), F.concat(F.lit("_"), safe)).otherwise(safe)
