"""Ontology packs: closed vocabularies of entity types and relations, with patterns to find them.

A pack is a JSON document (name, version, entity_types, relations, regex_patterns, dep_patterns). It is checked on
the driver, where it is small by nature, and turned into tables that joins broadcast.
"""

from __future__ import annotations

import functools
import json
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKS = Path(__file__).parent / "packs"
CHECKSUMS = ("lei", "isin")
#: A table of a pack is broadcast up to so many rows; larger ones are joined like any table.
BROADCAST_ROWS = 50_000


class PackError(ValueError):
    """A pack that cannot be used."""


@dataclass(frozen=True)
class Pack:
    name: str
    version: str
    description: str = ""
    entity_types: tuple[dict, ...] = ()
    relations: tuple[dict, ...] = ()
    regex_patterns: tuple[dict, ...] = ()
    dep_patterns: tuple[dict, ...] = ()
    parents: dict[str, str | None] = field(default_factory=dict)

    def ancestors(self, kind: str) -> list[str]:
        """Strict ancestors, nearest first."""
        out, at = [], self.parents.get(kind)
        while at is not None:
            out.append(at)
            at = self.parents.get(at)
        return out

    def is_descendant(self, kind: str, of: str) -> bool:
        return of in self.ancestors(kind)

    def knows(self, kind: str) -> bool:
        return kind in self.parents

    def labels(self) -> dict[str, str]:
        """Annotation label to type; of types that share a label the last declared wins."""
        return {label: t["type"] for t in self.entity_types for label in t.get("spacy_labels", ())}

    def allowed(self, relation: str, src: str, dst: str) -> bool:
        """Whether both ends are of a declared type or below one."""
        found = next((r for r in self.relations if r["type"] == relation), None)
        return found is not None and all(x in ends or any(a in ends for a in self.ancestors(x)) for x, ends in ((src, found["domain"]), (dst, found["range"])))

    def vocabulary_text(self) -> str:
        """Types and relations with their guidance, as a prompt states them."""
        lines = ["Entity types:"]
        for t in self.entity_types:
            lines.append(f"- {t['type']}" + (f" (a kind of {t['parent']})" if t.get("parent") else "") + (f": {t['guidance']}" if t.get("guidance") else ""))
        if self.relations:
            lines.append("Relation types:")
            lines += [f"- {r['type']}: {' | '.join(r['domain'])} -> {' | '.join(r['range'])}" + (f". {r['guidance']}" if r.get("guidance") else "") for r in self.relations]
        return "\n".join(lines)

    def tool_schema(self, mode: str = "generate", relation_types: list[str] | None = None) -> dict:
        """JSON schema of a model's answer in one of the three modes."""
        types, relations = sorted(self.parents), sorted(r["type"] for r in self.relations)
        text = {"type": "string"}

        def items(required: list[str], **properties: dict) -> dict:
            return {"type": "array", "items": {"type": "object", "properties": properties, "required": required}}

        relation = items(
            ["type", "src", "src_type", "dst", "dst_type", "evidence"],
            type={**text, "enum": relations}, src=text, src_type={**text, "enum": types}, dst=text, dst_type={**text, "enum": types}, confidence={"type": "number"}, evidence=text,
        )
        if mode == "generate":
            entity = items(["type", "surface"], type={**text, "enum": types}, surface=text, confidence={"type": "number"})
            return {"type": "object", "properties": {"entities": entity, "relations": relation}, "required": ["entities", "relations"]}
        if mode == "entity_scoped":
            return {"type": "object", "properties": {"relations": relation}, "required": ["relations"]}
        if mode == "classify":
            choice = {**text, "enum": [*sorted(set(relations if relation_types is None else relation_types)), "no_relation"]}
            return {"type": "object", "properties": {"labels": items(["pair_index", "relation_type"], pair_index={"type": "integer"}, relation_type=choice, evidence=text)}, "required": ["labels"]}
        raise PackError(f"no such mode: {mode}")

    # --- tables -----------------------------------------------------------------------------------------------

    def type_table(self, spark: SparkSession) -> DataFrame:
        rows = [(t["type"], t.get("parent"), i, t.get("guidance"), t.get("iri")) for i, t in enumerate(self.entity_types)]
        return spark.createDataFrame(rows, "type string, parent string, decl_idx int, guidance string, iri string")

    def label_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.labels().items()), "label string, type string")

    def closure_table(self, spark: SparkSession) -> DataFrame:
        rows = [(t, a, d + 1) for t in self.parents for d, a in enumerate(self.ancestors(t))]
        return spark.createDataFrame(rows, "type string, ancestor string, depth int")

    def allowed_table(self, spark: SparkSession) -> DataFrame:
        """Every (relation, source type, target type) that is legal, through the hierarchy."""
        rows = [(r["type"], s, d) for r in self.relations for s in self.parents for d in self.parents if self.allowed(r["type"], s, d)]
        return spark.createDataFrame(rows, "relation_type string, src_type string, dst_type string")


def small(table: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint, where the known number of rows permits."""
    from pyspark.sql import functions as F

    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def parse_pack(data: dict) -> Pack:
    """Construct and check a pack."""
    types, relations = data.get("entity_types") or [], data.get("relations") or []
    patterns, deps = data.get("regex_patterns") or [], data.get("dep_patterns") or []
    names = [t.get("type") for t in types]
    if not data.get("version"):
        raise PackError("a pack needs a version")
    if not names or not all(names):
        raise PackError("a pack needs entity types, each with a name")
    for what, found in (("entity type", names), ("relation", [r.get("type") for r in relations])):
        if len(set(found)) < len(found):
            raise PackError(f"a {what} is declared twice")
    parents = {t["type"]: t.get("parent") for t in types}
    if unknown := {p for p in parents.values() if p is not None} - set(names):
        raise PackError(f"undeclared parents: {sorted(unknown)}")
    for name in names:
        seen, at = set(), name
        while at is not None:
            if at in seen:
                raise PackError(f"{name} is its own ancestor")
            seen.add(at)
            at = parents[at]
    for r in relations:
        if not r.get("domain") or not r.get("range") or not set(r["domain"]) | set(r["range"]) <= set(names):
            raise PackError(f"relation {r.get('type')}: domain and range must name declared types")
    for p in patterns:
        if p.get("entity_type") not in parents:
            raise PackError(f"pattern for an undeclared type: {p.get('entity_type')}")
        if p.get("checksum") not in (None, *CHECKSUMS):
            raise PackError(f"no such checksum: {p['checksum']}")
        try:
            re.compile(p["pattern"])
        except (KeyError, re.error) as error:
            raise PackError(f"pattern for {p['entity_type']}: {error}") from error
    for d in deps:
        _check_dep(d, {r["type"] for r in relations})
    return Pack(data.get("name", ""), data["version"], data.get("description", ""), tuple(types), tuple(relations), tuple(patterns), tuple(deps), parents)


def _check_dep(d: dict, relations: set[str]) -> None:
    if d.get("relation_type") not in relations:
        raise PackError(f"dependency pattern for an undeclared relation: {d.get('relation_type')}")
    nodes: list[str] = []
    for place, token in enumerate(d.get("pattern") or []):
        new = token.get("RIGHT_ID")
        if not new or new in nodes:
            raise PackError(f"{d['relation_type']}: each token needs an id of its own")
        if place == 0 and ("LEFT_ID" in token or "REL_OP" in token):
            raise PackError(f"{d['relation_type']}: the first token is the anchor")
        if place > 0 and (token.get("LEFT_ID") not in nodes or not token.get("REL_OP")):
            raise PackError(f"{d['relation_type']}: {new} must hang on a token named before it")
        nodes.append(new)
    if not nodes or d.get("src_node") not in nodes or d.get("dst_node") not in nodes:
        raise PackError(f"{d['relation_type']}: source and target must be tokens of the pattern")


@functools.lru_cache(maxsize=32)
def load_pack(name: str) -> Pack:
    """A shipped pack by name, or any by path."""
    path = PACKS / f"{name}.json" if re.fullmatch(r"[A-Za-z0-9_-]+", name) else Path(name)
    if not path.exists():
        raise PackError(f"no such pack: {name}; there are {', '.join(available_packs())}")
    try:
        return parse_pack(json.loads(path.read_text(encoding="utf-8")))
    except json.JSONDecodeError as error:
        raise PackError(f"{path.name}: {error}") from error


def available_packs() -> list[str]:
    """S04."""
    return sorted(p.stem for p in PACKS.glob("*.json"))
