"""Settings of an extraction, checked before anything is planned."""

from __future__ import annotations

from dataclasses import dataclass, fields

ENGINES = ("rules", "spacy", "llm")
MODES = ("generate", "classify", "entity_scoped")


class ConfigError(ValueError):
    """Settings that contradict each other or name something unknown."""


@dataclass(frozen=True)
class Settings:
    engine: str = "llm"
    pack: str = "general"
    entity_types: tuple[str, ...] = ()
    confidence_threshold: float = 0.0
    relations_enabled: bool = True
    rules_relations_enabled: bool = False
    relation_strategy: str = "generate"
    coref_enabled: bool = False
    votes: int = 1
    top_n: int = 10
    model_id: str | None = None

    @classmethod
    def of(cls, options: dict) -> Settings:
        """Defaults, casts and clamps (E18); k of the vote is 1 to 5, top-N 0 to 20."""
        known = {f.name for f in fields(cls)}
        if unknown := set(options) - known:
            raise ConfigError(f"unknown settings: {sorted(unknown)}")
        given = {k: v for k, v in options.items() if v is not None}
        given["entity_types"] = tuple(given.get("entity_types", ()))
        for name, cast in (("confidence_threshold", float), ("votes", int), ("top_n", int), ("coref_enabled", bool), ("relations_enabled", bool), ("rules_relations_enabled", bool)):
            if name in given:
                given[name] = cast(given[name])
        out = cls(**given | {"votes": min(5, max(1, given.get("votes", 1))), "top_n": min(20, max(0, given.get("top_n", 10)))})
        out.check()
        return out

    def check(self) -> None:
        if self.engine not in ENGINES:
            raise ConfigError(f"no such engine: {self.engine}")
        if self.relation_strategy not in MODES:
            raise ConfigError(f"no such relation strategy: {self.relation_strategy}")
        if self.engine != "llm" and self.relations_enabled and (self.votes > 1 or self.relation_strategy != "generate"):
            raise ConfigError(f"votes and the strategy {self.relation_strategy} need model responses, which the engine {self.engine} has none of")

    def needs(self) -> list[str]:
        """Annotation tables the plan will read."""
        out = {"rules": [], "spacy": ["ner"], "llm": ["responses"]}[self.engine]
        classify = self.engine == "llm" and self.relations_enabled and self.relation_strategy == "classify"
        more = {"tokens": self.rules_relations_enabled, "rewrites": self.coref_enabled and self.engine == "llm", "sentences": classify}
        return [*out, *(name for name, wanted in more.items() if wanted)]


def lookup(spark, key: str, default: str | None = None) -> str | None:
    """First non-blank of the session's setting and the default."""
    value = spark.conf.get(key, None)
    return value if value and value.strip() else default
