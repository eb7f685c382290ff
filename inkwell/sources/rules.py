"""Scoring rules and the source registry: read from YAML or JSON files.

A rules file maps `financial_relevance` and `pr_noise` to groups of a weight, a
max_score and terms, lists `pr_counter_signals`, and maps `institutions` to
aliases. It is a parameter of the job; DEMO is a small one for prose without
banking words.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Groups that count as supervisory in the gate.
STRONG_GROUPS = ("supervisory_risk", "prudential_regulatory", "governance")


@dataclass(frozen=True)
class Group:
    name: str
    weight: float
    max_score: float
    terms: tuple[str, ...]


@dataclass(frozen=True)
class Rules:
    version: str
    financial: tuple[Group, ...]
    pr: tuple[Group, ...]
    counter: tuple[str, ...]
    institutions: tuple[tuple[str, tuple[str, ...]], ...]

    @classmethod
    def of(cls, held: dict) -> Rules:
        groups = lambda part: tuple(Group(k, float(g.get("weight", 0)), float(g.get("max_score", 100)), tuple(g.get("terms", ()))) for k, g in (part or {}).items())
        names = tuple((k, tuple(d.get("aliases", ()))) for k, d in (held.get("institutions") or {}).items())
        return cls(str(held.get("version", "UNKNOWN")), groups(held["financial_relevance"]), groups(held.get("pr_noise")), tuple(held.get("pr_counter_signals") or ()), names)

    def terms(self) -> list[str]:
        """All terms, signals and aliases."""
        return [t for g in self.financial + self.pr for t in g.terms] + list(self.counter) + [a for _, held in self.institutions for a in held]

    def terms_table(self, spark: SparkSession) -> DataFrame:
        """One row a term: kind, group, their order, weight and cap."""
        rows = [(kind, g.name, i, j, t, g.weight, g.max_score) for kind, part in (("financial", self.financial), ("pr", self.pr)) for i, g in enumerate(part) for j, t in enumerate(g.terms)]
        return spark.createDataFrame(rows, "kind string, group string, group_ord int, term_ord int, term string, weight double, max_score double")


def _read(path: str | Path) -> dict:
    """A YAML or JSON mapping, with or without a byte-order mark."""
    held = Path(path).read_text(encoding="utf-8-sig")
    if str(path).endswith(".json"):
        found = json.loads(held)
    else:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError(f"{path}: YAML files need the yaml package; JSON files do not") from e
        found = yaml.safe_load(held)
    if not isinstance(found, dict):
        raise ValueError(f"{path} is not a mapping")
    return found


def load_rules(path: str | Path) -> Rules:
    return Rules.of(_read(path))


REGISTRY = "source_key string, source_code string, name string, section_name string, enabled boolean, production_status string, acquisition_method string, url string"


def load_registry(spark: SparkSession, path: str | Path) -> DataFrame:
    """One row a source of the registry file."""
    sources = _read(path).get("sources")
    if not isinstance(sources, dict):
        raise ValueError(f"{path} has no mapping of sources")
    columns = [c.split()[0] for c in REGISTRY.split(", ")][1:]
    return spark.createDataFrame([(key, *[s.get(c) for c in columns]) for key, s in sources.items()], REGISTRY)


DEMO = Rules.of(
    {
        "version": "demo-1",
        "financial_relevance": {
            "banking_core": {"weight": 7, "max_score": 35, "terms": ["the", "of", "and", "of the", "tion"]},
            "governance": {"weight": 10, "max_score": 40, "terms": ["that", "with", "this"]},
            "financial_performance": {"weight": 5, "max_score": 20, "terms": ["de", "der", "la", "que", "und"]},
        },
        "pr_noise": {
            "strong_promotional": {"weight": 15, "max_score": 45, "terms": ["for", "was", "from", "license"]},
            "routine_business": {"weight": 7, "max_score": 28, "terms": ["is", "le", "los", "in the"]},
        },
        "pr_counter_signals": ["by", "all rights reserved", "are"],
        "institutions": {"Alpha Bank": {"aliases": ["of and", "to the"]}, "Beta Trust": {"aliases": ["public license"]}, "Gamma Fund": {"aliases": ["est", "en la"]}},
    }
)
