"""Configuration, read from YAML into frozen dataclasses; unset keys take the defaults below (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

import yaml


def _from(cls, values: dict | None, **more) -> Any:
    known = {f.name for f in fields(cls)}
    return cls(**({k: v for k, v in (values or {}).items() if k in known} | more))


@dataclass(frozen=True)
class Scoring:
    title_weight: float = 3
    abstract_weight: float = 1
    query_weight: float = 2
    generic_priority_weight: float = 1
    journal_bonus: float = 2
    conference_bonus: float = 3
    preprint_bonus: float = 1
    dataset_bonus: float = 1
    repository_penalty: float = 3
    report_penalty: float = 4
    missing_abstract_penalty: float = 1
    citation_weight: float = 0.25
    max_citation_bonus: float = 5


@dataclass(frozen=True)
class Triage:
    """The first language-model stage."""

    enabled: bool = False
    model: str = "qwen2.5:7b"
    base_url: str = "http://localhost:11434"
    classify_min_triage_score: float = 0
    timeout_seconds: int = 120
    temperature: float = 0.0
    max_papers_per_run: int | None = None
    calls_at_once: int | None = None
    system_prompt_path: str = "prompts/paper_triage_prompt.txt"
    #: Topics that the model may answer; our own list, as they depend on the review at hand.
    topics: tuple[str, ...] = ("in_scope", "adjacent", "both", "other")


@dataclass(frozen=True)
class Deep:
    """The second language-model stage."""

    enabled: bool = False
    model: str = "deepseek-r1:8b"
    base_url: str = "http://localhost:11434"
    only_priorities: tuple[str, ...] = ("read", "skim")
    timeout_seconds: int = 300
    temperature: float = 0.0
    max_papers_per_run: int | None = None
    calls_at_once: int | None = None
    system_prompt_path: str = "prompts/paper_deep_analysis_prompt.txt"


@dataclass(frozen=True)
class Topic:
    key: str
    label: str
    queries: tuple[str, ...] = ()
    terms: tuple[tuple[str, int], ...] = ()


@dataclass(frozen=True)
class SearchTerms:
    """Topics in the order of the file, which decides ties, and terms that count for every topic."""

    topics: tuple[Topic, ...] = ()
    generic: tuple[tuple[str, int], ...] = ()

    @classmethod
    def of(cls, values: dict | None) -> SearchTerms:
        weighted = lambda terms: tuple((str(t), int(w)) for t, w in (terms or {}).items())
        topics = ((values or {}).get("topics") or {}).items()
        made = tuple(Topic(k, v.get("label", k), tuple(v.get("queries") or ()), weighted(v.get("topic_terms"))) for k, v in topics)
        return cls(made, weighted((values or {}).get("generic_priority_terms")))

    def query_list(self) -> list[tuple[int, str, str]]:
        """(ordinal, topic key, query) in the order of the file."""
        pairs = [(t.key, q) for t in self.topics for q in t.queries]
        return [(i, k, q) for i, (k, q) in enumerate(pairs)]


@dataclass(frozen=True)
class Config:
    output_dir: str
    sota_table_path: str
    search_terms_path: str = "search_terms.yaml"
    recommended_summary_path: str = "output/recommended_papers_summary.md"
    max_results_per_query: int = 25
    mailto: str | None = None
    from_publication_date: str | None = None
    to_publication_date: str | None = None
    sleep_seconds: float = 1.0
    reply_ledger_path: str | None = None
    min_triage_score: float = 0
    drop_existing_below_min_score: bool = False
    include_repositories: bool = True
    include_datasets: bool = True
    include_preprints: bool = True
    scoring: Scoring = field(default_factory=Scoring)
    triage: Triage = field(default_factory=Triage)
    deep: Deep = field(default_factory=Deep)

    @classmethod
    def of(cls, values: dict) -> Config:
        """From the keys of a configuration file; ValueError without output_dir or sota_table_path."""
        if missing := [k for k in ("output_dir", "sota_table_path") if not values.get(k)]:
            raise ValueError(f"configuration lacks {', '.join(missing)}")
        deep = dict(values.get("ollama_deep_analysis") or {})
        if "only_priorities" in deep:
            deep["only_priorities"] = tuple(str(p).strip().lower() for p in deep["only_priorities"])
        values = {k: v for k, v in values.items() if v is not None}
        return _from(cls, values, scoring=_from(Scoring, values.get("scoring")), triage=_from(Triage, values.get("ollama")), deep=_from(Deep, deep))


def read_yaml(path: str) -> dict:
    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}


def read_config(path: str = "config.yaml") -> Config:
    return Config.of(read_yaml(path))


def read_search_terms(path: str = "search_terms.yaml") -> SearchTerms:
    return SearchTerms.of(read_yaml(path))
