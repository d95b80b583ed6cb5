"""The user prompts of the two language-model stages, and the JSON schemas of the answers (fixed values)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import strip, to_text

#: Title of each field, and the column it shows.
TRIAGE_FIELDS = (
    ("Title", "title"),
    ("Abstract", "abstract"),
    ("Venue", "venue"),
    ("Venue type", "venue_type"),
    ("Publication type", "openalex_type"),
    ("Discovery query", "query"),
    ("Keyword topic label", "topic_label"),
    ("Keyword triage score", "triage_score"),
)
DEEP_FIELDS = (
    ("Title", "title"),
    ("Authors", "authors"),
    ("Year", "year"),
    ("Venue", "venue"),
    ("Venue type", "venue_type"),
    ("Publication type", "openalex_type"),
    ("DOI", "doi"),
    ("URL", "url"),
    ("Discovery query", "query"),
    ("Keyword topic", "topic_label"),
    ("Keyword triage score", "triage_score"),
    ("Fast LLM priority", "llm_priority"),
    ("Fast LLM relevance", "llm_relevance"),
    ("Fast LLM reason", "llm_reason"),
    ("Fast LLM key terms", "llm_key_terms"),
    ("Fast LLM summary, if available", "llm_summary"),
    ("Abstract", "abstract"),
)
TRIAGE_TASK = "Classify this paper for the literature review."
DEEP_TASK = "Now produce a deeper structured analysis of this paper for literature-review screening."


def _prompt(fields, task: str, columns: list[str], value) -> Column:
    shown = [F.concat(F.lit(f"{title}:\n"), value(c) if c in columns else F.lit("")) for title, c in fields]
    return F.concat_ws("\n\n", F.lit("Paper metadata:"), *shown, F.lit(task))


def triage_prompt(columns: list[str]) -> Column:
    """columns: those the table has; the others show nothing."""
    return _prompt(TRIAGE_FIELDS, TRIAGE_TASK, columns, to_text)


def deep_prompt(columns: list[str]) -> Column:
    return _prompt(DEEP_FIELDS, DEEP_TASK, columns, lambda c: strip(to_text(c)))


def _object(**properties) -> dict:
    return {"type": "object", "properties": properties, "required": list(properties)}


_TEXT, _TEXTS, _YES = {"type": "string"}, {"type": "array", "items": {"type": "string"}}, {"type": "boolean"}
_SHARE = {"type": "number", "minimum": 0, "maximum": 1}


def _one_of(*values: str) -> dict:
    return {"type": "string", "enum": list(values)}


def triage_schema(topics: tuple[str, ...]) -> dict:
    return _object(
        llm_priority=_one_of("read", "skim", "ignore"),
        llm_relevance=_one_of("direct", "partial", "adjacent", "not_relevant"),
        llm_topic=_one_of(*topics),
        llm_reason=_TEXT,
        llm_key_terms=_TEXTS,
        llm_is_dataset_or_benchmark=_YES,
        llm_mentions_code_or_release=_YES,
        llm_confidence=_SHARE,
    )


def deep_schema() -> dict:
    return _object(
        deep_summary=_TEXT,
        deep_problem=_TEXT,
        deep_method=_TEXT,
        deep_datasets=_TEXTS,
        deep_results=_TEXT,
        deep_limitations=_TEXT,
        deep_relevance_to_review=_TEXT,
        deep_reading_notes=_TEXT,
        deep_confidence=_SHARE,
    )
