"""Row predicates. All are two-valued: missing values never make a row vanish unnoticed."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.text import normalize_category, strip, to_number, to_text

#: The texts of the second stage; its confidence alone doesn't count as an analysis (fixed values).
DEEP_TEXTS = ("deep_summary", "deep_problem", "deep_method", "deep_datasets", "deep_results", "deep_limitations", "deep_relevance_to_review", "deep_reading_notes")


def scores_at_least(least: float, score: str = "triage_score") -> Column:
    return F.coalesce(F.col(score), F.lit(0.0)) >= F.lit(float(least))


def repository_allowed(cfg: Config) -> Column:
    """False for papers of repositories when these are unwanted, unless they are of a wanted kind."""
    kind = F.lower(to_text("openalex_type"))
    spared = F.lit(cfg.include_repositories) | (F.lit(cfg.include_datasets) & (kind == "dataset")) | (F.lit(cfg.include_preprints) & (kind == "preprint"))
    return ~F.coalesce(F.col("is_repository"), F.lit(False)) | spared


def passes(cfg: Config) -> Column:
    return scores_at_least(cfg.min_triage_score) & repository_allowed(cfg)


def drop_low_scores(table: DataFrame, cfg: Config) -> DataFrame:
    """The rows of the merged table that reach the least score, if the configuration asks for it; by triage_score or else
    relevance_score, which may hold text; a table with neither stays as it is."""
    column = next((c for c in ("triage_score", "relevance_score") if c in table.columns), None)
    if not cfg.drop_existing_below_min_score or column is None:
        return table
    return table.where(to_number(column) >= F.lit(float(cfg.min_triage_score)))


def triage_candidate(cfg: Config) -> Column:
    return scores_at_least(cfg.triage.classify_min_triage_score)


def has_priority(priorities: tuple[str, ...], column: str = "llm_priority") -> Column:
    return normalize_category(column).isin(*priorities) if priorities else F.lit(False)


def require_columns(df: DataFrame, *names: str) -> None:
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}; run the triage stage first")


def has_deep_analysis(columns: list[str]) -> Column:
    present = [c for c in DEEP_TEXTS if c in columns]
    return reduce(or_, (strip(c) != "" for c in present), F.lit(False))
