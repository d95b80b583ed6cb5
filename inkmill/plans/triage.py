"""The triage pipeline: scan, deduplicate, score, filter, enrich, merge into the cumulative table, prune, save."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Config, SearchTerms
from ..enrich.clients import ChatClient, Client
from ..enrich.stage import deep, triage
from ..functions.scoring import score
from ..operators.dedup import keep_first, merge, new_rows
from ..operators.filters import drop_low_scores, passes
from ..session import remove, scratch
from ..sinks import append_run, keep_in_runs, make_folder, put_back, save_table
from ..sources import works
from ..sources.tables import by_run, exists, read_prompt, read_table


@dataclass(frozen=True)
class RunReport:
    n_raw: int
    n_unique: int
    n_kept: int = 0
    n_table: int | None = None  # None: the table was left as it is


def with_manual_columns(papers: DataFrame) -> DataFrame:
    """papers with manual_decision and notes, empty where they are new."""
    return papers.withColumns({c: F.coalesce(F.col(c), F.lit("")) if c in papers.columns else F.lit("") for c in ("manual_decision", "notes")})


def score_and_filter(papers: DataFrame, terms: SearchTerms, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """(unique papers with scores, those of them that pass). Lazy."""
    unique = with_manual_columns(score(keep_first(papers), terms, cfg.scoring))
    return unique, unique.where(passes(cfg))


def next_table(existing: DataFrame | None, papers: DataFrame, cfg: Config) -> DataFrame:
    """The whole table after papers are merged into it."""
    return drop_low_scores(merge(existing, papers), cfg)


def add_to_table(spark: SparkSession, papers: DataFrame, cfg: Config, run: str) -> None:
    """Merge papers, which are written somewhere, into the configured table as the rows of this run. The table's rows are neither sent nor written again, but where the
    configuration drops low scores and a run of the table has some. A table that is no folder of runs yet is deduplicated, pruned and written as one."""
    path = cfg.sota_table_path
    put_back(spark, path)
    found = exists(spark, path)
    if found and not by_run(spark, path):
        save_table(next_table(read_table(spark, path), papers, cfg), path, run)
        return
    new = new_rows(read_table(spark, path), papers) if found else merge(None, papers)
    append_run(drop_low_scores(new, cfg), path, run)
    if cfg.drop_existing_below_min_score:
        keep_in_runs(spark, path, lambda table: drop_low_scores(table, cfg))


def _client(stage) -> Client:
    return ChatClient(stage.model, stage.base_url, stage.timeout_seconds, stage.temperature)


def run(spark: SparkSession, cfg: Config, terms: SearchTerms, papers: DataFrame | None = None, client: Client | None = None, system: tuple[str, str] | None = None) -> RunReport:
    """One run. papers: scanned records with seq; None scans the works API. client: for both stages; None asks the configured
    servers. system: the two system prompts; None reads the configured files. Without any paper, or any that passes, the table isn't touched.

    Intermediate results lie in a folder of the run's own and go with its end, whatever it is. Papers are counted as they are written."""
    make_folder(spark, cfg.output_dir)
    folder = scratch(spark, "run")
    try:
        return _run(spark, cfg, terms, papers, client, system, folder)
    finally:
        remove(spark, folder)


def _run(spark: SparkSession, cfg: Config, terms: SearchTerms, papers: DataFrame | None, client: Client | None, system: tuple[str, str] | None, folder: str) -> RunReport:
    if papers is None:
        options = ("mailto", "from_publication_date", "to_publication_date", "sleep_seconds")
        papers = works.scan(spark, terms.query_list(), {"max_results": cfg.max_results_per_query} | {o: getattr(cfg, o) for o in options})
    found, unique, kept = (Observation() for _ in range(3))
    n = F.count(F.lit(1)).alias("n")
    # the scan is written once: a second look must not ask the service again
    papers.observe(found, n).write.parquet(f"{folder}/raw")
    every = with_manual_columns(score(keep_first(spark.read.parquet(f"{folder}/raw")), terms, cfg.scoring)).observe(unique, n)
    every.where(passes(cfg)).observe(kept, n).write.parquet(f"{folder}/kept")
    n_raw, n_unique, n_kept = (x.get["n"] for x in (found, unique, kept))
    if not n_kept:
        return RunReport(n_raw, n_unique)
    papers, staging = spark.read.parquet(f"{folder}/kept"), f"{folder}/replies"
    first, second = system or ("", "")
    if system is None:
        first = read_prompt(cfg.triage.system_prompt_path) if cfg.triage.enabled else ""
        second = read_prompt(cfg.deep.system_prompt_path) if cfg.deep.enabled else ""
    papers = triage(papers, cfg.triage, client or _client(cfg.triage), first, staging, cfg.reply_ledger_path)
    papers = deep(papers, cfg.deep, client or _client(cfg.deep), second, staging, cfg.reply_ledger_path)
    add_to_table(spark, papers, cfg, uuid.uuid4().hex)
    return RunReport(n_raw, n_unique, n_kept, read_table(spark, cfg.sota_table_path).count())
