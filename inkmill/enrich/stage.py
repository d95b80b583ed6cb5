"""The language-model stages: candidates in order of arrival, one call a candidate, replies parsed with a fallback.

Calls are made in a Python stage over the candidates alone, whose replies go through a ledger (ledger.py): neither a plan that is evaluated twice
nor a task that is repeated asks a prompt twice. A reply that is no JSON object of the expected kind gives the
fallback record, a failed request the error record; keys that the schema doesn't name are dropped.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..config import Deep, Triage
from ..operators.filters import has_priority, scores_at_least
from ..operators.order import first_n
from ..schema import DEEP, TRIAGE
from ..session import ship
from .clients import Client, ClientError
from .ledger import answers
from .prompts import deep_prompt, deep_schema, triage_prompt, triage_schema

#: Characters of a bad reply that are kept, and the records for bad replies and failed requests (fixed values).
SHOWN = 500
#: Rows that are Python objects at once.
ROWS = 256


def triage_fallback(reply: str) -> dict:
    return {
        "llm_priority": "ignore",
        "llm_relevance": "not_relevant",
        "llm_topic": "other",
        "llm_reason": f"Failed to parse Ollama JSON output: {reply[:SHOWN]}",
        "llm_key_terms": "",
        "llm_is_dataset_or_benchmark": False,
        "llm_mentions_code_or_release": False,
        "llm_confidence": 0.0,
    }


def triage_error(error: str) -> dict:
    return {"llm_priority": "error", "llm_relevance": "unknown", "llm_topic": "unknown", "llm_reason": f"Ollama request failed: {error}", "llm_key_terms": "", "llm_confidence": 0.0}


def _deep_note(note: str) -> dict:
    return {f.name: "" for f in DEEP if f.dataType == T.StringType()} | {"deep_reading_notes": note, "deep_confidence": 0.0}


def deep_fallback(reply: str) -> dict:
    return _deep_note(f"Failed to parse Ollama JSON output: {reply[:SHOWN]}")


def deep_error(error: str) -> dict:
    return _deep_note(f"Deep Ollama request failed: {error}")


def _fits(value, kind: T.DataType) -> bool:
    if value is None or isinstance(kind, T.StringType):
        return True
    if isinstance(kind, T.BooleanType):
        return isinstance(value, bool)
    return isinstance(value, (int, float)) and not isinstance(value, bool)


def parse_reply(reply: str, fields: T.StructType, fallback) -> dict:
    """The record of a reply. Lists of texts are joined by a comma and a space; other values of text fields become text."""
    try:
        got = json.loads(reply)
    except ValueError:
        return fallback(reply)
    if not isinstance(got, dict) or not all(_fits(got.get(f.name), f.dataType) for f in fields):
        return fallback(reply)
    out = {}
    for f in fields:
        value = got.get(f.name)
        if isinstance(value, list):
            if not all(isinstance(x, str) for x in value):
                return fallback(reply)
            value = ", ".join(value)
        elif isinstance(f.dataType, T.StringType) and value is not None and not isinstance(value, str):
            value = json.dumps(value, ensure_ascii=False)
        elif isinstance(f.dataType, T.DoubleType) and value is not None:
            value = float(value)
        out[f.name] = value
    return out


def _by_row(df: DataFrame, inputs: tuple[str, ...], record, fields: T.StructType) -> DataFrame:
    """seq and the fields of record(*inputs). A few rows at a time become Python objects, whatever the size of Spark's batches."""
    out = T.StructType([df.schema["seq"], *fields.fields])
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                rows = batch.slice(first, ROWS)
                found = [record(*x) for x in zip(*(rows.column(c).to_pylist() for c in inputs))]
                columns = [pa.array([r.get(f.name) for r in found], kind) for f, kind in zip(fields, kinds)]
                yield pa.RecordBatch.from_arrays([rows.column("seq"), *columns], out.names)

    return df.mapInArrow(run, out)


def call(candidates: DataFrame, prompt: Column, system: str, schema: dict, client: Client, fields: T.StructType, fallback, error) -> DataFrame:
    """seq and the fields, one row a candidate. As many calls run at once as candidates has partitions."""
    ship(candidates.sparkSession)
    rows = candidates.select("seq", prompt.alias("prompt"))

    def one(user: str) -> dict:
        try:
            return parse_reply(client.chat(system, user, schema), fields, fallback)
        except ClientError as failure:
            return error(str(failure))

    return _by_row(rows, ("prompt",), one, fields)


def call_once(candidates: DataFrame, prompt: Column, system: str, schema: dict, client: Client, fields: T.StructType, fallback, error, ledger: str, at_once: int | None = None) -> DataFrame:
    """What call() gives, by way of the ledger in that folder: each prompt that it doesn't hold is asked once."""
    found = answers(candidates.select("seq", prompt.alias("prompt")), client, system, schema, ledger, at_once)
    return _by_row(found, ("reply", "error"), lambda reply, failure: parse_reply(reply, fields, fallback) if reply is not None else error(failure), fields)


def _staged(df: DataFrame, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _with(papers: DataFrame, results: DataFrame, fields: T.StructType) -> DataFrame:
    """papers with the results; where there are none, what a column already held, else null (an empty cell)."""
    r = results.toDF("seq", *(f"_r_{f.name}" for f in fields)).withColumn("_called", F.lit(True))
    joined = papers.join(r, "seq", "left")
    made = {}
    for f in fields:
        before = F.col(f.name).cast(f.dataType) if f.name in papers.columns else F.lit(None).cast(f.dataType)
        made[f.name] = F.when(F.col("_called"), F.col(f"_r_{f.name}")).otherwise(before)
    return joined.withColumns(made).drop("_called", *(f"_r_{f.name}" for f in fields))


def triage(papers: DataFrame, cfg: Triage, client: Client, system: str, folder: str, ledger: str | None = None) -> DataFrame:
    """papers with the columns of the first stage; switched off, papers as they are, without these columns. ledger: a folder of replies that outlasts the
    run, whose prompts aren't asked again; unless given, one below folder."""
    if not cfg.enabled:
        return papers
    chosen = papers.join(first_n(papers, scores_at_least(cfg.classify_min_triage_score), cfg.max_papers_per_run), "seq", "left_semi")
    prompts = _staged(chosen.select("seq", triage_prompt(papers.columns).alias("prompt")), folder, "triage-prompts")  # read several times; scores are made once
    results = call_once(prompts, F.col("prompt"), system, triage_schema(cfg.topics), client, TRIAGE, triage_fallback, triage_error, ledger or f"{folder}/ledger", cfg.calls_at_once)
    return _with(papers, _staged(results, folder, "triage"), TRIAGE)


def with_deep_columns(papers: DataFrame) -> DataFrame:
    """papers with the columns of the second stage, empty where they are new."""
    return papers.withColumns({f.name: F.lit(None).cast(f.dataType) for f in DEEP if f.name not in papers.columns})


def deep(papers: DataFrame, cfg: Deep, client: Client, system: str, folder: str, ledger: str | None = None) -> DataFrame:
    """papers with the columns of the second stage, which exist, though empty, also when it is switched off. ledger: as for triage()."""
    if not cfg.enabled or "llm_priority" not in papers.columns:
        return with_deep_columns(papers)
    chosen = papers.join(first_n(papers, has_priority(cfg.only_priorities), cfg.max_papers_per_run), "seq", "left_semi")
    prompts = _staged(chosen.select("seq", deep_prompt(papers.columns).alias("prompt")), folder, "deep-prompts")
    results = call_once(prompts, F.col("prompt"), system, deep_schema(), client, DEEP, deep_fallback, deep_error, ledger or f"{folder}/ledger", cfg.calls_at_once)
    return _with(papers, _staged(results, folder, "deep"), DEEP)
