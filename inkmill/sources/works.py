"""The works API: a JSON search service for scholarly works, as a Spark data source, and the projection of its records.

    spark.dataSource.register(WorksDataSource)
    spark.read.format("works").option("queries", json.dumps([[0, "topic", "text"]])).load()

One partition a lane (lanes.py); each row is one record of the answer as JSON, with its place and date. Offline, captured answers are read with
from_responses(). Both give what project() takes.

Filters on published_date that the service understands become part of the requests (bounds that are whole dates, with or without equality); Spark plans no
filter for them. As with the options for dates, max_results counts the records within the bounds then. Needs spark.sql.python.filterPushdown.enabled; scan() sees to it.
"""

from __future__ import annotations

import datetime
import importlib
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, IsNotNull, LessThan, LessThanOrEqual

from ..functions.nested import author_list, best_venue, external_id, invert_index
from ..functions.text import clean_text
from ..schema import WORK_DDL
from .http import fetch_once, get, url_of
from .lanes import Lane, lanes, paced

#: Whether Spark offers filters to Python data sources.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
BASE_URL = "https://api.openalex.org/works"
RAW_DDL = "query_ordinal int, rank int, search_topic string, query string, published_date string, item string"


def date_filter(first: str | None = None, last: str | None = None) -> str:
    """The service's filter on publication dates; without an end it is today."""
    until = last or datetime.date.today().isoformat()
    return ",".join([f"from_publication_date:{first}"] * bool(first) + [f"to_publication_date:{until}"])


def in_dates(papers: DataFrame, first: str | None = None, last: str | None = None, column: str = "published_date") -> DataFrame:
    """The same filter on rows: dates compare as text."""
    kept = papers.where(F.col(column) <= (F.lit(last) if last else F.date_format(F.current_date(), "yyyy-MM-dd")))
    return kept.where(F.col(column) >= first) if first else kept


def request_parameters(query: str, options: dict) -> dict:
    made = {"search": query, "per-page": options.get("max_results", 25), "sort": "publication_date:desc"}
    made["filter"] = date_filter(options.get("from_publication_date"), options.get("to_publication_date"))
    return made | ({"mailto": options["mailto"]} if options.get("mailto") else {})


def fetcher(options: dict):
    """The transport that the options name as module:function, for tests and others; else HTTP."""
    if not (name := options.get("fetcher")):
        return get
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def tighter(first: str | None, last: str | None, filters: list[Filter]) -> tuple[str | None, str | None, list[Filter]]:
    """The bounds within first and last that the filters on published_date leave, and those filters that bounds don't express in full."""
    left = []
    for f in filters:
        if getattr(f, "attribute", None) != ("published_date",):
            left.append(f)
            continue
        value = getattr(f, "value", None)
        whole = isinstance(value, str) and re.fullmatch(r"\d{4}-\d\d-\d\d", value) is not None
        if whole and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
            first = max(first or value, value)
        if whole and isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
            last = min(last or value, value)
        # the service's bounds are within the range; no row lacks a date, though it may be empty
        if not (whole and isinstance(f, (EqualTo, GreaterThanOrEqual, LessThanOrEqual)) or isinstance(f, IsNotNull)):
            left.append(f)
    return first, last, left


class WorksReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        #: Bounds that came with filters, which rows keep to whatever the service answers.
        self.first, self.last = None, None

    def partitions(self) -> list[Lane]:
        return lanes(json.loads(self.options["queries"]), int(self.options.get("lanes", 1)))

    def read(self, lane: Lane):
        fetch = fetcher(self.options)
        for ordinal, topic, query in paced(lane.queries, float(self.options.get("sleep_seconds", 1.0)), lane.number, lane.of):
            url = url_of(self.options.get("base_url", BASE_URL), request_parameters(query, self.options))
            answer = json.loads(fetch_once(url, float(self.options.get("timeout", 30)), fetch))
            for rank, item in enumerate(answer.get("results") or []):
                date = str(item.get("publication_date") or "")
                if (not self.first or date >= self.first) and (not self.last or date <= self.last):
                    yield ordinal, rank, topic, query, date, json.dumps(item, ensure_ascii=False)


class DatedWorksReader(WorksReader):
    """Takes filters on dates into the requests."""

    def pushFilters(self, filters: list[Filter]):
        self.first, self.last, left = tighter(None, None, filters)
        first, last = (self.options.get(f"{x}_publication_date") for x in ("from", "to"))
        within = {"from_publication_date": max(filter(None, (first, self.first)), default=None), "to_publication_date": min(filter(None, (last, self.last)), default=None)}
        self.options = self.options | {k: v for k, v in within.items() if v}
        return left


class WorksDataSource(DataSource):
    """Options: queries (JSON of [ordinal, topic, text]), max_results, mailto, from_publication_date, to_publication_date, sleep_seconds,
    lanes, timeout, base_url, fetcher, push_dates (true: filters on dates go into the requests, which the session must allow)."""

    @classmethod
    def name(cls) -> str:
        return "works"

    def schema(self) -> str:
        return RAW_DDL

    def reader(self, schema) -> WorksReader:
        return (DatedWorksReader if self.options.get("push_dates") == "true" else WorksReader)(dict(self.options))


def from_responses(responses: DataFrame) -> DataFrame:
    """responses: query_ordinal, search_topic, query, body (a whole answer as JSON). The rows the data source would give, without the date beside the record."""
    body = F.from_json("body", "results array<string>")
    return responses.select("query_ordinal", "search_topic", "query", F.posexplode(body["results"]).alias("rank", "item"))


def project(raw: DataFrame) -> DataFrame:
    """Paper records of raw rows, with search_topic and seq, the place of arrival: query by query, then as the service ranks."""
    w = raw.withColumn("w", F.from_json("item", WORK_DDL))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    # the source's own column as it is, so that a filter reaches the source
    date = F.col("published_date") if "published_date" in raw.columns else text("w.publication_date")
    flat = w.select(
        F.struct("query_ordinal", "rank").alias("seq"),
        "search_topic",
        "query",
        text("w.id").alias("openalex_id"),
        clean_text("w.title").alias("title"),
        author_list(F.col("w.authorships")).alias("authors"),
        F.col("w.publication_year").alias("year"),
        date.alias("published_date"),
        text("w.updated_date").alias("updated_date"),
        best_venue(F.col("w.locations"), F.col("w.primary_location")).alias("v"),
        clean_text(invert_index(F.col("w.abstract_inverted_index"))).alias("abstract"),
        external_id(F.col("w.ids"), "doi").alias("doi"),
        F.coalesce("w.cited_by_count", F.lit(0)).cast("long").alias("citation_count"),
        text("w.type").alias("openalex_type"),
        text("w.type_crossref").alias("openalex_crossref_type"),
    )
    return flat.select(
        F.concat(F.lit("openalex:"), "openalex_id").alias("paper_id"),
        F.lit("openalex").alias("source"),
        "title", "authors", "year", "published_date", "updated_date",
        F.col("v.name").alias("venue"), F.col("v.type").alias("venue_type"),
        "abstract", (F.col("abstract") != "").alias("has_abstract"),
        F.when(F.col("doi") != "", F.col("doi")).otherwise(F.col("openalex_id")).alias("url"),
        "doi", F.lit("").alias("arxiv_id"), F.lit("").alias("semantic_scholar_id"), "openalex_id", "query", "citation_count",
        (F.col("v.type") == "repository").alias("is_repository"),
        "openalex_type", "openalex_crossref_type", "search_topic", "seq",
    )


def scan(spark, queries: list[tuple[int, str, str]], options: dict) -> DataFrame:
    """Paper records of a list of queries (ordinal, topic, text) from the service. Filters on their dates go into the requests, unless the session was told
    that Python data sources take none (spark.sql.python.filterPushdown.enabled set to false)."""
    spark.dataSource.register(WorksDataSource)
    if spark.conf.get(PUSHDOWN, None) is None:
        spark.conf.set(PUSHDOWN, "true")
    reader = spark.read.format("works").option("queries", json.dumps(queries)).option("push_dates", spark.conf.get(PUSHDOWN))
    for k, v in options.items():
        if v is not None:
            reader = reader.option(k, str(v))
    return project(reader.load())
