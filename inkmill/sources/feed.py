"""The preprint feed: an Atom search service, as a Spark data source, and the projection of its entries."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import urlencode

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from ..functions.nested import feed_query, last_segment
from ..functions.text import clean_text
from ..schema import FEED_DDL
from ..session import map_in_arrow
from .http import fetch_patiently, url_of
from .lanes import Lane, lanes, paced
from .works import fetcher

BASE_URL = "https://export.arxiv.org/api/query"
RAW_DDL = "query_ordinal int, search_topic string, query string, body string"


#: A phrase, or a run of characters that neither are white space nor begin a phrase.
_TERM = re.compile(r'''(?P<phrase>"[^"]+")|(?:(?!"[^"]+")\S)+''')


def compile_query(query: str, field: str = "all") -> str:
    """Free text in the service's syntax: every phrase and word has to be found in the field, phrases being named first. It is read once from left to
    right; text without any term is passed on as one."""
    terms: dict[bool, list[str]] = {True: [], False: []}
    for found in _TERM.finditer(query):
        quoted = found["phrase"] is not None
        inside = found[0][1:-1].strip() if quoted else found[0]
        if inside:
            terms[quoted].append(f'"{inside}"' if quoted else inside)
    return " AND ".join(f"{field}:{t}" for t in terms[True] + terms[False] or [query])


def request_parameters(query: str, options: dict) -> dict:
    return {
        "search_query": compile_query(query),
        "start": 0,
        "max_results": options.get("max_results", 25),
        "sortBy": options.get("sort_by", "submittedDate"),
        "sortOrder": options.get("sort_order", "descending"),
    }


def _pause(options: dict) -> float:
    return float(options.get("sleep_seconds", 3.0))


def ask(query: str, options: dict) -> str:
    """The service's answer to a query."""
    url = url_of(options.get("base_url", BASE_URL), request_parameters(query, options))
    agent = f"inkmill (mailto:{options['mailto']})" if options.get("mailto") else "inkmill"
    return fetch_patiently(url, timeout=float(options.get("timeout", 60)), agent=agent, fetch=fetcher(options))


def request_url(query: Column, options: dict) -> Column:
    """The address of a query's request, the one that ask() asks, as an expression."""
    encoded = F.replace(F.replace(F.url_encode(feed_query(query)), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    rest = {k: v for k, v in request_parameters("", options).items() if k != "search_query"}
    return F.concat(F.lit(f"{options.get('base_url', BASE_URL)}?search_query="), encoded, F.lit(f"&{urlencode(rest)}"))


class FeedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Lane]:
        return lanes(json.loads(self.options["queries"]), int(self.options.get("lanes", 1)))

    def read(self, lane: Lane):
        for ordinal, topic, query in paced(lane.queries, _pause(self.options), lane.number, lane.of):
            yield ordinal, topic, query, ask(query, self.options)


class FeedDataSource(DataSource):
    """Options as for the works API, and sort_by, sort_order. A row is a whole feed."""

    @classmethod
    def name(cls) -> str:
        return "preprint_feed"

    def schema(self) -> str:
        return RAW_DDL

    def reader(self, schema) -> FeedReader:
        return FeedReader(dict(self.options))


def project(raw: DataFrame) -> DataFrame:
    """Paper records of feeds: the 13 fields that a feed has, with search_topic and seq."""
    entries = raw.select("query_ordinal", "search_topic", "query", F.posexplode(F.from_xml("body", FEED_DDL)["entry"]).alias("rank", "e"))
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    doi_links = F.transform(F.filter("e.link", lambda x: x["_title"] == "doi"), lambda x: F.coalesce(x["_href"], F.lit("")))
    names = F.filter(F.transform("e.author", lambda a: a["name"]), lambda n: n.isNotNull())
    ident = last_segment(F.col("e.id"))
    return entries.select(
        F.concat(F.lit("arxiv:"), ident).alias("paper_id"),
        F.lit("arxiv").alias("source"),
        clean_text("e.title").alias("title"),
        F.coalesce(F.array_join(names, ", "), F.lit("")).alias("authors"),
        F.substring("e.published", 1, 4).try_cast("int").alias("year"),
        text("e.published").alias("published_date"),
        text("e.updated").alias("updated_date"),
        F.lit("").alias("venue"),
        clean_text("e.summary").alias("abstract"),
        text("e.id").alias("url"),
        F.coalesce(F.element_at(F.concat(F.array(F.lit("")), F.coalesce(doi_links, F.array().cast("array<string>"))), -1), F.lit("")).alias("doi"),
        ident.alias("arxiv_id"),
        "query",
        "search_topic",
        F.struct("query_ordinal", "rank").alias("seq"),
    )


def scan(spark, queries: list[tuple[int, str, str]], options: dict) -> DataFrame:
    spark.dataSource.register(FeedDataSource)
    reader = spark.read.format("preprint_feed").option("queries", json.dumps(queries))
    for k, v in options.items():
        if v is not None:
            reader = reader.option(k, str(v))
    return project(reader.load())


def scan_rows(queries: DataFrame, options: dict) -> DataFrame:
    """Paper records of the queries of a table (query_ordinal, search_topic, query) from the service, in as many lanes as the options say. Every evaluation asks anew: write the result."""
    n = int(options.get("lanes", 1))
    rows = queries.select(F.col("query_ordinal").cast("int").alias("query_ordinal"), "search_topic", "query")
    rows = (rows.coalesce(1) if n == 1 else rows.repartition(n, "query_ordinal")).sortWithinPartitions("query_ordinal")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        for one in paced((b.slice(i, 1) for b in batches for i in range(len(b))), _pause(options), number, n):
            body = ask(one.column("query")[0].as_py(), options)
            yield pa.RecordBatch.from_pydict({c: one.column(c) for c in one.schema.names} | {"body": pa.array([body], pa.string())})

    return project(map_in_arrow(rows, run, RAW_DDL))


def replay(queries: DataFrame, captured: DataFrame, options: dict) -> DataFrame:
    """Paper records of the queries of a table from answers that were kept (url, body), each under the address it was asked at. Queries without one have no records."""
    asked = queries.select(F.col("query_ordinal").cast("int").alias("query_ordinal"), "search_topic", "query", F.sha2(request_url(F.col("query"), options).cast("binary"), 256).alias("at"))
    kept = captured.select(F.sha2(F.col("url").cast("binary"), 256).alias("at"), "body")
    return project(asked.join(kept, "at").drop("at"))
