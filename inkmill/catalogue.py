"""Every query of the literature-triage operators, by the operator's number, with DuckDB SQL for the same rows."""

from __future__ import annotations

from array import array
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import testviews
from .config import Scoring
from .enrich import prompts, stage
from .enrich.clients import StubClient
from .functions import nested, scoring, text
from .functions.text import SPACE_CLASS
from .operators import aggregates, dedup, filters, order
from .plans import report, triage
from .schema import DEEP, TRIAGE, WORK_DDL
from .session import map_in_arrow, scratch, ship
from .sources import feed, tables, works
from .sources.http import url_of

TERMS, CONFIG, SCORES = testviews.TERMS, testviews.CONFIG, Scoring()
_Q: dict = {}
_SQL: dict[str, str] = {}
_WITH = "WITH p AS (" + testviews.PAPERS.replace("{documents}", "documents") + ")"


def _query(sql: str | None = None, name: str | None = None):
    def keep(f):
        key = name or f.__name__
        _Q[key] = f
        if sql:
            _SQL[key] = sql if sql.lstrip().startswith("WITH") else f"{_WITH} {sql}"
        return f

    return keep


def queries() -> dict:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testviews.papers(spark, sf_dir)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- SQL of the parts that many queries share

_CLEAN = "trim(regexp_replace(coalesce(cast({} as varchar), ''), '" + SPACE_CLASS + "+', ' ', 'g'))"
_STRIP = "regexp_replace(coalesce(cast({} as varchar), ''), '^" + SPACE_CLASS + "+|" + SPACE_CLASS + "+$', '', 'g')"
_NUMBER = "coalesce(CASE WHEN regexp_matches(" + _STRIP + r", '^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$') THEN try_cast(" + _STRIP + " AS double) END, 0e0)"


def _clean(c: str) -> str:
    return _CLEAN.replace("{}", c)


def _strip(c: str) -> str:
    return _STRIP.replace("{}", c)


def _number(c: str) -> str:
    return _NUMBER.replace("{}", c)


def _terms_sql(column: str, terms) -> str:
    return "(" + " + ".join([f"CASE WHEN contains({column}, '{t.lower()}') THEN {w} ELSE 0 END" for t, w in terms] or ["0"]) + ")"


def _topic_sql(terms) -> str:
    return " + ".join(f"{w}e0 * {_terms_sql(f'lower(coalesce({c}, {chr(39) * 2}))', terms)}" for c, w in (("title", 3), ("abstract", 1), ("query", 2)))


_TOPICS = ", ".join(f"cast({_topic_sql(t.terms)} as double) AS s{i}" for i, t in enumerate(TERMS.topics))
_MOST = "greatest(" + ", ".join(f"s{i}" for i in range(len(TERMS.topics))) + ")"


def _pick(what, none: str) -> str:
    return f"CASE WHEN {_MOST} <= 0 THEN {none} " + " ".join(f"WHEN s{i} = {_MOST} THEN {what(i, t)}" for i, t in enumerate(TERMS.topics)) + " END"


_ALL = "lower(coalesce(title, '') || ' ' || coalesce(abstract, '') || ' ' || coalesce(query, ''))"
_BONUS = "(CASE WHEN lower(venue_type) = 'journal' THEN 2e0 WHEN lower(venue_type) = 'conference' THEN 3e0 ELSE 0e0 END + CASE WHEN lower(openalex_type) IN ('preprint', 'dataset') THEN 1e0 ELSE 0e0 END)"
_PENALTY = "(CASE WHEN is_repository THEN 3e0 ELSE 0e0 END + CASE WHEN lower(openalex_type) = 'report' THEN 4e0 ELSE 0e0 END + CASE WHEN has_abstract THEN 0e0 ELSE 1e0 END)"
_CITED = "CASE WHEN citation_count > -1 THEN least(5e0, 0.25e0 * ln(1e0 + citation_count)) ELSE 0e0 END"
_SCORED = f"""
t AS (SELECT *, {_TOPICS}, cast({_terms_sql(_ALL, TERMS.generic)} as double) AS g FROM p),
b AS (SELECT *, {_pick(lambda i, t: f"'{t.key}'", "'out_of_scope'")} AS topic, {_pick(lambda i, t: f"'{t.label}'", "'Out of scope'")} AS best_label,
  CASE WHEN {_MOST} <= 0 THEN 0e0 ELSE {_MOST} END AS best FROM t),
scored AS (SELECT * EXCLUDE (topic_label), best_label AS topic_label, round(best, 3) AS topic_score,
  CASE WHEN topic = 'out_of_scope' THEN 0e0 ELSE round(g, 3) END AS generic_priority_score,
  CASE WHEN topic = 'out_of_scope' THEN 0e0 ELSE round(greatest(best + g + {_BONUS} - {_PENALTY} + {_CITED}, 0e0), 3) END AS triage_score FROM b)
"""
_WS = f"{_WITH}, {_SCORED}"
_KEYS = ("doi", "arxiv_id", "url", "title")
_KEY = "coalesce(" + ", ".join(f"'{k}:' || nullif(lower({_clean(k)}), '')" for k in _KEYS) + ", '')"
_ALLOWED = "(NOT is_repository OR lower(openalex_type) IN ('dataset', 'preprint'))"


def _scored(spark, sf_dir) -> DataFrame:
    return scoring.score(_papers(spark, sf_dir), TERMS, SCORES)


# --- text


@_query(f"SELECT doc_id, {_clean('text')} AS out FROM documents")
def t2_clean_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.clean_text("text").alias("out"))


@_query("SELECT event_id, value IS NULL OR isnan(value) AS missing, CASE WHEN value IS NULL OR isnan(value) THEN '' ELSE event_type END AS shown FROM events", name="t1_is_missing")
def t1_is_missing(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", text.is_missing("value").alias("missing"), F.when(text.is_missing("value"), "").otherwise(F.col("event_type")).alias("shown"))


_HALF = "cast(event_id % 50 as double) / 4"


@_query(f"SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE cast({_HALF} as varchar) END AS cleaned, cleaned AS key, cleaned AS stripped, cleaned AS category FROM events")
def t2_clean_double(spark, sf_dir):
    """Of a column of doubles in which NaN stands for what is missing."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("x", F.expr(f"CASE WHEN event_id % 5 = 0 THEN double('NaN') ELSE {_HALF} END"))
    return e.select("event_id", text.clean_text("x").alias("cleaned"), text.normalize_key("x").alias("key"), text.strip("x").alias("stripped"), text.normalize_category("x").alias("category"))


@_query(f"SELECT doc_id, lower({_clean('text')}) AS out FROM documents")
def t3_normalize_key(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.normalize_key("text").alias("out"))


@_query("SELECT seq, coalesce(abstract, '') AS abstract_text, coalesce(cast(citation_count as varchar), '') AS citations FROM p")
def t4_to_text(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", text.to_text("abstract").alias("abstract_text"), text.to_text("citation_count").alias("citations"))


@_query("SELECT seq, contains(lower(coalesce(abstract, '')), 'gan') AS has_gan, contains(lower(coalesce(title, '')), 'ung') AS has_ung FROM p")
def t5_contains_ci(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", text.contains_ci("abstract", "GAN").alias("has_gan"), text.contains_ci("title", "Ung").alias("has_ung"))


@_query(f"SELECT seq, {_strip('doi')} AS doi, {_strip('abstract')} AS abstract FROM p")
def t6_strip(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", text.strip("doi").alias("doi"), text.strip("abstract").alias("abstract"))


@_query(f"SELECT seq, {_strip('lower(llm_priority)')} AS priority FROM p")
def t7_category_norm(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", text.normalize_category("llm_priority").alias("priority"))


@_query("SELECT seq, coalesce(title || ', ' || venue, '') AS joined FROM p")
def t8_list_join(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", text.join_list(F.array("title", "venue")).alias("joined"))


@_query(f"SELECT seq, {_number('score_text')} AS n FROM p")
def t9_numeric_coerce(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", text.to_number("score_text").alias("n"))


@_query("SELECT doc_id, substr(text, 1, 500) AS cut FROM documents")
def t10_truncate(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.truncate("text", 500).alias("cut"))


# --- nested values


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """df, whose file may be one row group and so one task, for the making of indexes, which takes most of these queries' time."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


#: Rows of one batch with indexes.
_INDEXED = 256


def _with_index(df: DataFrame, column: str) -> DataFrame:
    """df with index, the inverted index of a text: a map of word to positions, null where it has no word. A few rows at a time, whatever the size of Spark's batches."""

    def indexes(texts: list) -> pa.MapArray:
        keys, ends, at, starts = [], [0], array("i"), [0]
        for x in texts:
            places: dict[str, array] = {}
            for i, word in enumerate((x or "").split()):
                places.setdefault(word, array("i")).append(i)
            for word, found in places.items():
                keys.append(word)
                at.extend(found)
                ends.append(len(at))
            starts.append(len(keys) if places else None)
        # a null start is a null map
        starts = [None if after is None else before for before, after in zip(_filled(starts), starts[1:])] + [len(keys)]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(at, "i4") if at else [], pa.int32()))
        return pa.MapArray.from_arrays(pa.array(starts, pa.int32()), pa.array(keys, pa.string()), lists)

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, _INDEXED):
                rows = batch.slice(first, _INDEXED)
                yield pa.RecordBatch.from_arrays([*rows.columns, indexes(rows.column(column).to_pylist())], [*rows.schema.names, "index"])

    return map_in_arrow(df, run, T.StructType([*df.schema.fields, T.StructField("index", T.MapType(T.StringType(), T.ArrayType(T.IntegerType())))]))


def _filled(starts: list) -> list:
    """The starts, a missing one being that before it."""
    return list(accumulate(starts, lambda a, b: a if b is None else b))


@_query(f"SELECT doc_id, {_clean('text')} AS out FROM documents")
def p1_invert_abstract(spark, sf_dir):
    return _with_index(_dealt(_docs(spark, sf_dir).select("doc_id", "text"), "doc_id"), "text").select("doc_id", nested.invert_index(F.col("index")).alias("out"))


@_query("SELECT seq, doi AS found, '' AS absent FROM p")
def p2_external_id(spark, sf_dir):
    ids = F.when(F.col("seq") % 3 == 0, F.create_map(F.lit("doi"), F.col("doi"), F.lit("mag"), F.lit("1")))
    return _papers(spark, sf_dir).select("seq", nested.external_id(ids, "doi").alias("found"), nested.external_id(ids, "pmid").alias("absent"))


_LINES = "row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate)"


def _authorships(spark, sf_dir) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("place", F.expr(_LINES))
    names = lines.join(spark.read.parquet(f"{sf_dir}/supplier.parquet"), F.col("l_suppkey") == F.col("s_suppkey"))
    name = F.when(F.col("l_suppkey") % 7 == 0, F.lit("")).when(F.col("l_suppkey") % 11 == 0, F.lit(None)).otherwise(F.col("s_name"))
    rows = F.array_sort(F.collect_list(F.struct("place", name.alias("display_name"))))
    return names.groupBy("l_orderkey").agg(F.transform(rows, lambda r: F.struct(F.struct(r["display_name"].alias("display_name")).alias("author"))).alias("authorships"))


@_query(
    f"""WITH l AS (SELECT l_orderkey, l_suppkey, {_LINES} AS place FROM lineitem)
    SELECT l_orderkey, coalesce(string_agg(CASE WHEN l_suppkey % 7 = 0 OR l_suppkey % 11 = 0 THEN NULL ELSE s_name END, ', ' ORDER BY place), '') AS authors
    FROM l JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_orderkey"""
)
def p3_authors(spark, sf_dir):
    return _authorships(spark, sf_dir).select("l_orderkey", nested.author_list(F.col("authorships")).alias("authors"))


def _source(name, kind) -> F.Column:
    return F.struct(F.struct(name.alias("display_name"), kind.alias("type")).alias("source"))


def _locations() -> F.Column:
    """Three places: one with neither name nor type, one by the paper's type, one nameless or a journal."""
    empty = _source(F.lit(None).cast("string"), F.lit(None).cast("string"))
    own = _source(F.col("venue"), F.lower("venue_type"))
    third = _source(F.when(F.col("seq") % 8 < 4, F.lit("")).otherwise(F.lit("Third")), F.lit("journal"))
    return F.when(F.col("seq") % 19 != 0, F.array(empty, own, third))


_VENUE_IS = "CASE WHEN seq % 19 = 0 THEN 'first' WHEN lower(venue_type) IN ('journal', 'conference') THEN 'own' WHEN seq % 8 >= 4 THEN 'third' ELSE 'first' END"
_VENUE = f"CASE {_VENUE_IS} WHEN 'own' THEN venue WHEN 'third' THEN 'Third' ELSE 'Main' END AS venue_name, CASE {_VENUE_IS} WHEN 'own' THEN lower(venue_type) WHEN 'third' THEN 'journal' ELSE 'repository' END AS venue_kind"


@_query(f"SELECT seq, {_VENUE} FROM p")
def p4_best_venue(spark, sf_dir):
    main = _source(F.lit("Main"), F.lit("repository"))
    return _papers(spark, sf_dir).select("seq", nested.best_venue(_locations(), main).alias("v")).select("seq", F.col("v.name").alias("venue_name"), F.col("v.type").alias("venue_kind"))


def _responses(spark, sf_dir) -> DataFrame:
    """Answers of the works API made of documents: one query a source, each with its documents as results."""
    used = ("seq", "paper_id", "title", "abstract", "has_abstract", "query", "doi", "authors", "venue", "venue_type", "year", "published_date", "citation_count", "openalex_type")
    papers = _with_index(_dealt(_papers(spark, sf_dir).select(*used), "seq"), "abstract")
    item = F.struct(
        F.col("paper_id").alias("id"),
        "title",
        F.create_map(F.lit("doi"), F.col("doi")).alias("ids"),
        F.array(F.struct(F.struct(F.col("authors").alias("display_name")).alias("author"))).alias("authorships"),
        _locations().alias("locations"),
        _source(F.lit("Main"), F.lit("repository")).alias("primary_location"),
        F.when(F.col("has_abstract"), F.col("index")).alias("abstract_inverted_index"),
        F.col("year").alias("publication_year"),
        F.col("published_date").alias("publication_date"),
        F.col("citation_count").alias("cited_by_count"),
        F.col("openalex_type").alias("type"),
    )
    return papers.select(F.col("query"), "seq", F.to_json(item).alias("item"))


_P5 = f"""SELECT seq, 'openalex:' || paper_id AS paper_id, {_clean('title')} AS title, authors, year, coalesce(published_date, '') AS published_date, {_VENUE},
  {_clean('abstract')} AS abstract, {_clean('abstract')} <> '' AS has_abstract, CASE WHEN doi <> '' THEN doi ELSE paper_id END AS url, query,
  cast(coalesce(citation_count, 0) as bigint) AS citation_count, openalex_type FROM p"""
_P5_COLUMNS = ("paper_id", "title", "authors", "year", "published_date", F.col, "abstract", "has_abstract", "url", "query", "citation_count", "openalex_type")


@_query(_P5)
def p5_paper_projection(spark, sf_dir):
    raw = _responses(spark, sf_dir).select(F.lit(0).alias("query_ordinal"), F.col("seq").cast("int").alias("rank"), F.lit("t").alias("search_topic"), "query", "item")
    out = works.project(raw)
    return out.select(
        F.col("seq.rank").cast("long").alias("seq"), "paper_id", "title", "authors", "year", "published_date", F.col("venue").alias("venue_name"), F.col("venue_type").alias("venue_kind"),
        "abstract", "has_abstract", "url", "query", "citation_count", "openalex_type",
    )


_PAGE = "query || '#' || cast(seq // 500 as varchar)"


@_query(f"""SELECT query, count(*) AS n, max(place) AS last_rank, count(DISTINCT paper_id) AS n_ids FROM
    (SELECT {_PAGE} AS query, paper_id, row_number() OVER (PARTITION BY {_PAGE} ORDER BY seq) - 1 AS place FROM p) GROUP BY query""")
def s1_scan_offline(spark, sf_dir):
    """Whole captured answers, one a query and page of at most 500 results: every result becomes a row with its place."""
    page = F.concat_ws("#", "query", F.floor(F.col("seq") / 500).cast("string"))
    items = _responses(spark, sf_dir).withColumn("query", page).groupBy("query").agg(F.array_sort(F.collect_list(F.struct("seq", "item"))).alias("found"))
    body = F.concat(F.lit('{"results":['), F.array_join(F.transform("found", lambda x: x["item"]), ","), F.lit("]}"))
    answers = items.select(F.lit(0).alias("query_ordinal"), F.lit("t").alias("search_topic"), "query", body.alias("body"))
    out = works.project(works.from_responses(answers))
    return out.groupBy("query").agg(F.count("*").alias("n"), F.max("seq.rank").cast("long").alias("last_rank"), F.countDistinct("paper_id").alias("n_ids"))


@_query("SELECT seq, title, published_date FROM p WHERE published_date >= '2021-03-01' AND published_date <= '2023-12-31'")
def s2_date_filter(spark, sf_dir):
    return works.in_dates(_papers(spark, sf_dir), "2021-03-01", "2023-12-31").select("seq", "title", "published_date")


def _feeds(spark, sf_dir) -> DataFrame:
    link = lambda title, href: F.struct(F.lit(title).alias("_title"), href.alias("_href"))
    links = F.when(F.col("seq") % 3 == 0, F.array(link("doi", F.lit("10.0/old")), link("pdf", F.lit("x")), link("doi", F.col("paper_id")))).otherwise(F.array(link("pdf", F.lit("x"))))
    entry = F.struct(
        F.concat(F.lit("http://a.org/abs/"), F.col("seq").cast("string"), F.lit("v2/")).alias("id"),
        F.col("published_date").alias("published"),
        F.lit("2024").alias("updated"),
        F.col("title"),
        F.col("abstract").alias("summary"),
        F.array(F.struct(F.col("authors").alias("name")), F.struct(F.lit("B").alias("name"))).alias("author"),
        links.alias("link"),
    )
    body = F.to_xml(F.struct(F.array(entry).alias("entry")), {"rowTag": "feed"})
    asked = F.concat(F.col("title"), F.lit(" "), F.col("paper_id"))
    return _papers(spark, sf_dir).select(F.col("seq").cast("int").alias("query_ordinal"), "search_topic", "query", asked.alias("asked"), body.alias("body"))


@_query(
    f"""SELECT cast(seq as bigint) AS seq, 'arxiv:' || seq || 'v2' AS paper_id, {_clean('title')} AS title, authors || ', B' AS authors, try_cast(substr(published_date, 1, 4) as int) AS year,
    coalesce(published_date, '') AS published_date, '2024' AS updated_date, {_clean('abstract')} AS abstract, 'http://a.org/abs/' || seq || 'v2/' AS url,
    CASE WHEN seq % 3 = 0 THEN paper_id ELSE '' END AS doi, seq || 'v2' AS arxiv_id, query FROM p"""
)
def p6_feed_projection(spark, sf_dir):
    out = feed.project(_feeds(spark, sf_dir)).drop("source", "venue", "search_topic")
    return out.withColumn("seq", F.col("seq.query_ordinal").cast("long"))


@_query("SELECT seq, '' AS manual_decision, title AS notes FROM p")
def p7_default_columns(spark, sf_dir):
    out = triage.with_manual_columns(_papers(spark, sf_dir).withColumn("notes", F.nullif("title", F.lit(""))))
    return out.select("seq", "manual_decision", "notes")


# --- query texts and lists

_RAW = "CASE WHEN doc_id % 3 = 0 THEN '\"' || split_part(text, chr(10), 1) || '\" ' || text || ' ' || source WHEN doc_id % 3 = 1 THEN text ELSE lang || ' \"a b\" \"\" \" \" ' || text END"
_FEED_SQL = f"""WITH q AS (SELECT doc_id, {_RAW} AS q FROM documents),
x AS (SELECT doc_id, q, list_concat(
  list_transform(list_filter(list_transform(regexp_extract_all(q, '"([^"]+)"', 1), lambda s: {_strip('s')}), lambda s: s <> ''), lambda s: 'all:"' || s || '"'),
  list_transform(list_filter(regexp_split_to_array(regexp_replace(q, '"[^"]+"', ' ', 'g'), '{SPACE_CLASS}+'), lambda s: s <> ''), lambda s: 'all:' || s)) AS parts FROM q)
SELECT doc_id, CASE WHEN len(parts) > 0 THEN array_to_string(parts, ' AND ') ELSE 'all:' || q END AS compiled FROM x"""


@_query(_FEED_SQL)
def s4_query_compile(spark, sf_dir):
    q = _docs(spark, sf_dir).select("doc_id", F.expr(_RAW).alias("q"))
    return q.select("doc_id", nested.feed_query(F.col("q")).alias("compiled"))


@_query("SELECT page_id, list_extract(string_split(rtrim(url, '/'), '/'), -1) AS id FROM pages")
def s6_id_extract(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", nested.last_segment(F.col("url")).alias("id"))


@_query("WITH r AS (SELECT lang, source, min(doc_id) AS first FROM documents GROUP BY 1, 2) SELECT lang AS topic, source AS query, row_number() OVER (PARTITION BY lang ORDER BY first) - 1 AS query_idx FROM r")
def s8_query_flatten(spark, sf_dir):
    first = _docs(spark, sf_dir).groupBy("lang", "source").agg(F.min("doc_id").alias("first"))
    topics = first.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("first", "source"))).alias("q"))
    topics = topics.select(F.lit(0).alias("topic_idx"), F.col("lang").alias("topic"), F.transform("q", lambda x: x["source"]).alias("queries"))
    return tables.flatten_queries(topics).select("topic", "query", F.col("query_idx").cast("long").alias("query_idx"))


@_query("SELECT 0 AS scan, 'all' AS search_topic, paper_id, venue, seq FROM p UNION ALL SELECT 1, 'no venue', paper_id, NULL, seq FROM p")
def s9_union_scan(spark, sf_dir):
    """Two scans of every row, of which one lacks a column."""
    p = _papers(spark, sf_dir)
    both = tables.union_scans([("all", p), ("no venue", p.drop("venue"))])
    return both.select(F.col("seq.scan").alias("scan"), "search_topic", "paper_id", "venue", F.col("seq.rank").alias("seq"))


@_query(
    f"""SELECT cast(seq as int) AS query_ordinal, 0 AS rank, search_topic, 'arxiv:' || seq || 'v2' AS paper_id, {_clean('title')} AS title, {_clean('abstract')} AS abstract, authors || ', B' AS authors,
    coalesce(published_date, '') AS published_date, title || ' ' || paper_id AS query FROM p"""
)
def s3_feed_scan(spark, sf_dir):
    """The feed asked by the queries of a table, one a paper, and answered by what was captured: each answer lies under the address that the live reader would ask, which the
    plan has to arrive at by its own expressions."""
    options = {"max_results": 10}

    @F.pandas_udf("string")
    def address(queries: pd.Series) -> pd.Series:
        return queries.map(lambda q: url_of(feed.BASE_URL, feed.request_parameters(q, options)))

    ship(spark)
    asked = F.concat(F.col("title"), F.lit(" "), F.col("paper_id"))
    queries = _papers(spark, sf_dir).select(F.col("seq").alias("query_ordinal"), "search_topic", asked.alias("query"))
    captured = _feeds(spark, sf_dir).select(address("asked").alias("url"), "body")
    found = feed.replay(queries, captured, options)
    return found.select("seq.query_ordinal", "seq.rank", "search_topic", "paper_id", "title", "abstract", "authors", "published_date", "query")


# --- scores


@_query(f"SELECT seq, cast({_terms_sql('lower(coalesce(abstract, ' + chr(39) * 2 + '))', TERMS.topics[0].terms)} as bigint) AS score FROM p")
def c1_term_score(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", scoring.term_score(F.lower(text.to_text("abstract")), TERMS.topics[0].terms).alias("score"))


@_query(f"SELECT seq, {_TOPICS} FROM p")
def c2_topic_scores(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", *(scoring.topic_score(t.terms, SCORES).alias(f"s{i}") for i, t in enumerate(TERMS.topics)))


@_query(f"{_WITH}, t AS (SELECT seq, {_TOPICS} FROM p) " + " UNION ALL ".join(f"SELECT seq, {i} AS topic_idx, '{t.key}' AS topic, s{i} AS score FROM t" for i, t in enumerate(TERMS.topics)))
def c2_topic_scores_relational(spark, sf_dir):
    return scoring.topic_scores_relational(_papers(spark, sf_dir), TERMS, SCORES).select("seq", "topic_idx", "topic", "score")


@_query(f"{_WS} SELECT seq, topic, topic_label, topic_score FROM scored")
def c3_best_topic(spark, sf_dir):
    return _scored(spark, sf_dir).select("seq", "topic", "topic_label", "topic_score")


@_query(f"SELECT seq, cast({_terms_sql(_ALL, TERMS.generic)} as bigint) AS generic FROM p")
def c4_generic(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", scoring.generic_score(TERMS.generic, SCORES).alias("generic"))


@_query("SELECT seq, 'out_of_scope' AS topic, 0e0 AS topic_score, 0e0 AS generic_priority_score, 0e0 AS triage_score FROM p")
def c5_out_of_scope(spark, sf_dir):
    none = testviews.SearchTerms.of({"topics": {"x": {"topic_terms": {"§§": 5}}, "y": {"topic_terms": {"the": -1}}}, "generic_priority_terms": {"ing": 3}})
    return scoring.score(_papers(spark, sf_dir), none, SCORES).select("seq", "topic", "topic_score", "generic_priority_score", "triage_score")


@_query(f"SELECT seq, {_BONUS} AS bonus FROM p")
def c6_bonuses(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", scoring.bonuses(SCORES).alias("bonus"))


@_query(f"SELECT seq, {_PENALTY} AS penalty FROM p")
def c7_penalties(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", scoring.penalties(SCORES).alias("penalty"))


@_query(f"SELECT seq, round({_CITED}, 6) AS bonus FROM p")
def c8_citation_bonus(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", F.round(scoring.citation_bonus(SCORES), 6).alias("bonus"))


@_query("SELECT seq, round(greatest(n / 7e0 - 3e0, 0e0), 3) AS x FROM (SELECT seq, coalesce(citation_count, 0) AS n FROM p)")
def c9_clamp_round(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", F.round(F.greatest(F.coalesce("citation_count", F.lit(0)) / 7 - 3, F.lit(0.0)), 3).alias("x"))


@_query(f"{_WS} SELECT seq, topic, topic_label, topic_score, generic_priority_score, triage_score, triage_score AS relevance_score FROM scored")
def c10_triage_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("seq", "topic", "topic_label", "topic_score", "generic_priority_score", "triage_score", "relevance_score")


@_query(f"SELECT seq, CASE {_strip('lower(llm_priority)')} WHEN 'read' THEN 0 WHEN 'skim' THEN 1 ELSE 2 END AS rank FROM p")
def c11_priority_rank(spark, sf_dir):
    return _papers(spark, sf_dir).select("seq", scoring.priority_rank("llm_priority").alias("rank"))


# --- filters


@_query(f"{_WS} SELECT seq, triage_score FROM scored WHERE triage_score >= 30")
def f1_min_score(spark, sf_dir):
    return _scored(spark, sf_dir).where(filters.scores_at_least(30)).select("seq", "triage_score")


@_query(f"SELECT seq FROM p WHERE {_ALLOWED}")
def f2_repository_policy(spark, sf_dir):
    return _papers(spark, sf_dir).where(filters.repository_allowed(CONFIG)).select("seq")


@_query(f"SELECT seq, score_text FROM p WHERE {_number('score_text')} >= 30")
def f3_prune(spark, sf_dir):
    table = _papers(spark, sf_dir).withColumn("relevance_score", F.col("score_text"))
    return filters.drop_low_scores(table, CONFIG).select("seq", "score_text")


@_query(f"{_WS} SELECT seq, triage_score >= 40 AS candidate FROM scored")
def f4_llm_candidates(spark, sf_dir):
    cfg = testviews.Config.of({"output_dir": "o", "sota_table_path": "t", "ollama": {"classify_min_triage_score": 40}})
    return _scored(spark, sf_dir).select("seq", filters.triage_candidate(cfg).alias("candidate"))


@_query(f"SELECT seq FROM p WHERE {_strip('lower(llm_priority)')} IN ('read', 'skim')")
def f5_deep_candidates(spark, sf_dir):
    return _papers(spark, sf_dir).where(filters.has_priority(CONFIG.deep.only_priorities)).select("seq")


@_query(f"SELECT seq, title FROM p WHERE {_strip('lower(llm_priority)')} IN ('read', 'skim')")
def f6_recommended(spark, sf_dir):
    return report.recommended(_papers(spark, sf_dir)).select("seq", "title")


@_query(f"SELECT seq, {_strip('deep_summary')} <> '' OR {_strip('deep_reading_notes')} <> '' AS has_deep FROM p")
def f8_any_deep(spark, sf_dir):
    p = _papers(spark, sf_dir)
    return p.select("seq", filters.has_deep_analysis(p.columns).alias("has_deep"))


# --- deduplication and merge


@_query(f"SELECT seq, {_KEY} AS key FROM p")
def d1_dedup_key(spark, sf_dir):
    p = _papers(spark, sf_dir)
    return p.select("seq", dedup.dedup_key(p.columns).alias("key"))


_UNIQUE = f"u AS (SELECT * FROM (SELECT *, {_KEY} AS k, row_number() OVER (PARTITION BY {_KEY} ORDER BY seq) AS place FROM p) WHERE place = 1 AND k <> '')"


@_query(f"{_WITH}, {_UNIQUE} SELECT seq, title, query FROM u")
def d2_keep_first(spark, sf_dir):
    return dedup.keep_first(_papers(spark, sf_dir)).select("seq", "title", "query")


_MERGED = f"m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY seq % 4 <> 1, seq) AS place FROM p) WHERE place = 1)"


@_query(f"{_WITH}, {_MERGED} SELECT seq, title, CASE WHEN seq % 4 = 1 THEN 'by hand' END AS notes, CASE WHEN seq % 4 <> 1 THEN venue END AS venue FROM m")
def d3_merge_existing(spark, sf_dir):
    p = _papers(spark, sf_dir)
    existing, new = p.where("seq % 4 = 1").withColumn("notes", F.lit("by hand")).drop("venue"), p.where("seq % 4 <> 1")
    return dedup.merge(existing, new).select("seq", "title", "notes", "venue")


@_query("SELECT seq, CASE WHEN seq % 2 = 0 THEN title END AS title, CASE WHEN seq % 2 = 1 THEN venue END AS venue FROM p")
def d4_schema_union(spark, sf_dir):
    p = _papers(spark, sf_dir)
    return dedup.schema_union(p.where("seq % 2 = 0").select("seq", "title"), p.where("seq % 2 = 1").select("seq", "venue"))


# --- orders, caps, ordinals

_TABLE_ORDER = "triage_score DESC NULLS LAST, published_date DESC NULLS LAST, seq"


@_query(f"{_WS} SELECT seq, cast(row_number() OVER (ORDER BY {_TABLE_ORDER}) as int) AS place FROM scored")
def o1_table_sort(spark, sf_dir):
    """The scores are written, as a table has them, before they are ranked."""
    folder = scratch(spark, "scores")
    _scored(spark, sf_dir).select("seq", "relevance_score", "published_date").write.mode("overwrite").parquet(folder)
    s = spark.read.parquet(folder)
    return order.with_ordinal(s, order.table_keys(s), "place").select("seq", F.col("place").cast("int").alias("place"))


_RANK = f"CASE {_strip('lower(llm_priority)')} WHEN 'read' THEN 0 WHEN 'skim' THEN 1 ELSE 2 END"
_REPORT_ORDER = f"{_RANK}, {_number('triage_score')} DESC, published_date DESC NULLS LAST, seq"


@_query(f"{_WITH}, r AS (SELECT *, score_text AS triage_score FROM p) SELECT seq, cast(row_number() OVER (ORDER BY {_REPORT_ORDER}) as int) AS place FROM r")
def o2_report_order(spark, sf_dir):
    p = _papers(spark, sf_dir).withColumn("triage_score", F.col("score_text"))
    return order.with_ordinal(p, order.report_keys(p), "place").select("seq", F.col("place").cast("int").alias("place"))


@_query("SELECT doc_id, array_to_string(list_sort(string_split(" + _clean("text") + ", ' ')), ' ') AS sorted_words FROM documents")
def o3_stable_sort(spark, sf_dir):
    words = F.split(text.clean_text("text"), " ")
    placed = F.array_sort(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    return _docs(spark, sf_dir).select("doc_id", F.array_join(F.transform(placed, lambda x: x["w"]), " ").alias("sorted_words"))


@_query("SELECT query, seq, rank FROM (SELECT query, seq, cast(row_number() OVER (PARTITION BY query ORDER BY published_date DESC NULLS LAST, seq) as int) AS rank FROM p) WHERE rank <= 25")
def o4_topk_per_query(spark, sf_dir):
    return order.top_per_query(_papers(spark, sf_dir), 25).select("query", "seq", "rank")


@_query(f"{_WS} SELECT seq FROM scored WHERE triage_score >= 40 ORDER BY seq LIMIT 50")
def o5_first_n_cap(spark, sf_dir):
    return order.first_n(_scored(spark, sf_dir), filters.scores_at_least(40), 50)


@_query(f"SELECT seq FROM p WHERE {_strip('lower(llm_priority)')} IN ('read', 'skim') ORDER BY seq LIMIT 20")
def o6_deep_cap(spark, sf_dir):
    return order.first_n(_papers(spark, sf_dir), filters.has_priority(("read", "skim")), 20)


@_query("SELECT seq, cast(row_number() OVER (ORDER BY published_date DESC NULLS LAST, seq) as int) AS ordinal FROM p")
def o7_ordinal(spark, sf_dir):
    return order.with_ordinal(_papers(spark, sf_dir), [order.Key("published_date", descending=True), order.Key("seq")]).select("seq", "ordinal")


# --- aggregates


@_query("SELECT coalesce(topic_label, 'Unknown') AS label, count(*) AS n, min(seq) AS first FROM p GROUP BY 1")
def a1_topic_counts(spark, sf_dir):
    return aggregates.counts_by(_papers(spark, sf_dir), "topic_label")


@_query("SELECT coalesce(llm_relevance, 'Unknown') AS label, count(*) AS n, min(seq) AS first FROM p GROUP BY 1")
def a2_relevance_counts(spark, sf_dir):
    return aggregates.counts_by(_papers(spark, sf_dir), "llm_relevance")


@_query(f"SELECT count(*) AS n_total, count(*) FILTER ({_RANK} = 0) AS n_read, count(*) FILTER ({_RANK} = 1) AS n_skim FROM p")
def a3_conditional_counts(spark, sf_dir):
    return aggregates.priority_counts(_papers(spark, sf_dir))


@_query(f"{_WITH}, {_UNIQUE} SELECT (SELECT count(*) FROM p) AS n_raw, (SELECT count(*) FROM u) AS n_unique, (SELECT count(*) FROM u WHERE {_ALLOWED}) AS n_kept")
def a4_run_counts(spark, sf_dir):
    raw = _papers(spark, sf_dir)
    unique = dedup.keep_first(raw)
    return aggregates.run_counts(raw, unique, unique.where(filters.repository_allowed(CONFIG)))


@_query(f"SELECT query, bool_or({_strip('deep_summary')} <> '') AS any_deep FROM p GROUP BY query")
def a5_any(spark, sf_dir):
    p = _papers(spark, sf_dir)
    return p.groupBy("query").agg(aggregates.any_text(p, "deep_summary").alias("any_deep"))


@_query(f"SELECT {_PAGE} AS query, string_agg(title, chr(10) ORDER BY seq) AS titles FROM p GROUP BY 1")
def a6_ordered_concat(spark, sf_dir):
    """By source and page of 500, as a group's texts become one."""
    page = F.concat_ws("#", "query", F.floor(F.col("seq") / 500).cast("string"))
    return _papers(spark, sf_dir).groupBy(page.alias("query")).agg(aggregates.concat_ordered("title", "seq").alias("titles"))


@_query("SELECT seq, greatest(length(title), coalesce(citation_count, 0)) AS most, least(length(title), coalesce(citation_count, 0)) AS least FROM p")
def a7_greatest_least(spark, sf_dir):
    n, m = F.length("title").cast("long"), F.coalesce("citation_count", F.lit(0))
    return _papers(spark, sf_dir).select("seq", F.greatest(n, m).alias("most"), F.least(n, m).alias("least"))


# --- language-model stages and report


def _prompt_sql(fields, task, present, value) -> str:
    shown = " || ".join(f"'{t}:' || chr(10) || " + (value(c) if c in present else "''") + " || chr(10) || chr(10)" for t, c in fields)
    return f"'Paper metadata:' || chr(10) || chr(10) || {shown} || '{task}'"


_PRESENT = ("title", "abstract", "authors", "venue", "venue_type", "openalex_type", "query", "topic_label", "doi", "url", "year", "llm_priority", "llm_relevance")
_L1_SQL = _prompt_sql(prompts.TRIAGE_FIELDS, prompts.TRIAGE_TASK, _PRESENT, lambda c: f"coalesce(cast({c} as varchar), '')")
_L6_SQL = _prompt_sql(prompts.DEEP_FIELDS, prompts.DEEP_TASK, _PRESENT, lambda c: _strip(c))


@_query(f"SELECT seq, {_L1_SQL} AS prompt FROM p")
def l1_triage_prompt(spark, sf_dir):
    p = _papers(spark, sf_dir)
    return p.select("seq", prompts.triage_prompt(p.columns).alias("prompt"))


@_query(f"SELECT seq, {_L6_SQL} AS prompt FROM p")
def l6_deep_prompt(spark, sf_dir):
    p = _papers(spark, sf_dir)
    return p.select("seq", prompts.deep_prompt(p.columns).alias("prompt"))


class _Lengths:
    """Replies that SQL can state too: broken for some lengths of the prompt, no answer for others."""

    def chat(self, system: str, user: str, schema: dict) -> str:
        n = len(user)
        if n % 7 == 0:
            return f"not json {n}"
        if n % 7 == 1:
            return "[1]"
        if n % 7 == 2:
            raise stage.ClientError("down")
        first = next(iter(schema["properties"]))
        last = list(schema["properties"])[-1]
        return f'{{"{first}": "read", "unknown": 1, "llm_key_terms": ["a", "b{n}"], "deep_datasets": ["d", "e"], "{last}": 0.5}}'


_BAD = "'Failed to parse Ollama JSON output: ' || CASE WHEN n % 7 = 0 THEN 'not json ' || n ELSE '[1]' END"
_L3 = f"""SELECT seq, CASE WHEN n % 7 IN (0, 1) THEN 'ignore' WHEN n % 7 = 2 THEN 'error' ELSE 'read' END AS llm_priority,
  CASE WHEN n % 7 IN (0, 1) THEN 'not_relevant' WHEN n % 7 = 2 THEN 'unknown' END AS llm_relevance,
  CASE WHEN n % 7 IN (0, 1) THEN {_BAD} WHEN n % 7 = 2 THEN 'Ollama request failed: down' END AS llm_reason,
  CASE WHEN n % 7 < 3 THEN '' ELSE 'a, b' || n END AS llm_key_terms, CASE WHEN n % 7 < 2 THEN false END AS llm_is_dataset_or_benchmark,
  CASE WHEN n % 7 < 3 THEN 0e0 ELSE 0.5e0 END AS llm_confidence FROM (SELECT seq, length({_L1_SQL}) AS n FROM p)"""


@_query(_L3)
def l3_parse_fallback(spark, sf_dir):
    p = _papers(spark, sf_dir)
    out = stage.call(p, prompts.triage_prompt(p.columns), "", prompts.triage_schema(("other",)), _Lengths(), TRIAGE, stage.triage_fallback, stage.triage_error)
    return out.select("seq", "llm_priority", "llm_relevance", "llm_reason", "llm_key_terms", "llm_is_dataset_or_benchmark", "llm_confidence")


@_query(_L3)
def l2_calls_once(spark, sf_dir):
    p = _papers(spark, sf_dir)
    folder = scratch(spark, "ledger")
    out = stage.call_once(p, prompts.triage_prompt(p.columns), "", prompts.triage_schema(("other",)), _Lengths(), TRIAGE, stage.triage_fallback, stage.triage_error, folder)
    return out.select("seq", "llm_priority", "llm_relevance", "llm_reason", "llm_key_terms", "llm_is_dataset_or_benchmark", "llm_confidence")


@_query(
    f"""SELECT seq, CASE WHEN n % 7 < 3 THEN '' ELSE 'read' END AS deep_summary, CASE WHEN n % 7 < 3 THEN '' ELSE 'd, e' END AS deep_datasets,
    CASE WHEN n % 7 < 2 THEN {_BAD} WHEN n % 7 = 2 THEN 'Deep Ollama request failed: down' END AS deep_reading_notes, CASE WHEN n % 7 < 3 THEN 0e0 ELSE 0.5e0 END AS deep_confidence
    FROM (SELECT seq, length({_L6_SQL}) AS n FROM p)"""
)
def l8_deep_fallback(spark, sf_dir):
    p = _papers(spark, sf_dir)
    out = stage.call(p, prompts.deep_prompt(p.columns), "", prompts.deep_schema(), _Lengths(), DEEP, stage.deep_fallback, stage.deep_error)
    return out.select("seq", "deep_summary", "deep_datasets", "deep_reading_notes", "deep_confidence")


@_query(f"{_WITH}, {_SCORED}, c AS (SELECT seq FROM scored WHERE triage_score >= 40 ORDER BY seq LIMIT 50) SELECT scored.seq, c.seq IS NOT NULL AS called FROM scored LEFT JOIN c ON scored.seq = c.seq")
def l5_triage_stub(spark, sf_dir):
    cfg = testviews.Config.of({"output_dir": "o", "sota_table_path": "t", "ollama": {"enabled": True, "classify_min_triage_score": 40, "max_papers_per_run": 50}}).triage
    p = _scored(spark, sf_dir).drop("llm_priority", "llm_relevance")
    out = stage.triage(p, cfg, StubClient(), "", scratch(spark, "replies"))
    return out.select("seq", F.col("llm_priority").isNotNull().alias("called"))


@_query("SELECT seq, deep_summary, deep_reading_notes, cast(NULL as varchar) AS deep_method, cast(NULL as double) AS deep_confidence FROM p")
def l9_deep_defaults(spark, sf_dir):
    return stage.with_deep_columns(_papers(spark, sf_dir)).select("seq", "deep_summary", "deep_reading_notes", "deep_method", "deep_confidence")


@_query(
    f"{_WITH}, c AS (SELECT seq FROM p WHERE {_strip('lower(llm_priority)')} IN ('read', 'skim') ORDER BY seq LIMIT 20) SELECT p.seq, c.seq IS NOT NULL AS called FROM p LEFT JOIN c ON p.seq = c.seq"
)
def l10_deep_stub(spark, sf_dir):
    cfg = testviews.Config.of({"output_dir": "o", "sota_table_path": "t", "ollama_deep_analysis": {"enabled": True, "max_papers_per_run": 20}}).deep
    out = stage.deep(_papers(spark, sf_dir), cfg, StubClient(), "", scratch(spark, "replies"))
    return out.select("seq", F.col("deep_confidence").isNotNull().alias("called"))


def _cell(c: str) -> str:
    return _strip(c) if c in _CELLS else "''"


_CELLS = (*_PRESENT, "published_date", "triage_score", "deep_summary", "deep_reading_notes")


def _line(title: str, c: str) -> str:
    return f"CASE WHEN {_cell(c)} <> '' THEN '**{title}:** ' || {_cell(c)} END"


_NL2 = "chr(10) || chr(10)"
_BLOCK = (
    f"concat_ws({_NL2}, '### ' || ordinal || '. ' || {_cell('title')}, nullif(concat_ws(chr(10), {', '.join(_line(*x) for x in report.META)}), ''), "
    + "concat_ws('  ' || chr(10), " + ", ".join(f"'**{t}:** {q}' || {_cell(c)} || '{q}'" for t, c, q in report.STANZA) + "), "
    + ", ".join(_line(*x) for x in report.FAST if x[1] in _CELLS or True)
    + f", CASE WHEN {_cell('deep_summary')} <> '' OR {_cell('deep_reading_notes')} <> '' THEN concat_ws({_NL2}, '#### Deep analysis', {', '.join(_line(*x) for x in report.DEEP)}) END, "
    + f"coalesce({_line('DOI', 'doi')}, {_line('URL', 'url')}))"
)
_RECOMMENDED = f"""r AS (SELECT *, score_text AS triage_score FROM p WHERE {_RANK} < 2),
q AS (SELECT *, row_number() OVER (ORDER BY {_REPORT_ORDER}) AS ordinal FROM r), blocks AS (SELECT ordinal, {_BLOCK} AS block FROM q)"""


def _reported(spark, sf_dir) -> DataFrame:
    return _papers(spark, sf_dir).withColumn("triage_score", F.col("score_text"))


@_query(f"{_WITH}, {_RECOMMENDED} SELECT cast(ordinal as int) AS ordinal, block FROM blocks")
def r1_paper_block(spark, sf_dir):
    p = _reported(spark, sf_dir)
    rows = order.with_ordinal(report.recommended(p), order.report_keys(p))
    return rows.select(F.col("ordinal").cast("int").alias("ordinal"), report.paper_block(rows.columns).alias("block"))


def _counts_sql(section: int, title: str, column: str) -> str:
    return f"""UNION ALL SELECT {section}, -2, '{title}' UNION ALL SELECT {section}, -1, '' UNION ALL SELECT {section}, 1 << 30, ''
    UNION ALL SELECT {section}, row_number() OVER (ORDER BY n DESC, f), '- ' || label || ': **' || n || '**' FROM (SELECT coalesce({column}, 'Unknown') AS label, count(*) AS n, min(ordinal) AS f FROM q GROUP BY 1)"""


_R2 = f"""{_WITH}, {_RECOMMENDED},
    h AS (SELECT count(*) AS n, count(*) FILTER ({_RANK} = 0) AS a, count(*) FILTER ({_RANK} = 1) AS b, bool_or({_cell('deep_summary')} <> '') AS d FROM r),
    lines AS (SELECT 0 AS section, unnest(range(0, 7)) AS place, unnest(['# Recommended Papers Summary', '', 'Total recommended papers: **' || n || '**', '- Read: **' || a || '**', '- Skim: **' || b || '**',
      '- Contains deep-analysis notes: **' || CASE WHEN d THEN 'yes' ELSE 'no' END || '**', '']) AS text FROM h
    {_counts_sql(1, '## Counts by topic', 'topic_label')} {_counts_sql(2, '## Counts by LLM relevance', 'llm_relevance')}
    UNION ALL SELECT 3, -2, '## Papers' UNION ALL SELECT 3, -1, '' UNION ALL SELECT 3, 2 * ordinal, block FROM blocks UNION ALL SELECT 3, 2 * ordinal + 1, chr(10) || '---' || chr(10) FROM blocks)
    SELECT section, cast(row_number() OVER (ORDER BY section, place) as int) AS line_no, text FROM lines"""


@_query(_R2)
def r2_report_lines(spark, sf_dir):
    return report.report_lines(_reported(spark, sf_dir))


@_query(f"SELECT unnest(string_split(regexp_replace(string_agg(text, chr(10) ORDER BY line_no), chr(10) || '$', ''), chr(10))) AS value FROM ({_R2})")
def m2_report_entry(spark, sf_dir):
    """The report's entry point, from a saved table to the file that it writes, a row a line; a line end at the end of the file begins none."""
    folder = scratch(spark, "report")
    cfg = testviews.Config.of({"output_dir": folder, "sota_table_path": f"{folder}/table", "recommended_summary_path": f"{folder}/report.md"})
    _reported(spark, sf_dir).write.parquet(cfg.sota_table_path)
    report.run(spark, cfg)
    return spark.read.text(cfg.recommended_summary_path, lineSep="\n")


_M1 = f"""{_WITH}, u0 AS (SELECT *, {_KEY} AS k FROM p WHERE seq % 4 <> 1),
    u AS (SELECT * EXCLUDE (k, place) FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq) AS place FROM u0 WHERE k <> '') WHERE place = 1),
    {_SCORED.replace('FROM p', 'FROM u')},
    kept AS (SELECT seq, doi, arxiv_id, url, title, topic, triage_score FROM scored WHERE triage_score >= 30 AND {_ALLOWED}),
    old AS (SELECT seq, doi, arxiv_id, url, title, 'by hand' AS topic, cast(seq % 100 as double) AS triage_score FROM p WHERE seq % 4 = 1),
    m AS (SELECT *, {_KEY} AS k, 0 AS side FROM old UNION ALL SELECT *, {_KEY}, 1 FROM kept)
    SELECT seq, title, topic, triage_score FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY side, seq) AS place FROM m) WHERE place = 1 AND triage_score >= 30"""


@_query(_M1)
def m1_pipeline(spark, sf_dir):
    """The triage pipeline from records to the next cumulative table, without the model stages: deduplicate, score, filter, merge into an
    existing table (a quarter of the papers, edited by hand), prune."""
    p = _papers(spark, sf_dir)
    _, kept = triage.score_and_filter(p.where("seq % 4 <> 1"), TERMS, CONFIG)
    old = p.where("seq % 4 = 1").withColumns({"topic": F.lit("by hand"), "triage_score": (F.col("seq") % 100).cast("double")})
    return triage.next_table(old, kept, CONFIG).select("seq", "title", "topic", "triage_score")


@_query(
    _M1.replace("m AS (SELECT *,", "called AS (SELECT seq FROM kept ORDER BY seq LIMIT 40), m AS (SELECT *,").replace(
        "SELECT seq, title, topic, triage_score FROM (", "SELECT seq, title, topic, triage_score, seq IN (SELECT seq FROM called) AS triaged FROM ("
    )
)
def m1_pipeline_with_models(spark, sf_dir):
    """The pipeline's entry point with both model stages, which a stub answers: from records to the saved table."""
    folder = scratch(spark, "pipeline")
    p = _papers(spark, sf_dir).drop("llm_priority", "llm_relevance", "deep_summary", "deep_reading_notes")
    made = {"output_dir": folder, "sota_table_path": f"{folder}/table", "min_triage_score": 30, "drop_existing_below_min_score": True, "include_repositories": False}
    cfg = testviews.Config.of(made | {"ollama": {"enabled": True, "max_papers_per_run": 40}, "ollama_deep_analysis": {"enabled": True, "max_papers_per_run": 10}})
    old = p.where("seq % 4 = 1").withColumns({"topic": F.lit("by hand"), "triage_score": (F.col("seq") % 100).cast("double")})
    old.write.parquet(cfg.sota_table_path)
    triage.run(spark, cfg, TERMS, p.where("seq % 4 <> 1"), StubClient(), ("", ""))
    return tables.read_table(spark, cfg.sota_table_path).select("seq", "title", "topic", "triage_score", F.col("llm_priority").isNotNull().alias("triaged"))
