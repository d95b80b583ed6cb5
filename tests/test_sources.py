import datetime

import pytest

from pyspark.sql import functions as F

from inkmill.functions.nested import feed_query
from inkmill.sources import feed, works
from inkmill.sources.http import HttpError, fetch_once, fetch_patiently, url_of
from inkmill.sources.lanes import lanes, paced
from inkmill.sources.tables import flatten_queries, union_scans

from fake_http import FEED, Script


def test_works_scan(spark):
    found = works.scan(spark, [(0, "t1", "first"), (1, "t2", "none")], {"fetcher": "fake_http:works", "sleep_seconds": 0, "max_results": 5})
    full, bare = (r.asDict() for r in found.orderBy("seq").collect())
    assert full["title"] == "A title" and full["authors"] == "Ann, Bob" and full["abstract"] == "we test what we" and full["has_abstract"]
    assert (full["venue"], full["venue_type"], full["url"], full["doi"], full["citation_count"], full["search_topic"], full["query"]) == ("Conf", "conference", "https://doi.org/10.1/x", "https://doi.org/10.1/x", 7, "t1", "first")
    assert (full["paper_id"], full["source"], full["is_repository"], full["openalex_type"], full["openalex_crossref_type"], full["arxiv_id"]) == ("openalex:https://o/W1", "openalex", False, "article", "journal-article", "")
    assert (bare["url"], bare["doi"], bare["venue"], bare["year"], bare["has_abstract"], bare["citation_count"], bare["authors"], bare["published_date"]) == ("https://o/W2", "", "", None, False, 0, "", "")
    assert [tuple(r["seq"]) for r in found.orderBy("seq").collect()] == [(0, 0), (0, 1)]
    with pytest.raises(Exception, match="status 500"):
        works.scan(spark, [(0, "t", "broken")], {"fetcher": "fake_http:works", "sleep_seconds": 0}).collect()


def test_captured_answers(spark):
    body = '{"results": [{"id": "a"}, {"id": "b", "title": null}], "meta": {}}'
    raw = works.from_responses(spark.createDataFrame([(0, "t", "q", body), (1, "t", "q", "{}")], "query_ordinal int, search_topic string, query string, body string"))
    assert [r["openalex_id"] for r in works.project(raw).orderBy("seq").collect()] == ["a", "b"]


def test_request_of_a_works_query():
    today = datetime.date.today().isoformat()
    assert works.date_filter() == f"to_publication_date:{today}"
    assert works.date_filter("2024-01-01", "2024-02-01") == "from_publication_date:2024-01-01,to_publication_date:2024-02-01"
    asked = works.request_parameters("a b", {"mailto": "m@x", "max_results": "7"})
    assert asked == {"search": "a b", "per-page": "7", "sort": "publication_date:desc", "filter": f"to_publication_date:{today}", "mailto": "m@x"}
    assert url_of("http://x", {"q": "a b~*"}) == "http://x?q=a+b~%2A"


def test_dates_of_rows(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-06-01",), ("2999-01-01",), (None,)], "published_date string")
    assert [r[0] for r in works.in_dates(df, "2024-02-01").collect()] == ["2024-06-01"]
    assert works.in_dates(df, None, "2999-12-31").count() == 3


def test_date_filters_go_into_the_request(spark):
    def asked(keeps, **options):
        found = keeps(works.scan(spark, [(0, "t", "q")], {"fetcher": "fake_http:dated_works", "sleep_seconds": 0} | options))
        rows = found.select("title", "openalex_id", "published_date").collect()
        plan = found.select("title", "openalex_id")._jdf.queryExecution().executedPlan().toString()
        return {r[0] for r in rows}, [r[1] for r in rows], "Filter (" in plan

    today = datetime.date.today().isoformat()
    assert asked(lambda df: df) == ({f"to_publication_date:{today}"}, ["W0", "W1", "W2", "W3", "W4"], False)
    assert asked(lambda df: works.in_dates(df, "2024-02-01", "2024-03-31")) == ({"from_publication_date:2024-02-01,to_publication_date:2024-03-31"}, ["W1", "W2"], False)
    assert asked(lambda df: works.in_dates(df, "2024-02-01")) == ({f"from_publication_date:2024-02-01,to_publication_date:{today}"}, ["W0", "W1", "W2"], False)
    # options and filters: the tighter bound of each side
    within = {"from_publication_date": "2024-03-01", "to_publication_date": "2024-04-30"}
    assert asked(lambda df: works.in_dates(df, "2024-01-01", "2024-03-31"), **within)[0] == {"from_publication_date:2024-03-01,to_publication_date:2024-03-31"}
    # a bound without equality narrows the request, Spark does the rest; so it does with what is no whole date
    day = F.col("published_date")
    assert asked(lambda df: df.where((day > "2024-02-01") & (day < "2024-05-01"))) == ({"from_publication_date:2024-02-01,to_publication_date:2024-05-01"}, ["W1"], True)
    assert asked(lambda df: df.where(day == "2024-02-01")) == ({"from_publication_date:2024-02-01,to_publication_date:2024-02-01"}, ["W2"], False)
    assert asked(lambda df: df.where((day >= "2024") & (F.col("openalex_id") != "W0"))) == ({f"to_publication_date:{today}"}, ["W1", "W2"], True)
    assert asked(lambda df: df.where((day >= "2024-05-01") | (day < "2024-01-01"))) == ({f"to_publication_date:{today}"}, ["W0", "W3", "W4"], True)
    # an empty date is the smallest text, as it is for a filter of Spark's
    assert asked(lambda df: df.where(day <= "1999-01-01")) == ({"to_publication_date:1999-01-01"}, ["W4"], False)


def test_date_filters_where_the_session_takes_none(spark):
    before = spark.conf.get(works.PUSHDOWN)
    spark.conf.set(works.PUSHDOWN, "false")
    try:
        found = works.in_dates(works.scan(spark, [(0, "t", "q")], {"fetcher": "fake_http:dated_works", "sleep_seconds": 0}), "2024-02-01", "2024-03-31")
        assert [r[0] for r in found.select("openalex_id").collect()] == ["W1", "W2"]
    finally:
        spark.conf.set(works.PUSHDOWN, before)


def test_feed_scan(spark):
    found = feed.scan(spark, [(3, "t", '"a b" c')], {"fetcher": "fake_http:feed", "sleep_seconds": 0})
    one, two = (r.asDict() for r in found.orderBy("seq").collect())
    assert (one["paper_id"], one["title"], one["authors"], one["year"], one["doi"], one["abstract"]) == ("arxiv:2401.00001v2", "One title", "Ann, Bob", 2024, "http://d/new", "Text & more")
    assert (one["published_date"], one["updated_date"], one["url"], one["venue"], one["source"]) == ("2024-01-02T03:04:05Z", "2024-02-01T00:00:00Z", "http://a.org/abs/2401.00001v2", "", "arxiv")
    assert (two["arxiv_id"], two["authors"], two["year"], two["doi"], two["published_date"]) == ("9901001", "", None, "", "")
    assert feed.request_parameters('"a b" c', {})["search_query"] == 'all:"a b" AND all:c'
    assert FEED.startswith("<?xml")


def test_retries():
    s = Script("down", (429, {"Retry-After": "7"}, ""), (429, {}, ""), (503, {}, ""), (200, {}, "ok"))
    assert fetch_patiently("u", agent="me", fetch=s.fetch, sleep=s.waits.append) == "ok"
    assert s.waits == [60, 7, 180, 240] and set(s.agents) == {"me"}
    s = Script(*["down"] * 5)
    with pytest.raises(RuntimeError):
        fetch_patiently("u", fetch=s.fetch, sleep=s.waits.append)
    assert s.waits == [60, 120, 180, 240, 300]
    s = Script((302, {}, ""), (429, {"Retry-After": "Wed"}, ""), (200, {}, "ok"))
    assert fetch_patiently("u", fetch=s.fetch, sleep=s.waits.append) == "ok" and s.waits == [120]
    with pytest.raises(HttpError):
        fetch_once("u", fetch=Script((404, {}, "")).fetch)


def test_lists_of_queries(spark):
    topics = spark.createDataFrame([(1, "b", ["p"]), (0, "a", ["q", "r"]), (2, "c", [])], "topic_idx int, topic string, queries array<string>")
    assert [tuple(r) for r in flatten_queries(topics).orderBy("topic_idx", "query_idx").collect()] == [(0, "a", 0, "q"), (0, "a", 1, "r"), (1, "b", 0, "p")]
    a, b = spark.createDataFrame([(0, "x")], "seq int, t string"), spark.createDataFrame([(0, 1)], "seq int, n int")
    both = union_scans([("one", a), ("two", b)]).orderBy("seq").collect()
    assert [(tuple(r["seq"]), r["search_topic"], r["t"], r["n"]) for r in both] == [((0, 0), "one", "x", None), ((1, 0), "two", None, 1)]


def times(df, column):
    return sorted(float(r[0]) for r in df.select(column).collect())


def test_a_service_is_asked_at_its_pace(spark):
    """On four cores: queries come one after another with the pause between, or in lanes that together come as seldom."""
    queries = [(i, "t", f"q{i}") for i in range(5)]
    table = spark.createDataFrame(queries, "query_ordinal int, search_topic string, query string").repartition(4)
    options = {"sleep_seconds": 0.3}
    for found in (
        times(feed.scan(spark, queries, options | {"fetcher": "fake_http:timed"}), "arxiv_id"),
        times(works.scan(spark, queries, options | {"fetcher": "fake_http:timed_works"}), "openalex_id"),
        times(feed.scan_rows(table, options | {"fetcher": "fake_http:timed"}), "arxiv_id"),
    ):
        assert len(found) == 5 and min(b - a for a, b in zip(found, found[1:])) >= 0.29
    found = times(feed.scan(spark, queries, options | {"fetcher": "fake_http:timed", "lanes": 2}), "arxiv_id")
    assert len(found) == 5 and min(found[i + 2] - found[i] for i in range(3)) >= 0.29
    assert [(x.number, x.of, x.queries) for x in lanes([1, 2, 3], 2)] == [(0, 2, [1, 3]), (1, 2, [2])] and lanes([], 3) == []


def test_pauses_of_lanes():
    waits = []
    assert list(paced("abc", 2.0, 1, 3, waits.append)) == ["a", "b", "c"] and waits == [2.0, 6.0, 6.0]


def test_order_of_the_requests_of_a_table(spark):
    table = spark.createDataFrame([(i, "t", f"q{i}") for i in (3, 1, 2, 0)], "query_ordinal int, search_topic string, query string").repartition(3)
    found = feed.scan_rows(table, {"sleep_seconds": 0.05, "fetcher": "fake_http:timed"}).select("seq.query_ordinal", "arxiv_id").collect()
    assert [r[0] for r in sorted(found, key=lambda r: float(r[1]))] == [0, 1, 2, 3]


QUERIES = ['a "b c" d', '""', "", "  ", '"x', 'x"', '"a""b"', '""x"', '" a "', '" "', "tilde~ star* per%7E ä ö", 'a"b c"d', "x" * 9000 + ' "' + "y" * 9000]


def test_requests_as_expressions(spark):
    """The compiled query and the address are those of the live reader, for odd texts too."""
    df = spark.createDataFrame([(q,) for q in QUERIES], "q string")
    got = df.select("q", feed_query(F.col("q")).alias("c"), feed.request_url(F.col("q"), {"max_results": 3, "base_url": "http://h"}).alias("u")).collect()
    for r in got:
        assert r.c == feed.compile_query(r.q) and r.u == url_of("http://h", feed.request_parameters(r.q, {"max_results": 3}))


def test_replay(spark):
    queries = spark.createDataFrame([(i, "t", q) for i, q in enumerate(QUERIES[:10])], "query_ordinal int, search_topic string, query string")
    captured = spark.createDataFrame([(url_of(feed.BASE_URL, feed.request_parameters(QUERIES[0], {})), FEED), ("http://other", FEED)], "url string, body string")
    found = feed.replay(queries, captured, {}).orderBy("seq").collect()
    assert [(tuple(r["seq"]), r["title"]) for r in found] == [((0, 0), "One title"), ((0, 1), "Two")]
