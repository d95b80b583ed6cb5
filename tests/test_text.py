from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkmill.functions import text
from inkmill.functions.nested import author_list, best_venue, external_id, feed_query, invert_index, last_segment
from inkmill.sources.feed import compile_query


def values(spark, rows, ddl, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, ddl).select(*columns).collect()]


def test_missing_values(spark):
    rows = [(None, None), (float("nan"), "NaN"), (1.5, "a"), (None, "")]
    assert values(spark, rows, "d double, s string", text.is_missing("d"), text.is_missing("s")) == [(True, True), (True, False), (False, False), (True, False)]
    assert values(spark, rows, "d double, s string", text.to_text("d"), text.to_text("s")) == [("", ""), ("", "NaN"), ("1.5", "a"), ("", "")]


SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0      　"


def test_clean_is_split_and_join(spark):
    rows = [(x,) for x in (f"a{c}{c}b" for c in SPACES)] + [(SPACES + "x y​z" + SPACES,), ("",), (None,)]
    got = values(spark, rows, "s string", text.clean_text("s"), text.normalize_key("s"), text.strip("s"))
    for (s,), (clean, key, stripped) in zip(rows, got):
        assert clean == " ".join((s or "").split())
        assert key == clean.lower()
        assert stripped == (s or "").strip()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=SPACES + "abÀß.", max_size=12), min_size=1, max_size=20))
def test_clean_property(spark, texts):
    got = values(spark, [(t,) for t in texts], "s string", text.clean_text("s"))
    assert [g for (g,) in got] == [" ".join(t.split()) for t in texts]


def test_numbers(spark):
    rows = [(x,) for x in ("12", " 3.5 ", "1e2", "-.5", "7d", "abc", "", None, "1_000", "0x10", "nan", "inf")]
    got = [x for (x,) in values(spark, rows, "s string", text.to_number("s"))]
    assert got == [12, 3.5, 100, -0.5, 0, 0, 0, 0, 0, 0, 0, float("inf")]
    assert values(spark, [(float("nan"),), (None,), (2.0,)], "d double", text.to_number("d")) == [(0,), (0,), (2,)]


def test_small_functions(spark):
    rows = [("Organ", ["a", "b"]), (None, None)]
    got = values(spark, rows, "s string, a array<string>", text.contains_ci("s", "GAN"), text.contains_ci("s", ""), text.join_list("a"), text.truncate("s", 3), text.normalize_category("s"))
    assert got == [(True, True, "a, b", "Org", "organ"), (False, True, "", None, "")]


def test_inverted_index(spark):
    rows = [({"b": [1, 3], "a": [0], "gap": [9]},), ({"x": [0], "y": [0]},), ({},), (None,), ({"n": None},)]
    got = values(spark, rows, "m map<string,array<int>>", invert_index(F.col("m")))
    assert got == [("a b b gap",), ("x y",), ("",), ("",), ("",)]


def test_nested_parts(spark):
    assert values(spark, [({"doi": "d"},), ({"doi": None},), ({},), (None,)], "m map<string,string>", external_id(F.col("m"), "doi")) == [("d",), ("",), ("",), ("",)]
    ddl = "a array<struct<author: struct<display_name: string>>>"
    rows = [([(("A",),), ((None,),), (("",),), (None,), (("B",),)],), ([],), (None,)]
    assert values(spark, rows, ddl, author_list(F.col("a"))) == [("A, B",), ("",), ("",)]
    place = "struct<source: struct<display_name: string, type: string>>"
    rows = [
        ([(None,), (("R", "repository"),), (("", "journal"),), (("C", "conference"),)], (("P", "repository"),)),
        ([None], (("P", None),)),
        (None, (None,)),
        ([], None),
        ([(("J", "Journal"),)], (("P", "x"),)),
    ]
    got = values(spark, rows, f"l array<{place}>, p {place}", best_venue(F.col("l"), F.col("p")))
    assert [tuple(v) for (v,) in got] == [("C", "conference"), ("P", ""), ("", ""), ("", ""), ("P", "x")]
    ids = [("http://a/abs/2401.1v2",), ("http://a/abs/hep/9901//",), ("x",), ("",), (None,)]
    assert values(spark, ids, "s string", last_segment(F.col("s"))) == [("2401.1v2",), ("9901",), ("x",), ("",), ("",)]


QUERIES = {
    '"image forgery" robust': 'all:"image forgery" AND all:robust',
    "image forgery": "all:image AND all:forgery",
    'a "b c"': 'all:"b c" AND all:a',
    '""': 'all:""',
    "": "all:",
    " \t": "all: \t",
    '" "': 'all:" "',
}


def test_feed_query(spark):
    got = values(spark, [(q,) for q in QUERIES], "q string", feed_query(F.col("q")))
    assert [g for (g,) in got] == list(QUERIES.values()) == [compile_query(q) for q in QUERIES]
