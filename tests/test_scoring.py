import math
import random

import pytest
from pyspark.sql import functions as F

from inkmill.config import Config, Scoring, SearchTerms
from inkmill.functions import scoring

TERMS = SearchTerms.of({"topics": {"a": {"label": "A", "topic_terms": {"GAN": 5, "net work": 2}}, "b": {"topic_terms": {"organ": 5, "x": 3.9}}}, "generic_priority_terms": {"survey": 2, "end start": 7}})
DDL = "seq int, title string, abstract string, query string, venue_type string, openalex_type string, has_abstract boolean, is_repository boolean, citation_count double"


def scored(spark, *rows, terms=TERMS, cfg=Scoring()):
    made = [dict(zip(("seq", "title", "abstract", "query", "venue_type", "openalex_type", "has_abstract", "is_repository", "citation_count"), (i, *r))) for i, r in enumerate(rows)]
    return [r.asDict() for r in scoring.score(spark.createDataFrame(made, DDL), terms, cfg).orderBy("seq").collect()]


def test_weights_and_ties(spark):
    tie, first, none = scored(
        spark,
        ("organ", None, None, None, None, True, False, None),  # gan is inside organ: both topics score 15, the first one wins
        ("net work", "x", "x", "JOURNAL", "Dataset", True, False, 0.0),
        ("zzz", None, None, "journal", "dataset", True, False, 50.0),
    )
    assert (tie["topic"], tie["topic_label"], tie["topic_score"]) == ("a", "A", 15)
    # b: the weight 3.9 counts as 3; abstract 1 * 3 + query 2 * 3 = 9 against 3 * 2 = 6
    assert (first["topic"], first["topic_label"], first["topic_score"], first["triage_score"]) == ("b", "b", 9, 9 + 2 + 1)
    assert (none["topic"], none["topic_label"], none["triage_score"], none["generic_priority_score"]) == ("out_of_scope", "Out of scope", 0, 0)


def test_generic_terms_span_fields(spark):
    (row,) = scored(spark, ("gan survey end", "start gan", "", None, None, True, False, None))
    assert row["generic_priority_score"] == 9 and row["triage_score"] == 15 + 5 + 9


@pytest.mark.parametrize("citations, bonus", [(None, 0), (-1.0, 0), (-5.0, 0), (0.0, 0), (10.0, 0.25 * math.log1p(10)), (1e12, 5), (float("nan"), 0)])
def test_citations(spark, citations, bonus):
    (row,) = scored(spark, ("gan", "a", "", None, None, True, False, citations))
    assert row["triage_score"] == pytest.approx(15 + bonus, abs=1e-3)


def test_penalties_stop_at_zero(spark):
    cfg = Scoring(repository_penalty=100)
    (row,) = scored(spark, ("gan", None, None, None, "Report", False, True, None), cfg=cfg)
    assert row["triage_score"] == 0 and row["topic"] == "a"
    (row,) = scored(spark, ("gan", None, None, "conference", "report", None, None, None))
    assert row["triage_score"] == 15 + 3 - 4 - 1


def test_no_topics_and_large_dictionaries(spark):
    (row,) = scored(spark, ("gan", None, None, None, None, True, False, None), terms=SearchTerms.of({}))
    assert row["topic"] == "out_of_scope"
    many = SearchTerms.of({"topics": {f"t{i}": {"topic_terms": {f"w{i}a{j}": j for j in range(90)} | {"gan": i}} for i in range(4)}})
    assert sum(len(t.terms) for t in many.topics) > scoring.UNROLLED_TERMS
    (row,) = scored(spark, ("gan w1a7", None, None, None, None, True, False, None), terms=many)
    assert (row["topic"], row["topic_score"]) == ("t1", 24)


def test_priority_rank(spark):
    df = spark.createDataFrame([("read",), (" Skim\n",), ("x",), (None,)], "p string")
    assert [r[0] for r in df.select(scoring.priority_rank("p")).collect()] == [0, 1, 2, 2]


def test_config_defaults(tmp_path):
    cfg = Config.of({"output_dir": "o", "sota_table_path": "t", "mailto": None, "scoring": {"title_weight": 9, "unknown": 1}, "ollama": {"enabled": True}, "ollama_deep_analysis": {"only_priorities": [" READ "]}})
    assert (cfg.max_results_per_query, cfg.scoring.title_weight, cfg.scoring.abstract_weight, cfg.triage.enabled, cfg.deep.only_priorities) == (25, 9, 1, True, ("read",))
    with pytest.raises(ValueError):
        Config.of({"output_dir": "o"})
    assert TERMS.query_list() == []
    assert SearchTerms.of({"topics": {"t": {"queries": ["p", "q"]}, "u": {"queries": ["r"]}}}).query_list() == [(0, "t", "p"), (1, "t", "q"), (2, "u", "r")]


def test_score_needs_no_shuffle(spark):
    df = spark.range(10).select(F.col("id").alias("seq"), *(F.lit("gan").alias(c) for c in ("title", "abstract", "query", "venue_type", "openalex_type")), F.lit(True).alias("has_abstract"), F.lit(False).alias("is_repository"), F.lit(1).alias("citation_count"))
    assert "Exchange" not in scoring.score(df, TERMS, Scoring())._jdf.queryExecution().executedPlan().toString()


def test_the_index_finds_what_contains_finds(spark):
    """Terms of all lengths, some twice, with overlaps and characters beyond the basic plane, in texts of all lengths."""
    pick = random.Random(5)
    text = lambda n: "".join(pick.choice("abcAé𝒳 ,|") for _ in range(n))
    texts = [None, "", "a", "ab", "abc"] + [text(n) for n in (3, 4, 5, 6, 40, 300, 2000)]
    listed = {f"t{k}": {"topic_terms": {text(pick.choice((0, 1, 2, 3, 4, 5, 6, 8))): pick.randint(-3, 9) for _ in range(120)} | {"GAN": 2, "gan": 3}} for k in range(4)} | {"none": {}}
    terms = SearchTerms.of({"topics": listed})
    rows = [(i, x, texts[-1 - i % 5], texts[i % 7]) for i, x in enumerate(texts + ["gan", "organ gan"])]
    df = spark.createDataFrame(rows, "seq int, title string, abstract string, query string")
    by_index, by_array, one_by_one = df.select(
        scoring.topic_scores_indexed(terms, Scoring()), scoring.topic_score_array(terms, Scoring()), F.array(*(scoring.topic_score(t.terms, Scoring()) for t in terms.topics))
    ).toDF("i", "a", "u").agg(*(F.collect_list(c) for c in "iau")).first()
    assert by_index == by_array == one_by_one and any(any(x) for x in by_index)
    generic = tuple(t for topic in terms.topics for t in topic.terms)
    assert len(generic) > scoring.UNROLLED_TERMS
    in_parts = sum((scoring.generic_score(t.terms, Scoring()) for t in terms.topics), F.lit(0))
    large, small = ([r[0] for r in df.orderBy("seq").select(c).collect()] for c in (scoring.generic_score(generic, Scoring()), in_parts))
    assert large == small


def test_an_empty_dictionary_in_the_index(spark):
    assert spark.range(1).select(F.size(scoring.indexed_hits(F.lit("text"), []))).first()[0] == 0
    assert spark.range(1).select(scoring.indexed_hits(F.lit("text"), [(0, "", 4), (1, "te", 5), (2, "z", 6)])).first()[0] == [(0, 4), (1, 5)]


def test_a_filter_on_a_score_makes_no_text_again_for_each_term(spark):
    """Spark moves the filter below the scores and repeats what they are made of there."""
    terms = SearchTerms.of({"topics": {f"t{i}": {"topic_terms": {f"w{i}a{j}": 5 for j in range(9)}} for i in range(4)}, "generic_priority_terms": {"survey": 2}})
    df = spark.createDataFrame([(i, f"w{i}a1 Survey", "ABSTRACT", "q", "Journal", "report", True, False, 3.0) for i in range(4)], DDL)
    kept = scoring.score(df, terms, Scoring()).where("triage_score >= 15").select("seq", "triage_score")
    assert kept._jdf.queryExecution().executedPlan().toString().count("lower(") < 30
    assert sorted(map(tuple, kept.collect())) == [(i, 15 + 2 + 2 - 4 + round(0.25 * math.log1p(3), 3)) for i in range(4)]
