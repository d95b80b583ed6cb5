import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from inkmill.config import Config, Deep, SearchTerms, Triage
from inkmill.enrich import prompts, stage
from inkmill.enrich.clients import ChatClient, ClientError, StubClient
from inkmill.plans import report, triage
from inkmill.schema import DEEP, PAPER, SCAN, TRIAGE
from inkmill.sources.tables import read_table
from inkmill.streaming.accumulate import accumulate

from fake_http import Logged

TERMS = SearchTerms.of({"topics": {"g": {"label": "Gans", "topic_terms": {"gan": 10}}}})
SYSTEM = ("first", "second")


def scanned(spark, n, first=0):
    rows = [
        dict(seq=i, paper_id=f"p{i}", source="test", title=f"Gan {i}" if i % 3 else f"other {i}", abstract="text", has_abstract=True, query="q", doi=f"10.1/{i}", venue_type="journal" if i % 2 else "repository",
             is_repository=i % 2 == 0, openalex_type="article", citation_count=i, published_date=f"2024-01-{i % 28 + 1:02d}", year=2024, url="", search_topic="g")
        for i in range(first, first + n)
    ]
    return spark.createDataFrame(rows, "seq int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCAN) + ", search_topic string")


def config(tmp_path, **more):
    return Config.of({"output_dir": str(tmp_path / "out"), "sota_table_path": str(tmp_path / "out" / "table"), "recommended_summary_path": str(tmp_path / "r.md"), "min_triage_score": 5} | more)


def test_a_run_and_a_second_one(spark, tmp_path):
    cfg = config(tmp_path, ollama={"enabled": True, "max_papers_per_run": 4}, ollama_deep_analysis={"enabled": True, "only_priorities": ["read", "skim", "ignore"], "max_papers_per_run": 2})
    client = Logged(str(tmp_path / "calls"))
    got = triage.run(spark, cfg, TERMS, scanned(spark, 12).union(scanned(spark, 3)), client, SYSTEM)
    assert got == triage.RunReport(15, 12, 8, 8)
    assert Path(client.path).read_text().split() == ["first"] * 4 + ["second"] * 2  # one call a candidate, the first in order of arrival
    table = spark.read.parquet(cfg.sota_table_path)
    assert {f.name for f in PAPER} <= set(table.columns)
    asked = table.where("llm_priority is not null")
    assert sorted(r["seq"] for r in asked.collect()) == [1, 2, 4, 5]
    assert sorted(r["seq"] for r in table.where("deep_confidence is not null").collect()) == [1, 2]
    first = {r["paper_id"]: r for r in table.collect()}
    edited = table.withColumn("notes", F.when(F.col("seq") == 1, "mine").otherwise(F.col("notes")))
    edited.write.parquet(f"{cfg.sota_table_path}-2")
    again = config(tmp_path, sota_table_path=f"{cfg.sota_table_path}-2")
    got = triage.run(spark, again, TERMS, scanned(spark, 6, 8), client, SYSTEM)
    assert got == triage.RunReport(6, 6, 4, 9)
    second = {r["paper_id"]: r for r in spark.read.parquet(again.sota_table_path).collect()}
    assert second["p1"]["notes"] == "mine" and second["p2"]["llm_priority"] == first["p2"]["llm_priority"]


def test_early_ends_leave_the_table(spark, tmp_path):
    cfg = config(tmp_path, min_triage_score=1000)
    assert triage.run(spark, cfg, TERMS, scanned(spark, 0)) == triage.RunReport(0, 0)
    assert triage.run(spark, cfg, TERMS, scanned(spark, 5)) == triage.RunReport(5, 5)
    assert not Path(cfg.sota_table_path).exists()


def test_replies():
    good = json.dumps({"llm_priority": "read", "llm_key_terms": ["a", "b"], "llm_confidence": 1, "other": 5, "llm_reason": {"x": 1}})
    got = stage.parse_reply(good, TRIAGE, stage.triage_fallback)
    assert got["llm_key_terms"] == "a, b" and got["llm_confidence"] == 1.0 and got["llm_relevance"] is None and "other" not in got and got["llm_reason"] == '{"x": 1}'
    for bad in ("", "not json", "{'a': 1}", '{"a": 1} more', "[1]", '"s"', "null", '{"llm_key_terms": [1]}', '{"llm_confidence": "high"}', '{"llm_is_dataset_or_benchmark": "yes"}'):
        got = stage.parse_reply(bad, TRIAGE, stage.triage_fallback)
        assert (got["llm_priority"], got["llm_relevance"], got["llm_topic"], got["llm_is_dataset_or_benchmark"], got["llm_confidence"]) == ("ignore", "not_relevant", "other", False, 0.0)
    long = stage.parse_reply("x" * 900, DEEP, stage.deep_fallback)
    assert long["deep_reading_notes"].endswith("x" * 500) and len(long["deep_reading_notes"]) < 560 and long["deep_summary"] == ""


def test_stages(spark, tmp_path):
    p = scanned(spark, 8).withColumns({"triage_score": F.col("seq").cast("double"), "topic_label": F.lit(None).cast("string")})
    assert stage.triage(p, Triage(), StubClient(), "", str(tmp_path)).columns == p.columns  # off: no columns
    assert set(stage.deep(p, Deep(), StubClient(), "", str(tmp_path)).columns) == set(p.columns) | {f.name for f in DEEP}  # off: empty columns
    out = stage.triage(p, Triage(enabled=True, classify_min_triage_score=5), StubClient(fail_every=1), "", str(tmp_path))
    rows = {r["seq"]: r for r in out.collect()}
    assert [rows[i]["llm_priority"] for i in (4, 5, 6, 7)] == [None, "error", "error", "error"]
    assert rows[7]["llm_reason"] == "Ollama request failed: no answer" and rows[7]["llm_confidence"] == 0.0
    deep = stage.deep(out, Deep(enabled=True, only_priorities=("error",), max_papers_per_run=1), StubClient(junk_every=1), "", str(tmp_path))
    notes = {r["seq"]: r["deep_reading_notes"] for r in deep.collect()}
    assert notes[5].startswith("Failed to parse") and notes[6] is None


def test_prompts(spark):
    p = spark.createDataFrame([(" T ", None, 2024, 1.5)], "title string, abstract string, year int, triage_score double")
    first, second = p.select(prompts.triage_prompt(p.columns), prompts.deep_prompt(p.columns)).first()
    assert first.startswith("Paper metadata:\n\nTitle:\n T \n\nAbstract:\n\n\nVenue:\n\n\n") and first.endswith("Keyword triage score:\n1.5\n\nClassify this paper for the literature review.")
    assert "Title:\nT\n\nAuthors:\n\n\nYear:\n2024\n\n" in second and second.count("\n\n") >= 17
    schema = prompts.triage_schema(("a", "b"))
    assert schema["properties"]["llm_topic"]["enum"] == ["a", "b"] and len(schema["required"]) == 8 and len(prompts.deep_schema()["required"]) == 9


def test_chat_client(monkeypatch):
    import requests

    class Answer:
        def __init__(self, body, status=200):
            self.body, self.status = body, status

        def raise_for_status(self):
            if self.status >= 400:
                raise requests.exceptions.HTTPError("bad")

        def json(self):
            return json.loads(self.body)

    sent = []
    replies = [Answer('{"message": {"content": "hi"}}'), Answer("", 500), Answer("no json"), Answer("{}")]
    monkeypatch.setattr(requests, "post", lambda url, json, timeout: (sent.append((url, json, timeout)), replies.pop(0))[1])
    client = ChatClient("m", "http://h/", 5, 0.5)
    assert client.chat("s", "u", {"x": 1}) == "hi"
    url, body, timeout = sent[0]
    assert url == "http://h/api/chat" and timeout == 5 and body["format"] == {"x": 1} and body["stream"] is False and body["options"] == {"temperature": 0.5}
    assert [m["role"] for m in body["messages"]] == ["system", "user"]
    for _ in range(2):
        with pytest.raises(ClientError):
            client.chat("s", "u", {})
    assert client.chat("s", "u", {}) == ""


REPORT = """# Recommended Papers Summary

Total recommended papers: **3**
- Read: **2**
- Skim: **1**
- Contains deep-analysis notes: **yes**

## Counts by topic

- B: **2**
- Unknown: **1**

## Counts by LLM relevance

- direct: **3**

## Papers

### 1. Second

**Year:** 2024

**Recommendation:** `read`  
**Relevance:** `direct`  
**Topic:** B  
**Triage score:** 9.0  
**Fast LLM confidence:** 

**Why it was recommended:** because

#### Deep analysis

**Deep-analysis confidence:** 0.5

**Deep summary:** deep

**DOI:** 10.1/x

---

"""  # noqa: W291


def test_report(spark, tmp_path):
    ddl = "seq int, title string, year int, llm_priority string, llm_relevance string, topic_label string, triage_score double, published_date string, llm_reason string, deep_summary string, deep_confidence double, doi string, url string"
    rows = [
        (0, "First", None, "read", "direct", None, 3.0, None, None, None, 0.9, "", "http://u"),
        (1, " Second ", 2024, " read", "direct", "B", 9.0, None, " because ", "deep", 0.5, "10.1/x", "http://u"),
        (2, "Third", None, "skim", "direct", "B", 99.0, None, None, " ", None, None, None),
        (3, "Fourth", None, "ignore", "x", "C", 99.0, None, None, None, None, None, None),
    ]
    cfg = config(tmp_path)
    spark.createDataFrame(rows, ddl).write.parquet(cfg.sota_table_path)
    assert report.run(spark, cfg)
    text = Path(cfg.recommended_summary_path).read_text(encoding="utf-8")
    assert text.startswith(REPORT)
    second, third = text[len(REPORT) :].split("\n\n---\n")[:2]
    assert second.strip().startswith("### 2. First") and second.endswith("**URL:** http://u") and "Deep analysis" not in second  # confidence alone is no analysis
    assert third.strip().startswith("### 3. Third\n\n**Recommendation:** `skim`")
    none = config(tmp_path / "none")
    spark.createDataFrame(rows[3:], ddl).write.parquet(none.sota_table_path)
    assert not report.run(spark, none) and not Path(none.recommended_summary_path.replace("r.md", "none/r.md")).exists()
    with pytest.raises(ValueError):
        report.report_lines(spark.createDataFrame(rows, ddl).drop("llm_priority"))


def test_stream_is_the_same_as_batches(spark, tmp_path):
    cfg = config(tmp_path)
    source = str(tmp_path / "in")
    scanned(spark, 6).coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema(scanned(spark, 0).schema).parquet(source)
    accumulate(spark, stream(), TERMS, cfg, str(tmp_path / "cp")).awaitTermination(120)
    scanned(spark, 6, 4).coalesce(1).write.mode("append").parquet(source)
    accumulate(spark, stream(), TERMS, cfg, str(tmp_path / "cp")).awaitTermination(120)
    whole = config(tmp_path / "whole")
    triage.run(spark, whole, TERMS, scanned(spark, 10))
    ids = lambda c: sorted(r["paper_id"] for r in spark.read.parquet(c.sota_table_path).collect())
    assert ids(cfg) == ids(whole)


def test_a_stream_from_which_nothing_passes_leaves_the_table(spark, tmp_path):
    """A batch without rows, and one of which none passes, prune nothing, as in a batch run; one that passes does."""
    source, cfg = str(tmp_path / "in"), config(tmp_path)
    triage.run(spark, cfg, TERMS, scanned(spark, 6))
    ids = lambda: sorted(r["paper_id"] for r in read_table(spark, cfg.sota_table_path).collect())
    before = ids()
    high = config(tmp_path, min_triage_score=32, drop_existing_below_min_score=True)
    stream = lambda: spark.readStream.schema(scanned(spark, 0).schema).parquet(source)
    for rows in (scanned(spark, 0), scanned(spark, 2, 20)):
        rows.coalesce(1).write.mode("append").parquet(source)
        accumulate(spark, stream(), TERMS, high, str(tmp_path / "cp")).awaitTermination(120)
        assert ids() == before
    assert triage.run(spark, high, TERMS, scanned(spark, 2, 20)).n_table is None and ids() == before
    low = config(tmp_path, min_triage_score=31, drop_existing_below_min_score=True)
    triage.run(spark, low, TERMS, scanned(spark, 6, 30))
    kept = read_table(spark, cfg.sota_table_path)
    assert kept.where("triage_score < 31").count() == 0 and kept.count() > 0


def test_a_stream_after_an_interrupted_swap(spark, tmp_path):
    cfg, source = config(tmp_path), str(tmp_path / "in")
    triage.run(spark, cfg, TERMS, scanned(spark, 4))
    table = Path(cfg.sota_table_path)
    table.rename(f"{table}.old-x")
    scanned(spark, 4, 2).coalesce(1).write.parquet(source)
    accumulate(spark, spark.readStream.schema(scanned(spark, 0).schema).parquet(source), TERMS, cfg, str(tmp_path / "cp")).awaitTermination(120)
    assert sorted(r["seq"] for r in spark.read.parquet(str(table)).collect()) == [1, 2, 4, 5]


def test_a_table_made_elsewhere(spark, tmp_path):
    """Its copies go when it is laid out by runs; later runs write beside it."""
    cfg = config(tmp_path)
    old = scanned(spark, 3).unionByName(scanned(spark, 2)).withColumns({"notes": F.lit("mine"), "relevance_score": F.lit(50.0)})
    old.write.parquet(cfg.sota_table_path)
    assert triage.run(spark, cfg, TERMS, scanned(spark, 4, 1)) == triage.RunReport(4, 4, 3, 4)
    first = {str(p) for p in Path(cfg.sota_table_path).rglob("part-*")}
    assert triage.run(spark, cfg, TERMS, scanned(spark, 3, 4)) == triage.RunReport(3, 3, 2, 5)
    assert first < {str(p) for p in Path(cfg.sota_table_path).rglob("part-*")}
    assert sorted((r["seq"], r["notes"]) for r in read_table(spark, cfg.sota_table_path).collect()) == [(0, "mine"), (1, "mine"), (2, "mine"), (4, ""), (5, "")]


def test_a_run_leaves_nothing_behind_and_counts_on_its_way(spark, tmp_path):
    cfg, shared = config(tmp_path), Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    left = lambda: {p.name for p in shared.glob("run-*")}
    before = left()
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{tmp_path.name}"
    spark.sparkContext.setJobGroup(group, "")
    none = config(tmp_path, min_triage_score=1000)
    assert triage.run(spark, none, TERMS, scanned(spark, 5)) == triage.RunReport(5, 5)
    assert len(tracker.getJobIdsForGroup(group)) <= 4  # what was scanned is written, then what passes (a shuffle's stages are jobs of their own)
    spark.sparkContext._jsc.clearJobGroup()
    with pytest.raises(Exception, match="stop"):
        triage.run(spark, cfg, TERMS, scanned(spark, 5).withColumn("title", F.raise_error(F.lit("stop")).cast("string")))
    triage.run(spark, cfg, TERMS, scanned(spark, 5))
    assert left() == before and sorted(p.name for p in Path(cfg.output_dir).iterdir()) == ["table"]
