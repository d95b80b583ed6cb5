import subprocess
import sys
from pathlib import Path

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkmill.config import Config
from inkmill.enrich import ledger, stage
from inkmill.enrich.clients import ChatClient, StubClient
from inkmill.enrich.prompts import triage_schema
from inkmill.schema import TRIAGE

from fake_http import Breaks

SCHEMA = triage_schema(("a", "b"))


def once(prompts, client, folder, at_once=None):
    return stage.call_once(prompts, F.col("text"), "s", SCHEMA, client, TRIAGE, stage.triage_fallback, stage.triage_error, str(folder), at_once)


def rows(df):
    return sorted(map(str, df.collect()))


def prompts_of(spark, n, first=0):
    return spark.createDataFrame([(i, f"prompt {'x' * (i // 2)}") for i in range(first, n)], "seq int, text string")  # two and two are equal


def calls(client):
    return Path(client.path).read_text().split()


def test_the_same_rows_as_plain_calls(spark, tmp_path):
    client = StubClient(fail_every=7, junk_every=5)
    p = prompts_of(spark, 40)
    plain = stage.call(p, F.col("text"), "s", SCHEMA, client, TRIAGE, stage.triage_fallback, stage.triage_error)
    for at_once in (None, 3):
        assert rows(once(p, client, tmp_path / f"l{at_once}", at_once)) == rows(plain)
    assert once(p.limit(0), client, tmp_path / "l").count() == 0


def test_a_run_that_breaks_asks_nothing_twice(spark, tmp_path):
    client = Breaks(str(tmp_path / "calls"), 9)
    p = prompts_of(spark, 40)
    with pytest.raises(Exception, match="lost"):
        once(p, client, tmp_path / "l", 2).collect()
    before = calls(client)
    assert len(before) >= 9
    got = rows(once(p, client, tmp_path / "l", 2))
    assert len(got) == 40 and len(calls(client)) == len(set(calls(client))) == 20
    assert got == rows(once(p, StubClient(junk_every=5), tmp_path / "other"))
    # a later run asks only what is new; another system prompt is another prompt
    once(prompts_of(spark, 44), client, tmp_path / "l").collect()
    assert len(calls(client)) == len(set(calls(client))) == 22
    assert [len(list((tmp_path / "l" / "known").glob("_run=*/*.parquet"))) > 0, ledger.known(spark, str(tmp_path / "l")).count()] == [True, 22]


def test_a_repeated_task_asks_nothing_twice(tmp_path):
    """In a session whose tasks are tried again."""
    client = Breaks(str(tmp_path / "calls"), 9)
    code = f"""
import sys; sys.path[:0] = [{str(Path(__file__).parent.parent)!r}, {str(Path(__file__).parent)!r}]
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import test_ledger as t
t.ship_tests(spark)
found = t.once(t.prompts_of(spark, 40), t.Breaks({client.path!r}, 9), {str(tmp_path / "l")!r}, 2)
assert found.count() == 40
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-3000:]
    assert Path(f"{client.path}.broken").exists() and len(calls(client)) == len(set(calls(client))) == 20


def ship_tests(spark):
    spark.sparkContext.addPyFile(str(Path(__file__).parent / "fake_http.py"))


def test_failed_requests_are_asked_again(spark, tmp_path):
    p = prompts_of(spark, 6)
    assert {r["llm_priority"] for r in once(p, StubClient(fail_every=1), tmp_path / "l").collect()} == {"error"}
    assert ledger.known(spark, str(tmp_path / "l")).count() == 0

    class Mended(StubClient):
        identity = repr(StubClient(fail_every=1))

    assert "error" not in {r["llm_priority"] for r in once(p, Mended(), tmp_path / "l").collect()}


def test_half_a_reply_is_none(tmp_path):
    found = ledger.OpenReplies(str(tmp_path / "r"))
    (tmp_path / "r" / ".k-1").write_text('{"digest": "k", "rep')
    assert found.get("k") is None
    found.put("k", "a\nb")
    assert found.get("k") == "a\nb"
    (again,) = ledger.ask(iter([pd.DataFrame({"digest": ["k"], "prompt": ["never asked"]})]), None, "", {}, str(tmp_path / "r"))
    assert again["reply"].tolist() == ["a\nb"]


def test_what_a_key_depends_on(spark):
    key = lambda *a: spark.range(1).select(ledger.digest(F.lit("p"), *a)).first()[0]
    a = key(ChatClient("m"), "s", {})
    assert a == key(ChatClient("m", "http://other", 5), "s", {})
    assert len({a, key(ChatClient("n"), "s", {}), key(ChatClient("m"), "t", {}), key(ChatClient("m"), "s", {"x": 1}), key(ChatClient("m", temperature=1.0), "s", {})}) == 5


def test_scores_are_made_once_for_the_candidates(spark, tmp_path):
    """Prompts are read more than once; what candidates are chosen by is not made again."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(seq):
        made.add(1)
        return float(seq)

    cfg = Config.of({"output_dir": "o", "sota_table_path": "t", "ollama": {"enabled": True, "classify_min_triage_score": 5, "max_papers_per_run": 4}}).triage
    papers = spark.range(20).select(F.col("id").alias("seq"), F.concat(F.lit("t"), "id").alias("title")).withColumn("triage_score", score("seq"))
    out = stage.triage(papers, cfg, StubClient(), "", str(tmp_path / "f"))
    assert made.value <= 60  # to choose, for the prompts and once for what comes out; 110 when each reader of prompts made them again
    assert sorted(r["seq"] for r in out.where("llm_priority is not null").collect()) == [5, 6, 7, 8]


def test_fast_replies_share_files(tmp_path):
    """A task's replies are lines of its journal; another attempt of the task reads them, half a line is none."""
    folder = str(tmp_path / "r")
    asked = pd.DataFrame({"digest": [f"d{i}" for i in range(500)], "prompt": ["x" * i for i in range(500)]})
    (first,) = ledger.ask(iter([asked]), StubClient(junk_every=5), "", SCHEMA, folder)
    files = list((tmp_path / "r").iterdir())
    assert 1 <= len(files) < 50
    (tmp_path / "r" / "0-killed.json").write_text('{"digest": "e", "rep')
    (again,) = ledger.ask(iter([asked]), None, "", SCHEMA, folder)
    assert again["reply"].tolist() == first["reply"].tolist() and ledger.OpenReplies(folder, "0").get("e") is None
    assert ledger.OpenReplies(folder, "1").get("d1") is None


def test_few_rows_are_objects_at_once(spark):
    """A batch of many prompts is taken in parts: the first results come before the last prompt is asked."""
    seen = {}

    class Frame:
        sparkSession, schema = spark, spark.range(1).select(F.col("id").alias("seq"), F.lit("p").alias("prompt")).schema

        def select(self, *_):
            return self

        def mapInArrow(self, run, out):
            seen["run"] = run
            return out

    asked = []

    class Counts:
        def chat(self, *a):
            asked.append(a)
            return '{"llm_priority": "read"}'

    stage.call(Frame(), F.lit("p"), "", SCHEMA, Counts(), TRIAGE, stage.triage_fallback, stage.triage_error)
    batch = pa.RecordBatch.from_pydict({"seq": list(range(5000)), "prompt": ["p"] * 5000})
    parts = seen["run"](iter([batch]))
    first = next(parts)
    assert first.num_rows == len(asked) < 1000
    assert first.num_rows + sum(p.num_rows for p in parts) == len(asked) == 5000
