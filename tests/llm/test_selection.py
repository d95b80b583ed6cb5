"""Quality rules, mixing, language identification, the ordinal classifier, and the pipeline."""

import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpora import clashing, edge_rows, listed, random_texts, rows, table
from inkmill.llm import language, mixing, ordinal, quality_rules

DATA = Path("/root/testdata/sf0.01")
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed


MEASURES = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@pytest.mark.parametrize("found", [edge_rows(), rows(random_texts(120, 21)), rows(["a a a a", "a b a b a b", "a b c", "x\nx\n\nx\r\n x", "a b c d a b c"])])
def test_measures(spark, found):
    got = listed(quality_rules.apply_rules(clashing(spark, found)), *MEASURES)
    assert got == sorted(((r[0], *brute_measures(r[1])) for r in found), key=repr)


def test_host_verdicts(spark):
    good = " ".join(f"w{i}" for i in range(60))
    found = [(i, good if host == "good" or (host == "mixed" and i % 2) or i % 50 == 0 else "bad " * 60, "en", host, 1) for i, host in enumerate(["good", "bad", "mixed", None] * 100)]
    got = quality_rules.apply_rules(table(spark, found)).groupBy("host").agg(F.count_if("kept").alias("kept"), F.count("*").alias("n"), F.min("host_kept").alias("host_kept"))
    verdicts = {r["host"]: (r["kept"], r["host_kept"]) for r in got.collect()}
    assert verdicts["good"] == (100, True) and verdicts["bad"][1] is False and verdicts["bad"][0] == 0 and verdicts[None][1] is False
    assert quality_rules.apply_rules(table(spark, found).limit(0)).count() == 0


def test_a_small_host_is_shrunk_towards_the_others(spark):
    good = " ".join(f"w{i}" for i in range(60))
    found = [(i, good if i % 9 else "bad " * 60, "en", f"h{i % 20}", 1) for i in range(1980)] + [(5000, "bad " * 60, "en", "small", 1), (5001, good, "en", "small", 1)]
    got = {r["host"]: r for r in quality_rules.host_verdicts(quality_rules.measures(table(spark, found))).collect()}
    assert got["small"]["base_failed_rate"] < 0.5 and got["small"]["host_kept"]


def test_a_host_that_is_twice_as_bad_goes(spark):
    good = " ".join(f"w{i}" for i in range(60))
    found = [(i, good if i % 19 else "bad " * 60, "en", f"h{i % 20}", 1) for i in range(1900)] + [(5000 + i, good if i % 3 else "bad " * 60, "en", "third", 1) for i in range(90)]
    got = quality_rules.apply_rules(table(spark, found)).groupBy("host").agg(F.max("kept").alias("kept")).collect()
    assert {r["host"] for r in got if not r["kept"]} == {"third"}


def brute_targets(sizes, weights=(1, 2, 3), epochs=3):
    """Exact water-filling, dealing out what is above the caps by weight until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = {s: Fraction(sum(sizes.values()) * w[s], sum(w.values())) for s in order}
    while any(target[s] > epochs * sizes[s] for s in order):
        excess = sum(max(target[s] - epochs * sizes[s], 0) for s in order)
        target = {s: min(target[s], Fraction(epochs * sizes[s])) for s in order}
        open_ = [s for s in order if target[s] < epochs * sizes[s]]
        for s in open_:
            target[s] += excess * w[s] / sum(w[x] for x in open_)
    return target


@pytest.mark.parametrize(
    "found",
    [
        edge_rows(),
        rows(random_texts(300, 31)),
        rows(["a b c"] * 400, sources=["big"] * 390 + ["b", "c", "d", None, "é", "z", "Z", "b", "c", "c"]),
        rows(["one two three four"] * 1000, sources=["s"] * 1000),
        [(None, "a b c", "en", s, 5) for s in ["s"] * 700 + ["t"] * 300 + [None] * 40] + [(i // 9, "a b c d", "en", "t", 7) for i in range(200)],
    ],
)
def test_mix(spark, found):
    docs = clashing(spark, found)
    plan = mixing.plan_mix(docs).collect()
    size = defaultdict(int)
    for r in found:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    want = brute_targets(size)
    taken, most = defaultdict(int), defaultdict(int)
    for r in plan:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(float(want[r["source"]]), rel=1e-9, abs=1e-9)
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    for s, t in want.items():
        assert abs(taken[s] - t) <= most[s] / 2 + 1e-6
    again = mixing.plan_mix(docs.repartition(7))
    assert listed(again) == sorted(map(tuple, plan), key=repr)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = Counter(r["doc_id"] for r in mixed.collect())
    planned = Counter()
    for r in plan:
        planned[r["doc_id"]] += r["repeats"]
    assert copies == +planned


def test_mix_of_nothing(spark):
    none = clashing(spark, edge_rows()).limit(0)
    assert mixing.plan_mix(none).count() == 0 and mixing.mix(none).count() == 0
    blank = table(spark, rows([None, "", " "]))
    assert {(r["target"], r["taken"]) for r in mixing.plan_mix(blank).collect()} == {(0.0, 0)}


def test_native_plans(spark):
    docs = table(spark, rows(random_texts(20, 1)))
    for df in (mixing.plan_mix(docs), mixing.mix(docs), quality_rules.apply_rules(docs), quality_rules.measures(docs)):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(str(DATA / "documents.parquet"))
    got = language.op2_language(spark, str(DATA)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.99
    assert not any(r["rejected"] for r in got) and all(0 <= r["score"] <= 1 for r in got)
    model = language.fit(docs)
    far = language.predict(spark.createDataFrame([(1, "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία " * 9), (2, "漢字仮名交じり文" * 30), (3, "12 34 !?"), (4, None), (5, "")], "doc_id long, text string"), model)
    rows_ = {r["doc_id"]: r for r in far.collect()}
    assert all(rows_[i]["rejected"] for i in rows_)
    assert [rows_[i]["lang_pred"] for i in (3, 4, 5)] == ["und"] * 3 and [rows_[i]["score"] for i in (3, 4, 5)] == [0.0] * 3
    assert rows_[1]["lang_pred"] in model.langs


def test_language_edges(spark):
    docs = clashing(spark, edge_rows())
    got = language.predict(docs, language.fit(docs))
    assert got.count() == len(edge_rows())
    assert {r["lang_pred"] for r in got.collect()} <= {"en", "fr", "de", "und"}
    kept = language.accepted(docs, language.fit(docs))
    assert kept.columns == docs.columns and kept.where("text is null or trim(text) = ''").count() == 0
    none = language.fit(docs.where("lang = 'xx'"))
    assert none is None and {(r["lang_pred"], r["score"], r["rejected"]) for r in language.predict(docs, none).collect()} == {("und", 0.0, True)}
    assert language.predict(docs.limit(0), none).count() == 0
    parts = language.vector("ab" * 10)
    assert parts.shape == (language.DIMENSIONS,)


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_ordinal_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(str(DATA.parent / "sf0.1" / f"{t}.parquet")) for t in ("documents", "labels"))
    model = ordinal.fit(docs, labels.where("doc_id % 4 <> 1"))
    assert model.thresholds[0] < model.thresholds[1]
    got = ordinal.score(docs, model).join(labels, "doc_id").where("doc_id % 4 = 1").collect()
    grade = np.array([0 if r["toxic"] else 2 if r["quality"] else 1 for r in got])
    chosen, expected = np.array([r["selected"] for r in got]), np.array([r["expected_grade"] for r in got])
    assert chosen[grade == 2].mean() > 0.95 and chosen[grade == 0].mean() < 0.1 and chosen[grade == 1].mean() < 0.15
    assert expected[grade == 0].mean() < expected[grade == 1].mean() < expected[grade == 2].mean()
    assert all(0 <= r["tail_prob"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in got)


def test_ordinal_slopes():
    """Fitting lowers the loss, and words with a clear meaning get their sign."""
    r = np.random.default_rng(3)
    docs, grades = [], []
    for i in range(600):
        g = i % 3
        docs.append(np.unique(np.append(r.integers(100, 5000, 30), g)))
        grades.append(g)
    m = ordinal.fit_features(docs, np.array(grades))
    assert m.weights[0] < m.weights[1] < m.weights[2] and np.abs(m.weights[100:5000]).max() < 1
    tails = m.tails(np.array([m.weights[d].sum() for d in docs]))
    assert ((tails > 0.5).sum(axis=1) == grades).mean() > 0.98


def test_ordinal_edges(spark):
    docs = clashing(spark, edge_rows())
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, None), (9, None, None), (None, 1, 1), (77, 1, 0)], "doc_id long, quality int, toxic int")
    for model in (ordinal.fit(docs, labels), ordinal.fit(docs, labels.limit(0))):
        got = ordinal.score(docs, model)
        assert got.count() == len(edge_rows())
        assert not any(r["selected"] for r in got.where("doc_id in (0, 1, 2)").collect())
    assert ordinal.score(docs.limit(0), model).count() == 0


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_pipeline_stages(spark):
    """Every stage against a brute-force run of its rule on its own input."""
    cp = pytest.importorskip("corpus_pipeline")
    from test_copies import brute_exact
    from test_near_copies import brute_kept
    from test_tokens import checked_pieces

    sf = str(DATA.parent / "sf0.001")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    steps = dict(cp.STAGES)
    assert list(steps) == ["language", "exact_dedup", "near_dedup", "mixing", "packing"]
    for name, stage in cp.STAGES:
        before = [tuple(r) for r in docs.collect()]
        out = stage(spark, docs, sf)
        after = [r for r in out.collect()]
        if name != "packing":
            assert out.columns == names
            tuples = sorted(tuple(r) for r in after)
        if name == "language":
            assert tuples == sorted(before)  # all of these documents are clean text of one of the languages
        elif name == "exact_dedup":
            assert [r[0] for r in tuples] == sorted(r[0] for r in brute_exact(before) if r[3])
        elif name == "near_dedup":
            assert [(False, r[0]) for r in tuples] == brute_kept(before)
        elif name == "mixing":
            size = defaultdict(int)
            for r in before:
                size[r[3]] += len(WORD.findall(r[1]))
            got = defaultdict(int)
            for r in tuples:
                got[r[3]] += len(WORD.findall(r[1]))
            longest = max(len(WORD.findall(r[1])) for r in before)
            assert all(abs(got[s] - t) <= longest for s, t in brute_targets(size).items()) and set(tuples) <= set(before)
        else:
            checked_pieces(before, after)
        docs = spark.createDataFrame(after, out.schema)
    assert cp.run(spark, sf).agg(F.sum("length")).first()[0] == sum(r["length"] for r in after)


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_sql(spark):
    import duckdb

    from inkmill import llm

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    for name, sql in llm.oracle_sql().items():
        got = llm.queries()[name](spark, str(DATA))
        found = duck.execute(sql)
        assert [d[0] for d in found.description] == got.columns
        assert listed(got) == sorted(map(tuple, found.fetchall()), key=repr)
