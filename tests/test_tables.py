import pytest
from pyspark.sql import functions as F

from inkmill import session, sinks
from inkmill.config import Config
from inkmill.operators import aggregates, dedup, filters, order
from inkmill.sinks import save_table, write_markdown
from inkmill.sources.tables import exists, query_rows, read_prompt, read_table
from inkmill.testviews import TERMS

DDL = "seq int, doi string, arxiv_id string, semantic_scholar_id string, openalex_id string, url string, title string"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def papers(spark, *given):
    return spark.createDataFrame([(i, *(tuple(g) + ("",) * 6)[:6]) for i, g in enumerate(given)], DDL)


def test_keep_first(spark):
    p = papers(spark, (" 10.1/A ",), ("10.1/a", "x"), ("", "A1"), ("", "a1 "), ("", "", "", "", "", "Same Title"), ("10.2", "", "", "", "", "Same Title"), (), ("", "", "", "", "  "))
    assert rows(dedup.keep_first(p), "seq") == [(0,), (2,), (4,), (5,)]
    keys = [r[0] for r in p.orderBy("seq").select(dedup.dedup_key(p.columns)).collect()]
    assert keys == ["doi:10.1/a", "doi:10.1/a", "arxiv_id:a1", "arxiv_id:a1", "title:same title", "doi:10.2", "", ""]
    again = dedup.keep_first(dedup.keep_first(p))
    assert rows(again, "seq") == rows(dedup.keep_first(p.repartition(7)), "seq")


def test_merge_keeps_existing_rows(spark):
    old = papers(spark, ("10.1/a",), ()).withColumn("notes", F.lit("mine"))
    new = papers(spark, ("10.1/A",), ("10.3",), (), ()).withColumn("score", F.lit(1.0))
    merged = dedup.merge(old, new)
    assert merged.columns == [*old.columns, "score"]
    assert rows(merged.fillna({"notes": "", "score": 0.0}), "doi", "notes", "score") == [("", "mine", 0.0), ("10.1/a", "mine", 0.0), ("10.3", "", 1.0)]
    assert rows(dedup.merge(None, new), "doi") == [("",), ("10.1/A",), ("10.3",)]
    assert rows(dedup.merge(old, old), *old.columns) == rows(old, *old.columns) == rows(dedup.merge(old, old.limit(0)), *old.columns)
    bare = spark.createDataFrame([("t",)], "title string")  # a table made elsewhere, without seq and most columns
    assert dedup.merge(bare, new).count() == 4


@pytest.mark.parametrize("datasets, preprints, kept", [(True, True, [0, 1, 2, 4, 5]), (False, True, [0, 2, 4, 5]), (False, False, [0, 4, 5])])
def test_repository_policy(spark, datasets, preprints, kept):
    cfg = Config.of({"output_dir": "o", "sota_table_path": "t", "include_repositories": False, "include_datasets": datasets, "include_preprints": preprints})
    df = spark.createDataFrame([(0, False, "x"), (1, True, "Dataset"), (2, True, "preprint"), (3, True, None), (4, None, None), (5, False, "dataset")], "seq int, is_repository boolean, openalex_type string")
    assert [r[0] for r in rows(df.where(filters.repository_allowed(cfg)), "seq")] == kept
    assert df.where(filters.repository_allowed(Config.of({"output_dir": "o", "sota_table_path": "t"}))).count() == 6


def test_prune(spark):
    cfg = Config.of({"output_dir": "o", "sota_table_path": "t", "min_triage_score": 5, "drop_existing_below_min_score": True})
    df = spark.createDataFrame([("7",), ("x",), (None,), (" 5 ",), ("4.9",)], "relevance_score string")
    assert rows(filters.drop_low_scores(df, cfg), "relevance_score") == [(" 5 ",), ("7",)]
    assert filters.drop_low_scores(df.withColumn("triage_score", F.lit(9)), cfg).count() == 5
    assert filters.drop_low_scores(df.toDF("other"), cfg).count() == 5
    assert filters.drop_low_scores(df, Config.of({"output_dir": "o", "sota_table_path": "t", "min_triage_score": 5})).count() == 5


def test_priorities_and_columns(spark):
    df = spark.createDataFrame([("read",), (" SKIM ",), ("ignore",), (None,)], "llm_priority string")
    assert df.where(filters.has_priority(("read", "skim"))).count() == 2
    assert df.where(filters.has_priority(())).count() == 0
    with pytest.raises(ValueError, match="llm_priority"):
        filters.require_columns(df.toDF("x"), "llm_priority")
    assert tuple(aggregates.priority_counts(df).first()) == (4, 1, 1)
    assert tuple(aggregates.priority_counts(df.limit(0), aggregates.any_text(df, "nothing")).first()) == (0, 0, 0, False)


def test_orders(spark):
    df = spark.createDataFrame([(0, 1.0, "2024"), (1, float("nan"), "2025"), (2, 1.0, None), (3, 2.0, "2020"), (4, None, "2026"), (5, 1.0, "2024")], "seq int, relevance_score double, published_date string")
    assert [r["seq"] for r in df.orderBy(*order.table_order(df)).collect()] == [3, 0, 5, 2, 4, 1]
    r = spark.createDataFrame([(0, "skim", "9"), (1, "read", "x"), (2, "READ", "3"), (3, "skim", "10")], "seq int, llm_priority string, triage_score string")
    assert [x["seq"] for x in r.orderBy(*order.report_order(r)).collect()] == [2, 1, 3, 0]
    assert [x["seq"] for x in order.first_n(df, F.col("relevance_score") == 1, 2).collect()] == [0, 2]
    assert order.first_n(df, F.lit(True), None).count() == 6 and order.first_n(df, F.lit(True), 0).count() == 0
    q = spark.createDataFrame([(0, "a", "1"), (1, "a", "3"), (2, "a", "2"), (3, "b", None)], "seq int, query string, published_date string")
    assert rows(order.top_per_query(q, 2), "query", "seq", "rank") == [("a", 1, 1), ("a", 2, 2), ("b", 3, 1)]


def test_counts(spark):
    df = spark.createDataFrame([(0, "b", "t0"), (1, None, "t1"), (2, "a", None), (3, "a", "t3"), (4, "b", "t4")], "seq int, topic_label string, t string")
    assert rows(aggregates.counts_by(df, "topic_label"), "label", "n", "first") == [("Unknown", 1, 1), ("a", 2, 2), ("b", 2, 0)]
    assert tuple(aggregates.run_counts(df, df.limit(3), df.limit(1)).first()) == (5, 3, 1)
    assert df.where("t is not null").agg(aggregates.concat_ordered("t", "seq", "|")).first()[0] == "t0|t1|t3|t4"


def test_save_over_the_table_it_came_from(spark, tmp_path):
    path = str(tmp_path / "table")
    assert read_table(spark, path).count() == 0 and "deep_confidence" in read_table(spark, path).columns
    save_table(spark.createDataFrame([(1, 5.0)], "seq int, relevance_score double"), path)
    save_table(read_table(spark, path).union(spark.createDataFrame([(2, 9.0)], "seq int, relevance_score double")), path)
    assert [tuple(r) for r in read_table(spark, path).coalesce(1).collect()] == [(2, 9.0), (1, 5.0)]
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_a_save_that_ends_between_the_renames(spark, tmp_path, monkeypatch):
    path, real = str(tmp_path / "table"), sinks._rename
    first = spark.createDataFrame([(1, 5.0)], "seq int, relevance_score double")
    save_table(first, path)

    def stops(spark, old, new):
        if new == path:
            raise KeyboardInterrupt
        real(spark, old, new)

    monkeypatch.setattr(sinks, "_rename", stops)
    with pytest.raises(KeyboardInterrupt):
        save_table(read_table(spark, path).union(spark.createDataFrame([(2, 9.0)], first.schema)), path)
    monkeypatch.setattr(sinks, "_rename", real)
    assert not (tmp_path / "table").exists() and exists(spark, path)
    assert [tuple(r) for r in read_table(spark, path).collect()] == [(1, 5.0)]
    save_table(read_table(spark, path).union(spark.createDataFrame([(3, 1.0)], first.schema)), path)
    assert [tuple(r) for r in read_table(spark, path).coalesce(1).collect()] == [(1, 5.0), (3, 1.0)]
    assert not list(tmp_path.glob("table.old-*"))


def test_ordinals(spark):
    df = spark.range(2000).select((F.col("id") * 7919 % 2003).alias("seq")).repartition(7)
    for spread in (1, 4):
        spark.conf.set("spark.sql.shuffle.partitions", spread)
        got = order.with_ordinal(df, [order.Key("seq", descending=True)])
        assert [(r["seq"], r["ordinal"]) for r in got.orderBy("ordinal").collect()] == [(s, i + 1) for i, s in enumerate(sorted((r["seq"] for r in df.collect()), reverse=True))]
    assert order.with_ordinal(df.limit(0), [order.Key("seq")]).count() == 0


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session)


def test_files(spark, tmp_path):
    lines = spark.createDataFrame([(2, "b\n"), (1, "ä"), (3, "")], "line_no int, text string")
    write_markdown(lines, str(tmp_path / "x" / "out.md"))
    assert (tmp_path / "x" / "out.md").read_text(encoding="utf-8") == "ä\nb\n\n"
    assert read_prompt(str(tmp_path / "x" / "out.md")).startswith("ä")
    assert [tuple(r) for r in query_rows(spark, TERMS).orderBy("query_ordinal").collect()][:2] == [(0, "en", "the"), (1, "en", "tion here")]


PAIR = "seq int, relevance_score double, doi string"


def pairs(spark, *found):
    return spark.createDataFrame([(i, s, f"10.1/{i}") for i, s in found], PAIR)


def files(path):
    return {p for p in path.rglob("part-*")}


def test_a_run_writes_its_new_rows_alone(spark, tmp_path):
    path = tmp_path / "table"
    sinks.append_run(pairs(spark, (1, 5.0), (2, 9.0)), str(path), "a")
    first = files(path)
    new = dedup.new_rows(read_table(spark, str(path)), pairs(spark, (2, 1.0), (3, 7.0)).withColumn("more", F.lit("x")))
    sinks.append_run(new, str(path), "b")
    assert rows(read_table(spark, str(path)), "seq", "relevance_score", "more") == [(1, 5.0, None), (2, 9.0, None), (3, 7.0, "x")]
    assert first < files(path)
    sinks.append_run(pairs(spark, (3, 8.0)), str(path), "b")  # done again: its own folder alone
    assert rows(read_table(spark, str(path)), "seq", "relevance_score") == [(1, 5.0), (2, 9.0), (3, 8.0)] and first < files(path)
    sinks.append_run(pairs(spark), str(path), "c")
    assert read_table(spark, str(path)).count() == 3
    assert read_table(spark, str(path)).where("_metadata.file_path is not null").columns == ["seq", "relevance_score", "doi"]


def test_a_run_that_fails_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.append_run(pairs(spark, (1, 5.0)), path, "a")
    bad = pairs(spark, (2, 1.0)).withColumn("doi", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        sinks.append_run(bad, path, "b")
    assert rows(read_table(spark, path), "seq") == [(1,)]
    with pytest.raises(Exception, match="stop"):
        save_table(bad, path)
    assert rows(read_table(spark, path), "seq") == [(1,)] and not list(tmp_path.glob("table.new-*"))


def test_pruning_writes_the_runs_that_lose_rows(spark, tmp_path):
    path = tmp_path / "table"
    for run, found in (("a", [(1, 5.0), (2, 9.0)]), ("b", [(3, 1.0)]), ("c", [(4, 8.0)])):
        sinks.append_run(pairs(spark, *found), str(path), run)
    kept = files(path / "_run=c")
    sinks.keep_in_runs(spark, str(path), lambda t: t.where("relevance_score >= 6"))
    assert rows(read_table(spark, str(path)), "seq") == [(2,), (4,)] and files(path / "_run=c") == kept and not (path / "_run=b").exists()
    before = files(path)
    sinks.keep_in_runs(spark, str(path), lambda t: t.where("relevance_score >= 6"))
    assert files(path) == before


def test_known_keys_by_every_way(spark):
    existing = spark.range(3000).select(F.col("id").alias("seq"), F.concat(F.lit("10.1/"), F.col("id")).alias("doi"))
    new = spark.range(2990, 3020).select(F.col("id").alias("seq"), F.concat(F.lit(" 10.1/"), F.col("id")).alias("doi"), F.lit("t").alias("title")).union(spark.sql("select 5L, null, null").union(spark.sql("select 4L, '', ''")))
    wanted = [(4,), *((i,) for i in range(3000, 3020))]
    keyed = new.select(dedup.key_digest(new.columns).alias("_key")).distinct()
    for broadcast_rows, filter_rows, most in ((100, 1000, 10), (0, 1000, 1500), (0, 0, 3000)):
        known = dedup.known_keys(existing, keyed, broadcast_rows, filter_rows)
        assert known.join(keyed, "_key", "left_semi").count() == 10 and known.count() <= most
    assert sorted(tuple(r) for r in dedup.new_rows(existing, new).select("seq").collect()) == wanted
    with_none = existing.union(spark.sql("select -1L, null"))
    assert sorted(tuple(r) for r in dedup.new_rows(with_none, new).select("seq").collect()) == wanted[1:]
    merged = dedup.merge(existing, new).select("seq", "doi").collect()
    assert sorted(r["seq"] for r in merged) == sorted([*range(3000), *(w[0] for w in wanted)])


def test_no_text_in_the_exchange_of_keys(spark):
    df = spark.createDataFrame([(1, "a title", "text")], "seq int, title string, abstract string")
    plan = dedup.keep_first(df).select("seq")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha2") == 1  # the key is made once


def test_ordinals_of_all_kinds_of_keys(spark):
    import random

    r = random.Random(3)
    made = [(i, r.choice([None, "a", "aé", "2024-01-0%d" % r.randrange(9), "x" * 12, "x" * 12 + r.choice("ab"), ""]), r.choice([None, float("nan"), -1.5, 0.0, 2.0]), r.choice([None, -(2**60), 2**60 + i % 3, i % 5])) for i in range(600)]
    df = spark.createDataFrame(made, "seq int, t string, x double, n long").select("*", F.struct("n", "seq").alias("s"), F.lit(1).alias("range"), F.lit(2).alias("_at")).repartition(5)
    for down in (True, False):
        for keys in (["t", "x", "n", "seq"], ["x", "t", "seq"], ["n", "seq"], ["s"], ["t", "s"]):
            by = [order.Key(k, down if k != "seq" else False) for k in keys]
            got = order.with_ordinal(df, by)
            assert got.columns == [*df.columns, "ordinal"]
            wanted = [(x["seq"], i + 1) for i, x in enumerate(df.orderBy(*(k.sort() for k in by)).collect())]
            assert [tuple(x) for x in got.orderBy("ordinal").select("seq", "ordinal").collect()] == wanted


def test_ordinals_are_lazy_and_read_keys_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(F.col("id").alias("seq"), F.lit("long text").alias("text")).write.parquet(path)
    group = "ordinals-are-lazy"
    spark.sparkContext.setJobGroup(group, "")
    df = spark.read.schema("seq long, text string").parquet(path)
    got = order.with_ordinal(df, [order.Key("seq", True)]).select("seq", "ordinal")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext._jsc.clearJobGroup()
    assert sorted(tuple(r) for r in got.collect()) == [(i, 100 - i) for i in range(100)]
    assert "text" not in got._jdf.queryExecution().executedPlan().toString().replace("text string", "")


def test_long_files_are_written_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "LINES", 7)
    lines = spark.range(100).select((100 - F.col("id")).alias("line_no"), F.concat(F.lit("l"), 100 - F.col("id")).alias("text")).repartition(6)
    target = tmp_path / "deep" / "er" / "x.md"
    for _ in range(2):
        write_markdown(lines, str(target))
        assert target.read_text() == "\n".join(f"l{i}" for i in range(1, 101)) and [p.name for p in target.parent.iterdir()] == ["x.md"]
    write_markdown(lines.limit(0), str(target))
    assert target.read_text() == ""
