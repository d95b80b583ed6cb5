"""Nulls beside ids that look like them, crowds of copies, and more languages than can be learned."""

import hashlib

import pytest
from pyspark.sql import functions as F

from inkmill.llm import common, exact_dedup, jaccard, language, simhash, substring_dedup, suffix_array

LAST = (1 << 63) - 1
LONG = " ".join(f"w{i}" for i in range(80))


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_the_text_null_is_no_null(spark, partitions):
    found = [("null", LONG), (None, LONG), ("b", LONG), (None, "other"), ("null", "other"), ("-", "third"), (None, "third"), ("+", "third")]
    docs = spark.createDataFrame(found, "doc_id string, text string").repartition(partitions)
    for dedup in (exact_dedup.dedup, simhash.near_dedup):
        assert sorted((r["doc_id"], r["text"]) for r in dedup(docs).collect()) == [("+", "third"), ("b", LONG), ("null", "other")]
    alone = spark.createDataFrame([(None, LONG), ("null", "x")] * 2, "doc_id string, text string").repartition(partitions)
    assert sorted(map(tuple, exact_dedup.dedup(alone).collect()), key=repr) == sorted([(None, LONG), ("null", "x")], key=repr)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_the_last_id_is_no_null(spark, partitions):
    """One text under the largest id, null twice and a smaller id: all but the first keep nothing; without the smaller one the largest id is first."""
    empty = hashlib.sha256(b"").hexdigest()
    for ids in ((LAST, None, None), (5, LAST, None)):
        docs = spark.createDataFrame([(i, LONG) for i in ids], "doc_id long, text string").repartition(partitions)
        kept = {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in substring_dedup.remove_repeats(docs).collect()}
        first = ids[0]
        assert kept[first] == (0, hashlib.sha256(LONG.encode()).hexdigest())
        assert all(kept[i] == (80, empty) for i in set(ids) - {first})
        shared = {r["doc_id"]: (r["n_shared"], r["n_removed"]) for r in suffix_array.shared_passages(docs).collect()}
        assert shared == {i: (80, 0 if i == first else 80) for i in set(ids)}


def test_a_crowd_of_copies_sends_one_text(spark):
    near = LONG.replace("w40 ", "x ")
    docs = spark.createDataFrame([(i, LONG) for i in range(3000)] + [(5000, near)], "doc_id long, text string").repartition(1)
    prints = simhash.wide_prints(docs, "doc_id", "text", 5)
    found = prints.groupBy("node").agg(F.min(F.struct("mark", "doc_id", "n", "fp")).alias("x")).select(F.lit(1).cast("long").alias("root"), "node", "x.mark", "x.doc_id", F.lit(1).alias("chunks"), F.lit(False).alias("hot"))
    sets = jaccard.candidate_sets(docs.repartition(4), common.staged(found), "text", "doc_id", 5)
    assert sets.count() == 2
    assert [r["doc_id"] for r in simhash.near_dedup(docs).collect()] == [0]


def test_more_languages_than_can_be_learned(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), "id").alias("text"), F.concat(F.lit("l"), F.col("id") % 3000).alias("lang"))
    with pytest.raises(ValueError, match="1024"):
        language.fit(docs)
    few = language.fit(docs.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % 40)))
    assert len(few.langs) == 40 and few.centroids.shape[0] == 40 * language.CLUSTERS

