"""A corpus pipeline of five stages, each one an operator of inkmill.llm applied to all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A stage's
result is written as Parquet and read again as the next one's input, which also cuts the lineage; a stage's input goes when its result is written, the
last intermediate result when the driver ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkmill.llm import exact_dedup, language, mixing, packing, simhash
from inkmill.llm.common import table
from inkmill.session import remove, scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near one of the languages that their labels teach; those without a letter, or too far away, go."""
    return language.accepted(docs, language.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of texts that are equal but for white space."""
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: a Jaccard similarity of 0.8 or more on five-word shingles."""
    return simhash.near_dedup(docs, shingle=5, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to the target weights of the sources takes them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 2048 token ids."""
    return packing.pack(docs, table_size=100_000)  # the workers that serve all stages keep this table


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL has neither the near groups' closure over links nor the tokenizer; tests/llm compares with a brute-force run instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the result is the last stage's."""
    folder, before = scratch(spark, "pipeline"), None
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
