"""The cumulative table (Parquet), prompt texts, and the list of queries as rows.

The table is a folder with a folder for each run (``_run=...``) that holds the run's new rows. A table that was made elsewhere may be plain Parquet.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SearchTerms
from ..schema import PAPER
from ..session import hadoop_path

#: The column that names a row's run, of the table's folders alone.
RUN = "_run"


def set_aside(spark: SparkSession, path: str) -> list[str]:
    """What sinks.save_table has put beside the table at path and not deleted yet, the latest first."""
    fs, p = hadoop_path(spark, f"{path}.old-*")
    found = sorted(fs.globStatus(p) or [], key=lambda x: -x.getModificationTime())
    return [x.getPath().toString() for x in found]


def current(spark: SparkSession, path: str) -> str | None:
    """Where the table at path is: there, or beside it if a run ended while it was being replaced."""
    fs, p = hadoop_path(spark, path)
    return path if fs.exists(p) else next(iter(set_aside(spark, path)), None)


def exists(spark: SparkSession, path: str) -> bool:
    return current(spark, path) is not None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at path, or an empty one with the columns of a paper if there is none."""
    found = current(spark, path)
    return read_runs(spark, found).drop(RUN) if found else spark.createDataFrame([], PAPER)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all runs, with RUN where the table has it. A run may bring columns that others lack."""
    return spark.read.option("mergeSchema", True).parquet(path)


def by_run(spark: SparkSession, path: str) -> bool:
    """Whether the table at path has a folder for each run."""
    fs, p = hadoop_path(spark, f"{path}/{RUN}=*")
    return bool(fs.globStatus(p))


def read_prompt(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")


def query_rows(spark: SparkSession, terms: SearchTerms) -> DataFrame:
    """One row a query, in the order of the file."""
    return spark.createDataFrame(terms.query_list(), "query_ordinal int, search_topic string, query string")


def flatten_queries(topics: DataFrame) -> DataFrame:
    """topics: topic_idx, topic, queries (an array). The same list, of topics that are data."""
    return topics.select("topic_idx", "topic", F.posexplode("queries").alias("query_idx", "query"))


def union_scans(scans: list[tuple[str, DataFrame]]) -> DataFrame:
    """The rows of several scans, each tagged with the topic that asked for it, with seq = (scan, place in it)."""
    from functools import reduce

    tagged = [d.withColumns({"search_topic": F.lit(topic), "seq": F.struct(F.lit(i).alias("scan"), F.col("seq").alias("rank"))}) for i, (topic, d) in enumerate(scans)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
