"""Accumulation as a stream: new papers are merged into the cumulative table as their files arrive.

Each micro-batch is scored, filtered and merged as a batch run does it, so the table is the same whether papers come all at once or
piece by piece in the same order; a batch from which nothing passes leaves it as it is, and so prunes nothing. A micro-batch writes its new rows as a run of the table, named after it: a replayed one
writes that run again, or nothing where its rows are there already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Config, SearchTerms
from ..plans.triage import add_to_table, score_and_filter
from ..session import remove, scratch


def accumulate(spark: SparkSession, papers: DataFrame, terms: SearchTerms, cfg: Config, checkpoint: str, **trigger) -> StreamingQuery:
    """Start merging the streaming DataFrame papers into the table of cfg. trigger: as for DataStreamWriter.trigger, default availableNow."""

    def merge_batch(batch: DataFrame, number: int) -> None:
        folder = scratch(spark, "batch")
        try:
            _, passed = score_and_filter(batch, terms, cfg)
            passed.write.mode("overwrite").parquet(folder)
            kept = spark.read.schema(passed.schema).parquet(folder)
            if kept.limit(1).count():
                add_to_table(spark, kept, cfg, f"batch-{number}")
        finally:
            remove(spark, folder)

    return papers.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
