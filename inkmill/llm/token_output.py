"""Writing a corpus as token ids in directly addressable codes, and reading it back.

Documents are put in ascending order of their id over all files (range partitioning, then a sort within each
partition), encoded, and written in segments of about a million ids, each one blob of codes.py. A segment is a
row of a Parquet table, which serves as the container: its commit protocol makes a lost executor or a repeated task
leave no half-written file, and any store that Spark knows will do. A row also has the documents' ids and lengths,
the partition, and the ids before it in its partition; a second, small table has the ids before each partition. So the
place of any token in the whole corpus is known: to read one, the row of its partition is found first, then the segment by literal bounds, which
Parquet's statistics answer (row groups hold a few segments), and the look-up itself is done where the segment is read.

Memory: one segment a task, and the ids of the longest document. Nothing but the table of partitions is
brought together.

Edge cases: null counts as the empty text and has the end id alone; rows with the same id follow each other in the order
of their texts, but may lie in several partitions, so that no id fills one: then those of each partition do, and partitions follow the order of the input; null ids come first; ids may be of any type; an empty table gives no segments and an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import map_in_arrow, scratch
from . import codes
from .common import small_side, table
from .tokens import BYTE_BPE, encoder, vocabulary

END_ID = 2
SEGMENT_IDS = 1 << 20
#: Pieces in the encoder's table; more of them cost memory and save time.
PIECES = 500_000
#: Bytes of a row group of the table of segments.
ROW_GROUP = 4 << 20


def write_tokens(docs: DataFrame, path: str, vocab: str | None = None, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of docs below path (tables ``segments`` and ``parts``). vocab: a tokenizer file, which all executors have."""
    vocab = vocab or vocabulary(BYTE_BPE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocab, PIECES)
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        segment = before = 0
        held, ids, lengths, n = [], [], [], 0

        def flush() -> pa.RecordBatch:
            blob = codes.encode(np.frombuffer(b"".join(held), "<u4"))
            row = {"part": (part, pa.int32()), "segment": (segment, pa.int32()), "before": (before, pa.int64()), "n_tokens": (n, pa.int64())}
            row |= {"doc_ids": (ids, pa.list_(kind)), "lengths": (lengths, pa.list_(pa.int64())), "codes": (blob, pa.binary())}
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in row.values()], list(row))

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if text.is_valid:
                    held.append(encode(text.as_buffer().to_pybytes()))
                held.append(end)
                count = (len(held[-2]) // 4 if text.is_valid else 0) + 1
                ids.append(doc_id)
                lengths.append(count)
                n += count
                if n >= segment_ids:
                    yield flush()
                    segment, before = segment + 1, before + n
                    held, ids, lengths, n = [], [], [], 0
        if n:
            yield flush()

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), text.cast("binary").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "text", "row")  # bounds of ranges are found without reading texts
    ddl = f"part int, segment int, before long, n_tokens long, doc_ids array<{id_type}>, lengths array<long>, codes binary"
    map_in_arrow(rows.select("doc_id", "text"), run, ddl).write.option("parquet.block.size", ROW_GROUP).parquet(f"{path}/segments")
    ends = docs.sparkSession.read.parquet(f"{path}/segments").groupBy("part").agg(F.max(F.col("before") + F.col("n_tokens")).alias("n_tokens"), F.max("n_tokens").alias("longest"))
    start = F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")  # one row a partition
    ends.select("part", start.alias("start"), "n_tokens", "longest").coalesce(1).write.parquet(f"{path}/parts")


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with start, the ids of the corpus before each."""
    parts = spark.read.parquet(f"{path}/parts").select("part", "start")  # one short row for each of the writer's partitions
    found = spark.read.parquet(f"{path}/segments").join(small_side(parts), "part")
    return found.withColumn("start", F.col("start") + F.col("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row a document, decoded from the files: doc_id, start, n_tokens, ids (u32, little-endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = codes.Segment(batch.column("codes")[i].as_buffer()).ids().astype("<u4")
                lengths = batch.column("lengths")[i].values.to_numpy()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                first = batch.column("start")[i].as_py()
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_ids")[i].values,
                        "start": pa.array(starts + first, pa.int64()),
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids": pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    }
                )

    rows = segments(spark, path).select("doc_ids", "lengths", "start", "codes")
    id_type = rows.schema["doc_ids"].dataType.elementType.simpleString()
    return map_in_arrow(rows, run, f"doc_id {id_type}, start long, n_tokens long, ids binary")


def segment_of(spark: SparkSession, path: str, position: int) -> tuple[DataFrame, int]:
    """The segments that may hold the id at a position of the whole corpus (its own, rarely others), and the position within their partition."""
    part = spark.read.parquet(f"{path}/parts").where(F.col("start") <= position).orderBy(F.col("start").desc()).first() if position >= 0 else None
    if part is None or position - part["start"] >= part["n_tokens"]:
        raise IndexError(position)
    at = position - part["start"]
    near = (F.col("part") == part["part"]) & (F.col("before") <= at) & (F.col("before") > at - part["longest"])
    return spark.read.parquet(f"{path}/segments").where(near).select("before", "codes"), at


def token_at(spark: SparkSession, path: str, position: int) -> int:
    """The id at a position of the whole corpus: a few bytes of one segment are looked at, and only the id reaches the driver."""
    rows, at = segment_of(spark, path, position)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for before, data in zip(batch.column("before").to_pylist(), batch.column("codes")):
                found = codes.Segment(data.as_buffer())
                if before <= at < before + len(found):
                    yield pa.RecordBatch.from_pydict({"id": pa.array([found[at - before]], pa.int64())})

    return map_in_arrow(rows, run, "id long").first()["id"]


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
