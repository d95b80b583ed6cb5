"""What the operators of this subpackage share: reading tables, cutting lineage, text expressions."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

#: White space of the word rule ``[^\x20\x09-\x0D]+``: the six ASCII characters.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of a text that are looked at together.
PIECE = 1 << 20
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

#: A side under this many rows (of at most ROW_BYTES each) is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 50_000


def word_pieces(data: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of data in order, a list for about every size bytes; no word is cut."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        if words := data[at:end].split():
            yield words
        at = end


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, read by Spark alone, so that any store that Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Compute df once and cut its lineage, in the folder all executors share (``spark.checkpoint.dir``).

    The files go when the driver's garbage collector finds the DataFrame unused and
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame) -> DataFrame:
    """df, marked for broadcast if a count finds it small enough; otherwise unmarked, to be joined by shuffle.

    Only for tables of a few short columns that are already staged, so that the count is cheap.
    """
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row however often body uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The array of words of a text; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def word_count(text: Column) -> Column:
    """The number of words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keep_rows(docs: DataFrame, key: tuple[Column, ...], rows: DataFrame, stays: DataFrame) -> DataFrame:
    """The rows of docs whose key is among the rows of stays, all columns kept; rows with the same key count once. rows: the keys of
    all rows of docs, as columns with the names of those of stays.

    Nulls in a key are equal to each other. Only the keys that go are joined with docs, and the rows of keys that stay but come again are
    taken apart, so that what stays isn't shuffled where little goes.
    """

    def text_of(parts) -> Column:
        # a value begins with a plus, so that no text is taken for a null
        return F.concat_ws(":", *(F.coalesce(F.concat(F.lit("+"), p.cast("string")), F.lit("-")) for p in parts)).alias("key")

    keys = rows.select(text_of(F.col(c) for c in stays.columns)).groupBy("key").agg((F.count("*") > 1).alias("twice"))
    kept = stays.select(text_of(F.col(c) for c in stays.columns)).withColumn("stays", F.lit(True))
    special = staged(keys.join(kept, "key", "left").where("twice or stays is null").select("key", (F.col("stays").isNotNull()).alias("stays")))
    marked = docs.select(text_of(key), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    plain = marked.join(small_side(special.select("key")), "key", "left_anti").select("row.*")
    again = special.where("stays").select("key")
    if not again.limit(1).count():
        return plain
    return plain.union(marked.join(small_side(again), "key", "left_semi").dropDuplicates(["key"]).select("row.*"))
