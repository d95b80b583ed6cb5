"""Deduplication by a prioritised key, and the insert-only merge into a cumulative table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_key

#: Fields that identify a paper, the surest first (fixed values).
KEY_FIELDS = ("doi", "arxiv_id", "semantic_scholar_id", "openalex_id", "url", "title")
#: So many keys at most are broadcast (32 bytes each), and told by a Bloom filter (2 bytes each).
BROADCAST_ROWS, FILTER_ROWS = 50_000, 16_000_000


def dedup_key(columns: list[str] | None = None) -> Column:
    """field:value of the first field that isn't empty once normalised; empty if none is. columns: those that exist."""
    fields = [f for f in KEY_FIELDS if columns is None or f in columns]
    return F.coalesce(*(F.concat(F.lit(f"{f}:"), F.nullif(normalize_key(f), F.lit(""))) for f in fields), F.lit(""))


def key_digest(columns: list[str] | None = None) -> Column:
    """dedup_key as 32 bytes: what is compared and sent, however long the key."""
    return F.unhex(F.sha2(dedup_key(columns).cast("binary"), 256))


#: The digest of the empty key.
NO_KEY = hashlib.sha256(b"").digest()


def _first_of(df: DataFrame, order: list[Column], keyed: bool = False) -> DataFrame:
    """The first row of each _key; keyed: none for the empty one. Spark keeps one row a key and task before it shuffles (window group limit)."""
    placed = df.withColumn("_place", F.row_number().over(Window.partitionBy("_key").orderBy(*order))).where("_place = 1")
    # a condition on the key alone would be moved below the window and make Spark compute keys twice
    placed = placed.where(F.when(F.col("_place") == 1, F.col("_key") != F.lit(NO_KEY)).otherwise(F.lit(False))) if keyed else placed
    return placed.drop("_place")


def keep_first(papers: DataFrame, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The first paper of each key in the given order; papers without a key go."""
    return _first_of(papers.withColumn("_key", key_digest(papers.columns)), [F.col(c) for c in order], keyed=True).drop("_key")


def schema_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of both, with the columns of old, then those only new has; what a side lacks is null."""
    return old.unionByName(new, allowMissingColumns=True)


def merge(existing: DataFrame | None, new: DataFrame, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """existing and the rows of new whose key it doesn't hold yet. Rows of existing win as a whole, so manual edits stay.

    Within a side the first row of a key in the given order stays; of rows without a key, one stays in all. Rows that tie in the
    order (existing rows of one key, where a table was made elsewhere) are told apart by their content, so that reruns agree.
    """
    parts = [d.withColumn("_side", F.lit(i)) for i, d in enumerate((existing, new)) if d is not None]
    both = parts[0] if len(parts) == 1 else schema_union(parts[0], parts[1])
    both = both.withColumn("_key", key_digest(both.columns))
    tie = F.xxhash64(F.to_json(F.struct(*(F.col(f"`{c}`") for c in both.columns))))
    by = [F.col("_side"), *(F.col(c).asc_nulls_last() for c in order if c in both.columns), tie]
    return _first_of(both, by).drop("_side", "_key")


def _bits(keys: DataFrame, n: int) -> DataFrame:
    """A Bloom filter of n keys with one hash and 16 bits a key: bucket, bits (4096 bytes each)."""
    place = F.pmod(F.xxhash64("_key"), F.lit(max(1 << 15, 1 << (16 * n - 1).bit_length())))
    return keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))


def known_keys(existing: DataFrame, keys: DataFrame, broadcast_rows: int = BROADCAST_ROWS, filter_rows: int = FILTER_ROWS) -> DataFrame:
    """_key of the rows of existing that are among keys (and a few more). Of existing nothing but keys is read or sent, and no key that a Bloom filter of keys doesn't know; few keys are
    broadcast themselves, and where they are too many for a filter of bounded size, all keys of existing are sent."""
    found = existing.select(key_digest(existing.columns).alias("_key"))
    n = keys.limit(filter_rows + 1).count()
    if n <= broadcast_rows:
        return found.join(F.broadcast(keys), "_key", "left_semi")
    if n > filter_rows:
        return found
    place = F.pmod(F.xxhash64("_key"), F.lit(max(1 << 15, 1 << (16 * n - 1).bit_length())))
    told = found.withColumn("p", place).withColumn("bucket", F.bitmap_bucket_number("p")).join(F.broadcast(_bits(keys, n)), "bucket")
    at = F.bitmap_bit_position("p")
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return told.where(F.getbit(byte.cast("long"), (at % 8).cast("int")) == 1).select("_key")


def new_rows(existing: DataFrame, new: DataFrame, order: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The rows of new that merge() would add to existing, whose keys are taken to differ. new is read several times."""
    first = _first_of(new.withColumn("_key", key_digest(new.columns)), [F.col(c) for c in order])
    return first.join(known_keys(existing, first.select("_key")), "_key", "left_anti").drop("_key")
