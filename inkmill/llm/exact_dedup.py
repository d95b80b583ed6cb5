"""Exact dedup by deterministic block naming.

A text, less the six ASCII white space characters, is cut into blocks of 4096 bytes. Every distinct block gets
an integer name; then every distinct pair of adjacent names gets one, and so on, until one name is left a
document. Texts of the same length have the same blocks at the same places at every level, so two documents are equal
if and only if length and last name agree.

A name is (h, r): h the 64-bit hash of the content, r the content's place in the sort order of the distinct
contents that share h, 0 for the first. Names never collide: the contents that share a hash are sorted and numbered
exactly. The least and the greatest content of each hash, taken within each task first (a block that a third of all documents hold
is sent once a task), tell whether it has several. Only where they differ, that is for a true 64-bit collision, are the contents
themselves numbered, and blocks take r from that table by a join on the content. One such round is run a level, log2 of the longest document's blocks in all.

Edge cases: null counts as the empty text; all empty texts are equal; rows with the same id are rows of their own;
a null id is kept and sorts after all others; other columns are kept by dedup() and ignored by identities().
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE_RUN, keep_rows, small_side, staged, table

BLOCK_BYTES = 4096
_NAME = "array<struct<h:bigint,r:int>>"


def _numbered(contents: DataFrame) -> DataFrame | None:
    """contents: h, content. The distinct contents that aren't the first of their h in sort order, with r from 1, staged; None if there are none."""
    # least and greatest content of each hash: one shuffle, after as much is done within each task
    shared = contents.groupBy("h").agg(F.min("content").alias("first"), F.max("content").alias("last")).where("first <> last")
    shared = staged(shared.select("h"))
    if not shared.limit(1).count():
        return None
    later = contents.join(small_side(shared), "h", "left_semi").distinct()
    return staged(later.select("h", "content", (F.row_number().over(Window.partitionBy("h").orderBy("content")) - 1).alias("r")).where("r > 0"))


def _blocks(norm: Column) -> Column:
    raw = norm.cast("binary")
    n = F.greatest(F.ceil(F.octet_length(norm) / BLOCK_BYTES), F.lit(1))
    return F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: F.substring(raw, i * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES)))


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, "")


def _fix(names: DataFrame, contents: DataFrame, collisions: DataFrame) -> DataFrame:
    """names with r put right where a content isn't the first of its hash. contents: row, place, h, content."""
    hit = contents.join(small_side(collisions), ["h", "content"])
    by_row = hit.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("place", "r"))).alias("fixed"))
    patched = names.join(by_row, "row", "left")
    return patched.withColumn("names", F.when(F.col("fixed").isNull(), F.col("names")).otherwise(F.transform("names", lambda x, i: F.struct(x["h"].alias("h"), F.coalesce(F.try_element_at("fixed", i), F.lit(0)).alias("r"))))).drop("fixed")


def _paired(names: Column) -> Column:
    """The adjacent pairs of names; the last one of an odd number is paired with nothing."""
    half = F.ceil(F.size(names) / 2).cast("int")
    return F.transform(F.sequence(F.lit(0), half - 1), lambda i: F.struct(F.get(names, 2 * i).alias("a"), F.get(names, 2 * i + 1).alias("b")))


def _exploded(docs: DataFrame, array: Column, hashed) -> DataFrame:
    return docs.select("row", F.posexplode(array).alias("place", "content")).select("row", "place", hashed(F.col("content")).alias("h"), "content")


def _pair_hash(p: Column) -> Column:
    return F.xxhash64(p["a"]["h"], p["a"]["r"], p["b"]["h"], p["b"]["r"])


def named(norms: DataFrame, hashed=F.xxhash64) -> DataFrame:
    """norms: row (an id of the row), norm (the text without white space), and more columns. Adds n_bytes, h and r, the
    collision-free identity; the column norm goes. hashed: the hash of a block, another one in tests."""
    found = _numbered(_exploded(norms, _blocks(F.col("norm")), hashed).select("h", "content"))
    if found is not None:
        norms = staged(norms)  # rows are numbered once and for all before they are joined by number
    level = norms.withColumn("n_bytes", F.octet_length("norm").cast("long")).withColumn(
        "names", F.transform(_blocks(F.col("norm")), lambda b: F.struct(hashed(b).alias("h"), F.lit(0).alias("r"))).cast(_NAME)
    )
    level = level.drop("norm")
    if found is not None:
        level = _fix(level, _exploded(norms, _blocks(F.col("norm")), hashed), found)
    level = staged(level)
    while level.where(F.size("names") > 1).limit(1).count():  # log2 of the longest document's blocks
        pairs = level.where(F.size("names") > 1)
        contents = _exploded(pairs, _paired(F.col("names")), _pair_hash)
        found = _numbered(contents.select("h", "content"))
        named_pairs = F.transform(_paired(F.col("names")), lambda p: F.struct(_pair_hash(p).alias("h"), F.lit(0).alias("r"))).cast(_NAME)
        level = level.withColumn("names", F.when(F.size("names") > 1, named_pairs).otherwise(F.col("names")))
        if found is not None:
            level = _fix(level, contents, found)
        level = staged(level)
    return level.select(*(c for c in level.columns if c != "names"), F.col("names")[0]["h"].alias("h"), F.col("names")[0]["r"].alias("r"))


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashed=F.xxhash64) -> DataFrame:
    """One row a document: row, doc_id, n_points (code points of the text), text_sha256, and the identity n_bytes, h, r."""
    norms = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_points"),
        normalised(F.col(text_col)).alias("norm"),
    )
    return named(norms.withColumn("text_sha256", F.sha2(F.col("norm").cast("binary"), 256)), hashed)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashed=F.xxhash64) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the row with the most code points in
    the whole text stays, of those the one with the smallest id, of those one."""
    rows = identities(docs, id_col, text_col, hashed)
    # the best row first: most code points, then smallest id, then smallest row number; sums by task come before the shuffle
    best = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    stays = rows.groupBy("n_bytes", "h", "r").agg(best.alias("best"), F.count("*").alias("group_size"))
    # staged, so that the join is one of two plain exchanges, whose crowded keys Spark splits
    stays = staged(stays.select("n_bytes", "h", "r", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"))
    out = rows.join(stays, ["n_bytes", "h", "r"])
    return out.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256", "n_bytes", "h", "r")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, all columns kept. Rows that agree in id, length and normalised text count once."""
    best = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("none"), "doc_id", "text_sha256"))
    rows = identities(docs, id_col, text_col).select("n_bytes", "h", "r", "text_sha256", "n_points", "doc_id")
    stays = rows.groupBy("n_bytes", "h", "r").agg(best.alias("b"))
    sha = F.sha2(normalised(F.col(text_col)).cast("binary"), 256)
    points = F.length(F.coalesce(F.col(text_col), F.lit("")))
    return keep_rows(docs, (sha, points, F.col(id_col)), rows, stays.select("b.text_sha256", (-F.col("b.p")).alias("n_points"), "b.doc_id"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
"""
