"""Mixing sources to target weights by capped water-filling.

Sizes are counted in words. The sources, in code point order with null last, weigh 1, 2, 3, 1, 2, 3, ...; all
of them together are to get as many words as the whole corpus has, in proportion to their weights, but none
more than ``max_epochs`` times its own size: what is above a cap is dealt out by weight among the others until
no source is above its cap. That is a water level: every source gets min(cap, weight * level), and the level is
found by a few rounds of sums over the table of sources (each round one row of sums reaches the driver).

A source's rate target/size is met by whole repetitions of all its documents (the rate's whole part) and one
more of some: its documents are ordered by a seeded hash of 60 bits of id and size (then of the text), and the first of them, as many
as bring their summed size nearest to what is missing, are taken once more. The hash space is cut into
4096 equal ranges; sums by source and range find the range in which the cut lies, and only that range is
looked at row by row, so no task ever gets a source's documents together, however large the source is. Rows that agree in
all of the order are interchangeable. Where the cut falls among such rows, their number that is still to be taken is dealt out over the
partitions they lie in, by counts, and numbered within each.

DataFrame functions only. Edge cases: null and blank texts have size 0 and are taken 0 words; repeated rows and rows with null ids
are documents like others, each taken for itself; a source without words has target 0; an empty table gives an empty result;
other columns are kept by mix() and ignored by plan_mix(). The same input, seed and weights take the same documents
on any number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_side, staged, table, word_count

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = 20240607
RANGE_BITS = 12
HASH_BITS = 60


def _big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def _range_of(u: Column) -> Column:
    return F.shiftright(u, HASH_BITS - RANGE_BITS)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sizes: source, source_size (one row a source). Adds place, weight and target (a double)."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # over one short row a source
    s = staged(
        sizes.withColumn("place", place)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
        .withColumn("cap", F.col("source_size") * max_epochs)
    )
    total = s.agg(F.sum("source_size")).first()[0] or 0
    rest, weight, capped = total, None, F.lit(False)
    while True:  # ends: the level only rises, so the capped sources only grow
        row = s.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0)).alias("at_cap"), F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("weight")).first()
        level = (total - (row["at_cap"] or 0), row["weight"] or 0)
        if level == (rest, weight) or not level[1]:
            break
        rest, weight = level
        capped = _big("weight") * _big(F.lit(rest)) > _big("cap") * _big(F.lit(weight))
    share = F.col("weight") * (F.lit(rest) / F.lit(weight or 1))
    return s.withColumn("target", F.when(capped, F.col("cap").cast("double")).otherwise(F.least(share, F.col("cap").cast("double")))).drop("cap")


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    """source, size, u (places the document in its source), v (a hash of its text)."""
    size = word_count(F.col(text_col))
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), size.cast("string"))
    u = F.conv(F.substring(F.md5(name.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")
    return [F.col(source_col).alias("source"), size.alias("size"), u.alias("u"), F.xxhash64(F.col(text_col)).alias("v")]


def source_cuts(rows: DataFrame, weights=WEIGHTS, max_epochs=MAX_EPOCHS) -> DataFrame:
    """rows: source, size, u, v. One row a source: place, source_size, weight, target, whole, cut_range, cut (size, u, v of the documents
    the cut falls on, or null), quota of tied: how many of these are taken once more than whole times, as are all that come before them."""
    rows = rows.select("source", "size", "u", "v")
    by_range = staged(rows.groupBy("source", _range_of(F.col("u")).alias("range")).agg(F.sum("size").alias("size")))
    targets = source_targets(by_range.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    targets = targets.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    targets = staged(targets.withColumn("need", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))))
    t = small_side(targets.select(F.col("source").alias("source_"), "need"))
    before = F.sum("size").over(Window.partitionBy("source").orderBy("range")) - F.col("size")  # at most 4096 rows a source
    ranges = by_range.withColumn("before", before).join(t, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    # the range that holds the cut: the last one that begins below the need
    edge = ranges.where((F.col("before") < F.col("need")) & (F.col("size") > 0)).groupBy("source").agg(F.max(F.struct("range", "before", "need")).alias("e"))
    edge = staged(edge.select(F.col("source").alias("source_"), F.col("e.range").alias("cut_range"), (F.col("e.need") - F.col("e.before")).alias("missing")))
    inside = rows.join(small_side(edge), F.col("source").eqNullSafe(F.col("source_")) & (_range_of(F.col("u")) == F.col("cut_range")))
    inside = inside.where("size > 0").groupBy("source", "missing", "u", "v", "size").agg(F.count("*").alias("tied"))
    total = F.col("size") * F.col("tied")
    so_far = F.sum(total).over(Window.partitionBy("source").orderBy("u", "v", "size")) - total  # the distinct rows of one range in 4096
    inside = inside.withColumn("so_far", so_far)
    best = F.least(F.greatest(F.ceil((F.col("missing") - F.col("so_far")) / F.col("size") - 0.5), F.lit(0)), F.col("tied")).cast("long")
    inside = inside.withColumn("quota", best).withColumn("off", F.abs(F.col("so_far") + F.col("size") * F.col("quota") - F.col("missing")))
    cut = inside.groupBy("source").agg(F.min(F.struct("off", "u", "v", "size", "quota", "tied")).alias("best"))
    cut = cut.select(F.col("source").alias("source_"), F.struct("best.u", "best.v", "best.size").alias("cut"), F.col("best.quota").alias("quota"), F.col("best.tied").alias("tied"))
    full = targets.join(edge.select("source_", "cut_range"), F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_")
    full = full.join(cut, F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_")
    return staged(full.select("place", "source", "source_size", "weight", "target", "whole", F.coalesce("cut_range", F.lit(-1)).alias("cut_range"), "cut", "quota", "tied"))


def _with_cuts(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """rows with the columns of cuts and repeats, how often the mix takes them."""
    side = small_side(cuts.withColumnRenamed("source", "source_"))
    joined = rows.join(side, F.col("source").eqNullSafe(F.col("source_")), "left").drop("source_")
    r, at = _range_of(F.col("u")), F.struct("u", "v", "size")
    on_cut = F.coalesce(at == F.col("cut"), F.lit(False)) & (r == F.col("cut_range"))
    ahead = (r < F.col("cut_range")) | ((r == F.col("cut_range")) & F.coalesce(at < F.col("cut"), F.lit(False)))

    def repeats(df: DataFrame, extra: Column) -> DataFrame:
        return df.withColumn("repeats", F.when(F.col("size") > 0, F.col("whole") + extra.cast("long")).otherwise(F.lit(0).cast("long")))

    if not cuts.where("quota > 0 and quota < tied").limit(1).count():
        return repeats(joined, ahead | (on_cut & (F.col("quota") > 0)))
    split = on_cut & (F.col("quota") > 0) & (F.col("quota") < F.col("tied"))
    plain = repeats(joined.where(~split), ahead | (on_cut & (F.col("quota") > 0)))
    tied = staged(joined.where(split)).withColumn("held_by", F.spark_partition_id())
    # how many of the rows that lie in earlier partitions there are: one row a partition and source
    counts = staged(tied.groupBy("place", "held_by").agg(F.count("*").alias("n")))
    earlier = F.sum("n").over(Window.partitionBy("place").orderBy("held_by")) - F.col("n")
    number = F.row_number().over(Window.partitionBy("place", "held_by").orderBy("u")) + F.col("earlier")
    tied = tied.join(small_side(counts.select("place", "held_by", earlier.alias("earlier"))), ["place", "held_by"]).withColumn("number", number)
    dealt = repeats(tied, F.col("number") <= F.col("quota"))
    return plain.unionByName(dealt.select(plain.columns))


def plan_mix(docs: DataFrame, weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """One row a document: doc_id, source, size, source_size, weight, target (of its source), repeats, taken."""
    rows = staged(docs.select(F.col(id_col).alias("doc_id"), *_keyed(docs, id_col, text_col, source_col, seed)))
    out = _with_cuts(rows, source_cuts(rows, weights, max_epochs))
    return out.select("doc_id", "source", "size", "source_size", "weight", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The mix itself: the rows of docs, each as many times as the plan takes it, all columns kept."""
    keyed = _keyed(docs, id_col, text_col, source_col, seed)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *keyed)
    keys = staged(docs.select(*keyed))
    mixed = _with_cuts(rows, source_cuts(keys, weights, max_epochs)).where("repeats > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))).select("row.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS weight
  FROM d GROUP BY source
), filled AS (  -- sources in the order in which a rising level reaches their caps
  SELECT *, sum(source_size) OVER () - {MAX_EPOCHS} * (sum(source_size) OVER o - source_size) AS rest, sum(weight) OVER () - (sum(weight) OVER o - weight) AS open
  FROM s WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), level AS (
  SELECT CAST(rest AS DOUBLE) / open AS level FROM filled WHERE weight * rest <= {MAX_EPOCHS} * source_size * open ORDER BY source_size / weight, source NULLS LAST LIMIT 1
), t AS (
  SELECT source, source_size, CASE WHEN weight * rest > {MAX_EPOCHS} * source_size * open THEN CAST({MAX_EPOCHS} * source_size AS DOUBLE)
    ELSE least(weight * (SELECT level FROM level), CAST({MAX_EPOCHS} * source_size AS DOUBLE)) END AS target
  FROM filled
), n AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), r AS (
  SELECT d.doc_id, d.source, d.size, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size AS need,
    row_number() OVER w AS place, CAST(sum(size) OVER w AS BIGINT) AS so_far
  FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source
  WINDOW w AS (PARTITION BY d.source
    ORDER BY size = 0, CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || size), 1, 15) AS BIGINT) ROWS UNBOUNDED PRECEDING)
), c AS (
  SELECT source, arg_min(place, (off, place)) AS cut
  FROM (SELECT source, place, abs(so_far - need) AS off FROM r WHERE size > 0 UNION ALL SELECT DISTINCT source, 0, abs(need) FROM r) GROUP BY source
)
SELECT doc_id, size, source_size, target, CASE WHEN size > 0 THEN size * (whole + CASE WHEN place <= cut THEN 1 ELSE 0 END) ELSE 0 END AS taken
FROM r JOIN c ON r.source IS NOT DISTINCT FROM c.source
"""
