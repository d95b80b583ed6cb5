"""Ranked lexical search: the K best documents of each item, by TPUT (three-phase uniform threshold) over term-partitioned postings.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case. With N documents that have a term, L terms in them, n terms in
a document, df documents that hold a term and tf occurrences in the document, a term's part of the score is
w * (10^9 * tf div (1000 * tf + 20 * m)), w = floor(1000 * ln((2N + 2) / (2df + 1))), m = 50 + 50 * n * N div L, all in integers.

The documents are read once. Every task deals its documents out in blocks of BLOCK and makes a list for each block and term: which documents, how often. Lists go by term and block
to one place each and are written: the postings. Only terms that a fixed bitmap of the items' terms knows are kept; one that it knows by mistake is in no item.

1. Heads: of each term the K largest parts. Summed by item and document they are lower bounds; the K-th largest of an item's is tau1. The exact scores of its HEADS * K best documents by heads
   are looked up: the K-th largest of them, tau, is a better bound.
2. Threshold: an item's terms, T of them, all get the threshold ceil(tau1 / T) (from tau it would be higher, but leave more open). A document without a part that reaches it can't reach tau1. Every list's entries that reach the lowest threshold
   of a group of items are fetched to the documents' blocks, where each item sums those that reach its own. What a document has not shown is bounded: a part
   below the threshold, and at most the term's largest. Documents whose upper bound reaches tau and the K-th lower bound of their block are candidates, and
   of these, all whose upper bound reaches tau2, the K-th lower bound of all.
3. Look-up: the candidates' parts below the threshold are taken from the lists, and the exact scores ranked.

Bounds: a block's lists are held at once, one block and group of ITEMS items at a time (BLOCK documents' entries of these items' terms, 6 bytes each); a term of all documents is dealt out by
block; two numbers (N, L) and the bitmap reach the driver. Ranks are windows that Spark cuts within each task first.

Edge cases: null text and text without a term: not a document; null and repeated ids are documents of their own, and rank by id among equal scores, nulls last; items without a term
have no rows; a repeated item is an item of its own; fewer than K documents with a score above 0: all of them; texts of any length are read a megabyte at a time; empty tables give an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import map_in_arrow, scratch
from .common import LOWER, PIECE, small_side, staged, table

K = 50
#: Documents of a block; offsets in it have 16 bits.
BLOCK = 8192
HEADS = 4
#: Items whose lists are fetched together.
ITEMS = 64
BITMAP_BITS = 22
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_APART = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def terms_of(data: bytes, size: int = PIECE) -> Counter[bytes]:
    """The terms of a UTF-8 text, with their counts."""
    if len(data) <= size:
        return Counter(_TERM.findall(data.translate(LOWER)))
    out: Counter[bytes] = Counter()
    at = 0
    while at < len(data):
        cut = _APART.search(data, min(at + size, len(data)))
        end = cut.start() if cut else len(data)
        out.update(_TERM.findall(data[at:end].translate(LOWER)))
        at = end
    return out


def _bit(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) & ((1 << BITMAP_BITS) - 1)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """A row for each item and distinct term: item (a number of its own), item_id, term, bit, n_terms."""
    rows = staged(items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text")))
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(terms_of(x.as_py())) if x.is_valid else [] for x in batch.column("text")]
            of = pa.array([i for i, terms in enumerate(found) for _ in terms], pa.int64())
            flat = [t for terms in found for t in terms]
            kept = {c: batch.column(c).take(of) for c in ("item", "item_id")}
            sizes = pa.array([len(found[i]) for i in of.to_pylist()], pa.int32())
            yield pa.RecordBatch.from_pydict(kept | {"term": pa.array(flat, pa.binary()), "bit": pa.array(map(_bit, flat), pa.int32()), "n_terms": sizes})

    return map_in_arrow(rows, run, f"item long, item_id {kind}, term binary, bit int, n_terms int")


def _bitmap(terms: DataFrame) -> bytes:
    """Which bits the terms have: at most 2 ** BITMAP_BITS of them, whatever the items."""
    bits = np.fromiter((r["bit"] for r in terms.select("bit").distinct().toLocalIterator()), np.int64)
    marked = np.zeros(1 << BITMAP_BITS, np.uint8)
    marked[bits] = 1
    return np.packbits(marked, bitorder="little").tobytes()


def postings(docs: DataFrame, bitmap: bytes, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The lists of the terms that bitmap knows, dealt out by term and block: term, block, docs (u16 each), tfs (u32 each), ns (u32 each, the documents' sizes), df.
    A row with a null term holds the block's documents: ids, ns, and n_docs and n_terms of those that have a term."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = f"term binary, block long, docs binary, tfs binary, ns binary, df long, ids array<{kind}>, n_docs long, n_terms long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bool] = {}
        marked = np.frombuffer(bitmap, np.uint8)
        first, made = TaskContext.get().partitionId() << 31, 0
        ids, ns, lists = [], array("I"), {}

        def flush(kind: pa.DataType) -> pa.RecordBatch:
            sizes = np.frombuffer(ns, np.uint32)
            terms = sorted(lists)
            at = [np.frombuffer(lists[t][0], np.uint16) for t in terms]
            tfs = [lists[t][1].tobytes() for t in terms]
            n = len(terms)
            return pa.RecordBatch.from_pydict(
                {
                    "term": pa.array([None, *terms], pa.binary()),
                    "block": pa.array([first + made] * (n + 1), pa.int64()),
                    "docs": pa.array([None, *(x.tobytes() for x in at)], pa.binary()),
                    "tfs": pa.array([None, *tfs], pa.binary()),
                    "ns": pa.array([sizes.tobytes(), *(sizes[x].tobytes() for x in at)], pa.binary()),
                    "df": pa.array([None, *map(len, at)], pa.int64()),
                    "ids": pa.array([ids] + [None] * n, pa.list_(kind)),
                    "n_docs": pa.array([len(ids)] + [None] * n, pa.int64()),
                    "n_terms": pa.array([int(sizes.sum(dtype=np.int64))] + [None] * n, pa.int64()),
                }
            )

        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if not text.is_valid or not (found := terms_of(text.as_buffer().to_pybytes())):
                    continue
                place = len(ids)
                ids.append(doc_id)
                ns.append(found.total())
                for term, tf in found.items():
                    keep = known.get(term)
                    if keep is None:
                        bit = _bit(term)
                        keep = bool(marked[bit >> 3] >> (bit & 7) & 1)
                        if len(known) < 1 << 17:
                            known[term] = keep
                    if keep:
                        one = lists.get(term)
                        if one is None:
                            one = lists[term] = (array("H"), array("I"))
                        one[0].append(place)
                        one[1].append(tf)
                if len(ids) == block:
                    yield flush(kind)
                    ids, ns, lists, made = [], array("I"), {}, made + 1
        if ids:
            yield flush(kind)

    return map_in_arrow(source, run, schema).repartition("term", "block")


def _parts(w: int, tfs: bytes, ns: bytes, n: int, length: int) -> np.ndarray:
    """A list's parts of the score. n, length: N and L of the corpus."""
    tf, m = np.frombuffer(tfs, np.uint32).astype(np.int64), 50 + (50 * n * np.frombuffer(ns, np.uint32).astype(np.int64)) // length
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _heads(k: int, n: int, length: int):
    """Of each list, the k largest parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict = {"term": [], "block": [], "place": [], "part": []}
            for term, block, at, tfs, ns, w in zip(*(batch.column(c).to_pylist() for c in ("term", "block", "docs", "tfs", "ns", "w"))):
                part = _parts(w, tfs, ns, n, length)
                top = np.argpartition(-part, k)[:k] if len(part) > k else np.arange(len(part))
                out["term"] += [term] * len(top)
                out["block"] += [block] * len(top)
                out["place"] += np.frombuffer(at, np.uint16)[top].tolist()
                out["part"] += part[top].tolist()
            yield pa.RecordBatch.from_pydict({"term": pa.array(out["term"], pa.binary()), "block": pa.array(out["block"], pa.int64()), "place": pa.array(out["place"], pa.int32()), "part": pa.array(out["part"], pa.int64())})

    return run


def _summed(k: int, n: int, length: int):
    """Input: rows block, grp, in this order, of each first the one with ids, then lists with uses (item, least, tau, rest) and w, most. Output: candidates."""

    def of_block(ids: pa.Scalar, lists: list) -> pa.RecordBatch:
        size = len(ids)
        by_item: dict[int, list] = {}
        for uses, most, at, part in lists:
            for use in uses:
                by_item.setdefault(use["item"], [use]).append((most, at, part))
        items, places, lower, upper = [], [], [], []
        for item, (use, *own) in by_item.items():
            least = use["least"]
            low, unseen = np.zeros(size, np.int64), np.full(size, use["rest"], np.int64)
            for most, at, part in own:
                reach = part >= least
                low[at[reach]] += part[reach]
                unseen[at[reach]] -= min(least - 1, most)
            shown = np.flatnonzero(low)
            if not len(shown):
                continue
            bound = use["tau"]
            if len(shown) > k:
                bound = max(bound, int(np.partition(low[shown], -k)[-k]))
            shown = shown[(low + unseen)[shown] >= bound]
            items += [item] * len(shown)
            places.append(shown)
            lower.append(low[shown])
            upper.append((low + unseen)[shown])
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        chosen = ids.values.take(pa.array(at)) if len(at) else ids.values.slice(0, 0)
        joined = [np.concatenate(x) if x else at for x in (lower, upper)]
        return pa.RecordBatch.from_pydict({"item": pa.array(items, pa.int64()), "place": pa.array(at, pa.int32()), "doc_id": chosen, "low": pa.array(joined[0], pa.int64()), "high": pa.array(joined[1], pa.int64())})

    def with_block(found: pa.RecordBatch, block: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"block": pa.array([block] * len(found), pa.int64())} | {c: found.column(c) for c in found.schema.names})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, lists = None, None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "grp", "uses", "w", "most", "docs", "tfs", "ns"))
            for own, block, grp, uses, w, most, at, tfs, ns in zip(batch.column("ids"), *columns):
                if (block, grp) != now:
                    if lists:
                        yield with_block(of_block(ids, lists), now[0])
                    now, ids, lists = (block, grp), own, []
                if uses is not None:
                    lists.append((uses, most, np.frombuffer(at, np.uint16), _parts(w, tfs, ns, n, length)))
        if lists:
            yield with_block(of_block(ids, lists), now[0])

    return run


def _looked_up(n: int, length: int):
    """Input: a list with w, item, least and places. Output: the parts below least of the documents at these places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict = {"item": [], "block": [], "place": [], "part": []}
            names = ("item", "block", "w", "least", "docs", "tfs", "ns")
            for places, item, block, w, least, at, tfs, ns in zip(batch.column("places"), *(batch.column(c).to_pylist() for c in names)):
                at, part = np.frombuffer(at, np.uint16), _parts(w, tfs, ns, n, length)
                want = np.sort(places.values.to_numpy())
                found = np.minimum(np.searchsorted(at, want), len(at) - 1)
                hit = found[(at[found] == want) & (part[found] < least)]
                out["item"] += [item] * len(hit)
                out["block"] += [block] * len(hit)
                out["place"] += at[hit].tolist()
                out["part"] += part[hit].tolist()
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int32() if c == "place" else pa.int64()) for c, v in out.items()})

    return run


def _kth(rows: DataFrame, value: str, k: int) -> DataFrame:
    """item, tau: the k-th largest value of each item that has so many rows."""
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col(value).desc()))
    return rows.withColumn("r", place).where(F.col("r") <= k).groupBy("item").agg(F.min(value).alias("tau"), F.count("*").alias("had")).where(F.col("had") == k).drop("had")


def _fetched(n: int, length: int):
    """Of each list, the entries that reach lowest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict = {"docs": [], "tfs": [], "ns": []}
            for w, lowest, *parts in zip(*(batch.column(c).to_pylist() for c in ("w", "lowest", "docs", "tfs", "ns"))):
                reach = _parts(w, parts[1], parts[2], n, length) >= lowest
                for name, kind, part in zip(out, (np.uint16, np.uint32, np.uint32), parts):
                    out[name].append(np.frombuffer(part, kind)[reach].tobytes())
            kept = {c: batch.column(c) for c in ("block", "grp", "uses", "w", "most")}
            yield pa.RecordBatch.from_pydict(kept | {c: pa.array(v, pa.binary()) for c, v in out.items()})

    return run


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: of each item the k documents with the highest scores above 0, equal ones by ascending id."""
    spark = docs.sparkSession
    asked = staged(item_terms(items, item_col, item_text_col))
    folder, lists_of = scratch(spark, "postings"), postings(docs, _bitmap(asked), id_col, text_col, block)
    lists_of.write.mode("overwrite").parquet(folder)
    made = spark.read.schema(lists_of.schema).parquet(folder)
    blocks, lists = made.where("term is null").select("block", "ids", "n_docs", "n_terms"), made.where("term is not null").select("term", "block", "docs", "tfs", "ns", "df")
    corpus = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("length")).first()
    n, length = corpus["n"], max(corpus["length"], 1)
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    terms = lists.groupBy("term").agg(F.sum("df").alias("df")).join(asked.select("term").distinct(), "term", "left_semi")
    terms = staged(terms.select("term", weight.alias("w")))
    lists = lists.drop("df")

    # 1: heads
    first = lambda by, value: F.row_number().over(Window.partitionBy(by).orderBy(F.col(value).desc()))
    heads = map_in_arrow(lists.join(small_side(terms), "term"), _heads(k, n, length), "term binary, block long, place int, part long")
    heads = staged(heads.withColumn("r", first("term", "part")).where(F.col("r") <= k).drop("r"))
    lower = asked.select("item", "term").join(heads, "term").groupBy("item", "block", "place").agg(F.sum("part").alias("low"))
    lower = staged(lower.withColumn("r", first("item", "low")).where(F.col("r") <= HEADS * k))
    scored = staged(asked.join(terms, "term").select("item", "item_id", "term", "n_terms", "w"))

    def looked_up(near: DataFrame, of: DataFrame) -> DataFrame:
        """The parts below least, by the terms in of, of the documents near: item, block, place, part."""
        wanted = near.groupBy("item", "block").agg(F.collect_list("place").alias("places"))  # at most a block's documents
        wanted = wanted.join(small_side(of.select("item", "term", "w", "least")), "item")
        return map_in_arrow(wanted.join(lists, ["term", "block"]).drop("term"), _looked_up(n, length), "item long, block long, place int, part long")

    whole = looked_up(lower, staged(scored.withColumn("least", F.lit((1 << 63) - 1)))).groupBy("item", "block", "place").agg(F.sum("part").alias("score"))
    bounds = _kth(lower, "low", k).withColumnRenamed("tau", "tau1").join(_kth(whole, "score", k), "item")

    # 2: one threshold for all lists of an item
    groups = -(-asked.select("item").distinct().count() // ITEMS)
    uses = scored.join(heads.groupBy("term").agg(F.max("part").alias("most")), "term").join(bounds, "item", "left")
    uses = uses.withColumn("tau", F.coalesce("tau", F.lit(0))).withColumn("least", F.greatest(F.expr("(coalesce(tau1, 0) + n_terms - 1) div n_terms"), F.lit(1)))
    uses = uses.withColumn("rest", F.sum(F.least(F.col("least") - 1, "most")).over(Window.partitionBy("item")))
    uses = staged(uses.select("item", "item_id", F.pmod(F.xxhash64("item"), F.lit(max(groups, 1))).cast("int").alias("grp"), "term", "w", "most", "tau", "least", "rest"))
    shared = uses.groupBy("term", "grp").agg(F.collect_list(F.struct("item", "least", "tau", "rest")).alias("uses"), F.min("least").alias("lowest"), F.first("w").alias("w"), F.first("most").alias("most"))
    shared = staged(shared.where("most >= lowest"))  # about ITEMS uses a row at most
    kept = "block long, grp int, uses array<struct<item:bigint,least:bigint,tau:bigint,rest:bigint>>, w long, most long, docs binary, tfs binary, ns binary"
    fetched = map_in_arrow(lists.join(small_side(shared), "term").drop("term"), _fetched(n, length), kept).withColumn("kind", F.lit(1))
    dealt = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(max(groups, 1) - 1))).alias("grp"), "ids", F.lit(0).alias("kind"))
    dealt = dealt.unionByName(fetched, allowMissingColumns=True).repartition("block", "grp").sortWithinPartitions("block", "grp", "kind")
    kind = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    near = staged(map_in_arrow(dealt, _summed(k, n, length), f"block long, item long, place int, doc_id {kind}, low long, high long"))
    near = staged(near.join(small_side(staged(_kth(near, "low", k))), "item", "left").where("tau is null or high >= tau").drop("tau", "high"))

    # 3: exact scores of the candidates
    missing = looked_up(near, uses.where("least > 1"))
    parts = near.select("item", "block", "place", F.col("low").alias("part"), "doc_id").unionByName(missing, allowMissingColumns=True)
    exact = parts.groupBy("item", "block", "place").agg(F.sum("part").alias("score"), F.first("doc_id", ignorenulls=True).alias("doc_id"))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "block", "place"))
    ranked = staged(exact.where("score > 0").withColumn("rank", place).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score"))
    return ranked.join(uses.select("item", "item_id").distinct(), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH q AS (SELECT DISTINCT item_id, unnest({_SQL_TERMS}) AS term FROM benchmark),
t AS (SELECT row_number() OVER () AS r, doc_id, {_SQL_TERMS} AS ts FROM documents),
d AS (SELECT r, doc_id, len(ts) AS n, ts FROM t WHERE len(ts) > 0),
c AS (SELECT count(*) AS n_docs, cast(sum(n) AS bigint) AS n_terms FROM d),
x AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1))) AS bigint) AS w FROM x, c GROUP BY term, n_docs),
s AS (SELECT item_id, x.r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS score
  FROM x JOIN d USING (r) JOIN w USING (term) JOIN q USING (term), c GROUP BY ALL)
SELECT item_id, cast(rank AS int) AS rank, doc_id, cast(score AS bigint) AS score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s JOIN d USING (r) WHERE score > 0) WHERE rank <= {K}
"""
