"""SimHash near-dedup on pigeonhole blocks.

A text is lower-cased (A-Z alone), split into words at ASCII white space and fingerprinted: a bit is set if it is set in over half of the
hashes of the text's shingles. Fingerprints are cut into blocks so that close pairs share a block; documents are joined on blocks, and the
Hamming distance of those that meet is checked. Documents that links connect are one group. There are two searches.

near_groups (op1): 64 bits of XXH64 (seed 42) of four-word shingles, repeats included; linked are fingerprints that differ in at most four
bits, and none is missed. The bits are cut into k blocks. Two fingerprints four bits apart agree on at least k - 4 of them, so
they meet in at least one of the C(k, 4) tables, each of which groups fingerprints by k - 4 chosen blocks. k rises with the number of distinct
fingerprints (6 up to 8 million), so that a group holds a few unrelated fingerprints at any size; the links are the same for every k.

near_dedup (the corpus pipeline): linked are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more. A bit of such a
pair's fingerprints differs with a chance of acos(cosine) / pi, 0.152 at 0.8, so four bits of 64 would find few of them. The fingerprint has WIDE * 64 bits of the set's
shingles; these are cut into blocks of w bits in several seeded orders, as many blocks that a pair at the threshold shares one of them with a chance of
1 - MISS; w is the binary logarithm of the number of fingerprints, so that a block holds about one unrelated one at any size. Where they meet, the Hamming distance
of the first 64 bits is checked (a pair at the threshold is 9.7 bits apart, with a deviation of 2.9; SPREAD deviations pass), and what is
connected by these links are candidates, among which exact intersections decide (jaccard.py): one document of each set sends its text there, however many copies it has. The number of blocks rises with about the fourth root of the corpus.

Bounds: copies share one fingerprint and are searched once. A group is read in sorted order: up to 16
fingerprints all pairs are compared; above, a walk takes one fingerprint at a time, links what is near and leaves it out of
further comparisons, so a crowd of near copies costs about one comparison and one link each, never all its
pairs. Groups above 4096 fingerprints are cut into chunks, and each pair of chunks is a group of its own, so no
task holds more than that at once and nothing is capped. Where chunks would repeat each fingerprint more than C(8, 4) = 70 times, near_groups first splits the group by
all choices of 4 of 8 blocks, again without missing a pair, and only what is crowded still is cut into chunks. Components come from links alone (components.py).

Edge cases: null, empty and blank texts have fingerprint 0; near_groups links them like any other, in near_dedup they are one group, linked to nothing else. Under
four (five) words the whole sequence is the one shingle; very long texts are hashed in pieces of a megabyte; rows with the same id
are rows of their own, in the group of their fingerprint; a null id never names a group, and stays, only where its group
has no other; an empty table gives an empty result; other columns are ignored, near_dedup() keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import acos, ceil, log, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import map_in_arrow
from . import jaccard
from .common import LOWER, keep_rows, small_side, staged, table, word_pieces
from .components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
ALL_PAIRS = 16
CHUNK = 4096
#: Blocks of the tables that the most crowded groups get of their own.
FINER = 8
WIDE = 16
#: Of a pair at the threshold, to share no block.
MISS = 0.005
SPREAD = 3
#: Of the nodes, for the search of crowded blocks.
SAMPLED = 64


def fingerprint(data: bytes) -> int:
    """The 64-bit SimHash of a UTF-8 text, unsigned."""
    digest = xxhash.xxh64_intdigest
    counts, total, held = np.zeros(64, np.int64), 0, []
    for piece in word_pieces(data.translate(LOWER)):
        words = held + piece
        if len(words) < SHINGLE:
            held = words
            continue
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - SHINGLE + 1].tolist()
        hashes = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(starts, ends[SHINGLE - 1 :].tolist())), np.uint64, len(starts))
        for i in range(0, len(hashes), 1 << 16):
            part = hashes[i : i + (1 << 16)].astype("<u8")
            counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(hashes)
        held = words[len(words) - SHINGLE + 1 :]
    if not total:
        return digest(b" ".join(held), SEED) if held else 0
    return sum(1 << k for k in np.flatnonzero(2 * counts > total).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[Column, ...] = ()) -> DataFrame:
    """One row a document: doc_id, more..., fp (the fingerprint as a signed long)."""
    source = docs.select(F.col(id_col).alias("doc_id"), *more, F.col(text_col).cast("string").cast("binary").alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema if f.name != "text") + ", fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint(x.as_buffer().to_pybytes())) if x.is_valid else 0 for x in batch.column("text")]
            kept = {n: batch.column(n) for n in batch.schema.names if n != "text"}
            yield pa.RecordBatch.from_pydict(kept | {"fp": pa.array(fps, pa.int64())})

    return map_in_arrow(source, run, schema)


def tables_of(k: int) -> list[int]:
    """The masks of the tables of k blocks, as signed longs: every choice of k - 4 of them."""
    edges = [64 * i // k for i in range(k + 1)]
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [_signed(sum(blocks[i] for i in chosen)) for chosen in combinations(range(k), k - DISTANCE)]


def block_masks(n: int) -> list[int]:
    """The masks of the tables for n distinct fingerprints."""
    k = DISTANCE + 2
    while n > 4 << (64 * (k - DISTANCE) // k):
        k += 1
    return tables_of(k)


def _near_pairs(fps: np.ndarray, runs: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within distance in the same run; runs: the run's number of each, ascending."""
    left, right = [], []
    for step in range(1, ALL_PAIRS):
        hit = np.flatnonzero((runs[step:] == runs[:-step]) & (np.bitwise_count(fps[step:] ^ fps[:-step]) <= distance))
        left.append(fps[hit])
        right.append(fps[hit + step])
    return np.concatenate(left), np.concatenate(right)


def _walk(fps: np.ndarray, distance: int) -> tuple[list, list]:
    """Links that connect what the links within distance connect among fps: one for each fingerprint but the first of a group."""
    left, right, rest = [], [], fps
    while len(rest):
        first, todo, rest = rest[0], [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            near = np.bitwise_count(rest ^ at) <= distance
            if near.any():
                hit = rest[near]
                left.append(np.full(len(hit), first, np.uint64))  # any link will do that connects the same, and the smallest come again in other blocks
                right.append(hit)
                todo.extend(hit)
                rest = rest[~near]
    return left, right


def _linker(distance: int):
    """Input: rows grp, fp, where the rows of a grp follow each other. Output: links a, b."""

    def links(grp: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        change = np.flatnonzero(np.concatenate(([True], grp[1:] != grp[:-1])))
        sizes = np.diff(np.append(change, len(grp)))
        runs = np.repeat(np.arange(len(sizes)), sizes)
        small = sizes[runs] <= ALL_PAIRS
        a, b = _near_pairs(fps[small], runs[small], distance)
        left, right = [a], [b]
        for at, size in zip(change[sizes > ALL_PAIRS], sizes[sizes > ALL_PAIRS]):
            more = _walk(np.unique(fps[at : at + size]), distance)
            left += more[0]
            right += more[1]
        return pa.RecordBatch.from_pydict({"a": np.concatenate(left).view(np.int64), "b": np.concatenate(right).view(np.int64)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_g, held_f = [], []
        for batch in batches:
            g, f = batch.column("grp").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
            if not len(g):
                continue
            cut = int(np.searchsorted(g[::-1] != g[-1], True))  # rows of the last run, which the next batch may go on with
            cut = len(g) - cut if g[0] != g[-1] else 0
            if cut:
                yield links(np.concatenate([*held_g, g[:cut]]), np.concatenate([*held_f, f[:cut]]))
                held_g, held_f = [], []
            elif held_g and held_g[-1][-1] != g[0]:
                yield links(np.concatenate(held_g), np.concatenate(held_f))
                held_g, held_f = [], []
            held_g.append(g[cut:])
            held_f.append(f[cut:])
        if held_g:
            yield links(np.concatenate(held_g), np.concatenate(held_f))

    return run


def links(fps: DataFrame, n: int) -> DataFrame:
    """fps: the distinct fingerprints, n of them. Links a, b that connect the same fingerprints as all links within DISTANCE."""
    masks = F.array(*(F.lit(m) for m in block_masks(n)))
    rows = fps.select("fp", F.posexplode(F.transform(masks, lambda m: F.col("fp").bitwiseAND(m))).alias("t", "key"))
    crowded = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    crowded = staged(crowded.select("t", "key", F.ceil(F.col("n") / (CHUNK // 2)).cast("int").alias("chunks"), F.col("n") > CHUNK))
    crowded = crowded.toDF("t", "key", "chunks", "hot")
    met = rows.join(crowded, ["t", "key"])
    one = met.where("not hot").select(F.xxhash64("t", "key").alias("grp"), "fp")
    out = one
    if crowded.where("hot").limit(1).count():
        finer = tables_of(FINER)
        hot = met.where("hot").select(F.xxhash64("t", "key").alias("grp"), "fp", "chunks")
        split = F.posexplode(F.transform(F.array(*(F.lit(m) for m in finer)), lambda m: F.col("fp").bitwiseAND(m))).alias("t", "key")
        most = hot.where(F.col("chunks") > len(finer)).select("grp", "fp", split).select(F.xxhash64("grp", "t", "key").alias("grp"), "fp")
        sizes = staged(most.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > 1))
        sizes = sizes.select("grp", F.when(F.col("n") > CHUNK, F.ceil(F.col("n") / (CHUNK // 2))).otherwise(1).cast("int").alias("chunks"))
        hot = hot.where(F.col("chunks") <= len(finer)).unionByName(most.join(sizes, "grp"))
        mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int")
        hot = hot.select("grp", "fp", mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j"))
        out = one.union(hot.select(F.xxhash64("grp", F.least("i", "j"), F.greatest("i", "j")).alias("grp"), "fp"))
    return map_in_arrow(out.repartition("grp").sortWithinPartitions("grp", "fp"), _linker(DISTANCE), "a long, b long").distinct()


def near_groups(prints: DataFrame) -> DataFrame:
    """prints: staged rows with doc_id and fp. Adds component_id, the smallest doc_id that links reach, and root, the
    smallest fingerprint they reach, which names the group also where all its ids are null."""
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(nodes.select("fp"), nodes.count()))
    linked = staged(nodes.join(roots.withColumnRenamed("node", "fp"), "fp"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    moved = staged(linked.join(least, "root").select("fp", "root", "component_id"))
    whole = nodes.join(small_side(moved), "fp", "left")
    whole = whole.select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "first").alias("component_id"))
    return prints.join(staged(whole), "fp")  # one of two plain exchanges, whose crowded fingerprints Spark splits


def fingerprint_text(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The WIDE u64 of a set of hashes; the first of them is the fingerprint of the hashes as they are."""
    factors = np.random.Generator(np.random.PCG64(SEED)).integers(1, 1 << 63, WIDE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    counts = np.zeros(64 * WIDE, np.int64)
    for at in range(0, len(hashes), 240):  # so many that counts of bytes don't overflow
        x = hashes[at : at + 240, None] * factors
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x[:, 0] = hashes[at : at + 240]
        counts += np.add.reduce(np.unpackbits(x.astype("<u8").view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")


def differing(similarity: float) -> float:
    """The chance that a bit differs between the fingerprints of two sets of this Jaccard similarity (and the same size, where it is greatest)."""
    return acos(min(1.0, 2 * similarity / (1 + similarity))) / pi


def wide_blocks(n: int, similarity: float) -> np.ndarray:
    """For n fingerprints: the places of the bits of each block."""
    width = max(8, (n - 1).bit_length())
    hit = (1 - differing(similarity)) ** width
    blocks = 1 if hit >= 1 else ceil(log(MISS) / log(1 - hit))
    r, out = np.random.Generator(np.random.PCG64(SEED)), []
    while len(out) < blocks:
        order = r.permutation(64 * WIDE)
        out += [order[at : at + width] for at in range(0, 64 * WIDE - width + 1, width)]
    return np.array(out[:blocks])


def wide_distance(similarity: float) -> int:
    """The distance of 64 bits that all but a thousandth of the pairs at this similarity keep."""
    p = differing(similarity)
    return round(64 * p + SPREAD * sqrt(64 * p * (1 - p)))


def wide_prints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """One row a document: doc_id, mark (the text's hash), node (its set's hash), n (the set's size), fp, wide (the fingerprint's bytes)."""
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("mark"), text.cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for x in batch.column("text"):
                hashes = jaccard.shingle_set(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle)
                wide = wide_fingerprint(hashes)
                made.append((_signed(xxhash.xxh64_intdigest(hashes.tobytes())), len(hashes), int(wide.view(np.int64)[0]), wide.tobytes()))
            columns = zip(*made) if made else [()] * 4
            kinds = {"node": pa.int64(), "n": pa.int64(), "fp": pa.int64(), "wide": pa.binary()}
            kept = {"doc_id": batch.column("doc_id"), "mark": batch.column("mark")}
            yield pa.RecordBatch.from_pydict(kept | {k: pa.array(c, t) for (k, t), c in zip(kinds.items(), columns)})

    return map_in_arrow(source, run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, mark long, node long, n long, fp long, wide binary")


def _block_rows(blocks: np.ndarray):
    """wide, fp -> a row grp, fp for each block."""
    powers = np.uint64(1) << np.arange(blocks.shape[1], dtype=np.uint64)
    salt = np.arange(len(blocks), dtype=np.uint64) << np.uint64(blocks.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide, fps = batch.column("wide").to_pylist(), batch.column("fp").to_numpy()
            for at in range(0, len(fps), 512):
                bits = np.unpackbits(np.frombuffer(b"".join(wide[at : at + 512]), np.uint8).reshape(-1, 8 * WIDE), axis=1, bitorder="little")
                grp = np.stack([bits[:, b] @ powers for b in blocks], axis=1) + salt
                yield pa.RecordBatch.from_pydict({"grp": grp.reshape(-1).view(np.int64), "fp": np.repeat(fps[at : at + 512], len(blocks))})

    return run


def candidate_links(nodes: DataFrame, similarity: float) -> DataFrame:
    """nodes: staged, fp and wide of each set. Links a, b between the fingerprints of sets that may be similar."""
    run = _block_rows(wide_blocks(max(nodes.count(), 2), similarity))
    rows = map_in_arrow(nodes.select("wide", "fp"), run, "grp long, fp long")
    # blocks that a sample of the nodes shows to be crowded; others are looked at whole in any case, so the sample changes no link
    some = map_in_arrow(nodes.where(F.pmod(F.xxhash64("fp", F.lit(2)), F.lit(SAMPLED)) == 0).select("wide", "fp"), run, "grp long, fp long")
    crowded = some.groupBy("grp").agg(F.count("*").alias("n")).where(F.col("n") > max(2, CHUNK // SAMPLED))
    crowded = staged(crowded.select("grp", F.ceil(F.col("n") * SAMPLED / (CHUNK // 2)).cast("int").alias("chunks")))
    if crowded.limit(1).count():
        side = small_side(crowded)
        mine = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("chunks")).cast("int")
        hot = rows.join(side, "grp").select("grp", "fp", mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j"))
        hot = hot.select(F.xxhash64("grp", F.least("i", "j"), F.greatest("i", "j")).alias("grp"), "fp")
        rows = rows.join(side, "grp", "left_anti").union(hot)
    found = map_in_arrow(rows.repartition("grp").sortWithinPartitions("grp", "fp"), _linker(wide_distance(similarity)), "a long, b long")
    # near copies meet in many blocks: each keeps its link to the smallest it met, and the others it met are linked to that one
    met = found.groupBy("b").agg(F.collect_set("a").alias("met"))  # a few for each block
    met = met.select("b", "met", F.array_min("met").alias("a"))
    return met.select("a", F.explode(F.array_append("met", F.col("b"))).alias("b")).where("a <> b").distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one row of each group of near copies, that with the smallest id, all columns kept."""
    prints = staged(wide_prints(docs, id_col, text_col, shingle))
    nodes = prints.where("n > 0").groupBy("node").agg(F.min(F.struct("mark", "doc_id", "n", "fp")).alias("x"), F.first("wide").alias("wide"))  # equal sets have the same n, fp, wide
    nodes = staged(nodes.select("node", "x.mark", "x.doc_id", "x.n", "x.fp", "wide"))
    roots = staged(components(candidate_links(nodes, similarity)))
    found = nodes.drop("wide").join(small_side(roots.withColumnRenamed("node", "fp")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    linked = staged(jaccard.groups(docs, found, text_col, id_col, shingle, similarity))
    grouped = prints.drop("wide").join(small_side(linked), "node", "left").withColumn("group", F.coalesce("root", "node"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("b")
    stays = grouped.groupBy("group").agg(best).select("b.mark", "b.doc_id")
    return keep_rows(docs, (F.xxhash64(F.col(text_col).cast("string")), F.col(id_col)), prints, stays)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = staged(fingerprints(table(spark, sf_dir, "documents")))
    return near_groups(prints).select("doc_id", fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")
