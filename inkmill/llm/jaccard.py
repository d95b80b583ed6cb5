"""Sets of word shingles, and the groups that exact links between those of high Jaccard similarity make, within given groups of candidates.

A text is lower-cased (A-Z alone), split into words at ASCII white space and turned into the set of the XXH64 hashes of its
shingles. Each candidate's set is sent once to one place, and a walk there takes one set at a time, links what is similar by exact intersection and
leaves it out of further comparisons, so a crowd of near copies costs about one comparison and one link each.

Bounds: equal sets are searched once. Candidates of more than CHUNK hashes are cut into chunks, and each pair of chunks is a
group of its own, so no task holds more than that (or one text) at once and nothing is capped. Only what these pairs link needs components over
all tasks; candidates that one task holds are grouped there.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import map_in_arrow
from .common import LOWER, small_side, staged, word_pieces
from .components import components

CHUNK = 1 << 20


def shingle_set(data: bytes, shingle: int) -> np.ndarray:
    """The distinct hashes of a UTF-8 text's shingles, ascending."""
    digest = xxhash.xxh64_intdigest
    found, held = [], []
    for piece in word_pieces(data.translate(LOWER)):
        words = held + piece
        if len(words) < shingle:
            held = words
            continue
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        found.append(np.fromiter((digest(joined[i:j]) for i, j in zip(starts, ends[shingle - 1 :].tolist())), np.uint64, len(starts)))
        held = words[len(words) - shingle + 1 :]
    if not found:
        return np.array([digest(b" ".join(held))] if held else [], np.uint64)
    return np.unique(np.concatenate(found))


def _walk(nodes: np.ndarray, sets: list[np.ndarray], least: Fraction) -> tuple[list, list]:
    """Links that connect what all links among these sets connect."""
    left, right, rest = [], [], list(range(len(nodes)))
    while rest:
        todo = [rest.pop(0)]
        while todo and rest:
            at = todo.pop()
            a = sets[at]
            sizes = np.fromiter((len(sets[i]) for i in rest), np.int64, len(rest))
            fits = np.flatnonzero((np.minimum(sizes, len(a)) * least.denominator) >= np.maximum(sizes, len(a)) * least.numerator)
            if not len(fits):
                continue
            joined = np.concatenate([sets[rest[i]] for i in fits])
            met = a[np.minimum(np.searchsorted(a, joined), len(a) - 1)] == joined
            both = np.add.reduceat(met, np.concatenate(([0], np.cumsum(sizes[fits])[:-1])), dtype=np.int64)
            near = set(fits[both * least.denominator >= (len(a) + sizes[fits] - both) * least.numerator].tolist())
            hit = [rest[i] for i in sorted(near)]
            left += [nodes[at]] * len(hit)
            right += [nodes[i] for i in hit]
            todo += hit
            rest = [x for i, x in enumerate(rest) if i not in near]
    return left, right


def _own_groups(members: dict, least: Fraction) -> pa.RecordBatch:
    """node, root of what links within these members connect: root is the smallest node."""
    a, b = _walk(np.fromiter(members, np.int64, len(members)), [np.frombuffer(x, np.uint64) for x in members.values()], least)
    root = {}
    for x, y in zip(a, b):  # a link's left end comes before as a right end, unless it begins a group
        root[y] = root.setdefault(x, x)
    smallest = {}
    for node, r in root.items():
        smallest[r] = min(smallest.get(r, node), node)
    return pa.RecordBatch.from_pydict({"a": pa.array([int(x) for x in root], pa.int64()), "b": pa.array([int(smallest[r]) for r in root.values()], pa.int64())})


def _own_links(members: dict, least: Fraction) -> pa.RecordBatch:
    a, b = _walk(np.fromiter(members, np.int64, len(members)), [np.frombuffer(x, np.uint64) for x in members.values()], least)
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _by_group(made, least: Fraction):
    """Input: rows grp, node, hashes, where the rows of a grp follow each other. Output: made of each group with several nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members = None, {}
        for batch in batches:
            for grp, node, hashes in zip(batch.column("grp").to_pylist(), batch.column("node").to_pylist(), batch.column("hashes")):
                if grp != now:
                    if len(members) > 1:
                        yield made(members, least)
                    now, members = grp, {}
                members.setdefault(node, hashes.as_py())
        if len(members) > 1:
            yield made(members, least)

    return run


def candidate_sets(docs: DataFrame, found: DataFrame, text_col: str, id_col: str, shingle: int) -> DataFrame:
    """found: root, node, mark and doc_id (of a document that has the set), chunks, hot. Adds hashes, the set, one row a node and task, so that of a crowd of copies only the one that
    is named is read, and of rows that repeat as a whole one a task."""
    text = F.col(text_col).cast("string")
    texts = docs.select(F.xxhash64(text).alias("mark"), F.col(id_col).alias("id"), text.cast("binary").alias("text"))
    found = small_side(found).alias("f")
    same = (F.col("f.mark") == texts["mark"]) & F.col("f.doc_id").eqNullSafe(texts["id"])
    rows = texts.join(found, same).select("root", "node", "chunks", "hot", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            fresh = [i for i, node in enumerate(batch.column("node").to_pylist()) if node not in met and not met.add(node)]
            made = pa.array([shingle_set(batch.column("text")[i].as_buffer().to_pybytes(), shingle).tobytes() for i in fresh], pa.binary())
            kept = {n: batch.column(n).take(pa.array(fresh, pa.int64())) for n in ("root", "node", "chunks", "hot")}
            yield pa.RecordBatch.from_pydict(kept | {"hashes": made})

    return map_in_arrow(rows, run, "root long, node long, chunks int, hot boolean, hashes binary")


def groups(docs: DataFrame, nodes: DataFrame, text_col: str, id_col: str, shingle: int, similarity: float) -> DataFrame:
    """nodes: root (of a group of candidates), node (of a set), n (its size), mark and doc_id (of a document that has it: xxhash64 of the text, and id). node, root for
    each node that is linked to others: the smallest node that links of similar sets within its candidates reach."""
    sizes = nodes.groupBy("root").agg(F.count("*").alias("k"), F.sum("n").alias("n")).where("k > 1")
    sizes = staged(sizes.select("root", F.ceil(F.col("n") / (CHUNK // 2)).cast("int").alias("chunks"), (F.col("n") > CHUNK).alias("hot")))
    found = staged(nodes.select("root", "node", "mark", "doc_id").join(small_side(sizes), "root"))
    sets = candidate_sets(docs, found, text_col, id_col, shingle)
    least = Fraction(str(similarity))

    def dealt(rows: DataFrame, made) -> DataFrame:
        return map_in_arrow(rows.repartition("grp").sortWithinPartitions("grp"), _by_group(made, least), "a long, b long")

    crowded = sizes.where("hot").limit(1).count() > 0
    if crowded:
        sets = staged(sets)
    own = dealt(sets.where("not hot").select(F.col("root").alias("grp"), "node", "hashes"), _own_groups).toDF("node", "root")
    if not crowded:
        return own
    mine = F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).cast("int")
    hot = sets.where("hot").select("root", "node", "hashes", mine.alias("i"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j"))
    pairs = hot.select(F.xxhash64("root", F.least("i", "j"), F.greatest("i", "j")).alias("grp"), "node", "hashes")
    return own.union(components(dealt(pairs, _own_links).distinct()))
