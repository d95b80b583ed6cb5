"""Finding every window of a fixed number of words that occurs more than once in a corpus.

What op5 and op6 share. Both choose a few positions of each document as anchors, in such a way that two equal windows
always have an anchor at the same place within them; they differ in how they choose (a Scheme).

1. Documents with the same words throughout are told by a 256-bit hash; of them only the first goes on, the others are
   repeats from end to end.
2. Anchors: the hash of the words that start at each anchor. The anchors are dealt out by hash in shares, packed (15 bytes
   each), sorted within each share and compared with their neighbours; those that occur once in the corpus are dropped. Only
   part of a hash is sent: a chance match makes a candidate too many, never a wrong result.
3. Windows that hold an anchor which occurs again, at the place the scheme says, are candidates: only they can be
   repeats. They are extended to their whole length by hashing all their words (128 bits).
4. Runs of neighbouring candidates are cut where a window's hash says so (one place in eight), that is at the same
   places in every copy. A segment between two cuts that occurs earlier as a whole needs no further look: all its windows
   are repeats. What stays, the first of equal segments and the ends of runs, is grouped window by window. The
   first occurrence of a window always stays, so nothing is lost.

op5 goes another way from step 3 on for all anchors but the most frequent (suffix_array.py).

Equal anchors, segments or windows are never listed in pairs. Within a task only the first of equal ones is sent on
under its hash; the others are known to repeat already and go under keys of their own. So a passage that a third of
all documents hold makes a row a task under one key, not a row a document. A Python task holds the anchors of
RUN_WORDS words (or of one document) and one share, whose size follows from the number of words counted in the corpus: about SHARE_BYTES, or more where that
would make shares by the thousand, and never above MOST_BYTES but by chance. The texts are shuffled once: every
step joins the same exchange by document within one query.

Order of occurrences: ids ascending, null last, then start. Rows with the same id and the same text count as one
document, all of which get the same result; rows with the same id and other texts follow each other in the order
of a hash of the text. A document's key is its id and that hash, which is 0 where the id is the document's own. Ids must be integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..session import map_in_arrow
from .common import SPACE_RUN, SPACES, shuffle_partitions, small_side, staged, word_count, word_pieces

TABLE = 500_000
#: Words whose anchors a task holds before it sends them.
RUN_WORDS = 1 << 21
SHARE_BYTES = 1 << 20
MOST_BYTES = 1 << 25
#: One window in so many ends a segment.
CUT = 8
#: Stands for a null id, behind all others.
LAST = (1 << 63) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """word -> the 16 bytes of its 128-bit hash, bounded."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > TABLE:
            self.clear()
        value = xxhash.xxh3_128_digest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_words = _Words()


def word_hashes(data: bytes) -> np.ndarray:
    """A row of two u64 for each word of a text."""
    get = _words.__getitem__
    return np.frombuffer(b"".join(b"".join(map(get, words)) for words in word_pieces(data)), "<u8").reshape(-1, 2)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of every n words in a row: a sum of the words' hashes times odd constants, one for each place."""
    factors = np.random.default_rng(n).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros(max(len(words) - n + 1, 0), np.uint64)
    for k in range(n):
        out += factors[k] * words[k : k + len(out)]
    return mixed(out)


@dataclass(frozen=True)
class Scheme:
    """How anchors are chosen. length: words of a window; gram: words hashed at an anchor; hot: an anchor that occurs more often is told apart."""

    length: int
    gram: int
    hot: int = 1 << 15

    def density(self) -> float:
        """Anchors a word."""
        raise NotImplementedError

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The positions of the anchors and the hashes of their grams. words: one hash a word."""
        raise NotImplementedError

    def candidates(self, words: np.ndarray, marked: np.ndarray) -> np.ndarray:
        """The starts of the windows that may occur again, ascending, given the anchors that do."""
        raise NotImplementedError


@dataclass(frozen=True)
class Corpus:
    """digests: staged, one row a document: doc, d (its key), doc_id, n_words, sha (of its words joined by one space), copies (rows that are this
    document), copy: an earlier document has the same words, twin: another one has. texts: doc, d, text, one row a row of the input."""

    digests: DataFrame
    texts: DataFrame

    def shares(self, bytes_a_word: float) -> int:
        """In how many shares what has so many bytes for each word of the corpus is dealt out."""
        words = self.digests.where(~F.col("copy")).agg(F.sum("n_words")).first()[0] or 0
        total = int(words * bytes_a_word)
        few = min(total // SHARE_BYTES, 3 * shuffle_partitions(self.digests.sparkSession))
        return max(1, few, total // MOST_BYTES)


def corpus(docs: DataFrame, id_col: str, text_col: str) -> Corpus:
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be a column of integers, it is {docs.schema[id_col].dataType.simpleString()}")
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc")
    # the first bit tells a null from the id that it shares a place with, and puts it behind
    mark = F.xxhash64(F.col(text_col))
    mark = F.when(F.col(id_col).isNull(), mark.bitwiseAND(F.lit(LAST))).otherwise(mark.bitwiseOR(F.lit(-LAST - 1)))
    joined = F.regexp_replace(F.btrim(F.coalesce(F.col(text_col), F.lit("")), F.lit(SPACES)), SPACE_RUN, " ")
    rows = staged(docs.select(doc, mark.alias("mark"), F.col(id_col).cast("long").alias("doc_id"), word_count(F.col(text_col)).alias("n_words"), F.unhex(F.sha2(joined.cast("binary"), 256)).alias("sha")))
    texts = docs.select(doc, F.col(text_col).cast("string").cast("binary").alias("text"))
    shared = staged(rows.groupBy("doc").agg((F.min("mark") != F.max("mark")).alias("many")).where("many"))
    # always 0, but no constant to Spark, which would plan the joins below, and with them the one exchange of texts, in different ways
    own = F.pmod("doc", F.lit(1)).cast("long").alias("d")
    if shared.limit(1).count():  # ids that several documents have
        own = F.when(F.col("many"), F.col("mark")).otherwise(F.lit(0)).cast("long").alias("d")
        side = small_side(shared)
        rows = rows.join(side, "doc", "left")
        texts = docs.select(doc, mark.alias("mark"), F.col(text_col).cast("string").cast("binary").alias("text")).join(side, "doc", "left")
    rows = rows.groupBy("doc", own, "doc_id", "n_words", "sha").agg(F.count("*").alias("copies"))
    key = F.struct("doc", "d")
    # staged, so that the join is one of two plain exchanges, whose crowded keys Spark splits
    same = staged(rows.groupBy("sha", "n_words").agg(F.min(key).alias("first"), F.max(key).alias("last")))
    digests = rows.join(same, ["sha", "n_words"]).select("doc", "d", "doc_id", "n_words", "sha", "copies", (key != F.col("first")).alias("copy"), (F.col("first") != F.col("last")).alias("twin"))
    return Corpus(staged(digests), texts.select("doc", own, "text"))


def dump(*columns: np.ndarray) -> bytes:
    """Columns of unsigned numbers as bytes: all lowest bytes of a column, then all next ones, so that what is alike lies together."""
    return b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.nbytes // max(len(c), 1)).T).tobytes() for c in columns)


def load(data, *widths: int) -> list[np.ndarray]:
    """The columns of dump, each of so many bytes, as u64."""
    flat = np.frombuffer(data, np.uint8).reshape(sum(widths), len(data) // sum(widths))
    out, at = [], 0
    for w in widths:
        wide = np.zeros((flat.shape[1], 8), np.uint8)
        wide[:, :w] = flat[at : at + w].T
        out.append(wide.view("<u8").reshape(-1))
        at += w
    return out


#: Bytes of an anchor's hash that are sent.
HASH_BYTES = 5
#: The columns of a row of keys: hash, document's number in the run, position, times it occurs in the run (65535 stands for more).
_KEY_WIDTHS = (HASH_BYTES, 4, 4, 2)
_KEYS, _NAMES, _REPEATS, _MARKS = 0, 1, 2, 3
_PACKED = "share int, run long, kind int, data binary"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"share": pa.int32(), "run": pa.int64(), "kind": pa.int32(), "data": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds.values())], list(kinds))


def share_of(hashes: np.ndarray, shares: int) -> np.ndarray:
    """The share of each hash. Hashed once more, as those of minimisers are small numbers."""
    return ((mixed(hashes ^ _MIX) >> np.uint64(32)) * np.uint64(shares)) >> np.uint64(32)


def _anchor_rows(scheme: Scheme, shares: int):
    """Of each run of documents: a row for every share with the anchors that fall in it, one with the keys of its documents, and one with
    the anchors that repeat others of the run, each with the one that stands for it in its share.

    A run's number is that of the partition and a count. The rows of a partition are sorted by key, so a repeated task makes the same runs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        keys, hashes, names, places, n_words = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            k, name, pos = map(np.concatenate, (hashes, names, places))
            order = np.argsort(k, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], k[order][1:] != k[order][:-1])))
            times = np.diff(np.append(first, len(k)))
            lead = order[first]  # the first of equal ones, ascending by hash
            again = order[np.repeat(times > 1, times)]
            by = np.repeat(lead, times)[np.repeat(times > 1, times)]
            number, home = part << 32 | count, (part + 7919 * count) % shares
            rows = [
                (home, number, _NAMES, dump(*(np.array(x, np.int64).view(np.uint64) for x in zip(*keys)))),
                (home, number, _REPEATS, dump(name[again], pos[again], name[by], pos[by])),
            ]
            share = share_of(k[lead], shares)
            order = np.argsort(share, kind="stable")
            share, lead, times = share[order], lead[order], times[order]
            found, start = np.unique(share, return_index=True)
            for s, i, j in zip(found.tolist(), start, np.append(start[1:], len(lead))):
                at = lead[i:j]
                sent = np.ascontiguousarray(k[at].view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES])
                rows.append((s, number, _KEYS, dump(sent, name[at], pos[at], np.minimum(times[i:j], 65535).astype(np.uint16))))
            return _packed(rows)

        for batch in batches:
            for doc, d, text in zip(batch.column("doc").to_pylist(), batch.column("d").to_pylist(), batch.column("text")):
                words = word_hashes(text.as_buffer().to_pybytes())[:, 0]
                if len(words) < scheme.length:
                    continue
                found, grams = scheme.anchors(words)
                hashes.append(grams)
                names.append(np.full(len(found), len(keys), np.uint32))
                places.append(found.astype(np.uint32))
                keys.append((doc, d))
                n_words += len(words)
                if n_words >= RUN_WORDS:
                    yield flush()
                    count += 1
                    keys, hashes, names, places, n_words = [], [], [], [], 0
        if keys:
            yield flush()

    return run


def _matches(hot: int):
    """Rows of one share follow each other. Its anchors are sorted and compared with their neighbours; those that have an equal one, or occur more than hot
    times, are returned to their runs."""

    def settle(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        parts = [load(data, *_KEY_WIDTHS) for _, data in held]
        k, times = (np.concatenate([p[c] for p in parts]) for c in (0, 3))
        order = np.argsort(k)
        first = np.flatnonzero(np.concatenate(([True], k[order][1:] != k[order][:-1])))
        sizes, total = np.diff(np.append(first, len(k))), np.add.reduceat(times[order], first)
        hit, often = np.zeros(len(k), bool), np.zeros(len(k), bool)
        often[order] = np.repeat(total > hot, sizes)
        hit[order] = np.repeat((sizes > 1) | (total > hot), sizes)
        rows, at = [], 0
        for (number, _), (k, name, pos, _) in zip(held, parts):
            found, many = hit[at : at + len(k)], often[at : at + len(k)]
            at += len(k)
            if found.any():
                rows.append((0, number, _MARKS, dump(name[found].astype(np.uint32), pos[found].astype(np.uint32), many[found].astype(np.uint8))))
        if rows:
            yield _packed(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, held = None, []
        for batch in batches:
            passed = []
            for s, number, kind, data in zip(*(batch.column(c).to_pylist() for c in ("share", "run", "kind", "data"))):
                if s != share:
                    yield from settle(held)
                    share, held = s, []
                if kind == _KEYS:
                    held.append((number, data))
                else:
                    passed.append((0, number, kind, data))
            if passed:
                yield _packed(passed)
        yield from settle(held)

    return run


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one run follow each other, the keys of its documents first. Returns doc, d, marks (the positions of the anchors that occur again, ascending), hot
    (which of them are the most frequent)."""

    def settle(names: list[np.ndarray], repeats: list[np.ndarray], held: list[bytes]) -> Iterator[pa.RecordBatch]:
        def place(name: np.ndarray, pos: np.ndarray) -> np.ndarray:
            return name << np.uint64(32) | pos

        parts = [load(data, 4, 4, 1) for data in held]
        sent, often = (np.concatenate(x) for x in zip(*((place(a, b), c > 0) for a, b, c in parts))) if parts else (np.zeros(0, np.uint64), np.zeros(0, bool))
        again, by = place(*repeats[:2]), place(*repeats[2:])
        at, where = np.unique(np.concatenate((sent, again)), return_index=True)
        if not len(at):
            return
        hot = np.concatenate((often, np.isin(by, sent[often])))[where]
        name, pos = at >> np.uint64(32), (at & np.uint64(0xFFFFFFFF)).astype(np.int32)
        found, first = np.unique(name, return_index=True)
        ends = pa.array(np.append(first, len(name)).astype(np.int32))
        lists = {"marks": pa.ListArray.from_arrays(ends, pa.array(pos)), "hot": pa.ListArray.from_arrays(ends, pa.array(hot))}
        yield pa.RecordBatch.from_pydict({"doc": names[0][found].view(np.int64), "d": names[1][found].view(np.int64)} | lists)

    number, names, repeats, held = None, [], [], []
    for batch in batches:
        for n, kind, data in zip(*(batch.column(c).to_pylist() for c in ("run", "kind", "data"))):
            if n != number and number is not None:
                yield from settle(names, repeats, held)
                held = []
            number = n
            if kind == _NAMES:
                names = load(data, 8, 8)
            elif kind == _REPEATS:
                repeats = load(data, 4, 4, 4, 4)
            else:
                held.append(data)
    if number is not None:
        yield from settle(names, repeats, held)


def repeated_anchors(corpus: Corpus, scheme: Scheme) -> DataFrame:
    """doc, d, marks, hot of the documents with anchors that occur again (see _marks). Of documents with the same words only the first is looked at."""
    single = corpus.digests.where(~F.col("copy") & (F.col("n_words") >= scheme.length)).select("doc", "d")
    texts = corpus.texts.join(single, ["doc", "d"], "left_semi")
    shares = corpus.shares(scheme.density() * sum(_KEY_WIDTHS))
    packed = map_in_arrow(texts.sortWithinPartitions("doc", "d"), _anchor_rows(scheme, shares), _PACKED)
    matched = map_in_arrow(packed.repartitionById(shares, "share").sortWithinPartitions("share", "run", "kind"), _matches(scheme.hot), _PACKED)
    return map_in_arrow(matched.repartition("run").sortWithinPartitions("run", "kind"), _marks, "doc long, d long, marks array<int>, hot array<boolean>")


def _placed(parts: list[tuple]) -> pa.RecordBatch:
    """Rows h1, h2, doc, d, start, n, sure, many of a batch's segments or windows, or several that are sure in a row; n: windows in a row. sure: equals an
    earlier one of the batch; many: equals another one of the batch."""
    h1, h2, doc, d, start, n = map(np.concatenate, zip(*parts))
    order = np.lexsort((start, d, doc, h2, h1))
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    a, b, place = h1[order], h2[order], (doc[order], d[order], start[order])
    same = np.concatenate(([False], (a[1:] == a[:-1]) & (b[1:] == b[:-1])))[: len(a)]
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))  # of each run of equal ones
    sure = (place[0] != place[0][first]) | (place[1] != place[1][first]) | (place[2] != place[2][first])
    many = np.bincount(first, sure, len(first))[first] > 0
    sure, many = sure[back], many[back]
    own = mixed(mixed(doc.view(np.uint64) * _MIX + d.view(np.uint64)) + start.astype(np.uint64) * _MIX)
    # what is sure already and follows on what is sure needs no row of its own
    on = sure[1:] & sure[:-1] & (doc[1:] == doc[:-1]) & (d[1:] == d[:-1]) & (start[1:] == start[:-1] + n[:-1])
    head = np.flatnonzero(np.concatenate(([True], ~on))[: len(sure)])
    columns = {"h1": np.where(sure, own, h1).view(np.int64), "h2": np.where(sure, ~h2, h2).view(np.int64), "doc": doc, "d": d, "start": start, "sure": sure, "many": many}
    columns = {k: v[head] for k, v in columns.items()} | {"n": np.add.reduceat(n, head, dtype=np.int32) if len(head) else n}
    return pa.RecordBatch.from_pydict({k: columns[k] for k in ("h1", "h2", "doc", "d", "start", "n", "sure", "many")})


_PLACED = "h1 long, h2 long, doc long, d long, start int, n int, sure boolean, many boolean"


def _candidates(scheme: Scheme, batch: pa.RecordBatch) -> Iterator[tuple]:
    """For each document: its key, the starts of its candidate windows and their two hashes, the row's number."""
    for i, (doc, d, text, marks) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("d").to_pylist(), batch.column("text"), batch.column("marks"))):
        words = word_hashes(text.as_buffer().to_pybytes())
        starts = scheme.candidates(words[:, 0], marks.values.to_numpy())
        starts = starts[starts + scheme.length <= len(words)]
        if len(starts):
            hull = words[starts[0] : starts[-1] + scheme.length]
            yield doc, d, starts, *(gram_hashes(hull[:, c], scheme.length)[starts - starts[0]] for c in (0, 1)), i


def _segments(starts: np.ndarray, h1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first window of each segment, by its number among starts, and whether the segment lies between two cuts."""
    cut = h1 % np.uint64(CUT) == 0
    gap = np.concatenate(([True], np.diff(starts) != 1))
    first = np.flatnonzero(cut | gap)
    after = np.append(first[1:], len(starts))
    ended = np.append(cut, False)[after] & ~np.append(gap, True)[after]
    return first, cut[first] & ended


def _segment_rows(scheme: Scheme):
    """The segments between two cuts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for doc, d, starts, h1, h2, _ in _candidates(scheme, batch):
                first, whole = _segments(starts, h1)
                n = np.diff(np.append(first, len(starts)))
                at = (np.arange(len(starts)) - np.repeat(first, n)).astype(np.uint64) * _MIX
                sums = [np.add.reduceat(mixed(h + at), first)[whole] for h in (h1, h2)]
                m = int(whole.sum())
                parts.append((*sums, np.full(m, doc, np.int64), np.full(m, d, np.int64), starts[first[whole]].astype(np.int32), n[whole].astype(np.int32)))
            if parts:
                yield _placed(parts)

    return run


def _window_rows(scheme: Scheme):
    """The candidate windows that aren't in a segment of the column done, which begin at done.start and have done.n windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, done = [], batch.column("done")
            for doc, d, starts, h1, h2, i in _candidates(scheme, batch):
                if done[i].is_valid:
                    seen = done[i].values
                    left = ~covered(seen.field("start").to_numpy(), seen.field("n").to_numpy(), int(starts[-1]) + 1)[starts]
                    starts, h1, h2 = starts[left], h1[left], h2[left]
                n = len(starts)
                parts.append((h1, h2, np.full(n, doc, np.int64), np.full(n, d, np.int64), starts.astype(np.int32), np.ones(n, np.int32)))
            if parts:
                yield _placed(parts)

    return run


def _judged(rows: DataFrame) -> DataFrame:
    """rows of _placed that occur more than once: doc, d, start, n, later (another one is earlier)."""
    place, equal = F.struct("doc", "d", "start"), Window.partitionBy("h1", "h2")
    rows = rows.withColumns({"first": F.min(place).over(equal), "last": F.max(place).over(equal)})
    rows = rows.where(F.col("many") | F.col("sure") | (F.col("first") != F.col("last")))
    return rows.select("doc", "d", "start", "n", (F.col("sure") | (F.col("first") != place)).alias("later"))


def repeated_windows(marked: DataFrame, scheme: Scheme) -> DataFrame:
    """marked: doc, d, text, marks. The windows that hold a mark and occur more than once: doc, d, start, n (windows in a row), later (another one is earlier)."""
    key = ["doc", "d"]
    segments = _judged(map_in_arrow(marked, _segment_rows(scheme), _PLACED))
    done = segments.where("later").groupBy("doc", "d").agg(F.collect_list(F.struct("start", "n")).alias("done"))
    return segments.union(_judged(map_in_arrow(marked.join(done, key, "left"), _window_rows(scheme), _PLACED)))


def by_document(windows: DataFrame) -> DataFrame:
    """One row a document: doc, d, later (start and n of windows in a row that occur earlier too), shared (the same of all windows that occur elsewhere too)."""
    run = F.struct("start", "n")
    return windows.groupBy("doc", "d").agg(F.collect_list(F.when(F.col("later"), run)).alias("later"), F.collect_list(run).alias("shared"))


def find(corpus: Corpus, scheme: Scheme) -> DataFrame:
    """by_document of all windows that occur more than once."""
    # nothing from here on is staged, so that every use of the texts is the same exchange by document
    marks = repeated_anchors(corpus, scheme).select("doc", "d", "marks")
    return by_document(repeated_windows(corpus.texts.join(marks, ["doc", "d"]), scheme))


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the ranges that begin at starts."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def words_covered(runs: pa.StructArray, length: int, n_words: int) -> np.ndarray:
    """Which words lie in a window of runs (start, n: windows in a row), each of length words."""
    return covered(runs.field("start").to_numpy(), runs.field("n").to_numpy() + (length - 1), n_words)
