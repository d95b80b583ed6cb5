"""Suffix-array dedup on a sparse suffix array.

Of the suffixes of all texts (a suffix starts at each word) only those at minimiser positions are kept: in every 26
neighbouring positions the one whose 25 words have the smallest hash, the leftmost of equals. That depends on the words alone,
so two equal windows of 50 words keep a suffix at the same place within them.

1. Suffixes whose first 25 words begin no other kept suffix are dropped (repeats.py, steps 1 and 2).
2. The others go to shares by the hash of these 25 words, each with the 25 words before it and the 25 after, all that a window of 50 words
   can reach. Of those of one run that agree in all of this only the first is sent; the others are repeats as far as they reach.
3. In a share the suffixes are sorted twice: by their words to the right, and by their words to the left read backwards. Neighbours are compared
   word by word, which gives the common prefix, and the common extension to the left, of any two.
4. A window that begins o words before a suffix occurs again if another suffix agrees with it in o words to the left and 50 - o to
   the right, that is if the two lie in one interval of either order. So matches are extended left and right for all o at once, without pairs; the earliest
   suffix of each such meeting of intervals is the first occurrence.

A share's suffixes are sorted in memory, so the most frequent beginnings (above HOT occurrences, 11 MB) aren't sent there, lest a passage that a third of
all documents hold fill one task: the windows around them are hashed whole and dealt out one by one (repeats.py, steps 3 and 4). Both ways
are exact and a window's words alone decide which it goes. Words are compared by 48 bits of their hash, first 25 words by 128.

The result: a word is shared if and only if it lies in 50 words in a row that occur more than once in the corpus.

Edge cases: null and blank texts have no words; texts under 50 words share nothing; rows with the same id and text get
the same result and don't repeat each other; a null id comes after all others; ids that aren't integers raise TypeError; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import map_in_arrow
from . import repeats
from .common import table

WINDOW = 50
GRAM = 25
#: A beginning that occurs more often isn't sorted in one task.
HOT = 1 << 15
#: Bytes of a word's hash that are compared.
WORD_BYTES = 6
#: Suffixes that a task holds before it sends them.
RUN = 1 << 16
#: Bytes of a suffix in a share besides its words: the hash of its first words, document, position, flag.
_HEAD = (8, 8, 8, 8, 4, 1)
_SENT, _DONE = 0, 1
_SENT_DDL = "share int, kind int, head binary, words binary"
_FOUND_DDL = "doc long, d long, start int, n int, later boolean"


@dataclass(frozen=True)
class MinimiserScheme(repeats.Scheme):
    @property
    def reach(self) -> int:
        """Words on either side of a suffix's first words that a window can hold."""
        return self.length - self.gram

    def density(self) -> float:
        return 2 / (self.reach + 2)

    def _least(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window the position of its minimiser; the hashes of all grams."""
        grams, wide = repeats.gram_hashes(words, self.gram), self.length - self.gram + 1
        if len(grams) < wide:
            return np.zeros(0, np.int64), grams
        out = np.empty(len(grams) - wide + 1, np.int64)
        for at in range(0, len(out), 1 << 18):  # a bounded part of a very long text at a time
            part = np.lib.stride_tricks.sliding_window_view(grams[at : at + (1 << 18) + wide - 1], wide)
            out[at : at + len(part)] = part.argmin(axis=1) + np.arange(at, at + len(part))
        return out, grams

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least, grams = self._least(words)
        at = np.unique(least)
        return at, grams[at]

    def candidates(self, words: np.ndarray, marked: np.ndarray) -> np.ndarray:
        """Windows whose minimiser is marked."""
        chosen = np.zeros(len(words), bool)
        chosen[marked] = True
        return np.flatnonzero(chosen[self._least(words)[0]])


def scheme(window: int = WINDOW, gram: int | None = None, hot: int = HOT) -> MinimiserScheme:
    gram = gram or max(window // 2, window - 62)
    if window - gram > 62:
        raise ValueError("a window is at most 62 words longer than what is hashed of a suffix")  # a bit for each place of a window
    return MinimiserScheme(window, gram, hot)


def _contexts(words: np.ndarray, pos: np.ndarray, s: MinimiserScheme) -> tuple[np.ndarray, ...]:
    """Of the suffixes at pos: two hashes of the first words; the words before them, nearest first, and those after, as rows of bytes. words: two
    hashes a word. Places beyond the text are 0, which no word is."""
    factors = np.random.default_rng(s.gram).integers(1, 1 << 63, (2, s.gram), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    first = words[pos[:, None] + np.arange(s.gram)]
    heads = [repeats.mixed((first[:, :, c] * factors[c]).sum(axis=1, dtype=np.uint64)) for c in (0, 1)]
    low = words[:, 0] & np.uint64((1 << 8 * WORD_BYTES) - 1)
    low[low == 0] = 1
    none = np.zeros(s.reach, np.uint64)
    padded = np.concatenate((none, low, none)).astype("<u8")
    before = padded[(pos + s.reach - 1)[:, None] - np.arange(s.reach)]
    after = padded[(pos + s.reach + s.gram)[:, None] + np.arange(s.reach)]
    left, right = (np.ascontiguousarray(x.view(np.uint8).reshape(len(pos), -1, 8)[:, :, :WORD_BYTES]).reshape(len(pos), -1) for x in (before, after))
    return *heads, left, right


def _common(rows: np.ndarray, same: np.ndarray) -> np.ndarray:
    """For each row but the first, how many words it has in common with the row before; -1 where same says that these can't be compared."""
    m = rows.reshape(len(rows), -1, WORD_BYTES)
    equal = (m[1:] == m[:-1]).all(axis=2)
    n = np.where(equal.all(axis=1), equal.shape[1], equal.argmin(axis=1))
    return np.where(same, n, -1)


def _as_text(*columns: np.ndarray) -> np.ndarray:
    """Rows of bytes, as one string each, which sorts as they do."""
    flat = np.ascontiguousarray(np.concatenate([c if c.ndim == 2 else c.astype(">u8").view(np.uint8).reshape(len(c), -1) for c in columns], axis=1))
    return flat.view(f"S{flat.shape[1]}").reshape(-1)


def _valid(left: np.ndarray, right: np.ndarray, reach: int) -> np.ndarray:
    """Which windows lie within the text: row by row, by the number of words before the suffix."""
    places = np.arange(reach + 1)
    before, after = ((x.reshape(len(x), -1, WORD_BYTES) > 0).any(axis=2).sum(axis=1) for x in (left, right))
    return (places <= before[:, None]) & (reach - places <= after[:, None])


def matches(head1: np.ndarray, head2: np.ndarray, left: np.ndarray, right: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their places in the corpus. For each, and each number of words before it: whether that window occurs
    earlier, and whether it occurs elsewhere."""
    n = len(head1)
    intervals = []
    for side in (right, left):
        order = np.argsort(_as_text(head1, head2, side), kind="stable")
        same = (head1[order][1:] == head1[order][:-1]) & (head2[order][1:] == head2[order][:-1])
        intervals.append((order, _common(side[order], same)))
    valid = _valid(left, right, reach)
    earlier, elsewhere = np.zeros((n, reach + 1), bool), np.zeros((n, reach + 1), bool)
    for o in range(reach + 1):
        meet = np.zeros(n, np.int64)
        for (order, common), least in zip(intervals, (reach - o, o)):
            number = np.empty(n, np.int64)
            number[order] = np.concatenate(([0], np.cumsum(common < least)))
            meet = meet * n + number
        at = np.flatnonzero(valid[:, o])
        _, first, own, times = np.unique(meet[at], return_index=True, return_inverse=True, return_counts=True)
        earlier[at, o] = np.arange(len(at)) != first[own]
        elsewhere[at, o] = times[own] > 1
    return earlier, elsewhere


def _runs(doc: np.ndarray, d: np.ndarray, pos: np.ndarray, earlier: np.ndarray, elsewhere: np.ndarray) -> pa.RecordBatch:
    """Rows doc, d, start, n, later: the windows marked, as runs of windows in a row."""
    parts = []
    for later, marked in ((True, earlier), (False, elsewhere & ~earlier)):
        edge = np.diff(np.pad(marked.view(np.int8), ((0, 0), (1, 1))), axis=1)
        row, a = np.nonzero(edge == 1)
        _, b = np.nonzero(edge == -1)  # windows that begin a to b - 1 words before the suffix
        parts.append((doc[row], d[row], pos[row] - b + 1, b - a, np.full(len(row), later)))
    doc, d, start, n, later = map(np.concatenate, zip(*parts))
    return pa.RecordBatch.from_pydict({"doc": doc, "d": d, "start": start.astype(np.int32), "n": n.astype(np.int32), "later": later})


def _distinct(doc: np.ndarray, d: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of places in the corpus, and where in it each place begins: rows that are one document have the same places."""
    order = np.lexsort((pos, d, doc))
    a, b, c = doc[order], d[order], pos[order]
    return order, np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1]))))


def _rows(doc: np.ndarray, d: np.ndarray, pos: np.ndarray, h1: np.ndarray, h2: np.ndarray, many: np.ndarray) -> tuple:
    return repeats.dump(h1, h2, doc.view(np.uint64), d.view(np.uint64), pos.astype(np.uint32), many.astype(np.uint8))


def _suffix_rows(s: MinimiserScheme, shares: int):
    """The marked suffixes, packed by share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, count, n = TaskContext.get().partitionId(), [], 0, 0

        def flush() -> pa.RecordBatch:
            doc, d, pos, h1, h2, left, right = map(np.concatenate, zip(*held))
            order, first = _distinct(doc, d, pos)
            doc, d, pos, h1, h2, left, right = (x[order[first]] for x in (doc, d, pos, h1, h2, left, right))
            _, first, own, times = np.unique(_as_text(h1, h2, left, right), return_index=True, return_inverse=True, return_counts=True)
            lead = np.zeros(len(doc), bool)
            lead[first] = True
            many = times[own] > 1
            rows, again = [], np.flatnonzero(~lead)
            if len(again):
                head = _rows(doc[again], d[again], pos[again], h1[again], h2[again], many[again])
                rows.append(((part + 7919 * count) % shares, _DONE, head, np.concatenate((left[again], right[again]), axis=1).tobytes()))
            lead = np.flatnonzero(lead)
            share = repeats.share_of(h1[lead], shares)
            order = np.argsort(share, kind="stable")
            lead = lead[order]
            found, start = np.unique(share[order], return_index=True)
            for share, i, j in zip(found.tolist(), start, np.append(start[1:], len(lead))):
                at = lead[i:j]
                rows.append((share, _SENT, _rows(doc[at], d[at], pos[at], h1[at], h2[at], many[at]), np.concatenate((left[at], right[at]), axis=1).tobytes()))
            kinds = {"share": pa.int32(), "kind": pa.int32(), "head": pa.binary(), "words": pa.binary()}
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds.values())], list(kinds))

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc", "d"))
            for doc, d, text, marks in zip(*columns, batch.column("text"), batch.column("marks")):
                pos = marks.values.to_numpy().astype(np.int64)
                if not len(pos):
                    continue
                words = repeats.word_hashes(text.as_buffer().to_pybytes())
                for at in range(0, len(pos), RUN):
                    some = pos[at : at + RUN]
                    held.append((np.full(len(some), doc, np.int64), np.full(len(some), d, np.int64), some, *_contexts(words, some, s)))
                    n += len(some)
                    if n >= RUN:
                        yield flush()
                        held, count, n = [], count + 1, 0
        if held:
            yield flush()

    return run


def _sorted_shares(s: MinimiserScheme):
    """Rows of one share follow each other. Returns the windows that occur more than once (see _runs)."""

    def load(rows: list[tuple]) -> tuple[np.ndarray, ...]:
        columns = [np.concatenate(x) for x in zip(*(repeats.load(head, *_HEAD) for head, _ in rows))]
        words = np.frombuffer(b"".join(words for _, words in rows), np.uint8).reshape(len(columns[0]), 2, s.reach * WORD_BYTES)
        h1, h2, doc, d, pos, many = columns
        return h1, h2, doc.view(np.int64), d.view(np.int64), pos.astype(np.int64), many > 0, words[:, 0], words[:, 1]

    def settle(held: list[tuple]) -> pa.RecordBatch:
        found = load(held)
        order, first = _distinct(*found[2:5])
        many = np.logical_or.reduceat(found[5][order], first)
        h1, h2, doc, d, pos, _, left, right = (x[order[first]] for x in found)
        earlier, elsewhere = matches(h1, h2, left, right, s.reach)
        return _runs(doc, d, pos, earlier, elsewhere | (many[:, None] & _valid(left, right, s.reach)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, held = None, []
        for batch in batches:
            for now, kind, head, words in zip(*(batch.column(c).to_pylist() for c in ("share", "kind", "head", "words"))):
                if now != share:
                    if held:
                        yield settle(held)
                    share, held = now, []
                if kind == _SENT:
                    held.append((head, words))
                else:  # equal to earlier ones as far as they reach
                    _, _, doc, d, pos, _, left, right = load([(head, words)])
                    whole = _valid(left, right, s.reach)
                    yield _runs(doc, d, pos, whole, whole)
        if held:
            yield settle(held)

    return run


def find(corpus: repeats.Corpus, s: MinimiserScheme) -> DataFrame:
    """One row for each document with windows that occur more than once: see repeats.by_document."""
    key = ["doc", "d"]
    marks = repeats.repeated_anchors(corpus, s)
    # nothing from here on is staged, so that every use of the texts is the same exchange by document
    chosen = lambda often: F.transform(F.filter(F.arrays_zip("marks", "hot"), lambda x: x["hot"] == often), lambda x: x["marks"])
    rare = marks.select(*key, chosen(False).alias("marks")).where(F.size("marks") > 0)
    often = marks.select(*key, chosen(True).alias("marks")).where(F.size("marks") > 0)
    shares = corpus.shares(s.density() * (sum(_HEAD) + 2 * s.reach * WORD_BYTES))
    sent = map_in_arrow(corpus.texts.join(rare, key), _suffix_rows(s, shares), _SENT_DDL)
    found = map_in_arrow(sent.repartitionById(shares, "share").sortWithinPartitions("share", "kind"), _sorted_shares(s), _FOUND_DDL)
    return repeats.by_document(found.union(repeats.repeated_windows(corpus.texts.join(often, key), s)))


def shared_passages(docs: DataFrame, window: int = WINDOW, gram: int | None = None, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_words, n_shared (words in passages of at least window words that occur elsewhere too), n_removed (those
    of passages that occur earlier), spans (start and length in words of what is removed)."""
    corpus = repeats.corpus(docs, id_col, text_col)
    found = find(corpus, scheme(window, gram, hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"doc": batch.column("doc"), "d": batch.column("d"), "shared_words": [], "removed": [], "starts": [], "lengths": []}
            for later, shared in zip(batch.column("later"), batch.column("shared")):
                ends = shared.values.field("start").to_numpy() + shared.values.field("n").to_numpy()
                n = int(ends.max()) + window
                words = repeats.words_covered(later.values, window, n)
                edge = np.flatnonzero(np.diff(np.concatenate(([0], words.view(np.int8), [0]))))
                out["shared_words"].append(int(repeats.words_covered(shared.values, window, n).sum()))
                out["removed"].append(int(words.sum()))
                out["starts"].append(edge[::2])
                out["lengths"].append(edge[1::2] - edge[::2])
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(out.values(), kinds)], list(out))

    cut = map_in_arrow(found, run, "doc long, d long, shared_words long, removed long, starts array<long>, lengths array<long>")
    # a document whose words an earlier one has from end to end is a repeat as a whole, and the earlier one is shared as a whole
    whole = F.col("copy") & (F.col("n_words") >= window)
    spans = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"))
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    rows = corpus.digests.join(cut, ["doc", "d"], "left").withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(
        "doc_id",
        "n_words",
        F.when(F.col("twin") & (F.col("n_words") >= window), F.col("n_words")).otherwise(F.coalesce("shared_words", F.lit(0))).cast("long").alias("n_shared"),
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("length")))).otherwise(F.coalesce(spans, none)).alias("spans"),
    )


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shared_passages(table(spark, sf_dir, "documents"))
    spans = F.transform("spans", lambda x: F.concat_ws("+", x["start"].cast("string"), x["length"].cast("string")))
    return found.withColumn("spans", F.array_join(spans, ","))


#: Windows are compared as their words joined by one space.
OP5_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS win FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM d)
), met AS (
  SELECT r, i, row_number() OVER (PARTITION BY win ORDER BY r, i) AS nth, count(*) OVER (PARTITION BY win) AS times FROM w
), removed AS (
  SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS i FROM met WHERE nth > 1
), shared AS (
  SELECT r, count(DISTINCT i) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS i FROM met WHERE times > 1) GROUP BY r
), span AS (
  SELECT r, min(i) - 1 AS start, count(*) AS length FROM (SELECT r, i, i - row_number() OVER (PARTITION BY r ORDER BY i) AS island FROM removed) GROUP BY r, island
), spans AS (
  SELECT r, sum(length) AS n, string_agg(start || '+' || length, ',' ORDER BY start) AS spans FROM span GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(shared.n, 0) AS BIGINT) AS n_shared, CAST(coalesce(spans.n, 0) AS BIGINT) AS n_removed,
  coalesce(spans, '') AS spans
FROM d LEFT JOIN shared USING (r) LEFT JOIN spans USING (r)
"""
