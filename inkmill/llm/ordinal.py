"""Quality classifier: ordinal cumulative-link regression on hashed text.

Grades are ordered: 0 toxic, 1 of low quality, 2 good (from the labels quality and toxic). A text's features are its
lower-cased words, hashed to DIMENSIONS bins, each counted once, and a few classes of its shape (how many of its words carry
symbols, are in capitals, or come again). One weight vector is shared by all thresholds: P(grade >= k) = sigmoid(w.x - t_k)
with t_1 < t_2. That gives an expected grade and the tail probability P(grade >= 2), by which documents are selected.

Training: at most SAMPLE labelled documents, those with the smallest hashes of their ids (20,000 of them; a parameter), one text each, of several
rows with one id the text with the smallest hash; of these, as many in that order as have FEATURES bins in all (a parameter too, 32 MB). They are
fitted on the driver by accelerated proximal steps on all of them at once; bins that occur in fewer than MIN_DOCS of them have no weight. Only their bins
reach the driver, and the weights (256 kB) the tasks. Scoring reads all rows and whole texts, a megabyte at a time.

Edge cases: null and blank texts have no words, the shape of an empty text, and aren't selected; without any labelled documents all get
tail probability 0.5 and expected grade 1 and are selected if they have a word; several labels of a document are taken together (lowest quality, highest
toxicity), and null labels count as quality 1, toxic 0; rows with the same id are scored each; ids may be of any type that documents and labels share; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import map_in_arrow
from .common import small_side, staged, table, word_pieces

BITS = 16
DIMENSIONS = 1 << BITS
SHAPES = 64
SAMPLE = 20_000
FEATURES = 8_000_000
MIN_DOCS = 3
ROUNDS = 300
#: Of the weights' absolute values, so that words without a clear meaning weigh nothing.
PENALTY = 3e-4
SELECT = 0.5
GRADES = 3
_SYMBOL, _CAPITAL = 1 << 20, 1 << 21
_EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SYMBOLS = frozenset(b"#*$%&|<>")


class _Bins(dict):
    """word -> its bin, and whether it carries a symbol or is in capitals; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        text = word.decode("utf-8", "replace").strip(_EDGES.decode())
        value = xxhash.xxh32_intdigest(text.lower().encode()) & (DIMENSIONS - 1)
        value |= _SYMBOL * (not _SYMBOLS.isdisjoint(word)) | _CAPITAL * (len(text) > 1 and text.isupper())
        if len(word) <= 64:
            self[word] = value
        return value


_bins = _Bins()


def features(data: bytes) -> np.ndarray:
    """The numbers of a text's features, ascending; those of its shape come after those of its words."""
    found, n, symbols, capitals = np.zeros(0, np.int64), 0, 0, 0
    for words in word_pieces(data):
        values = np.fromiter(map(_bins.__getitem__, words), np.int64, len(words))
        n += len(words)
        symbols += int((values & _SYMBOL > 0).sum())
        capitals += int((values & _CAPITAL > 0).sum())
        found = np.union1d(found, values & (DIMENSIONS - 1))
    if not n:
        return np.array([DIMENSIONS], np.int64)
    tenth = lambda x: min(int(10 * x / n), 9)
    again = tenth(n - len(found)) if n >= 20 else 10
    return np.concatenate((found, DIMENSIONS + np.array([1 + tenth(symbols) + (symbols > 0), 14 + tenth(capitals), 26 + again])))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _ordered(t: np.ndarray) -> np.ndarray:
    return np.maximum.accumulate(t + 0.0) + 1e-3 * np.arange(len(t))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # of grades 1 and 2

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2) of each score."""
        return _sigmoid(scores[:, None] - self.thresholds)


def fit_features(docs: list[np.ndarray], grades: np.ndarray) -> Model:
    weights = np.zeros(DIMENSIONS + SHAPES)
    if not docs:
        return Model(weights, np.zeros(GRADES - 1))
    lengths = np.array([len(d) for d in docs])
    bins, rows = np.concatenate(docs), np.repeat(np.arange(len(docs)), lengths)
    often = np.bincount(bins, minlength=len(weights)) >= MIN_DOCS
    bins, rows = bins[often[bins]], rows[often[bins]]
    n = len(docs)
    share = np.clip([(grades >= k).mean() for k in range(1, GRADES)], 0.01, 0.99)
    thresholds = _ordered(-np.log(share / (1 - share)))  # those that fit without any feature
    # a bound of the curvature by each weight: the sum, over the documents with its bin, of their numbers of features
    used = np.bincount(rows, minlength=n) + GRADES
    step = 2 * n / np.maximum(np.bincount(bins, used[rows], minlength=len(weights)), 1)
    first, last, at = grades == 0, grades == GRADES - 1, np.arange(n)
    w, speed = weights, 1.0  # where the slope is taken, ahead of the weights
    for _ in range(ROUNDS):
        t = thresholds
        s = np.bincount(rows, w[bins], minlength=n)
        up = np.where(first, 1.0, _sigmoid(s - t[np.maximum(grades - 1, 0)]))  # P(>= own grade)
        down = np.where(last, 0.0, _sigmoid(s - t[np.minimum(grades, GRADES - 2)]))  # P(>= next grade)
        p = np.maximum(up - down, 1e-12)
        by_up, by_down = np.where(first, 0, up * (1 - up)) / p / n, np.where(last, 0, down * (1 - down)) / p / n
        g = np.bincount(bins, (by_down - by_up)[rows], minlength=len(weights))
        g_t = np.bincount(grades[~first] - 1, by_up[~first], minlength=GRADES - 1) - np.bincount(grades[~last], by_down[~last], minlength=GRADES - 1)
        new = w - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0)
        thresholds = _ordered(thresholds - g_t)  # a plain step: these few bend little, and needn't wait for the words
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead = (speed - 1) / faster
        w, weights, speed = new + ahead * (new - weights), new, faster
    return Model(weights.astype(np.float32), thresholds)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, n_features: int = FEATURES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are fitted: mark (the id's hash), grade, n (features), bins (i32)."""
    quality, toxic = F.coalesce(F.min("quality"), F.lit(1)), F.coalesce(F.max("toxic"), F.lit(0))
    graded = labels.where("doc_id is not null").groupBy("doc_id").agg(F.when(toxic > 0, 0).when(quality > 0, 2).otherwise(1).alias("grade"))
    graded = staged(graded.withColumn("mark", F.xxhash64("doc_id")))
    n = graded.count()
    if n > 4 * sample:  # the hashes are even, so this leaves about twice the sample to be sorted in one task
        graded = graded.where(F.col("mark") < F.lit(-(1 << 63) + (1 << 64) * 2 * sample // n))
    chosen = small_side(staged(graded.orderBy("mark", "doc_id").limit(sample).select(F.col("doc_id").alias("label_id"), "mark", "grade")))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).where("text is not null").join(chosen, F.col("doc_id") == F.col("label_id"))
    rows = rows.select("label_id", "mark", "grade", F.xxhash64("text").alias("v"), F.col("text").cast("binary").alias("text"))
    one = staged(rows.groupBy("label_id").agg(F.min("v").alias("v")))
    rows = rows.join(small_side(one), ["label_id", "v"], "left_semi").select("mark", "v", "grade", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(x.as_buffer().to_pybytes()).astype("<i4").tobytes() for x in batch.column("text")]
            sizes = [len(x) // 4 for x in found]
            yield pa.RecordBatch.from_pydict({"mark": batch.column("mark"), "grade": batch.column("grade"), "n": pa.array(sizes, pa.int64()), "bins": pa.array(found, pa.binary())})

    made = staged(map_in_arrow(rows, run, "mark long, grade int, n long, bins binary").dropDuplicates(["mark"]))
    so_far = F.sum("n").over(Window.orderBy("mark").rowsBetween(Window.unboundedPreceding, 0))  # at most sample short rows
    fits = made.select("mark", "n").withColumn("so_far", so_far).where(F.col("so_far") <= n_features)
    return made.join(small_side(fits.select("mark")), "mark", "left_semi")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, n_features: int = FEATURES, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """labels: doc_id, quality, toxic."""
    found = training_rows(docs, labels, sample, n_features, id_col, text_col).select("mark", "grade", "bins").collect()
    found.sort(key=lambda r: r["mark"])
    return fit_features([np.frombuffer(r["bins"], "<i4").astype(np.int64) for r in found], np.array([r["grade"] for r in found], np.int64))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, expected_grade, tail_prob, selected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, worded = np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            for i, text in enumerate(batch.column("text")):
                x = features(text.as_buffer().to_pybytes() if text.is_valid else b"")
                scores[i], worded[i] = model.weights[x].sum(dtype=np.float64), x[0] != DIMENSIONS
            tails = model.tails(scores)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "expected_grade": tails.sum(axis=1), "tail_prob": tails[:, -1], "selected": (tails[:, -1] >= SELECT) & worded})

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return map_in_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, expected_grade double, tail_prob double, selected boolean")


def op10_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
