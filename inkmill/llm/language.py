"""Language identification by nearest centroids.

A text is lower-cased, character by character; all but letters and the marks on them becomes a space; its character bigrams and trigrams are counted in DIMENSIONS
hashed bins; the vector is the logarithms of the counts times the bins' inverse document frequencies, normalised. Each
learned language has CLUSTERS centroids (spherical k-means of its training vectors), and a text gets the language of the centroid with
the largest cosine, which is also its score.

Rejection by distance: the score may come from a centroid that a few odd training texts made, so what counts is the cosine c to
the mean vector of the text's nearest language. A text with m bins (m taken down to a power of two) is held against that language's
NEAREST training texts that are closest to m in size, with their own c taken down by the root of m/n where they have n > m bins. Its bound
is REJECT times the LOW quantile of these, so neither a single odd text nor short ones set the bound of long ones. A text below its bound is rejected. lang_pred stays the
nearest language then, so that the caller decides; ``und`` is kept for texts without a letter.

Training: at most SAMPLE texts a language, those with the smallest hashes, so the sample is the same at any partitioning, and at most about
SAMPLE_ALL in all, which many languages share evenly. The texts may be long, but only their vectors (32 kB each) reach the driver: 128 MB at
most. The tasks get a model of (CLUSTERS + 1) * 32 kB a language. Both hold as there may be LANGUAGES languages at most (each has CLUSTERS texts then); more are a ValueError, before any
vector is made. Everything else reads all rows and whole texts. A very long text is
counted a million characters at a time, which changes nothing: the last characters of a piece go before the next one.

Edge cases: null texts and texts without a letter are ``und`` with score 0, and rejected; no labelled rows at all make every text
``und``; a null id is never held out and never trained on; rows with the same id are predicted each; an empty table gives an empty result;
other columns are ignored by predict() and kept by accepted().
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import map_in_arrow, ship
from .common import small_side, staged, table

BITS = 13
DIMENSIONS = 1 << BITS
CLUSTERS = 4
SAMPLE = 300
SAMPLE_ALL = 4096
LANGUAGES = SAMPLE_ALL // CLUSTERS
NEAREST = 60
LOW = 0.05
REJECT = 0.5
PIECE = 1 << 20
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: itself if it is a letter or a mark, else that of the space."""
    return np.fromiter((c if unicodedata.category(chr(c))[0] in "LM" else 32 for c in range(0x110000)), np.uint32, 0x110000)


def vector(text: str, piece: int = PIECE) -> np.ndarray:
    """Logarithms of the counts of the bigrams and trigrams, not yet weighted or normalised."""
    counts = np.zeros(DIMENSIONS, np.int64)
    tail = np.array([32], np.uint32)  # the last two letters or blanks so far
    for at in range(0, len(text) + 1, piece):
        part = text[at : at + piece] + " " * (at + piece > len(text))
        # only this letter's lower case depends on its neighbours
        codes = np.frombuffer(part.replace("Σ", "σ").lower().encode("utf-32-le", "surrogatepass"), "<u4")
        a = np.concatenate((tail, _letters()[codes]))
        blank = a == 32
        a = a[~(blank & np.concatenate(([False], blank[:-1])))]
        two = (a[:-1] * np.uint32(0x9E3779B1) ^ a[1:]) * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ a[2:]) * np.uint32(0xC2B2AE35)
        counts += np.bincount(np.concatenate((two[len(tail) - 1 :], three)) >> np.uint32(32 - BITS), minlength=DIMENSIONS)
        tail = a[-2:]
    return np.log1p(counts).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _size_class(logs: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum((logs > 0).sum(axis=-1), 1)).astype(int)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # (len(langs) * CLUSTERS, DIMENSIONS), a language's together
    means: np.ndarray  # (len(langs), DIMENSIONS)
    floors: np.ndarray  # (len(langs), size classes)

    def predict(self, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each vector: the language's number, the cosine, and whether it is too far away."""
        x = _unit(logs * self.idf)
        cosines = x @ self.centroids.T
        best = cosines.argmax(axis=1)
        lang, score = best // CLUSTERS, cosines[np.arange(len(best)), best]
        return lang, score, (x * self.means[lang]).sum(axis=1) < self.floors[lang, _size_class(logs)]


def _cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means: the first centroid is the mean's nearest vector, each further one the vector that is farthest from those
    chosen. With fewer vectors than k some centroids are the same."""
    chosen = [int((x @ x.mean(axis=0)).argmax())]
    while len(chosen) < k:
        chosen.append(int((x @ x[chosen].T).max(axis=1).argmin()))
    centroids = x[chosen]
    for _ in range(rounds):
        own = (x @ centroids.T).argmax(axis=1)
        centroids = np.stack([x[own == j].mean(axis=0) if (own == j).any() else centroids[j] for j in range(k)])
        centroids = _unit(centroids)
    return centroids


def fit_vectors(langs: list[str], logs: np.ndarray) -> Model | None:
    """The model of training vectors and their languages."""
    if not langs:
        return None
    names = sorted(set(langs))
    idf = (np.log((1 + len(logs)) / (1 + (logs > 0).sum(axis=0))) + 1).astype(np.float32)
    x, y = _unit(logs * idf), np.array(langs)
    centroids = np.concatenate([_cluster(x[y == name], CLUSTERS) for name in names]).astype(np.float32)
    means = _unit(np.stack([x[y == name].mean(axis=0) for name in names]))
    sizes = np.maximum((logs > 0).sum(axis=1), 1)
    floors = np.zeros((len(names), BITS + 1))
    for i, name in enumerate(names):
        own, n = x[y == name] @ means[i], sizes[y == name]
        for c in range(BITS + 1):
            like = np.argsort(np.abs(np.log2(n) - c), kind="stable")[:NEAREST]
            floors[i, c] = REJECT * np.quantile(own[like] * np.sqrt(np.minimum(1, 2**c / n[like])), LOW)
    return Model(names, idf, centroids, means, floors)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """The model learned from the texts and non-null languages of documents that aren't held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # hashes alone: the ranking moves no texts. They are even, so a bound leaves about four times the sample of a language to be ranked
    keys = rows.select("lang", F.xxhash64("doc_id", "text").alias("mark"))
    bounds = staged(keys.groupBy("lang").agg(F.approx_count_distinct("mark").alias("n")))  # one row a language
    languages = bounds.count()
    if languages > LANGUAGES:
        raise ValueError(f"{languages} languages are labelled, and at most {LANGUAGES} can be learned; map rare labels to null or to a common one")
    sample = min(SAMPLE, SAMPLE_ALL // max(languages, 1))
    bounds = bounds.select("lang", (F.lit(4.0 * sample) / F.col("n") * 2.0**64 - 2.0**63).alias("bound"))
    keys = keys.join(small_side(bounds), "lang").where(F.col("mark").cast("double") < F.col("bound")).select("lang", "mark").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("mark"))
    keys = staged(keys.withColumn("rank", rank).where(F.col("rank") <= sample).select("lang", "mark"))
    chosen = rows.withColumn("mark", F.xxhash64("doc_id", "text")).join(small_side(keys), ["lang", "mark"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs = [vector(x).tobytes() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"lang": batch.column("lang"), "mark": batch.column("mark"), "logs": pa.array(logs, pa.binary())})

    found = sorted(map_in_arrow(chosen, run, "lang string, mark long, logs binary").distinct().collect(), key=lambda r: (r["lang"], r["mark"]))
    logs = np.frombuffer(b"".join(r["logs"] for r in found), np.float32).reshape(-1, DIMENSIONS)
    return fit_vectors([r["lang"] for r in found], logs)


_PREDICTED = "struct<lang_pred: string, score: double, rejected: boolean>"


def _predictor(model: Model | None):
    """A function of a text column. Only the texts go to Python and only the verdicts come back; the rest of the rows stays where it is."""

    @F.arrow_udf(_PREDICTED)
    def run(texts: pa.Array) -> pa.Array:
        n = len(texts)
        lang, score, far = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
        for at in range(0, n, 256):
            logs, rows = [], []
            for i in range(at, min(at + 256, n)):
                text = texts[i].as_py()
                if model and text and _LETTER.search(text):
                    logs.append(vector(text))
                    rows.append(i)
            if rows:
                a, b, c = model.predict(np.stack(logs))
                score[rows], far[rows] = np.clip(b, 0, 1), c
                for i, k in zip(rows, a.tolist()):
                    lang[i] = model.langs[k]
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score), pa.array(far)], ["lang_pred", "score", "rejected"])

    return run


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score, rejected."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), _predictor(model)(F.col(text_col).cast("string")).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


def accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of docs that aren't rejected, with all their columns and nothing else."""
    ship(docs.sparkSession)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), _predictor(model)(F.col(text_col).cast("string")).alias("p"))
    return rows.where(~F.col("p.rejected")).select("row.*")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs))
