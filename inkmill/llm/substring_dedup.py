"""Substring dedup on difference-cover anchors.

Windows of 20 words that occur earlier in the corpus are removed, word by word. Anchors are the positions p with
p mod 13 in {0, 1, 3, 9}. Every residue is the difference of two of these, so for any two positions there is a step below 13
that takes both to an anchor: two equal windows of 20 words have an anchor each at the same place among their first 13
words, and the 8 words from there lie within both. An anchor whose 8 words occur only once in the corpus
can't belong to a repeat; what is left is extended to windows and compared whole (see repeats.py, which also says how bounds hold).

Edge cases: null and blank texts have no words and keep the hash of the empty text; texts under 20 words keep
all their words; rows with the same id and text get the same result; a null id comes after all others; ids that aren't integers raise TypeError; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import map_in_arrow
from . import repeats
from .common import table

WINDOW = 20
PERIOD = 13
COVER = (0, 1, 3, 9)


@dataclass(frozen=True)
class CoverScheme(repeats.Scheme):
    period: int = PERIOD
    cover: tuple[int, ...] = COVER

    def density(self) -> float:
        return len(self.cover) / self.period

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        grams = repeats.gram_hashes(words, self.gram)
        at = np.flatnonzero(np.isin(np.arange(self.period), self.cover)[np.arange(len(grams)) % self.period])
        return at, grams[at]

    def candidates(self, words: np.ndarray, marked: np.ndarray) -> np.ndarray:
        """Windows with a marked anchor among their first period words."""
        n = len(words) - self.gram + 1
        return np.flatnonzero(repeats.covered(np.maximum(marked - self.period + 1, 0), np.minimum(marked + 1, self.period), n))


def scheme(window: int = WINDOW) -> CoverScheme:
    return CoverScheme(window, window - PERIOD + 1)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept_sha256, and kept: the text that is left where words were removed (its words
    joined by one space), else null."""
    corpus = repeats.corpus(docs, id_col, text_col)
    later = repeats.find(corpus, scheme(window)).where(F.size("later") > 0).select("doc", "d", "later")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, runs in zip(batch.column("text"), batch.column("later")):
                words = text.as_buffer().to_pybytes().split()
                gone = repeats.words_covered(runs.values, window, len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(words[i] for i in np.flatnonzero(~gone).tolist()))
            shas = [hashlib.sha256(x).digest() for x in kept]
            yield pa.RecordBatch.from_pydict({"doc": batch.column("doc"), "d": batch.column("d"), "removed": pa.array(removed, pa.int64()), "sha_left": pa.array(shas, pa.binary()), "kept": pa.array([x.decode() for x in kept], pa.string())})

    cut = map_in_arrow(corpus.texts.join(later, ["doc", "d"]), run, "doc long, d long, removed long, sha_left binary, kept string").dropDuplicates(["doc", "d"])
    whole = F.col("copy") & (F.col("n_words") >= window)
    rows = corpus.digests.join(cut, ["doc", "d"], "left").withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.lower(F.hex(F.coalesce("sha_left", "sha")))).alias("kept_sha256"),
        F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


#: Windows are compared as their words joined by one space.
OP6_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), w AS (
  SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS win FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM d)
), later AS (
  SELECT r, i FROM (SELECT r, i, row_number() OVER (PARTITION BY win ORDER BY r, i) AS nth FROM w) WHERE nth > 1
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS i FROM later
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d) ANTI JOIN gone USING (r, i) GROUP BY r
), n AS (
  SELECT r, count(*) AS n FROM gone GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""
