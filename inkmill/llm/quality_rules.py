"""Quality rules with verdicts on hosts.

Every document is measured against a few rules. The failures are then counted by host (``source``), each
host's failure rate is shrunk towards the mean of all hosts by a beta prior whose strength is estimated from
the spread between hosts (empirical Bayes, method of moments), and a host whose shrunk rate is above half, or
twice that of all documents and a tenth at least, loses all its documents. DataFrame functions only: one pass over the texts, one row of measures a document is
kept (staged), hosts are aggregated with partial sums before the shuffle, so a host with a third of all rows
costs no more than any other, and the verdicts come back over a join whose small side is checked before it is
broadcast.

Edge cases: a null or blank text has no words, fails the base rule and isn't kept; a null source is a host of
its own; repeated rows are measured and counted each; an empty table gives an empty result; columns beyond
those named are ignored, also those that are called like a result column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, let, small_side, staged, table, words_of

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 30
#: A host goes if the shrunk share of its documents that fail a rule is above MAX_HOST_RATE, or above MAX_HOST_RATIO times the share of all documents that
#: do and no less than MIN_HOST_RATE.
MAX_HOST_RATE = 0.5
MAX_HOST_RATIO = 2
MIN_HOST_RATE = 0.1
#: Bounds of the prior's strength, in documents.
STRENGTH = (1.0, 1e6)
RULES = ("base_failed", "symbols_failed", "lines_failed")


def repeated_words(words: Column) -> Column:
    """How many words lie in three-word windows that occur at least twice among words (a long).

    The 64-bit hashes of the windows are compared for a first answer; only texts with a repeated hash go on:
    there the windows are sorted with their starts, neighbours compared word by word's hash, and the starts
    of the repeated ones merged, each adding the words up to the next start, three at most.
    """
    third = F.greatest(F.size(words) - 2, F.lit(0))
    zipped = F.arrays_zip(
        F.slice(words, F.lit(1), third).alias("a"), F.slice(words, F.lit(2), third).alias("b"), F.slice(words, F.lit(3), third).alias("c")
    )
    hashes = F.transform(zipped, lambda w: F.xxhash64(w["a"], w["b"], w["c"]))

    def covered(starts: Column) -> Column:
        gaps = F.zip_with(starts, F.slice(starts, F.lit(2), F.size(starts)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    def repeated(ordered: Column) -> Column:
        n = F.size(ordered)
        after = F.zip_with(ordered, F.slice(ordered, F.lit(2), n), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
        return let(
            after,
            lambda same: F.transform(
                F.filter(
                    F.zip_with(
                        ordered,
                        F.zip_with(same, F.concat(F.array(F.lit(False)), F.slice(same, F.lit(1), n - 1)), lambda a, b: a | b),
                        lambda window, twice: F.struct(window["i"].alias("i"), twice.alias("twice")),
                    ),
                    lambda x: x["twice"],
                ),
                lambda x: x["i"],
            ),
        )

    def counted(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(ordered, lambda o: let(F.sort_array(repeated(o)), covered))
        )

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(hashes, counted))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row a document: its id, host and the measures of the rules."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    packed = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(host_col).alias("host"),
        let(
            words_of(text),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
                repeated_words(w).alias("n_repeat_words"),
            ),
        ).alias("w"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))).alias("l"),
    )
    out = packed.select("doc_id", "host", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")
    return out.withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
            "symbols_failed": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars"),
            "lines_failed": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"),
        }
    )


def host_verdicts(measured: DataFrame) -> DataFrame:
    """One row a host: its documents, the failures and shrunk rate of each rule, and host_kept.

    Prior of a rule over hosts with n documents and k failures: mean m = sum(k)/sum(n); v = the variance of
    k/n around m, hosts weighted by n; strength = m(1-m)/v - 1 within STRENGTH (its upper end if v is 0);
    shrunk rate = (k + m * strength) / (n + strength). It is held against the limit
    min(MAX_HOST_RATE, max(MIN_HOST_RATE, MAX_HOST_RATIO * m)).
    """
    hosts = staged(measured.groupBy("host").agg(F.count("*").alias("n"), *(F.count_if(F.col(r)).alias(r) for r in RULES)))
    sums = [F.sum(r).alias(r) for r in RULES]
    total = hosts.agg(F.sum("n").alias("n"), *sums).first()  # one row
    mean = {r: (total[r] or 0) / (total["n"] or 1) for r in RULES}
    spread = hosts.agg(*(F.sum(F.col("n") * (F.col(r) / F.col("n") - mean[r]) ** 2).alias(r) for r in RULES)).first()
    out, kept = hosts, F.lit(True)
    for r in RULES:
        v = (spread[r] or 0.0) / (total["n"] or 1)
        strength = min(max(mean[r] * (1 - mean[r]) / v - 1 if v > 1e-12 else STRENGTH[1], STRENGTH[0]), STRENGTH[1])
        out = out.withColumn(f"{r}_rate", (F.col(r) + mean[r] * strength) / (F.col("n") + strength))
        kept &= F.col(f"{r}_rate") <= min(MAX_HOST_RATE, max(MIN_HOST_RATE, MAX_HOST_RATIO * mean[r]))
    return out.withColumn("host_kept", kept)


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Measures, failures, host_kept and kept of every document (see the module's text)."""
    measured = staged(measures(docs, id_col, text_col, host_col))
    hosts = host_verdicts(measured).select(F.col("host").alias("host_"), "host_kept")
    joined = measured.join(small_side(hosts), F.col("host").eqNullSafe(F.col("host_")), "left").drop("host_")
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("host_kept"), F.lit(True)))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_WS = r"[\x20\x09-\x0D]+"
OP3_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, source, text, list_filter(string_split_regex(text, '{_WS}'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS c
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
), rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM win WHERE c >= 2) GROUP BY r
), m AS (
  SELECT w.r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{_WS}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM w LEFT JOIN rep ON w.r = rep.r
), f AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
    100 * n_symbols > {MAX_SYMBOL_PERCENT} * word_chars AS symbols_failed,
    100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines AS lines_failed
  FROM m
), h AS (
  SELECT source, rule, count(*) AS n, count(*) FILTER (failed) AS k
  FROM (SELECT source, unnest(['base', 'symbols', 'lines']) AS rule, unnest([base_failed, symbols_failed, lines_failed]) AS failed FROM f)
  GROUP BY source, rule
), p AS (
  SELECT rule, any_value(m) AS m, sum(n * (k / n - m) ** 2) / sum(n) AS v
  FROM (SELECT *, sum(k) OVER (PARTITION BY rule) / sum(n) OVER (PARTITION BY rule) AS m FROM h) GROUP BY rule
), s AS (
  SELECT rule, m, least(greatest(CASE WHEN v > 1e-12 THEN m * (1 - m) / v - 1 ELSE {STRENGTH[1]} END, {STRENGTH[0]}), {STRENGTH[1]}) AS strength FROM p
), verdict AS (
  SELECT h.source, bool_and((k + m * strength) / (n + strength) <= least({MAX_HOST_RATE}, greatest({MIN_HOST_RATE}, {MAX_HOST_RATIO} * m))) AS host_kept FROM h JOIN s USING (rule) GROUP BY h.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
FROM f JOIN verdict ON f.source IS NOT DISTINCT FROM verdict.source
"""
