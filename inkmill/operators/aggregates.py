"""Counts and the ordered concatenation of the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip, to_text
from .filters import has_priority
from .order import Key


def _label(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("Unknown")).alias("label")


def counts_by(df: DataFrame, column: str) -> DataFrame:
    """label, n, first: rows by the value of column, missing ones as Unknown; first is the smallest seq."""
    return df.groupBy(_label(column)).agg(F.count("*").alias("n"), F.min("seq").alias("first"))


def ranked_counts(df: DataFrame, column: str, order: list[Key]) -> DataFrame:
    """label, n, place (from 1): rows by the value of column, most first, then the label whose first row in the given order comes first. Rows need no numbers for
    that: each task sends its first row of each label. The labels, which are few, are placed in one task."""
    keyed = df.select(_label(column), *(k.value().alias(f"k{i}") for i, k in enumerate(order)))
    by = [Key(f"k{i}", k.descending).sort() for i, k in enumerate(order)]
    first = keyed.withColumn("nth", F.row_number().over(Window.partitionBy("label").orderBy(*by))).where("nth = 1")
    both = first.join(keyed.groupBy("label").agg(F.count("*").alias("n")), "label")
    return both.select("label", "n", F.row_number().over(Window.orderBy(F.col("n").desc(), *by)).alias("place"))


def priority_counts(df: DataFrame, *more: Column) -> DataFrame:
    """One row: all rows, those to read, those to skim, and more aggregates."""
    return df.agg(F.count("*").alias("n_total"), F.count_if(has_priority(("read",))).alias("n_read"), F.count_if(has_priority(("skim",))).alias("n_skim"), *more)


def any_text(df: DataFrame, column: str) -> Column:
    """Whether any row has a text in column; False where there is no such column."""
    return F.coalesce(F.bool_or(strip(to_text(column)) != ""), F.lit(False)) if column in df.columns else F.lit(False)


def run_counts(raw: DataFrame, unique: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: how many papers were found, unique, and kept."""
    tagged = [d.select(F.lit(name).alias("of")) for name, d in (("raw", raw), ("unique", unique), ("kept", kept))]
    return tagged[0].union(tagged[1]).union(tagged[2]).agg(*(F.count_if(F.col("of") == n).alias(f"n_{n}") for n in ("raw", "unique", "kept")))


def concat_ordered(text: str, ordinal: str, separator: str = "\n") -> Column:
    """An aggregate: the texts in the order of ordinal as one string. For reports: all of them come together."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col(text).alias("t"))))
    return F.array_join(F.transform(rows, lambda r: r["t"]), separator)
