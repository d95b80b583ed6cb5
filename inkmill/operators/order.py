"""Orders, caps by position and ordinals. Rows have no order of their own: seq, the place of arrival, is a column."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scoring import priority_rank
from ..functions.text import to_number

#: Rows whose keys tell the ranges that with_ordinal deals rows out by, and the most ranges there are.
SAMPLE, RANGES = 16_384, 256
#: Bytes of a text that count in that.
PREFIX = 12


@dataclass(frozen=True)
class Key:
    """A part of an order. Missing values are the smallest."""

    column: Column | str
    descending: bool = False

    def value(self) -> Column:
        return F.col(self.column) if isinstance(self.column, str) else self.column

    def sort(self) -> Column:
        return self.value().desc_nulls_last() if self.descending else self.value().asc_nulls_first()


def _tie(df: DataFrame) -> list[Key]:
    return [Key("seq")] if "seq" in df.columns else []


def table_keys(df: DataFrame) -> list[Key]:
    """Of the saved table: scores, then dates, both descending with missing ones last (NaN counts as missing)."""
    by = []
    if "relevance_score" in df.columns:
        by.append(Key(F.nanvl(F.col("relevance_score").cast("double"), F.lit(None).cast("double")), True))
    if "published_date" in df.columns:
        by.append(Key("published_date", True))
    return by + _tie(df)


def table_order(df: DataFrame) -> list[Column]:
    return [k.sort() for k in table_keys(df)]


def report_keys(df: DataFrame) -> list[Key]:
    """Of the report: priority, then score and date descending, those that the table has."""
    by = [Key(priority_rank("llm_priority"))]
    if "triage_score" in df.columns:
        by.append(Key(to_number("triage_score"), True))
    if "published_date" in df.columns:
        by.append(Key("published_date", True))
    return by + _tie(df)


def report_order(df: DataFrame) -> list[Column]:
    return [k.sort() for k in report_keys(df)]


def top_per_query(df: DataFrame, n: int, query: str = "query", date: str = "published_date") -> DataFrame:
    """The n latest rows of each query."""
    place = F.row_number().over(Window.partitionBy(query).orderBy(F.col(date).desc_nulls_last(), F.col("seq")))
    return df.withColumn("rank", place).where(F.col("rank") <= n)


def first_n(df: DataFrame, candidate: Column, n: int | None) -> DataFrame:
    """seq of the candidates, or of the first n of them by arrival, whatever their scores."""
    found = df.where(candidate).select("seq")
    return found if n is None else found.orderBy("seq").limit(int(n))


def _coarse(value: Column, kind: T.DataType, sign: int) -> tuple[list[Column], bool]:
    """Doubles that compare, as a list, as the values do in the order, and whether values that differ always differ there."""
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0)) * sign
    parts, exact = [number(value.isNotNull().cast("int"))], True
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            more, exact = _coarse(value[f.name], f.dataType, sign)
            parts += more
            if not exact:
                break
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        odd = F.isnan(value)
        parts += [number(odd.cast("int")), F.when(odd, F.lit(0.0)).otherwise(number(value))]
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
        parts.append(number(value.cast("int")))
    elif isinstance(kind, (T.LongType, T.DateType, T.TimestampType)):
        whole = value if isinstance(kind, T.LongType) else F.unix_date(value).cast("long") if isinstance(kind, T.DateType) else F.unix_micros(value)
        parts += [number(F.shiftright(whole, 32)), number(whole.bitwiseAND(F.lit((1 << 32) - 1)))]
    elif isinstance(kind, T.StringType):
        raw = value.cast("binary")
        for at in (1, 1 + PREFIX // 2):
            parts.append(number(F.conv(F.rpad(F.hex(F.substring(raw, at, PREFIX // 2)), PREFIX, "0"), 16, 10)))
        parts.append(number((F.octet_length(raw) > PREFIX).cast("int")))
        exact = False
    else:
        exact = False
    return parts, exact


def with_ordinal(df: DataFrame, order: list[Key], name: str = "ordinal") -> DataFrame:
    """Numbers (long) from 1 in the given order, in which no rows should be equal.

    The keys of a sample of rows (those with the smallest hashes) tell ranges, the rows of each are counted, and a row's number is its place in its range plus the rows of the ranges before. Both are subqueries of
    the plan, so nothing runs before the result is asked for, and columns that nobody asks for are neither sent nor read: without texts in the
    result only keys are. Rows of one range meet in one task; rows whose keys begin alike, such as texts with 12 equal bytes, share a range.
    """
    tag = uuid.uuid4().hex
    key, bounds, at, sizes = (f"_{x}_{tag}" for x in ("key", "bounds", "range", "sizes"))
    kinds = [f.dataType for f in df.select(*(k.value().alias(str(i)) for i, k in enumerate(order))).schema]
    parts, told = [], F.lit(True)  # told: whether all keys so far are told whole; only then the next one counts
    for k, kind in zip(order, kinds):
        more, exact = _coarse(k.value(), kind, -1 if k.descending else 1)
        parts += [F.when(told, p).otherwise(F.lit(0.0)) for p in more]
        if not exact and not isinstance(kind, T.StringType):
            break
        if not exact:
            told &= F.coalesce(F.octet_length(k.value()) <= PREFIX, F.lit(True))
    ranges = max(1, min(RANGES, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    keyed = df.withColumn(key, F.array(*parts))
    some = keyed.select(key).orderBy(F.xxhash64(key)).limit(SAMPLE).agg(F.array_sort(F.collect_list(key)).alias("s"))
    picked = F.transform(F.sequence(F.lit(1), F.lit(ranges)), lambda i: F.get("s", F.floor(i * F.size("s") / F.lit(ranges + 1)).cast("int")))
    ranged = df.withColumn(bounds, some.select(F.array_distinct(F.filter(picked, lambda b: b.isNotNull()))).scalar())
    # an array of one, so that a row's key is made once and not once a bound
    ranged = ranged.withColumn(at, F.transform(F.array(F.array(*parts)), lambda k: F.size(F.filter(bounds, lambda b: b <= k)))[0]).drop(bounds)
    counts = ranged.groupBy(at).agg(F.count("*").alias("n")).agg(F.collect_list(F.struct(F.col(at).alias("at"), "n")).alias("all"))
    before = F.transform(F.sequence(F.lit(0), F.lit(ranges)), lambda i: F.aggregate(F.filter("all", lambda c: c["at"] < i), F.lit(0).cast("long"), lambda total, c: total + c["n"]))
    place = F.row_number().over(Window.partitionBy(at).orderBy(*(k.sort() for k in order)))
    numbered = ranged.withColumn(sizes, counts.select(before).scalar())
    return numbered.withColumn(name, place + F.get(sizes, F.col(at))).drop(at, sizes)
