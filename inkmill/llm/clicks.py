"""Click deduplication in windows that expire, as a stateful stream.

A click's repeats come again under its click_id, late and out of order. The first of them opens a window, which takes all that are at most WINDOW hours later, tells how many
came and which differ from it, and closes when the stream is so far on that no more can come.

The stream is applyInPandasWithState with EventTimeTimeout. Its watermark lies LATENESS hours behind the largest hour that earlier micro-batches saw. Spark keeps it in the checkpoint, so that a query
that is started anew goes on where the last one was, and wakes up the states whose deadline it has passed: they emit their windows. What comes behind the watermark is dropped. A second is added to the
delay, so that rows and deadlines exactly at the bound are on its right side. In each micro-batch what came in several chunks is folded in the order of hour and hash.

State: click_ids are dealt by hash into groups, and a group's state is one packed table of its open windows (click_id, start, repeats, conflicts, sum of checksums, hash: 72 bytes each); its timeout is
the earliest deadline among them. With groups=None every click_id has a state of its own. The results are the same (tests compare them); but a call of the Python
function costs much more than a row (on sf0.01 some 55,000 calls more took eight cores 12 s more), and a click comes two times on average. README has the figures.

run_batches() plays a table as a stream: rows are copied, put into batches by a delay, written once, a folder a batch, and for each batch the query is started anew
on the same checkpoint and reads that batch's folder. A deadline that a batch's rows pass is seen when the next one starts, and its window says after which batch it closed; micro-batches without data,
which would see it earlier, are switched off, as each costs as much as one with data. At the end a sentinel row far ahead lets the watermark pass every deadline.

Bounds: a call holds the rows of a group of about ROWS_A_GROUP rows a batch. A click_id that has more than CROWDED rows comes reduced: only what may open a window (the least hash of one of
its hours, wherever it comes) is kept apart, with its number; of all others, which can only be conflicts, one row an hour goes on with their number and the sum of their checksums. So a click_id's rows in a batch are
bounded by hours, not by clicks, and the reduction is summed within tasks first. To the driver go the least and largest place in time and the number of rows.

Edge cases: rows without click_id or arrival have no place in the stream and are left out; of a negative click_id the remainder is taken as positive; null client, kind, value, ts and
props are empty in the hash, NaN counts as 0 there; equal rows are repeats; a batch without rows isn't started, as it changes nothing; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import hadoop_path, scratch, ship
from .common import small_side, staged, table

WINDOW, LATENESS, BATCHES = 72, 48, 12
ROWS_A_GROUP = 4096
CROWDED = 10_000
HOUR = 3_600_000
#: Hours that the stream's time starts at, so that it is after 1970 whatever the rows' time.
ORIGIN = 1_000_000
#: Hours after the last row at which the sentinel is.
BEYOND = 1_000_000
ROW = "grp int, click_id long, at timestamp, hash binary, n long, crc long"
OUT = "click_id long, start_hour long, closed_batch long, n_repeats long, n_conflicts long, conflict_crc long, hash string"
_STATE = np.dtype([("click_id", "<i8"), ("start", "<i8"), ("repeats", "<i8"), ("conflicts", "<i8"), ("crc", "<i8"), ("hash", "S32")])
_SENTINEL = -1


def _hashes(packed: np.ndarray) -> list[bytes]:
    return [x.ljust(32, b"\0") for x in packed["hash"].tolist()]  # numpy takes zeros from the end


def folder_of(window: int, batch: int, before: int, last: int, flush: int, first_hour: int):
    """The function of a group's rows and state. batch: the number of the batch at hand; before: that of the one before; last: of the last, after which all close: from
    the watermark flush (in milliseconds) on. first_hour: the hour that ORIGIN stands for."""

    def told(closed: list) -> pd.DataFrame:
        batches, found = zip(*closed)
        ids, starts, repeats, conflicts, crcs, hashes = zip(*found)
        made = {"click_id": ids, "start_hour": [s + first_hour - ORIGIN for s in starts], "closed_batch": batches, "n_repeats": repeats, "n_conflicts": conflicts, "conflict_crc": crcs}
        return pd.DataFrame({c: np.array(v, np.int64) for c, v in made.items()} | {"hash": pd.Series([h.hex() for h in hashes], dtype=object)})

    def fold(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark = state.getCurrentWatermarkMs()
        opened: dict[int, list] = {}
        if state.exists:
            packed = np.frombuffer(state.get[0], _STATE)
            columns = [packed[c].tolist() for c in ("click_id", "start", "repeats", "conflicts", "crc")]
            opened = {x[0]: list(x) for x in zip(*columns, _hashes(packed))}
        closed = [(last if mark >= flush else before, w) for w in opened.values() if (w[1] + window) * HOUR < mark]
        for _, w in closed:
            del opened[w[0]]
        rows: dict[tuple, list] = {}  # equal rows are one
        for chunk in () if state.hasTimedOut else chunks:
            chunk = chunk[chunk["click_id"].notna()]  # all but the sentinel, which is alone
            times = chunk["at"].to_numpy("datetime64[ms]").astype(np.int64).tolist()
            for click_id, at, digest, n, crc in zip(chunk["click_id"].tolist(), times, chunk["hash"].tolist(), chunk["n"].tolist(), chunk["crc"].tolist()):
                if at > mark:
                    had = rows.setdefault((click_id, at // HOUR, digest is None, digest), [0, 0])
                    had[0] += n
                    had[1] += crc
        for (click_id, hour, _, digest), (n, crc) in sorted(rows.items()):
            w = opened.get(click_id)
            if w is None or hour > w[1] + window:
                if w is not None:
                    closed.append((batch, w))
                opened[click_id] = [click_id, hour, n - 1, 0, 0, digest]  # the first of an hour has a hash
                continue
            w[2] += n
            if digest != w[5]:
                w[3] += n
                w[4] += crc
        if opened:
            state.update((np.array([tuple(w) for w in opened.values()], _STATE).tobytes(),))
            state.setTimeoutTimestamp((min(w[1] for w in opened.values()) + window) * HOUR)
        elif state.exists:
            state.remove()
        if closed:
            yield told(closed)

    return fold


def windows(rows: DataFrame, fold, lateness: int = LATENESS) -> DataFrame:
    """rows: a stream of grp, click_id, at, hash, n, crc. The windows that close, as a stream. fold: of folder_of()."""
    ship(rows.sparkSession)
    known = rows.withWatermark("at", f"{lateness * 3600 + 1} seconds")
    return known.groupBy("grp").applyInPandasWithState(fold, OUT, "windows binary", "append", GroupStateTimeout.EventTimeTimeout)


def _hours(ts: Column, kind: str) -> Column:
    return F.floor(_micros(ts, kind) / F.lit(3_600_000_000)).cast("long")


def _micros(ts: Column, kind: str) -> Column:
    """Microseconds since 1970, a time without a zone taken as UTC."""
    if kind != "timestamp_ntz":
        return F.unix_micros(ts)
    second = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    minutes = F.unix_date(ts.cast("date")).cast("long") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minutes * 60_000_000 + second


def copies(clicks: DataFrame) -> DataFrame:
    """Every click's copies: click_id, hour, place (in the order of arrival), digest (the hash as 32 bytes), crc (of the hash as text)."""
    kinds = dict(clicks.dtypes)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    made = clicks.where("click_id is not null and arrived_at is not null")
    told = [F.col("client_id"), F.col("kind"), F.floor(100 * F.col("value").cast("double") + 0.5), _micros(F.col("ts"), kinds["ts"]), F.col("props")]
    made = made.select(
        F.col("click_id").cast("long").alias("click_id"),
        _hours(F.col("arrived_at"), kinds["arrived_at"]).alias("arrived"),
        F.concat(*(x for c in told for x in (text(c), F.lit("|")))).alias("said"),
        F.explode(F.sequence(F.lit(0), F.pmod("click_id", F.lit(3)).cast("int"))).alias("j"),
    )
    made = made.withColumn("c", F.crc32(F.concat(F.col("click_id").cast("string"), F.lit(":"), F.col("j").cast("string")).cast("binary")))
    made = made.withColumn("hour", F.col("arrived") + 6 * F.col("j") * (F.col("c") % 10)).withColumn("hash", F.sha2(F.concat("said", (F.col("c") % 3).cast("string")).cast("binary"), 256))
    return made.select("click_id", "hour", (F.col("hour") + F.floor(F.col("c") / 10) % 200).alias("place"), F.unhex("hash").alias("digest"), F.crc32(F.col("hash").cast("binary")).alias("crc"))


def _reduced(rows: DataFrame) -> DataFrame:
    """rows of crowded click_ids (batch, click_id, hour, digest, crc): what may open a window by itself, the rest summed by hour."""
    counted = rows.groupBy("batch", "click_id", "hour", "digest").agg(F.count("*").alias("n"), F.sum("crc").alias("crc"))
    first = rows.groupBy("batch", "click_id", "hour").agg(F.min("digest").alias("digest")).select("click_id", "digest").distinct().withColumn("opens", F.lit(True))
    told = counted.join(first, ["click_id", "digest"], "left").withColumn("digest", F.when(F.col("opens"), F.col("digest")))
    return told.groupBy("batch", "click_id", "hour", "digest").agg(F.sum("n").alias("n"), F.sum("crc").alias("crc"))


def write_batches(spark: SparkSession, clicks: DataFrame, path: str, batches: int = BATCHES, crowded: int = CROWDED, groups: int | None = 0) -> tuple[int, int] | None:
    """Write the copies of clicks to path/batch=0, 1, ...; the first and last hour of all, None if there are no rows. groups: how many groups click_ids are dealt into; 0: by their number; None: each is its own."""
    made = copies(clicks)
    span = made.agg(F.min("place").alias("first"), F.max("place").alias("last"), F.min("hour").alias("low"), F.max("hour").alias("high"), F.count("*").alias("n")).first()
    if not span["n"]:
        return None
    made = made.withColumn("batch", F.expr(f"cast((place - {span['first']}L) * {batches} div {span['last'] - span['first'] + 1}L as int)")).drop("place")
    many = staged(clicks.where("click_id is not null").groupBy(F.col("click_id").cast("long").alias("click_id")).agg(F.count("*").alias("rows")).where(F.col("rows") > crowded).select("click_id"))
    if many.limit(1).count():
        plain = made.join(small_side(many), "click_id", "left_anti").withColumn("n", F.lit(1).cast("long"))
        made = plain.unionByName(_reduced(made.join(small_side(many), "click_id", "left_semi")))
    else:
        made = made.withColumn("n", F.lit(1).cast("long"))
    number = groups or max(64, -(-span["n"] // (batches * ROWS_A_GROUP)))
    grp = F.col("click_id") if groups is None else F.pmod(F.xxhash64("click_id"), F.lit(number)).cast("int")
    at = F.timestamp_millis((F.col("hour") - span["low"] + ORIGIN) * HOUR)
    rows = made.select(grp.alias("grp"), "click_id", at.alias("at"), F.col("digest").alias("hash"), "n", "crc", "batch")
    rows.write.partitionBy("batch").parquet(path)
    return span["low"], span["high"]


def run_batches(spark: SparkSession, clicks: DataFrame, batches: int = BATCHES, window: int = WINDOW, lateness: int = LATENESS, crowded: int = CROWDED, groups: int | None = 0) -> DataFrame:
    """The windows of clicks, played as so many batches: click_id, start_hour, closed_batch, n_repeats, n_conflicts, conflict_crc, hash."""
    folder = scratch(spark, "clicks")
    span = write_batches(spark, clicks, f"{folder}/rows", batches, crowded, groups)
    if span is None:
        return spark.createDataFrame([], OUT)
    kind = "long" if groups is None else "int"
    schema, end = ROW.replace("grp int", f"grp {kind}"), (span[1] - span[0] + ORIGIN + BEYOND) * HOUR
    sentinel = spark.range(1).select(F.lit(_SENTINEL).cast(kind).alias("grp"), F.lit(None).cast("long").alias("click_id"), F.timestamp_millis(F.lit(end)).alias("at"))
    sentinel = sentinel.select("*", F.lit(None).cast("binary").alias("hash"), F.lit(1).cast("long").alias("n"), F.lit(0).cast("long").alias("crc"))
    sentinel.write.parquet(f"{folder}/rows/batch={batches}")
    fs, _ = hadoop_path(spark, folder)
    before = -1
    for number in range(batches + 1):
        if not fs.exists(hadoop_path(spark, f"{folder}/rows/batch={number}")[1]):
            continue
        # braces make it a pattern: on a restart Spark looks at the last batch's files again, which lie elsewhere
        rows = spark.readStream.schema(schema).parquet(f"{folder}/rows/batch={{{number}}}")
        fold = folder_of(window, number, before, batches - 1, end - (lateness + 1) * HOUR, span[0])
        with _without_idle_batches(spark, number < batches):
            query = windows(rows, fold, lateness).writeStream.format("parquet").option("path", f"{folder}/windows").option("checkpointLocation", f"{folder}/checkpoint")
            query = query.outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
        before = number
    return spark.read.schema(OUT).parquet(f"{folder}/windows")


@contextmanager
def _without_idle_batches(spark: SparkSession, without: bool) -> Iterator[None]:
    """Queries that are started meanwhile run no micro-batches without data; a query takes the setting when it starts."""
    key, had = "spark.sql.streaming.noDataMicroBatches.enabled", spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled")
    spark.conf.set(key, str(not without).lower())
    try:
        yield
    finally:
        spark.conf.set(key, had)


def op12_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_batches(spark, table(spark, sf_dir, "clicks"))
