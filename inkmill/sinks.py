"""Sinks: the cumulative table, a Markdown file, and the run's counters.

A run's new rows are appended to the table as a folder of their own, by Spark's dynamic overwrite of partitions: what is written follows what is new, a run that is
done again writes its own folder again, and one that ends early leaves the others as they are. What the table drops, it drops folder by folder. Only a table that isn't laid out by runs is written anew as a whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.order import table_order
from .session import hadoop_path, remove, scratch
from .sources.tables import RUN, current, read_runs, set_aside

#: Lines of a text file that one task writes.
LINES = 10_000


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.mkdirs(p)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, source = hadoop_path(spark, old)
    if not fs.rename(source, hadoop_path(spark, new)[1]):
        raise OSError(f"could not rename {old} to {new}")


def save_table(df: DataFrame, path: str, run: str | None = None) -> None:
    """Write df, sorted, in place of the table at path, which df may be read from: the new one is written beside it and then
    takes its name. A failed write leaves the old one; a run that ends between the two renames leaves it beside its place, where
    read_table finds it. run: lay the table out by runs, all rows being of this one."""
    spark = df.sparkSession
    by = table_order(df)
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    rows = df.orderBy(*by) if by else df
    try:
        (rows.withColumn(RUN, F.lit(run)).write.partitionBy(RUN) if run else rows.write).parquet(new)
    except BaseException:
        remove(spark, new)
        raise
    fs, target = hadoop_path(spark, path)
    if fs.exists(target):
        _rename(spark, path, old)
    _rename(spark, new, path)
    for left in set_aside(spark, path):
        remove(spark, left)


def put_back(spark: SparkSession, path: str) -> None:
    """Put a table that lies beside its place, as a run ended while it was being replaced, back there."""
    found = current(spark, path)
    if found and found != path:
        _rename(spark, found, path)


def append_run(df: DataFrame, path: str, run: str) -> None:
    """Add df, sorted, to the table at path, which is laid out by runs or isn't there yet, as the rows of this run."""
    by = table_order(df)
    rows = (df.orderBy(*by) if by else df).withColumn(RUN, F.lit(run))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path)


def keep_in_runs(spark: SparkSession, path: str, keeps) -> None:
    """Drop the rows of the table at path that keeps(table) lacks. Only the runs that lose rows are written again, those that lose all are removed."""
    table = read_runs(spark, path)
    sizes = table.groupBy(RUN).agg(F.count("*").alias("n")).join(keeps(table).groupBy(RUN).agg(F.count("*").alias("left")), RUN, "left")
    less = {r[RUN]: r["left"] for r in sizes.where("left is null or left < n").collect()}  # a row a run
    some = [run for run, left in less.items() if left]
    if some:
        kept = keeps(table.where(F.col(RUN).isin(some)))
        kept.repartition(RUN).sortWithinPartitions(RUN, *table_order(kept)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path)
    for run in set(less) - set(some):
        remove(spark, f"{path}/{RUN}={run}")


def write_markdown(lines: DataFrame, path: str, ordinal: str = "line_no", text: str = "text") -> None:
    """The texts in the order of ordinal, numbered from 1 without gaps, joined by line ends, as one UTF-8 file.

    Tasks write LINES of them each; the file system then strings the parts together, a stream that passes the driver but is never held there. The file takes its name when it is whole."""
    spark = lines.sparkSession
    folder, page = scratch(spark, "lines"), F.floor((F.col(ordinal) - 1) / LINES).cast("long")
    rows = lines.select(page.alias("page"), F.col(ordinal).alias("at"), F.col(text).alias("text"))
    rows.repartition("page").sortWithinPartitions("page", "at").select("page", "text").write.mode("overwrite").option("lineSep", "\n").partitionBy("page").text(folder)
    fs, _ = hadoop_path(spark, folder)
    parts = list(fs.globStatus(hadoop_path(spark, f"{folder}/page=*/part-*")[1]) or [])
    parts.sort(key=lambda x: int(x.getPath().getParent().getName().removeprefix("page=")))
    out_fs, target = hadoop_path(spark, path)
    made = hadoop_path(spark, f"{path}.new-{uuid.uuid4().hex}")[1]
    out_fs.mkdirs(target.getParent())
    out_fs.setWriteChecksum(False)  # a local file gets no companion
    jvm = spark._jvm
    out = out_fs.create(made)
    try:
        for i, x in enumerate(parts):
            source = fs.open(x.getPath())
            try:
                last = i == len(parts) - 1  # whose last line has no end
                taken = jvm.org.apache.commons.io.input.BoundedInputStream(source, x.getLen() - 1) if last else source
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(taken, out, 1 << 16, False)
            finally:
                source.close()
    finally:
        out.close()
    out_fs.delete(target, False)
    _rename(spark, made.toString(), path)
    remove(spark, folder)
