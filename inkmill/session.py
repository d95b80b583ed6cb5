"""What a Spark session needs to run this package's Python functions on its executors, and its folder for intermediate data."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once an application, so that they need no copy of it."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="inkmill-")
        sc.addPyFile(shutil.make_archive(f"{folder}/inkmill", "zip", package.parent, package.name))
        _shipped.add(sc.applicationId)


def map_in_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """df.mapInArrow(run, schema), with this package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """The session's folder for intermediate results (``spark.checkpoint.dir``), which all executors share. Only where executors run on the
    driver's machine alone a temporary folder will do in its stead."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="inkmill-checkpoint-"))
    return sc.getCheckpointDir()


def hadoop_path(spark: SparkSession, path: str):
    """The file system of path, and path, for calls to them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, which goes at the latest when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    fs, p = hadoop_path(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path
