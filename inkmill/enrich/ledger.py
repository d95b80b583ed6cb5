"""A ledger of replies, so that a model is asked once a prompt, whatever happens to the task or the run that asked.

A prompt is known by a digest of the model's identity, the system prompt, the reply's schema and its own text. Replies are kept in two forms below the
ledger's folder, which must be one that driver and executors share:

    open/<run>/<task>-*.json    journals of a task, a line a reply, written as it comes; a task that is repeated finds what the one before it was told
    known/_run=<run>/           the replies of a finished run as Parquet; its open ones go then

A journal is closed after ROLL seconds or the next reply, so that on stores that show closed files alone no more than that is lost, and tasks whose replies come fast write few files.
Both are read before anything is asked, so what a run that was stopped has left counts too. Failed requests are no replies: they are asked again by the next run.
Prompts that are equal are asked once and all get the reply. With speculative execution two copies of a task may ask at the same moment.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import is_dataclass

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path, remove, ship
from ..sources.tables import exists
from .clients import Client, ClientError

#: Seconds after which a journal is closed.
ROLL = 1.0
ANSWER_DDL = "digest string, reply string, error string"


def identity(client: Client) -> str:
    """What a reply depends on in a client: its identity if it states one, else its class, with its fields if it is a dataclass."""
    return getattr(client, "identity", None) or (repr(client) if is_dataclass(client) else type(client).__qualname__)


def digest(prompt: Column, client: Client, system: str, schema: dict) -> Column:
    """The key of a prompt, 64 hex digits."""
    context = hashlib.sha256(json.dumps([identity(client), system, schema]).encode()).hexdigest()
    return F.sha2(F.concat(F.lit(context), prompt), 256)


class OpenReplies:
    """The replies to one task of one run that isn't finished, in a folder of any file system that pyarrow knows. Made within a task. task: what is the same when it is repeated."""

    def __init__(self, folder: str, task: str = "0"):
        from pyarrow import fs

        self.fs, self.folder = fs.FileSystem.from_uri(folder)
        self.task = task
        self.fs.create_dir(self.folder, recursive=True)
        self.file, self.opened = None, 0.0
        #: Replies to the task's earlier attempts, and those of the journal that is open; a task has no prompt twice, so it need not keep what it wrote before.
        self.told: dict[str, str] = {}
        self.own: dict[str, str] = {}
        for info in self.fs.get_file_info(fs.FileSelector(self.folder)):
            if info.is_file and info.base_name.startswith(f"{task}-"):
                self._read(info.path)

    def _read(self, path: str) -> None:
        with self.fs.open_input_stream(path) as f:
            for line in f.read().split(b"\n"):
                try:
                    made = json.loads(line)
                    self.told[made["digest"]] = made["reply"]
                except ValueError:  # half a line, of a task that was killed
                    continue

    def get(self, key: str) -> str | None:
        return self.told.get(key, self.own.get(key))

    def put(self, key: str, reply: str) -> None:
        """A line of the journal. Every reply is handed to the file system at once."""
        if self.file is None:
            self.file, self.opened = self.fs.open_output_stream(f"{self.folder}/{self.task}-{uuid.uuid4().hex}.json"), time.monotonic()
        self.file.write(json.dumps({"digest": key, "reply": reply}).encode() + b"\n")
        self.file.flush()
        self.own[key] = reply
        if time.monotonic() - self.opened >= ROLL:
            self.close()

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file, self.own = None, {}


def ask(batches: Iterator[pd.DataFrame], client: Client, system: str, schema: dict, folder: str) -> Iterator[pd.DataFrame]:
    """The work of a task: an answer for every digest and prompt, from the open replies where they have it."""
    context = TaskContext.get()
    replies = OpenReplies(folder, str(context.partitionId() if context else 0))
    try:
        for batch in batches:
            found = []
            for key, prompt in zip(batch["digest"], batch["prompt"]):
                reply, error = replies.get(key), None
                if reply is None:
                    try:
                        reply = client.chat(system, prompt, schema)
                        replies.put(key, reply)
                    except ClientError as failure:
                        error = str(failure)
                found.append((key, reply, error))
            yield pd.DataFrame(found, columns=["digest", "reply", "error"], dtype=object)
    finally:
        replies.close()


def known(spark: SparkSession, folder: str) -> DataFrame:
    """digest, reply: what the ledger holds, one row a digest."""
    held = spark.createDataFrame([], "digest string, reply string")
    if exists(spark, f"{folder}/known"):
        held = held.union(spark.read.schema(ANSWER_DDL).parquet(f"{folder}/known").where("reply is not null").select("digest", "reply"))
    if exists(spark, f"{folder}/open"):
        held = held.union(spark.read.schema("digest string, reply string").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true").option("mode", "DROPMALFORMED").json(f"{folder}/open").where("reply is not null"))
    return held.groupBy("digest").agg(F.min("reply").alias("reply"))


def answers(prompts: DataFrame, client: Client, system: str, schema: dict, folder: str, at_once: int | None = None) -> DataFrame:
    """prompts: seq, prompt (no nulls). seq, reply, error: one row a row, of which one of reply and error is null.

    Asks for what the ledger in folder doesn't hold and writes it there. at_once: the number of requests at once; unless set, Spark's partitions decide."""
    spark = prompts.sparkSession
    ship(spark)
    run = uuid.uuid4().hex
    fs, p = hadoop_path(spark, folder)
    base = fs.makeQualified(p).toString()
    keyed = prompts.withColumn("digest", digest(F.col("prompt"), client, system, schema))
    new = keyed.select("digest", "prompt").join(known(spark, folder), "digest", "left_anti")
    new = (new.repartition(at_once, "digest") if at_once else new).dropDuplicates(["digest"])
    opened = f"{base}/open/{run}"
    asked = new.mapInPandas(lambda batches: ask(batches, client, system, schema, opened), ANSWER_DDL)
    asked.write.parquet(f"{folder}/known/_run={run}")
    remove(spark, opened)
    failed = spark.read.schema(ANSWER_DDL).parquet(f"{folder}/known/_run={run}").where("reply is null").select("digest", F.coalesce("error", F.lit("")).alias("error"))
    return keyed.select("seq", "digest").join(known(spark, folder), "digest", "left").join(failed, "digest", "left").select("seq", "reply", F.when(F.col("reply").isNull(), F.col("error")).alias("error"))
