"""Resumable work lists: a file stream whose checkpoint remembers what has been done."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only where none is set, as on one machine."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    return path or tempfile.mkdtemp(prefix="ledgerlode-")


def drain(spark: SparkSession, source: str, schema, state: str, each: Callable[[DataFrame, int], None]) -> int:
    """Gives what is new in ``source`` since the last call with the same ``state`` to ``each`` and returns the number of batches.

    ``each`` gets a batch and its number and must give the same result when called again
    with the same number, which is what a restart does.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    run = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return sum(p["numInputRows"] > 0 for p in run.recentProgress)


def into(path: str) -> Callable[[DataFrame, int], None]:
    """A sink with a folder for each batch, written over when a batch is repeated."""

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return each


def drained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events through the stream, run twice over the same state: the second run must add nothing."""
    root = f"{shared_folder(spark)}/resume-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    for _ in range(2):
        drain(spark, f"{sf_dir}/events.parque[t]", schema, f"{root}/state", into(f"{root}/out"))
    return spark.read.parquet(f"{root}/out")
