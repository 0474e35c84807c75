"""Folders on storage that all executors share, for data that a query derives and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, label: str) -> str:
    """A new path below spark.checkpoint.dir. Where that is unset, below a folder of our own if all runs on this machine, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/tidewell/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> str:
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return path


def spread(df: DataFrame) -> DataFrame:
    """df dealt to all cores alike: for rows that cost much to judge and lie in few bytes, of which a scan makes few tasks."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def streamed(df: DataFrame, label: str) -> DataFrame:
    """df, written and read again as a stream."""
    return df.sparkSession.readStream.schema(df.schema).parquet(written(df, label))


def drained(stream: DataFrame, label: str) -> DataFrame:
    """What the stream gives for all that is there now, as a table."""
    spark = stream.sparkSession
    out = folder(spark, label)
    stream.writeStream.format("parquet").option("checkpointLocation", folder(spark, label)).trigger(availableNow=True).outputMode("append").start(out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def drained_by_clock(stream: DataFrame, label: str) -> DataFrame:
    """The same for a stream with timers or state that ends by the clock: such a stream goes on without data, so it is stopped after two batches that had none."""
    spark = stream.sparkSession
    out = folder(spark, label)
    q = stream.writeStream.format("parquet").option("checkpointLocation", folder(spark, label)).trigger(processingTime="1 second").outputMode("append").start(out)
    # the first batch reads all files; timers that are due fire in it or in the next one
    while q.isActive and (q.lastProgress is None or q.lastProgress.batchId < 2 or q.lastProgress.numInputRows):
        q.awaitTermination(0.5)
    if q.exception() is not None:
        raise q.exception()
    q.stop()
    return spark.read.schema(stream.schema).parquet(out)


@contextmanager
def split_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """Files split at so many bytes for the jobs inside."""
    keys = {"spark.sql.files.maxPartitionBytes": str(most), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
