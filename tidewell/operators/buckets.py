"""Tables that grow by batches and hold each key once: a batch reads the buckets of its own keys, and nothing moves but the batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a table, and keys of a batch up to which they are broadcast to the table's scan.
BUCKETS, MOST_KEYS = 64, 1 << 20


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def held_at(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table below path, or an empty one if nothing has been written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def held_rows(batch: DataFrame, path: str, schema: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows below path whose key is among the batch's.

    Only the buckets of the batch's keys are read: their numbers, at most `buckets`, prune the partitions. The keys are
    broadcast if they are counted to be at most MOST_KEYS, so that the table is not shuffled; else both sides are.
    """
    spark = batch.sparkSession
    keys = batch.select(key).distinct()
    about = keys.agg(F.collect_set(bucket_of(key, buckets)).alias("numbers"), F.count("*").alias("n")).first()
    numbers, small = about.numbers, about.n <= MOST_KEYS
    table = held_at(spark, path, f"{schema}, bucket int").where(F.col("bucket").isin(numbers) if numbers else F.lit(False))
    return table.join(F.broadcast(keys) if small else keys, key, "left_semi").drop("bucket")


def append(rows: DataFrame, path: str, key: str, *parts: str, buckets: int = BUCKETS) -> None:
    """Append rows below path, by parts and bucket; a task writes whole buckets, so that a batch adds a file to each."""
    placed = rows.withColumn("bucket", bucket_of(key, buckets))
    placed.repartition(*parts, "bucket").write.mode("append").partitionBy(*parts, "bucket").parquet(path)
