"""Helpers that the operators of this subpackage share: tables staged on shared storage, and components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What separates words: the ASCII white space bytes 0x20 and 0x09 to 0x0D.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, one of our own if all runs on this machine, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-stage-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: later stages start from files that outlive any executor."""
    spark = df.sparkSession
    path = f"{stage_dir(spark)}/tidewell/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for the jobs inside: rows that carry whole sets of hashes are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for df in frames:
        spark = df.sparkSession
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def semi_join(df: DataFrame, keys: DataFrame, on: str, most: int = 1 << 20) -> DataFrame:
    """The rows of df whose key is among keys: by broadcast if those are counted to be at most `most`, else by a shuffle."""
    keys = staged(keys.select(on).distinct(), "keys")
    return df.join(F.broadcast(keys) if keys.limit(most + 1).count() <= most else keys, on, "left_semi")


def numbered(rows: DataFrame, key: str, order: list[str], label: str) -> DataFrame:
    """rows with idx from 0 within their key (null is a key) and n, the key's rows, as a staged table; of a key's rows no window sees more than one a partition."""
    laid = staged(rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("at", F.monotonically_increasing_id()), label)
    laid = laid.withColumn("part", F.shiftright("at", 33))
    runs = laid.groupBy(F.col(key).alias("k"), F.col("part").alias("p")).agg(F.min("at").alias("first"), F.count("*").alias("held"))
    all_of = Window.partitionBy("k")
    earlier = all_of.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0))).withColumn("n", F.sum("held").over(all_of))
    out = laid.join(runs, F.col(key).eqNullSafe(F.col("k")) & (F.col("part") == F.col("p")))
    out = staged(out.withColumn("idx", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "k", "p", "first", "held", "before"), label)
    discard(laid)
    return out


def connected_components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """(node, component): component is the smallest node that the links (src, dst) reach.

    Alternates large-star and small-star steps until nothing changes; every step is a min per node and an equi-join,
    so that no node's neighbours are gathered in one place, and ends in a staged table.
    """
    links = edges.where("src is not null and dst is not null and src <> dst").select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    ).distinct()
    links, seen, old = staged(links, label), None, []
    while True:
        # large star: every larger neighbour of u is linked with the smallest node around u
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours are linked with the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = staged(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), label)
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        old.append(links)
        if now == seen:
            discard(*old)
            break
        links, seen = new, now
    return new.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
