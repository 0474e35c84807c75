"""Ranks and running totals along an order, for keys of any size: the rows of one key are spread over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.scratch import written

#: Rows of one key that a running total takes in one window, as a power of two.
BLOCK_BITS = 16


def laid_out(df: DataFrame, keys: list[str], order: list[str | Column], label: str = "ordered") -> DataFrame:
    """df with __at, which ascends by keys and order: the partition in the upper 31 bits, the place in it in the lower 33.

    Range-partitioned by keys and order together, so that a large key fills several partitions, and written to shared
    storage: the sampled bounds of a second run would be others, and every later step has to see the same places.
    """
    out = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("__at", F.monotonically_increasing_id())
    return df.sparkSession.read.schema(out.schema).parquet(written(out, label))


def joined(rows: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """rows beside their totals; a null key meets the null key."""
    totals = totals.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys]
    return rows.join(totals, on).drop(*(f"__key_{k}" for k in keys))


def ranked(df: DataFrame, keys: list[str], order: list[str | Column], name: str = "rank") -> DataFrame:
    """df with its rows' numbers from 1 within their keys, as row_number() gives them, without a window over a key's rows.

    A window sees one row for each partition that a key lies in; a row's number is its place in the partition after the
    key's first row there, and the rows in the partitions before.
    """
    rows = laid_out(df, keys, order).withColumn("__part", F.shiftright("__at", 33))
    runs = rows.groupBy(*keys, "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    out = joined(rows, runs, [*keys, "__part"])
    return out.withColumn(name, F.col("__at") - F.col("__first") + F.col("__before") + 1).drop("__at", "__part", "__first", "__before")


def running(df: DataFrame, keys: list[str], order: list[str | Column], sums: dict[str, Column], highs: dict[str, Column] | None = None) -> DataFrame:
    """df with the sums (null counts as 0) and highest values (null is passed over) of each key's rows up to and with each row.

    Windows see 2^BLOCK_BITS rows at most, and one row for each such block of a key.
    """
    highs = highs or {}
    rows = laid_out(df, keys, order).withColumns({f"__v_{n}": c for n, c in (sums | highs).items()}).withColumn("__block", F.shiftright("__at", BLOCK_BITS))
    agg = lambda n: F.sum(F.coalesce(f"__v_{n}", F.lit(0))) if n in sums else F.max(f"__v_{n}")
    totals = rows.groupBy(*keys, "__block").agg(*(agg(n).alias(f"__v_{n}") for n in [*sums, *highs]))
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "__block", *(agg(n).over(earlier).alias(f"__b_{n}") for n in [*sums, *highs]))
    inside = Window.partitionBy(*keys, "__block").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    out = joined(rows.withColumns({f"__v_{n}": agg(n).over(inside) for n in [*sums, *highs]}), totals, [*keys, "__block"])
    out = out.withColumns({n: F.col(f"__v_{n}") + F.coalesce(f"__b_{n}", F.lit(0)) for n in sums} | {n: F.greatest(f"__v_{n}", f"__b_{n}") for n in highs})
    return out.drop("__at", "__block", *(f"__{x}_{n}" for n in [*sums, *highs] for x in "vb"))
