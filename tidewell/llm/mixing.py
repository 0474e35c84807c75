"""Mixing sources to target weights along a curriculum: every occurrence of a document gets its position in training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import SPACE, staged

#: Rows of a source in one bucket of its order, about.
BUCKET = 10_000
#: How far a source's weight moves over training: from 1 + tilt times its mean weight to 1 - tilt times.
TILT = 0.5
WEIGHTS = (5.0, 2.0, 1.0)


def word_count(c: str) -> Column:
    """Words of a text: runs of characters other than 0x20 and 0x09 to 0x0D; 0 for null."""
    parts = F.split(F.trim(F.regexp_replace(F.coalesce(F.col(c), F.lit("")), SPACE, " ")), " ")
    return F.when(F.trim(F.translate(F.coalesce(F.col(c), F.lit("")), "\t\n\x0b\f\r", "     ")) == "", 0).otherwise(F.size(parts)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """(source, source_size, target): weights repeat over the sources by code point, null last, and share the sum of all sizes.

    A target stops at `most` times its source's size; the excess is shared among the others by weight until none is
    above. In order of size per weight, the sources that stop are the first ones; those before a source take `most`
    times their sizes, the rest share what is left.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.get(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights)))
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    upto, after = by_room.rowsBetween(Window.unboundedPreceding, -1), by_room.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.partitionBy()) - most * F.coalesce(F.sum("source_size").over(upto), F.lit(0))) / F.sum("weight").over(after)
    rows = sizes.withColumn("weight", w).withColumn("level", level).withColumn("stops", F.col("level") * F.col("weight") > most * F.col("source_size"))
    rows = rows.withColumn("final", F.max(F.when(~F.col("stops"), F.col("level"))).over(Window.partitionBy()))
    return rows.withColumn("target", F.when(F.col("stops"), most * F.col("source_size")).otherwise(F.col("final") * F.col("weight"))).select("source", "source_size", "target")


#: Sources up to which what is known of them is broadcast.
MAX_SOURCES = 1 << 16


def numbered(docs: DataFrame, *columns: Column) -> DataFrame:
    """A staged table of one row for each row of docs, with columns, that gives each a number n, its size in words and a hash of its text; texts are split once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), "source", word_count("text").alias("size"), F.xxhash64("text").alias("text_hash"), *columns)
    return staged(rows.withColumn("n", F.monotonically_increasing_id()), "sized")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, tilt: float = TILT) -> DataFrame:
    """One row for each row of docs: doc (its doc_id), source, size, source_size, target, copies, positions.

    size counts words. Each source is to give `target` words (see targets) of the sum of all sizes. Within a source,
    documents are ordered by a hash of their id, size and text; each is taken floor(target / source_size) times, and once
    more as long as its words fit into what is left of the target; the gap that remains goes to the document nearest
    to it in size, so that a source misses its target by far less than one document's words. `copies` says how often, `positions` where in training: 0 to 1, rising.

    A source's weight at time t is its mean weight times 1 + slope * (1 - 2t): sources of shorter documents lead and
    longer ones follow, with slopes that cancel out over all sources at every t, so that the weights always sum up.
    Integrated, the source has given target * ((1 + slope) * t - slope * t * t) words at t; the inverse of that at
    the words a document's turn comes after is its position.

    A null text has size 0; sizes of 0 are taken floor(target / source_size) times, too, which costs nothing. A source
    of size 0 has target 0 and is not taken. A null source is a source. Rows that repeat are taken each; ties in the
    order are rows of equal id, size and text, which are alike. Rows without doc_id take part and are dealt over the
    order by their place in the table. Other columns are not read. An empty table gives an empty result.
    """
    return _placed(numbered(docs), weights, most, tilt)


def by_source(df: DataFrame, known: DataFrame) -> DataFrame:
    """df with what is known of its source: by broadcast if the sources are counted to be at most MAX_SOURCES."""
    known = known.withColumnRenamed("source", "s")
    return df.join(F.broadcast(known) if known.limit(MAX_SOURCES + 1).count() <= MAX_SOURCES else known, F.expr("source <=> s")).drop("s")


def _placed(sized: DataFrame, weights, most, tilt) -> DataFrame:
    """The rows of numbered() with their places in the mix; only narrow rows move."""
    sized = sized.select("n", "doc", "source", "size", "text_hash")
    sources = staged(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")), "sources")
    goal = targets(sources.select("source", "source_size"), weights, most).join(sources.select(F.col("source").alias("s"), "rows"), F.expr("source <=> s")).drop("s")
    every = Window.partitionBy()
    mean = F.log(F.col("source_size") / F.col("rows") + 1)
    share = F.col("target") / F.sum("target").over(every)
    goal = goal.withColumn("length", mean).withColumn("off", F.col("length") - F.sum(F.col("length") * share).over(every))
    slope = F.when(F.max(F.abs("off")).over(every) > 0, -tilt * F.col("off") / F.max(F.abs("off")).over(every)).otherwise(0.0)
    goal = staged(goal.withColumn("slope", slope).select("source", "source_size", "target", "slope", "rows"), "targets")

    key = F.xxhash64("doc", "size", "text_hash", F.when(F.col("doc").isNull(), F.col("n")))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rows") / BUCKET))
    own = by_source(sized, goal)
    own = own.withColumn("key", key).withColumn("bucket", F.floor((F.shiftrightunsigned("key", 1).cast("double") / 2.0**63) * parts))
    sums = own.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("before", before).select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before")
    own = own.join(sums, F.expr("source <=> s and bucket = b")).drop("s", "b")
    within = Window.partitionBy("source", "bucket").orderBy(F.shiftrightunsigned("key", 1), "doc", "size", "n").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("begin", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0)
    own = own.withColumn("full", full.cast("int"))
    rest = F.col("target") - F.col("full") * F.col("source_size")
    own = own.withColumn("rest", rest).withColumn("fits", F.col("begin") + F.col("size") <= F.col("rest"))
    # what the whole documents leave of the rest, in the bucket where it ends, goes to the one document nearest to it in size
    bucket = Window.partitionBy("source", "bucket")
    own = own.withColumn("gap", F.col("rest") - F.coalesce(F.max(F.when(F.col("fits"), F.col("begin") + F.col("size"))).over(bucket), F.col("before").cast("double")))
    last = (F.col("before") <= F.col("rest")) & (F.max(F.col("begin") + F.col("size")).over(bucket) > F.col("rest"))
    miss = F.when(last & ~F.col("fits") & (F.abs(F.col("size") - F.col("gap")) < F.col("gap")), F.abs(F.col("size") - F.col("gap")))
    own = own.withColumn("miss", miss)
    nearest = F.col("miss").isNotNull() & (F.row_number().over(bucket.orderBy(F.asc_nulls_last("miss"), "key", "n")) == 1)
    own = own.withColumn("copies", F.col("full") + ((F.col("size") > 0) & F.col("fits")).cast("int") + nearest.cast("int"))
    done = F.transform(
        F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.least(F.lit(1.0), F.when(F.col("target") > 0, (i * F.col("source_size") + F.col("begin")) / F.col("target")).otherwise(0.0)),
    )
    # ((1 + s) - sqrt((1 + s)^2 - 4 s y)) / (2 s), in a form that holds at s = 0
    at = lambda y: 2 * y / (1 + F.col("slope") + F.sqrt(F.greatest(F.lit(0.0), (1 + F.col("slope")) * (1 + F.col("slope")) - 4 * F.col("slope") * y)))
    return own.withColumn("positions", F.transform(done, at)).select("n", "doc", "source", "size", "source_size", "target", "copies", "positions", "key")


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0, tilt: float = TILT, parts: int | None = None) -> DataFrame:
    """The rows of docs as the mix takes them, each as often as it is taken, range-sorted by position in training.

    See mix() for the rules and for nulls, ties and empty tables. A row that is not taken is left out.
    """
    rows = numbered(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    places = _placed(rows, weights, most, tilt).where("copies > 0").select("n", "key", "positions")
    out = rows.select("n", "row").join(places, "n").withColumn("position", F.explode("positions"))
    out = out.repartitionByRange(*([parts] if parts else []), "position", "key", "n").sortWithinPartitions("position", "key", "n")
    return out.select("row.*")
