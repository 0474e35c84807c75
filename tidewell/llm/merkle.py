"""A hash tree over all rows, source by source, with the proof of every leaf by pointer jumping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, numbered, staged

#: Nodes under one parent.
FAN = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_hash(*fields: Column) -> Column:
    """sha256 of the fields, each as its UTF-8 length, a colon and its value, or `-` if null."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in text)), 256)


def parents(nodes: DataFrame) -> DataFrame:
    """One level up: nodes(tree, idx, n, digest), of which FAN at most share a parent, as (tree, idx, n, kids, digest); kids are the digests from left to right."""
    kids = F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"])
    up = nodes.groupBy("tree", F.floor(F.col("idx") / FAN).alias("up")).agg(F.ceil(F.first("n") / FAN).alias("n"), kids.alias("kids"))
    return up.select("tree", F.col("up").alias("idx"), "n", "kids", F.sha2(F.array_join("kids", ""), 256).alias("digest"))


def siblings(parent: Column, place: Column) -> Column:
    """One step of a proof: the place in the run, and the other digests of the run as one text."""
    others = F.array_join(F.filter(parent, lambda _, i: i != place), "")
    return F.struct(place.cast("int").alias("place"), others.alias("others"))


def grown(first: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """All inner nodes (tree, level, idx, kids) above first(tree, idx, n, digest), and the roots (tree, digest).

    Level by level, each a grouping of at most FAN digests, until no tree has two nodes; trees of fewer rows end sooner.
    """
    nodes, levels, most = first, [], first.agg(F.max("n").alias("n")).first().n or 0
    roots, level = first.where("n = 1").select("tree", "digest"), 0
    inner = first.sparkSession.createDataFrame([], "tree string, level int, idx long, kids array<string>").withColumn("tree", F.col("tree").cast(first.schema["tree"].dataType))
    while most > 1:
        level, most = level + 1, -(-most // FAN)
        nodes = staged(parents(nodes.where("n > 1")), label)
        roots = roots.unionByName(nodes.where("n = 1").select("tree", "digest"))
        inner = inner.unionByName(nodes.select("tree", F.lit(level).alias("level"), "idx", "kids"))
    return inner, roots


def jumped(inner: DataFrame, label: str) -> DataFrame:
    """(tree, level, idx, path) of each inner node: the steps from it to its tree's root.

    Every node begins with the step to its parent. Joined with itself, a node takes over its ancestor's ancestor and
    appends the ancestor's steps to its own, so that the distance doubles each time; a root has no ancestor and no step.
    """
    above = inner.select(F.col("tree").alias("t"), F.col("level").alias("l"), F.col("idx").alias("i"), "kids")
    up = [F.col("tree").eqNullSafe(F.col("t")), F.col("level") + 1 == F.col("l"), F.floor(F.col("idx") / FAN) == F.col("i")]
    none = F.array().cast("array<struct<place:int,others:string>>")
    step = F.when(F.col("l").isNotNull(), F.array(siblings(F.col("kids"), F.col("idx") % FAN))).otherwise(none)
    now = staged(inner.drop("kids").join(above, up, "left").select("tree", "level", "idx", F.col("l").alias("to_level"), F.col("i").alias("to_idx"), step.alias("path")), label)
    while now.where("to_level is not null").limit(1).count():
        far = now.select(F.col("tree").alias("t"), F.col("level").alias("l"), F.col("idx").alias("i"), F.col("to_level").alias("al"), F.col("to_idx").alias("ai"), F.col("path").alias("rest"))
        on = [F.col("tree").eqNullSafe(F.col("t")), F.col("to_level") == F.col("l"), F.col("to_idx") == F.col("i")]
        new = staged(now.join(far, on, "left").select("tree", "level", "idx", F.col("al").alias("to_level"), F.col("ai").alias("to_idx"), F.concat("path", F.coalesce("rest", none)).alias("path")), label)
        discard(now)
        now = new
    return now.drop("to_level", "to_idx")


def proved(first: DataFrame, inner: DataFrame, label: str) -> DataFrame:
    """first(tree, idx, digest, ...) with path, the steps to its tree's root: none for a tree of one row.

    A parent's row brings its run's digests and its own path once to at most FAN children.
    """
    paths = jumped(inner, label).where("level = 1").select(F.col("tree").alias("t1"), F.col("idx").alias("i1"), "path")
    runs = inner.where("level = 1").select("tree", "idx", "kids").join(paths, F.col("tree").eqNullSafe(F.col("t1")) & (F.col("idx") == F.col("i1")))
    runs = runs.select(F.col("tree").alias("t"), F.col("idx").alias("i"), "kids", F.col("path").alias("up_path"))
    rows = first.join(runs, F.col("tree").eqNullSafe(F.col("t")) & (F.floor(F.col("idx") / FAN) == F.col("i")), "left")
    own = F.concat(F.array(siblings(F.col("kids"), F.col("idx") % FAN)), F.col("up_path"))
    none = F.array().cast("array<struct<place:int,others:string>>")
    return rows.withColumn("path", F.when(F.col("kids").isNotNull(), own).otherwise(none)).drop("t", "i", "kids", "up_path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(F.substring(s["others"], F.lit(1), s["place"] * 64), acc, F.substring(s["others"], s["place"] * 64 + 1, F.octet_length(s["others"]))), 256))


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): every row's place in a hash tree over all rows, and whether its tampered form is told apart.

    One tree a source, leaves by doc_id (null first; rows of one doc_id by their hash), 16 nodes a run, the last run
    fewer; over the sources' roots, by source (null first, bytewise), a tree of the same kind. A source of one row is its
    own subroot, a single source's subroot is the root. Repeated rows are leaves each. A row whose doc_id is null is never
    tampered with; of the others those whose crc32 is divisible by 5, in whose text A-Z become lower case. Columns other
    than doc_id, source, lang, n_chars and text are not read. An empty table gives an empty result.

    Texts are hashed where they are read; only digests move. Places come from a range partition and counts per partition,
    so a source that holds most rows is spread over all tasks. Paths are joined level by level for inner nodes, a
    fifteenth of the rows, and reach the leaves one run at a time.
    """
    spark = docs.sparkSession
    other = [F.col("source"), F.col("lang"), F.col("n_chars")]
    touched = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    low = F.when(touched, leaf_hash(F.col("doc_id"), *other, F.translate("text", UPPER, LOWER)))
    rows = docs.select(F.col("doc_id"), F.col("source").alias("tree"), leaf_hash(F.col("doc_id"), *other, F.col("text")).alias("digest"), low.alias("changed"))
    rows = staged(rows, "hashed")  # the range partition samples its input: texts are read before that, once
    leaves = numbered(rows, "tree", ["doc_id", "digest"], "leaves")
    inner, subroots = grown(leaves.select("tree", "idx", "n", "digest"), "nodes")
    tops = numbered(subroots.select(F.col("tree").alias("source"), "digest", F.lit("all").alias("tree")), "tree", ["source"], "sources")
    over, root = grown(tops.select("tree", "idx", "n", "digest"), "roots")
    tops = proved(tops, over, "tops").select(F.col("source").alias("s"), F.col("digest").alias("subroot"), F.col("path").alias("top_path"))
    top = root.first()
    if top is None:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    out = proved(leaves, inner, "paths").join(tops, F.col("tree").eqNullSafe(F.col("s"))).withColumn("path", F.concat("path", "top_path"))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: s["others"]), ""), 256)
    out = out.withColumn("folded_root", folded(F.coalesce("changed", "digest"), F.col("path")))
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(top.digest).alias("root"), proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == top.digest).alias("verified"))
