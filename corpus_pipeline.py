"""Raw documents to packed training sequences: five stages, each over everything that its predecessor kept.

What every stage does with odd rows: a row without doc_id is never rejected or dropped as a copy, because decisions are
taken by doc_id, and repeated rows of one doc_id share their fate. Null and empty texts are not toxic, have no lines,
are copies of nothing, have no words to mix and pack into one token. Ties are settled by the smaller doc_id. Empty tables
give empty tables. Columns other than COLUMNS do not pass.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import lines, minhash, mixing, packing, toxicity
from tidewell.llm.queries import tokenizer_path
from tidewell.llm.shared import staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Rows of an Arrow batch: ten times as many texts, Spark's default, lie in the executor's JVM, in its stream and in each worker at once.
ROWS = 1000


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with Arrow batches of ROWS rows. They are set in the session and stay, because the last jobs of a stage run when its result is written."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS)
        return stage(spark, docs, sf_dir)

    return run


def without(docs: DataFrame, ids: DataFrame, key: str, most: int = 1 << 20) -> DataFrame:
    """docs less the rows of these ids: by broadcast if they are counted to be at most `most`, else by a shuffle."""
    ids = staged(ids, "ids")
    docs = docs.select(*COLUMNS)
    return docs.join(F.broadcast(ids) if ids.limit(most + 1).count() <= most else ids, F.col("doc_id") == F.col(key), "left_anti")


@in_small_batches
def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject. A score depends on the text alone; of rows that share a doc_id all go if one is rejected."""
    judged = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    bad = judged.where("predicted = 1").select(F.col("doc_id").alias("__bad")).distinct()
    return without(docs, bad, "__bad")


@in_small_batches
def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines whose templates recur; those of which no word is left go."""
    out = lines.dedup_lines(docs).where("n_dropped = 0 or new_text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    text = F.col("new_text").alias("text")
    return out.select("row.doc_id", text, "row.lang", "row.source", F.length("new_text").cast("long").alias("n_chars"))


@in_small_batches
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each near-duplicate class on five-word shingles at a similarity of 0.8. A copy with one word in twenty changed is less similar than that."""
    gone = minhash.near_duplicates(docs, k=5, percent=80).where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return without(docs, gone, "__gone")


@in_small_batches
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of training."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048, in the order of training: the order of the files that mixing has written, however the reader deals them over tasks."""
    pieces = packing.pack(packing.file_streams(docs), tokenizer_path(), size=2048, end_id=1, stream="stream")
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_recurring_lines),
    ("near-duplicates", without_near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

#: The classifier and the sketches have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
