"""Quality rules: counts over whole texts, and a log-likelihood ratio between a trusted and a raw model of hashed n-grams.

Everything here is a DataFrame expression; nothing runs Python on executors.
"""

from __future__ import annotations

import json
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE

#: Buckets of the hashed multinomials; smoothing count of a bucket.
BUCKETS, SMOOTH = 1 << 16, 1.0
#: Tokens: runs of ASCII signs, and runs of anything else but white space.
TOKEN = r"[!-/:-@\[-`{-~]+|[^\x20\x09-\x0D!-/:-@\[-`{-~]+"
#: A document whose mean log-likelihood ratio per n-gram lies below is not kept: text like the trusted one is near 0, and
#: junk, whose signs and repeats the raw corpus has e times as often as the trusted documents or more, near -1 and below.
THRESHOLD = -0.5
#: Labelled good documents up to which their ids are broadcast; more are shuffled to their documents.
MAX_BROADCAST = 1 << 18


def words(c: str) -> Column:
    """Words of a text, runs of characters other than 0x20 and 0x09 to 0x0D, in order; empty for null."""
    return F.filter(F.split(F.coalesce(F.col(c), F.lit("")), SPACE), lambda w: w != "")


def with_counts(df: DataFrame) -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of its column text."""
    t = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("words", words("text")).withColumn("lines", lines)
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    w = F.col("hashes")
    window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    df = df.withColumn("n_words", F.size("words").cast("long"))
    df = df.withColumn("triples", F.when(F.col("n_words") > 2, F.transform(F.sequence(F.lit(0), F.size("words") - 3), window)).otherwise(F.array().cast("array<long>")))
    again = F.size("triples") - F.size(F.array_distinct("triples"))
    # places of the windows that occur again: sorted by hash, equal neighbours
    placed = F.sort_array(F.transform("triples", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = df.withColumn("sorted", F.when(again > 0, placed))
    s = F.col("sorted")
    same = lambda a, b: F.coalesce(F.get(s, a)["h"] == F.get(s, b)["h"], F.lit(False))
    twice = F.filter(s, lambda x, i: F.when(i > 0, same(i, i - 1)).otherwise(F.lit(False)) | same(i, i + 1))
    at = F.sort_array(F.transform(twice, lambda x: x["i"]))
    # words under the windows: three each, less what the next one covers too
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(at, start, lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).cast("long").alias("n")), lambda a: a["n"])
    return df.select(
        *(c for c in df.columns if c not in ("words", "lines", "hashes", "triples", "sorted")),
        F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("sorted").isNotNull(), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def tokens(c: str) -> Column:
    """Words and runs of signs (see TOKEN) in order, the whole of a text but its white space; empty for null."""
    return F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit(TOKEN), F.lit(0))


def place(h: Column, buckets: int) -> Column:
    return h.bitwiseAND(F.lit(buckets - 1)).cast("int")


def neighbours(hashes: Column, f) -> Column:
    """f of each pair of neighbouring hashes."""
    n = F.greatest(F.size(hashes) - 1, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(2), n), lambda a, b: f(F.xxhash64(a, b)))


def gram_buckets(hashes: Column, buckets: int) -> Column:
    """The buckets of all n-grams of a text, from the hashes of its tokens: one for each token, then one for each pair of neighbours. buckets: a power of two."""
    return F.concat(F.transform(hashes, lambda h: place(h, buckets)), neighbours(hashes, lambda h: place(h, buckets)))


def log_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """log(trusted / raw) of each bucket's share, smoothed: raw counts the n-grams of all documents, trusted those of labelled good ones."""
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("id")).distinct()
    few = good.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST
    good = good.withColumn("good", F.lit(1))
    good = F.broadcast(good) if few else good.hint("merge")
    marked = docs.select(F.col("doc_id").cast("long").alias("doc"), "text").join(good, F.col("doc") == F.col("id"), "left")
    marked = marked.select("good", F.transform(tokens("text"), lambda w: F.xxhash64(w)).alias("hashes"))
    counts = marked.select("good", F.explode(gram_buckets(F.col("hashes"), buckets)).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("raw"), F.count("good").alias("good"))
    raw, trusted = [0] * buckets, [0] * buckets
    for r in counts.collect():  # one row a bucket
        raw[r.bucket], trusted[r.bucket] = r.raw, r.good
    n, m = sum(raw) + SMOOTH * buckets, sum(trusted) + SMOOTH * buckets
    return [round(log((g + SMOOTH) / m) - log((r + SMOOTH) / n), 5) for g, r in zip(trusted, raw, strict=True)]


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score.

    word_chars: code points in words; n_symbols: characters of #*$%&|<>; n_dup_lines: lines with a word that equal an
    earlier line of the text; n_repeat_words: words in 3-word windows that the text holds twice or more.
    base_failed: n_words < 50 or 100 * n_repeat_words > 50 * n_words. score: mean over all tokens
    and pairs of neighbouring tokens of log(trusted share / raw share) of their hash bucket, null without tokens. kept: not base_failed and
    score >= threshold.

    A null or empty text has no words and fails. Rows that share a doc_id, and rows without, are judged each. Labels
    that are null or repeated count once or not at all. Without any good label the trusted share is even, all the same
    deterministic. Extra columns are not read. An empty table gives an empty result.
    """
    ratios = F.from_json(F.lit(json.dumps(log_ratios(docs, labels, buckets))), "array<double>")
    counted = with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    counted = counted.withColumn("tokens", F.transform(tokens("text"), lambda w: F.xxhash64(w)))
    ratio = lambda h: F.get(ratios, place(h, buckets))
    each = F.aggregate("tokens", F.lit(0.0), lambda a, h: a + ratio(h))
    pairs = F.aggregate(neighbours(F.col("tokens"), ratio), F.lit(0.0), lambda a, x: a + x)
    out = counted.withColumn("score", F.when(F.size("tokens") > 0, F.round((each + pairs) / (2 * F.size("tokens") - 1), 6)))
    out = out.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"))
    out = out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(0.0)) >= threshold))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
