"""Secret scan: a random forest over the shape and surroundings of candidate words removes false findings.

Extraction, features, training and scoring run in Spark's JVM; nothing runs Python on executors.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import SPACE, staged

#: Labelled findings of either kind that train the forest at most (those of the smallest hashed text).
MAX_FINDINGS = 20_000
#: Words before or inside a candidate that announce a secret.
HINTS = "passw|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|auth(?!ors?(?![a-z])|ored|orit|enti)|credential|bearer|private[_-]?key"
#: Formats that label a finding as a secret, and those that label it as none.
#: What stands before a value that is assigned to a telling name, in its own word or the two before it; words that are no value.
NAMED = rf"(?i)({HINTS})[a-z0-9_.-]*[\"')\]}}]*\s?[=:]+>?\s?(?:(?:bearer|basic|token)\s)?[\"'(\[{{]*[^\s=:\"'(\[{{]\S*$"
PASSWORD = r"(?i)(passw|passphrase|pwd)[a-z_]*[\"']?\s?[=:]+\s?[\"']?(?=\S*[0-9])(?=\S*[a-z])\S{6,}$"
NO_VALUE = r"(?i)^(a|an|the|it|its|is|are|was|be|in|on|at|to|of|and|or|for|by|as|if|this|that|these|you|your|we|our|i|my|he|she|they|what|how|who|when|not|no|yes|none|null|nil|true|false|undefined|required|optional|string)$"
#: URLs with user info, and long random parts, either of which may be a secret.
USER_INFO = r"://[^\s/?#@]*:[^\s/?#@]+@"
RANDOM = r"(?<![A-Za-z0-9_+-])(?=[A-Za-z_+-]*[0-9])(?=[0-9_+-]*[A-Za-z])[A-Za-z0-9_+-]{16,}"
TRUE_FORMATS = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk_live_[0-9A-Za-z]{16,}$|^AIza[0-9A-Za-z_-]{35}$"
ASSIGNED = rf"(?i)({HINTS})[a-z_]*[\"']?\s*[=:]+\s*[\"']?[A-Za-z0-9+/_=-]{{12,}}[\"']?[.,;]?$"
FALSE_FORMATS = r"@|^[0-9 .,+()-]+$|^https?:|^www\.|[#$%&*|<>]{2,}|!!|^(.)\1+$"
FEATURES = ("length", "transitions", "digits", "uppers", "letters", "distinct", "coverage", "path", "before", "inside", "sentence")


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, word_no, word, value, previous, second, next): words of 12 characters or more with a digit, of a secret's format, or assigned to a telling name."""
    # every candidate holds a digit, a hint or the start of a format, so that no document with one is left out
    words = docs.where(F.col("text").rlike(rf"(?i)[0-9]|{HINTS}|AKIA|ASIA|gh[pousr]_|xox|sk_live_|AIza"))
    words = words.select(F.col("doc_id").cast("long").alias("doc_id"), F.filter(F.split("text", SPACE), lambda w: w != "").alias("w"))

    def wanted(w: Column, i: Column) -> Column:
        told = lambda: F.concat_ws(" ", F.get("w", i - 2), F.get("w", i - 1), w)
        near = lambda k: F.coalesce(F.get("w", i - k), F.lit("")).rlike("[=:]")
        return (F.length(w) >= 12) & (w.rlike("[0-9]") | stripped(w).rlike(TRUE_FORMATS)) | (w.rlike("[=:]") | near(1) | near(2)) & told().rlike(NAMED)

    at = F.filter(F.transform("w", lambda w, i: F.when(wanted(w, i), i)), lambda i: i.isNotNull())
    rows = words.select("doc_id", "w", F.explode(at).alias("word_no"))
    rows = rows.select("doc_id", "word_no", *(F.coalesce(F.get("w", F.col("word_no") + k), F.lit("")).alias(n) for n, k in (("second", -2), ("previous", -1), ("word", 0), ("next", 1))))
    value = stripped(F.col("word"))
    return rows.withColumn("value", F.when(F.length(value) > 0, value).otherwise(F.col("word")))


def stripped(word: Column) -> Column:
    """What a word assigns, or the word, without the marks around it."""
    return F.regexp_replace(F.regexp_replace(word, r"^.*?[=:]+(?=.)", ""), r"^[\"'(\[{]+|[\"')\]}.,;!?#$%&*|<>]+$", "")


def plain_word(word: Column) -> Column:
    """Whether a word as it stands is a URL, a host name with or without a path, or a word, date, version or number of short parts.

    Parts are split off and looked at one by one: a repeated group in one pattern would take a stack frame for each part.
    """
    w = F.lower(word)
    url = w.rlike(r"^[\"'(<\[]*(https?|ftp)://")
    host = F.split(F.rtrim(F.substring_index(F.ltrim(w, F.lit("\"'(<[")), "/", 1), F.lit(".,;:)]>\"'")), r"\.")
    named = (F.size(host) > 1) & F.forall(host, lambda p: p.rlike("^[a-z0-9-]+$")) & F.element_at(host, -1).rlike("^[a-z]{2,6}$")
    rest = F.regexp_replace(F.ltrim(F.rtrim(w, F.lit(".,;:!?)]\"'")), F.lit("\"'([")), "^[a-z-]*", "")
    parts = F.split(rest, "[.,:/_-]")
    short = F.element_at(parts, 1).rlike("^[0-9]{1,6}$") & F.forall(parts, lambda p: p.rlike("^[0-9a-z]{1,6}$"))
    return url | named | short


def share(part: Column) -> Column:
    return F.when(F.length("value") > 0, part / F.length("value")).otherwise(0.0)


def with_features(found: DataFrame, docs: DataFrame) -> DataFrame:
    """found with FEATURES; coverage is the share of a value's characters in runs of letters that are words of the corpus."""
    kind = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]", "\u0001"), "[A-Z]", "\u0002"), "[0-9]", "\u0003"), "[^\u0001-\u0003]", "\u0004")
    runs = F.length(F.regexp_replace(kind, "(.)\\1+", "$1"))
    without = lambda chars: F.length("value") - F.length(F.regexp_replace("value", chars, ""))
    before = F.concat_ws(" ", "second", "previous")
    found = (
        found.withColumn("length", F.length("value").cast("double")).withColumn("transitions", share(runs - 1)).withColumn("digits", share(without("[0-9]")))
        .withColumn("uppers", share(without("[A-Z]"))).withColumn("letters", share(without("[A-Za-z]")))
        .withColumn("distinct", share(F.size(F.array_distinct(F.split("value", "")))))
        .withColumn("path", (F.col("value").rlike(r"@|://|[a-z]\.[a-z]{2,}|(^|[^A-Za-z0-9+])/[a-z]")).cast("double"))
        .withColumn("before", F.lower(before).rlike(HINTS).cast("double")).withColumn("inside", F.lower("word").rlike(f"({HINTS})[a-z_]*[\"']?[=:]").cast("double"))
        .withColumn("sentence", F.col("next").rlike("^[a-z]").cast("double"))
    )
    parts = found.select("value", F.explode(F.regexp_extract_all("value", F.lit("([A-Za-z]{3,})"), F.lit(1))).alias("part")).distinct()
    parts = staged(parts.withColumn("part", F.lower("part")), "parts")
    plain = F.filter(F.split("text", SPACE), lambda w: w.rlike("^[A-Za-z]{3,}$"))
    known = docs.where("text is not null").select(F.explode(plain).alias("part")).select(F.lower("part").alias("part"))
    # counted before it meets the parts: an inner join, unlike a semi-join, is not moved below the count
    known = known.groupBy("part").agg(F.count("*").alias("c")).where("c >= 3").select("part")
    covered = parts.join(known, "part").groupBy("value").agg(F.sum(F.length("part")).alias("covered"))
    return found.join(covered, "value", "left").withColumn("coverage", share(F.least(F.coalesce("covered", F.lit(0)), F.length("value")))).drop("covered")


def seed_findings(found: DataFrame) -> DataFrame:
    """Findings that their format labels beyond doubt: label 1.0 for secrets, 0.0 for others; the rest has none, as have URLs that may hold a secret."""
    told = F.concat_ws(" ", F.regexp_replace(F.concat_ws(" ", "second", "previous"), r"^.* (?=\S+ \S+$)", ""), "word")
    value = F.col("value")
    yes = value.rlike(TRUE_FORMATS) | told.rlike(ASSIGNED) & ~value.rlike("^[A-Za-z]+$") | told.rlike(PASSWORD) & ~F.col("path").cast("boolean")
    open_ = F.col("word").rlike(USER_INFO) | F.col("path").cast("boolean") & value.rlike(RANDOM) | told.rlike(NAMED) & ~value.rlike(NO_VALUE)
    no = value.rlike(FALSE_FORMATS) | value.rlike(NO_VALUE) | plain_word(F.col("word"))
    return found.withColumn("label", F.when(yes, 1.0).when(no & ~open_, 0.0))


def scan(docs: DataFrame, findings: DataFrame | None = None, least: float = 0.5, seed: int = 7) -> DataFrame:
    """One row for each candidate: doc_id, word_no, value, probability, is_secret (probability >= least).

    findings: labelled candidates with FEATURES and label, by default those that seed_findings() labels in docs. Of
    either label at most MAX_FINDINGS, those of the smallest hashed value, train the forest; every candidate is scored.

    A null or empty text has no candidates. Repeated rows and rows without doc_id are scanned each; a word of any
    length is one candidate. Without findings of both labels the labels alone decide: probability 1 or 0, 0.5 without.
    Extra columns are not read. An empty table gives an empty result.
    """
    found = staged(with_features(staged(candidates(docs), "candidates"), docs), "found")
    told = seed_findings(found)
    given = (findings if findings is not None else told).where("label is not null")
    train = None
    for y in (1.0, 0.0):
        part = given.where(F.col("label") == y).select(*FEATURES, "label", F.xxhash64("value").alias("h")).orderBy("h", *FEATURES).limit(MAX_FINDINGS)
        train = part if train is None else train.unionByName(part)
    train = staged(train.coalesce(1), "train")
    if train.select("label").distinct().count() < 2:
        told = told.withColumn("probability", F.coalesce("label", F.lit(0.5)))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
        forest = RandomForestClassifier(featuresCol="vector", labelCol="label", probabilityCol="p", numTrees=20, maxDepth=6, seed=seed)
        model = forest.fit(vectors.transform(train))
        told = model.transform(vectors.transform(told)).withColumn("probability", F.round(vector_to_array("p")[1], 6))
    return told.select("doc_id", "word_no", "value", "probability", (F.col("probability") >= least).alias("is_secret"))
