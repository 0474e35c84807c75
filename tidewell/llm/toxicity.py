"""Toxicity by weak supervision (Ratner et al., "Data Programming", 2016; "Snorkel", 2017).

Voters are lexicons of words and word beginnings, beginnings that crowd a text, seed words and patterns. Labels serve to
mine the lexicons and, as known classes in the expectation maximisation of a generative model over the vote vectors of
all documents, to estimate how accurate and how dependent the voters are. The linear classifier never sees a label: it
learns from the model's posteriors of labelled and unlabelled rows alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_rows, discard, staged
from .wordhash import Hasher, chunks, mix, spans

#: Labelled rows that are read at most, and unlabelled ones that train the classifier beside them (those of the smallest hashed doc_id).
MAX_LABELLED, MAX_UNLABELLED = 20_000, 20_000
#: Rows of an Arrow batch: a batch of whole texts lies in the executor's JVM, in its stream and in the worker at once.
ROWS = 1000
#: Word beginnings of so many bytes are features beside whole words (0).
KINDS = (0, 4, 5, 6, 7, 8)
#: A beginning crowds a text if two distinct words or more have it and they make up such a share of its words.
CROWDS = (0.005, 0.015)
#: What a feature must reach to be taken: rows of the positive class, for a crowding beginning and for others; their share; standard errors above chance.
LEAST, SHARE, ERRORS = (2, 3), 0.6, 3.0
#: English insults that make up the seed lexicon, and patterns of abuse.
SEED_WORDS = "idiot moron imbecile scum trash loser stupid pathetic worthless disgusting clown filth vermin dumb".split()
PATTERNS = (r"(?i)\b(you|they) (all )?(are|'re) (all |just |such |so )?(an? )?(idiot|moron|scum|trash|filth|vermin|loser|clown)", r"(?i)\b(kill yourself|drop dead|go to hell|shut (the \w+ )?up)\b")
_SALT = {k: np.uint64(0x51ED270B0A1F39C1 * (k + 1) & (1 << 64) - 1) for k in KINDS}
_CROWD = [np.uint64(0xA24BAED4963EE407 * (i + 1) & (1 << 64) - 1) for i in range(len(CROWDS))]
#: Kinds of features as voters tell them apart: words, beginnings, and beginnings that crowd a text by either share.
WORD, BEGINNING, CROWD = 0, 1, 2
COUNTED = "feature long, base long, kind byte, pos double, n double"


def lowered(b: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with A-Z and the capital letters U+00C0 to U+00DE in lower case."""
    out = np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)
    late = np.zeros(len(b), bool)
    late[1:] = b[:-1] == 0xC3
    return np.where(late & (b >= 0x80) & (b <= 0x9E) & (b != 0x97), b + np.uint8(32), out)


class Wanted:
    """A sorted set of hashes with a table that rules most others out."""

    def __init__(self, hashes: np.ndarray):
        self.sorted = np.unique(hashes)
        self.may = np.zeros(1 << 20, bool)
        self.may[(self.sorted >> np.uint64(44)).astype(np.int64)] = True

    def among(self, h: np.ndarray) -> np.ndarray:
        """Places in h of hashes of the set."""
        at = np.flatnonzero(self.may[(h >> np.uint64(44)).astype(np.int64)])
        return at[np.isin(h[at], self.sorted)]


def features(b: np.ndarray, off: np.ndarray, bases: Wanted | None = None) -> tuple[np.ndarray, ...]:
    """(document, feature, base, kind) of a run of texts, each pair of document and feature once.

    Words are runs of letters, digits and bytes beyond ASCII. base is the hash of the word or beginning itself; with
    `bases`, only features of those are returned.
    """
    b = lowered(b)
    letter = ((b >= 97) & (b <= 122)) | ((b >= 48) & (b <= 57)) | (b >= 128)
    start, end = spans(b, off, ~letter)
    doc, hasher = np.searchsorted(off, start, "right") - 1, Hasher(b)
    word, n = hasher(start, end), np.bincount(doc, minlength=len(off) - 1)
    out = []
    for k in KINDS:
        own = np.flatnonzero(end - start > k)
        h = (hasher(start[own], start[own] + k) if k else word) ^ _SALT[k]
        if bases is not None:
            at = bases.among(h)
            own, h = own[at], h[at]
        d, w = doc[own], word[own]
        order = np.lexsort((w, h, d))
        d, h, w = d[order], h[order], w[order]
        first = np.ones(len(d), bool)
        first[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
        at = np.flatnonzero(first)
        d1, h1 = d[at], h[at]
        out.append((d1, h1, h1, np.full(len(at), BEGINNING if k else WORD, np.int8)))
        if k and len(at):
            new = first.copy()
            new[1:] |= w[1:] != w[:-1]
            distinct, tokens = np.add.reduceat(new.astype(np.int64), at), np.diff(np.append(at, len(d)))
            for i, share in enumerate(CROWDS):
                crowd = np.flatnonzero((distinct > 1) & (tokens >= share * n[d1]))
                out.append((d1[crowd], mix(h1[crowd] ^ _CROWD[i]), h1[crowd], np.full(len(crowd), CROWD + i, np.int8)))
    return tuple(np.concatenate([x[i] for x in out]) for i in range(4))


def word_feature(word: str) -> int:
    b = np.frombuffer(word.encode(), np.uint8)
    return int(features(b, np.array([0, len(b)]))[1][0])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (text, weight of the positive class): each feature's rows and their weight."""
    for batch in batches:
        y = batch.column(1).to_numpy(zero_copy_only=False)
        for i, j, b, off in chunks(batch.column(0)):
            d, f, base, kind = features(b, off)
            f, first, inv = np.unique(f, return_index=True, return_inverse=True)
            pos, n = np.bincount(inv, y[i:j][d], len(f)), np.bincount(inv, minlength=len(f)).astype(float)
            yield pa.RecordBatch.from_arrays([pa.array(f.view(np.int64)), pa.array(base[first].view(np.int64)), pa.array(kind[first]), pa.array(pos), pa.array(n)], ["feature", "base", "kind", "pos", "n"])


def select_features(rows: DataFrame, weight: str) -> pd.DataFrame:
    """(feature, base, kind, pos, n), by feature, of those that rows of the positive class hold more often than chance has it; weight: the column of that class."""
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(weight), F.lit(0)).cast("double").alias("pos")).first()
    if not total.pos or total.pos >= total.n:
        return pd.DataFrame({"feature": np.zeros(0, np.uint64), "base": np.zeros(0, np.uint64), "kind": np.zeros(0, np.int8), "pos": [], "n": []})
    rate = total.pos / total.n
    z = (F.col("pos") - rate * F.col("n")) / F.sqrt(rate * (1 - rate) * F.col("n"))
    least = F.when(F.col("kind") >= CROWD, LEAST[0]).otherwise(LEAST[1])
    counted = rows.select("text", F.col(weight).cast("double")).mapInArrow(_counts, COUNTED).groupBy("feature")
    counted = counted.agg(F.first("base").alias("base"), F.first("kind").alias("kind"), F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    found = counted.where((F.col("pos") >= least - 0.1) & (F.col("pos") >= SHARE * F.col("n")) & (z >= ERRORS)).toPandas()  # of a bounded sample
    found = found.assign(feature=found["feature"].to_numpy(np.int64).view(np.uint64), base=found["base"].to_numpy(np.int64).view(np.uint64))
    return found.sort_values("feature").reset_index(drop=True)


class Finder:
    """Which features of a fixed set the texts of a run have, as places in the set."""

    def __init__(self, chosen: pd.DataFrame):
        self.known = chosen["feature"].to_numpy(np.uint64)
        self.bases = Wanted(chosen["base"].to_numpy(np.uint64))

    def __call__(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, place) pairs, by row."""
        rows, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, _, b, off in chunks(col):
            d, f, _, _ = features(b, off, self.bases)
            at = np.searchsorted(self.known, f)
            at[at == len(self.known)] = 0
            ok = np.flatnonzero(self.known[at] == f) if len(self.known) else np.zeros(0, np.int64)
            ok = ok[np.argsort(d[ok], kind="stable")]
            rows.append(d[ok] + i), places.append(at[ok])
        return np.concatenate(rows), np.concatenate(places)


class Voters:
    """Votes of texts: 1 toxic, -1 not, 0 none."""

    def __init__(self, chosen: pd.DataFrame):
        seeds = np.array([word_feature(w) for w in SEED_WORDS], np.uint64)
        kind, rate, pos = chosen["kind"].to_numpy(), (chosen["pos"] / chosen["n"]).to_numpy(float), chosen["pos"].to_numpy(float)
        mine = chosen["feature"].to_numpy(np.uint64)
        # lexicons: the surer features of a kind, which vote for toxic only, and all of them
        lexicons = [(mine[(kind == k) & ok], both) for k in (WORD, BEGINNING, CROWD, CROWD + 1) for ok, both in (((rate >= 0.95) & (pos >= 5), False), (rate >= 0, True))]
        every = pd.DataFrame({"feature": np.concatenate([mine, seeds]), "base": np.concatenate([chosen["base"].to_numpy(np.uint64), seeds])}).drop_duplicates("feature").sort_values("feature")
        self.find = Finder(every.reset_index(drop=True))
        self.lexicons = [(np.isin(self.find.known, x), both) for x, both in lexicons]
        self.seeds = np.isin(self.find.known, seeds)
        self.n = len(self.lexicons) + 2 + len(PATTERNS)

    def __call__(self, texts: pa.Array, patterns: list[np.ndarray]) -> np.ndarray:
        row, place = self.find(texts)
        votes = np.zeros((len(texts), self.n), np.int8)
        for v, (lexicon, both) in enumerate(self.lexicons):
            votes[:, v] = np.where(np.bincount(row[lexicon[place]], minlength=len(texts)) > 0, 1, -1 if both else 0)
        seeded = np.bincount(row[self.seeds[place]], minlength=len(texts))
        votes[:, len(self.lexicons)], votes[:, len(self.lexicons) + 1] = seeded > 0, seeded > 1
        for k, hit in enumerate(patterns):
            votes[:, self.n - len(PATTERNS) + k] = hit
        return votes


def with_patterns(rows: DataFrame, *columns: str) -> DataFrame:
    """text, whether each pattern is in it, and columns."""
    return rows.select("text", *(F.coalesce(F.col("text").rlike(p), F.lit(False)).cast("int").alias(f"pattern_{i}") for i, p in enumerate(PATTERNS)), *columns)


def _votes(batch: pa.RecordBatch, voters: Voters) -> np.ndarray:
    return voters(batch.column(0), [batch.column(1 + i).to_numpy() for i in range(len(PATTERNS))])


def vote_counts(docs: DataFrame, voters: Voters, label: str) -> pd.DataFrame:
    """(votes, label, n) over all rows of docs; label -1 where unknown. A handful of lexicons votes alike on most texts, so that these are few."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = np.concatenate([_votes(batch, voters), batch.column(1 + len(PATTERNS)).to_numpy().astype(np.int8)[:, None]], axis=1)
                v, n = np.unique(v, axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in v], pa.binary()), pa.array(n, pa.int64())], ["votes", "n"])

    rows = with_patterns(docs, F.coalesce(F.col(label).cast("int"), F.lit(-1)).alias("label"))
    return rows.mapInArrow(count, "votes binary, n long").groupBy("votes").agg(F.sum("n").alias("n")).orderBy("votes").toPandas()


class LabelModel:
    """Two classes and voters that each say -1, 0 or 1 with a probability of the class; voters that go together within a class share their weight."""

    def __init__(self, votes: np.ndarray, label: np.ndarray, counts: np.ndarray, rounds: int = 25):
        """EM over vote vectors and their counts; rows with a label keep their class, and the others weigh no more than they do in all."""
        known, open_ = counts * (label >= 0), counts * (label < 0)
        weight = known + open_ * (min(1.0, known.sum() / max(open_.sum(), 1e-9)) if known.sum() else 1.0)
        post = np.where(label >= 0, label, np.where((votes > 0).sum(1) >= 2, 0.95, 0.02)).astype(float)
        for _ in range(rounds):
            w1, w0 = weight * post, weight * (1 - post)
            self.prior = float(np.log((w1.sum() + 1) / (w0.sum() + 1)))
            odds = np.stack([np.log((w1 @ (votes == v) + 0.5) / (w1.sum() + 1.5)) - np.log((w0 @ (votes == v) + 0.5) / (w0.sum() + 1.5)) for v in (-1, 0, 1)])
            # residual correlations within the classes
            mean = [(w[:, None] * votes).sum(0) / max(w.sum(), 1e-9) for w in (w0, w1)]
            cov = sum(((votes - m) * w[:, None]).T @ (votes - m) for w, m in ((w0, mean[0]), (w1, mean[1]))) / max(weight.sum(), 1e-9)
            sd = np.sqrt(np.diag(cov)) + 1e-6
            self.odds = odds / np.clip(cov / sd[:, None] / sd[None, :] + 1e-6, 0, 1).sum(1).clip(1)[None, :]
            post = np.where(label >= 0, label, self.posterior(votes))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of the toxic class from the votes alone."""
        logit = self.prior + sum(self.odds[v + 1][None, :] * (votes == v) for v in (-1, 0, 1)).sum(1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_linear(rows: np.ndarray, cols: np.ndarray, target: np.ndarray, n: int, l2: float = 0.3, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic regression on pairs (row, feature), by accelerated gradient descent."""
    size = np.bincount(rows, minlength=len(target)) + 1
    rate = 4 / np.sqrt(size.mean() * size.max())
    mean = target.mean().clip(1e-6, 1 - 1e-6)
    w, b = np.zeros(n), float(np.log(mean / (1 - mean)))
    vw, vb, m = np.zeros(n), 0.0, 0.9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(b + m * vb + np.bincount(rows, (w + m * vw)[cols], minlength=len(target)), -30, 30)))
        g = p - target
        vw = m * vw - rate * (np.bincount(cols, g[rows], minlength=n) / len(target) + l2 / len(target) * (w + m * vw))
        vb = m * vb - rate * g.mean()
        w, b = w + vw, b + vb
    return w, float(b)


def training_rows(labels: DataFrame, held_out) -> DataFrame:
    """(doc_id, toxic) of at most MAX_LABELLED rows that are not held out."""
    return (
        labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .where(~held_out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    )


def sampled(docs: DataFrame, labels: DataFrame, held_out) -> DataFrame:
    """(doc_id, text, toxic): the rows of training_rows, and the MAX_UNLABELLED other documents of the smallest hashed doc_id, toxic null."""
    told = staged(training_rows(labels, held_out), "told")
    other = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out).select("doc_id").join(F.broadcast(told), "doc_id", "left_anti").distinct()
    other = other.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_UNLABELLED).withColumn("toxic", F.lit(None).cast("int"))
    chosen = staged(told.unionByName(other), "chosen")
    return staged(docs.where("text is not null").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"), "sample")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, modulus: int = 4, held: int = 2) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted.

    Labels (labels.toxic) are read of rows whose crc32(doc_id as text) modulo `modulus` is not `held`; held_out marks the
    others, whose texts train nothing either. The vote vectors of all documents that are not held out fit the label
    model; features and classifier come from a bounded sample (MAX_LABELLED, MAX_UNLABELLED) and its posteriors.
    The score depends on the whole text alone: equal texts, equal scores. predicted is 1 if score >= threshold.
    A null or empty text gets the score of a text without any feature. A row without doc_id is scored and not held out.
    Repeated rows are scored each; repeated labels of one doc_id count once, as toxic if one says so. Null labels are
    left out. Without labels, or with labels of one class only, every score is 0. An empty table gives an empty result.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == held, F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with arrow_rows(docs.sparkSession, ROWS):
        rows = sampled(docs, labels, held_out)
        mined = select_features(rows.where("toxic is not null"), "toxic")
        if not len(mined):
            return docs.select("doc_id", held_out.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
        voters = Voters(mined)
        told = rows.where("toxic is not null").select("text", "toxic")
        rest = docs.where(~held_out & F.col("text").isNotNull()).select("text", F.lit(None).cast("int").alias("toxic"))
        seen = pd.concat([vote_counts(told, voters, "toxic"), vote_counts(rest, voters, "toxic")])
        votes = np.stack([np.frombuffer(v, np.int8) for v in seen["votes"]])
        model = LabelModel(votes[:, :-1].astype(float), votes[:, -1], seen["n"].to_numpy(float))

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = model.posterior(_votes(batch, voters).astype(float))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], ["text", "posterior"])

        judged = staged(with_patterns(rows).mapInArrow(judge, "text string, posterior double"), "judged")
        chosen = select_features(judged, "posterior")
        if not len(chosen):
            chosen = mined
        find = Finder(chosen)

        def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, place = find(batch.column(0))
                at = np.searchsorted(row, np.arange(batch.num_rows + 1))
                yield pa.RecordBatch.from_arrays([pa.array([place[at[i] : at[i + 1]].astype(np.int32).tobytes() for i in range(batch.num_rows)], pa.binary()), batch.column(1)], ["hits", "posterior"])

        train = judged.mapInArrow(hits, "hits binary, posterior double").toPandas()  # a bounded sample
        ids = [np.frombuffer(h, np.int32) for h in train["hits"]]
        w, b = fit_linear(np.repeat(np.arange(len(ids)), [len(x) for x in ids]), np.concatenate(ids).astype(np.int64), train["posterior"].to_numpy(), len(chosen))
        discard(rows, judged)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, place = find(batch.column(1))
            s = b + np.bincount(row, w[place], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(s, -30, 30))))], ["doc_id", "score"])

    scored = docs.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def crc32_text(doc_id: int) -> int:
    """What held_out is computed from, for tests."""
    return zlib.crc32(str(doc_id).encode())
