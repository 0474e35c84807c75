"""Near-duplicate classes of documents by SetSketch registers (Ertl, "SetSketch: Filling the Gap between MinHash and HyperLogLog", 2021).

A register holds the exponentially spaced, truncated minimum of a hash over a document's shingles:
floor(1 - log_B(minimum)), where the minimum is exponentially distributed. Equal shingle sets have equal registers,
the registers of a union are the larger ones of each place, and two registers agree about as often as the sets
are similar. Bands of registers are the buckets in which candidates meet; the likelihood of smaller, equal and larger
registers given both set sizes screens candidates, and the full sets settle each link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_rows, connected_components, discard, semi_join, staged
from .wordhash import M3, mix, shingle_sets

BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
#: Spacing of the registers; close to 1, so that registers of unrelated sets hardly ever agree.
B = 1.001
OFFSET, TOP = 2400, 65535
_RNG = np.random.default_rng(20240607)
_MUL = _RNG.integers(0, 1 << 32, REGISTERS, np.uint32) | np.uint32(1)
_XOR = _RNG.integers(0, 1 << 32, REGISTERS, np.uint32)


def registers(shingles: np.ndarray, mul: np.ndarray = _MUL, xor: np.ndarray = _XOR) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes."""
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    low = np.full(len(mul), 0xFFFFFFFF, np.uint32)
    step = (1 << 19) // len(mul)
    for i in range(0, len(x), step):
        np.minimum(low, ((x[None, i : i + step] ^ xor[:, None]) * mul[:, None]).min(axis=1), out=low)
    e = -np.log1p(-(low + 0.5) / 2**32)
    return np.clip(np.floor(1 - np.log(e) / np.log(B)) + OFFSET, 0, TOP).astype(np.uint16)


def joint_estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sets from rows of registers and the set sizes, on a grid of 1/100."""
    more, less = (ra > rb).sum(1), (ra < rb).sum(1)
    same = ra.shape[1] - more - less
    u = (na / (na + nb))[:, None]
    v = 1 - u
    grid = np.arange(0, 101)[None, :] / 100
    p = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (B - 1) / B) / np.log(B)
    pa_, pb_ = p(u - v * grid), p(v - u * grid)
    like = more[:, None] * np.log(pa_) + less[:, None] * np.log(pb_) + same[:, None] * np.log(np.clip(1 - pa_ - pb_, 1e-9, 1))
    like[grid > np.minimum(u / v, v / u) + 0.01] = -np.inf
    return grid[0][like.argmax(1)]


def _sketch(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, key, sketch = [], [], []
        for s in shingle_sets(batch.column(1), k):
            n.append(len(s))
            if len(s):
                with np.errstate(over="ignore"):
                    key.append(np.array([s.sum(), mix(s * M3).sum()], np.uint64).tobytes())
                sketch.append(registers(s).tobytes())
            else:
                key.append(None)
                sketch.append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sketch, pa.binary())], ["doc_id", "n_shingles", "set_key", "sketch"]
        )


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, sketch) of every row; key and sketch are null for a text without words."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lambda it: _sketch(it, k), "doc_id long, n_shingles long, set_key binary, sketch binary"
    )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        r = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, BANDS, ROWS).astype(np.uint64)
        h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), r.shape[:2]).copy()
        with np.errstate(over="ignore"):
            for i in range(ROWS):
                h = mix(h * M3 + r[:, :, i])
        rep = np.repeat(batch.column(0).to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64).ravel()), pa.array(rep)], ["band", "rep"])


#: Where a bucket still holds several components, so many further registers of its sets, shortened to a bit each, screen
#: its pairs inside the join.
LONG = 4096
WORDS = LONG // 64
#: Standard errors that a screen leaves below the least similarity.
SLACK = 4.5
_LONG_MUL = _RNG.integers(0, 1 << 32, LONG, np.uint32) | np.uint32(1)
_LONG_XOR = _RNG.integers(0, 1 << 32, LONG, np.uint32)


def _long_sketches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    shift = np.arange(64, dtype=np.uint64)
    for batch in batches:
        words, sets = np.zeros((batch.num_rows, WORDS), np.uint64), []
        for i, s in enumerate(shingle_sets(batch.column(1), k)):
            if len(s):
                with np.errstate(over="ignore"):
                    r = mix(registers(s, _LONG_MUL, _LONG_XOR).astype(np.uint64) * M3) >> np.uint64(63)
                words[i] = (r.reshape(WORDS, 64) << shift).sum(1)
            sets.append(s.view(np.int64))
        words = words.view(np.int64)
        n = pa.array([len(s) for s in sets], pa.int64())
        columns = [batch.column(0), n, pa.array(sets, pa.list_(pa.int64())), *(pa.array(np.ascontiguousarray(words[:, i])) for i in range(WORDS))]
        yield pa.RecordBatch.from_arrays(columns, ["rep", "n", "shingles", *(f"w{i}" for i in range(WORDS))])


def may_be_near(x: str, y: str, percent: int) -> str:
    """SQL: the bits of x and y differ in no more places than SLACK standard errors allow at the least similarity.

    A quarter of them first. Bits differ half as often as registers. A bit does not tell a smaller register from a larger
    one, so that the likelihood of two sketches depends on the number of differing bits alone and falls with it: this
    bound on the count is a bound on the likelihood ratio.
    """
    rate = (1 - percent / 100) / 2

    def first(words: int) -> str:
        most = 64 * words * rate + SLACK * (64 * words * rate * (1 - rate)) ** 0.5
        return " + ".join(f"bit_count({x}.w{i} ^ {y}.w{i})" for i in range(words)) + f" <= {int(most)}"

    return f"{first(WORDS // 4)} and {first(WORDS)}"


def _shingles(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in shingle_sets(batch.column(1), k)], pa.binary())], ["rep", "shingles"])


def _overlap(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(batch.column(2), batch.column(3), strict=True):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            a, b = (a, b) if len(a) <= len(b) else (b, a)
            at = np.searchsorted(b, a)
            at[at == len(b)] = 0
            both = int((b[at] == a).sum()) if len(b) else 0
            keep.append(100 * both >= percent * (len(a) + len(b) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["src", "dst"]).filter(pa.array(keep, pa.bool_()))


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (src, dst) whose full shingle sets have 100 * intersection >= percent * union."""
    needed = pairs.select(F.col("src").alias("rep")).union(pairs.select("dst")).distinct()
    sets = (
        semi_join(docs.select(F.col("doc_id").cast("long").alias("rep"), "text"), needed, "rep")
        .mapInArrow(lambda it: _shingles(it, k), "rep long, shingles binary")
    )
    both = (
        pairs.join(sets.select(F.col("rep").alias("src"), F.col("shingles").alias("a")), "src")
        .join(sets.select(F.col("rep").alias("dst"), F.col("shingles").alias("b")), "dst").select("src", "dst", "a", "b")
    )
    return both.mapInArrow(lambda it: _overlap(it, percent), "src long, dst long").distinct()


def _screen(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        ra, rb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3))
        est = joint_estimate(ra, rb, batch.column(4).to_numpy(), batch.column(5).to_numpy())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["src", "dst"]).filter(pa.array(est >= least))


def screened(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs whose registers' joint estimate is at most SLACK standard errors below the least similarity."""
    least = percent / 100 - SLACK * (percent / 100 * (1 - percent / 100) / REGISTERS) ** 0.5
    a, b = (reps.select(F.col("rep").alias(x), F.col("sketch").alias(s), F.col("n").alias(n)) for x, s, n in (("src", "ra", "na"), ("dst", "rb", "nb")))
    return (
        pairs.join(a, "src").join(b, "dst").select("src", "dst", "ra", "rb", "na", "nb")
        .mapInArrow(lambda it: _screen(it, least), "src long, dst long")
    )


def _texts_of_one_id(found: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (src, dst) between a doc_id whose rows have different sets and the documents that stand for those."""
    told = found.where("set_key is not null and doc_id is not null").select("doc_id", "set_key", F.xxhash64("set_key").alias("h"))
    several = told.groupBy("doc_id").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("doc_id")
    return semi_join(told, several, "doc_id").join(reps, "set_key").where("doc_id <> rep").select(F.col("doc_id").alias("src"), F.col("rep").alias("dst")).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, kept.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased; a document's set holds its distinct
    k-word shingles, or its whole word sequence if that is shorter. Documents with
    100 * intersection >= percent * union are linked; component_id is the smallest doc_id that links reach, and
    kept says that it is the row's own.

    A null or empty text has an empty set: linked with nothing, its own component, kept. Rows that share a doc_id are one
    document: a link of one's text is a link of all of them with a word. A row without doc_id is never linked:
    component_id null, kept true. Other columns are not read. An empty table gives an empty result.

    Equal sets are merged first. Every other set meets the smallest doc_id of each of its buckets; the most frequent of
    those is screened by likelihood and verified. Then all pairs that share a bucket but not yet a component are tested
    inside the join, by longer sketches and then by the full sets, so that only true links leave it. Two sets
    at the least similarity share no bucket with a probability of (1 - 0.8**6)**40, or 5 in a million, and fail a screen
    with one of 3 in a million.
    """
    with arrow_rows(docs.sparkSession, 1000):
        found = staged(sketches(docs, k), "sketch")
        reps = staged(
            found.where("set_key is not null and doc_id is not null").groupBy("set_key")
            .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")),
            "reps",
        )
        bands = staged(reps.select("rep", "sketch").mapInArrow(_bands, "band long, rep long"), "bands")
        buckets = bands.groupBy("band").agg(F.min("rep").alias("center"), F.count("*").alias("c")).where("c > 1").select("band", "center")
        shared = staged(bands.join(buckets, "band"), "shared")
        discard(bands)
        first = (
            shared.where("rep <> center").groupBy("rep", "center").agg(F.count("*").alias("c"))
            .groupBy("rep").agg(F.max(F.struct("c", (-F.col("center")).alias("m"))).alias("best"))
            .select(F.col("rep").alias("src"), (-F.col("best.m")).alias("dst"))
        )
        first = staged(screened(first, reps, percent), "first")
        links = staged(verified(first, docs, k, percent).unionByName(_texts_of_one_id(found, reps)), "links")
        parts = connected_components(links)
        marked = shared.join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("band", "rep", F.coalesce("component", "rep").alias("part"))
        # the buckets of several components
        open_buckets = marked.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("band")
        rest = staged(marked.join(open_buckets, "band", "left_semi"), "rest")
        texts = semi_join(docs.select(F.col("doc_id").cast("long").alias("rep"), "text"), rest, "rep")
        sketched = texts.mapInArrow(lambda it: _long_sketches(it, k), "rep long, n long, shingles array<long>, " + ", ".join(f"w{i} long" for i in range(WORDS)))
        full = rest.join(sketched, "rep")
        near = f"""x.band = y.band and x.part < y.part
            and 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and {may_be_near('x', 'y', percent)}
            and exists(array(struct(x.shingles as a, y.shingles as b)), p -> {100 + percent} * size(array_intersect(p.a, p.b)) >= {percent} * (x.n + y.n))"""
        # the exact test stands in a lambda, which is not compiled into the loop over pairs: that stays small enough for the JVM's compiler
        late = full.alias("x").join(full.alias("y"), F.expr(near)).select(F.col("x.rep").alias("src"), F.col("y.rep").alias("dst"))
        more = staged(links.unionByName(late).distinct(), "links")
        discard(rest, shared, first, links)
    parts = connected_components(more)
    named = reps.select("set_key", "rep").join(parts.withColumnRenamed("node", "rep"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component_id"))
    return (
        found.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
