"""Exact maximum-inner-product search over blocks of vectors sorted by length, with rotated partial sums as bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import staged

#: Vectors in a block, and queries in a block.
BLOCK, QUERIES = 4096, 1024
#: Leading rotated dimensions whose partial sum bounds an inner product.
LEADING = 16


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v array<long>, norm2): floor(scale * x) of each component; rows without vec_id, with a null vector or a null or non-finite component are left out."""
    x = F.col("embedding")
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    v = F.transform(x, lambda c: F.floor(c.cast("double") * scale))
    out = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    return out.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))


def rotation(rows: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all rows together, from the sum of their outer products."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = np.zeros((dim, dim))
        for batch in batches:
            m = matrix(batch.column(0), dim)
            g += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(list(g), pa.list_(pa.float64()))], ["i", "g"])

    sums = rows.select("v").mapInArrow(gram, "i int, g array<double>").select("i", F.posexplode("g").alias("j", "g")).groupBy("i", "j").agg(F.sum("g").alias("g"))
    g = np.zeros((dim, dim))
    for r in sums.collect():
        g[r.i, r.j] = r.g
    return np.linalg.eigh(g)[1][:, ::-1]


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as float64; a shorter vector counts as followed by zeros."""
    n = np.diff(col.offsets.to_numpy())
    if (n == dim).all():
        return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    out = np.zeros((len(col), dim))
    for i, v in enumerate(col.to_pylist()):
        out[i, : len(v)] = v
    return out


def _blocks(batches: Iterator[pa.RecordBatch], size: int, dim: int, start: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows as one row: (block, longest, ids, vectors), in the order in which they come."""
    from pyspark import TaskContext

    block = start + (TaskContext.get().partitionId() << 24)
    ids, rows, norms, have = [], [], [], 0

    def out(i, v, n):
        nonlocal block
        block += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([block - 1]), pa.array([float(np.sqrt(n.max()))]), pa.array([i.tobytes()], pa.binary()), pa.array([v.astype(np.float64).tobytes()], pa.binary())], ["block", "longest", "ids", "vectors"]
        )

    for batch in batches:
        ids.append(batch.column(0).to_numpy()), rows.append(matrix(batch.column(1), dim)), norms.append(batch.column(2).to_numpy())
        have += batch.num_rows
        while have >= size:
            i, v, n = np.concatenate(ids), np.concatenate(rows), np.concatenate(norms)
            yield out(i[:size], v[:size], n[:size])
            ids, rows, norms, have = [i[size:]], [v[size:]], [n[size:]], have - size
    if have:
        yield out(np.concatenate(ids), np.concatenate(rows), np.concatenate(norms))


def exact_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row-wise integer inner products; in 64-bit integers where doubles could round."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1] < 2**53:
        return (q * v).sum(1).astype(np.int64)
    return (q.astype(np.int64) * v.astype(np.int64)).sum(1)


def best_in_block(qid, q, floor, ids, v, turn, k) -> list[tuple]:
    """(query_id, vec_id, score, place in the block) of every candidate of one block that can be among a query's k best.

    floor: a score that k candidates of the query are known to reach, or -inf. |q| * |v| bounds whole rows; then the
    partial sum over the leading rotated dimensions plus the product of the residual lengths bounds each pair.
    Bounds are widened by their rounding error; only exact integer scores decide.
    """
    lead = min(LEADING, q.shape[1])
    nq, nv = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))
    use = np.flatnonzero(nq * nv.max(initial=0) * (1 + 1e-9) + 1e-6 >= floor)
    q, qid, floor, nq = q[use], qid[use], floor[use], nq[use]
    qr, vr = q @ turn[:, :lead], v @ turn[:, :lead]
    rq, rv = (np.sqrt(np.maximum(n * n - (r * r).sum(1), 0) + 1e-9 * n * n) for n, r in ((nq, qr), (nv, vr)))
    order = np.argsort(-nv, kind="stable")
    out = []
    for a in range(len(q)):
        bound = vr @ qr[a] + rv * rq[a]
        bound += 1e-9 * nq[a] * nv + 1e-6
        least, top = floor[a], []
        for c in range(0, len(order), 512):  # longest first: the floor rises early
            at = order[c : c + 512]
            at = at[bound[at] >= least]
            at = at[ids[at] != qid[a]]
            if not len(at):
                continue
            score = exact_products(np.broadcast_to(q[a], (len(at), q.shape[1])), v[at])
            top += [(int(s), int(i), int(j)) for s, i, j in zip(score, ids[at], at, strict=True) if s >= least]
            top.sort(key=lambda x: (-x[0], x[1]))
            del top[k:]
            if len(top) == k:
                least = max(least, top[-1][0])
        out += [(int(qid[a]), i, s, j) for s, i, j in top]
    return out


def _search(batches: Iterator[pa.RecordBatch], turn: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    dim = len(turn)
    for batch in batches:
        for qids, qs, fl, ids, vs, block in zip(*(batch.column(i) for i in range(6)), strict=True):
            qid, ids = np.frombuffer(qids.as_buffer(), np.int64), np.frombuffer(ids.as_buffer(), np.int64)
            q, v = (np.frombuffer(x.as_buffer(), np.float64).reshape(-1, dim) for x in (qs, vs))
            floor = np.frombuffer(fl.as_buffer(), np.float64) if fl.is_valid else np.full(len(qid), -np.inf)
            rows = best_in_block(qid, q, floor, ids, v, turn, k)
            row = block.as_py() * BLOCK
            yield pa.RecordBatch.from_arrays([*(pa.array([r[c] for r in rows], pa.int64()) for c in range(3)), pa.array([row + r[3] for r in rows], pa.int64())], ["query_id", "vec_id", "score", "row"])


def _floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, ids, qids, scores in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            known = dict(zip(qids, scores, strict=True))
            floor = np.array([known.get(i, -np.inf) for i in np.frombuffer(ids, np.int64).tolist()])
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([floor.tobytes()], pa.binary())], ["qblock", "floor"])


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query with all rows but its own.

    Queries are the rows whose vec_id is divisible by `every`; vectors become floor(scale * x). Ties go to the smaller
    vec_id; a query with fewer than k candidates has all of them. Vectors that are null or hold a null or non-finite
    component take no part, nor do rows without vec_id; an empty vector has only products of 0. A shorter vector counts
    as followed by zeros. Rows that share a vec_id are candidates each, and equal result rows of a repeated query
    appear once. Other columns are not read. An empty table gives an empty result.

    Rows are range-partitioned by descending length and packed into blocks. All query blocks first search the block of
    the longest vectors, which gives each query a floor; then each query block meets every other block whose longest
    vector can still reach a floor. Only block numbers are paired; a task holds one block of each kind.
    """
    spark = vectors.sparkSession
    rows = staged(integer_vectors(vectors, scale), "vectors")
    about = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    if not about.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = max(about.dim, 1)
    turn = rotation(rows, dim)
    schema = "block long, longest double, ids binary, vectors binary"
    parts = max(1, -(-about.n // BLOCK))
    by_length = rows.select("vec_id", "v", "norm2").repartitionByRange(parts, F.desc("norm2"), "vec_id").sortWithinPartitions(F.desc("norm2"), "vec_id")
    blocks = staged(by_length.mapInArrow(lambda it: _blocks(it, BLOCK, dim, 0), schema), "blocks")
    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "v", "norm2").distinct()
    asked = asked.repartition(max(1, -(-about.n // (every * QUERIES))), "vec_id")
    qblocks = staged(asked.mapInArrow(lambda it: _blocks(it, QUERIES, dim, 0), schema), "queries").withColumnsRenamed({"block": "qblock", "longest": "qlongest", "ids": "qids", "vectors": "queries"})
    first = blocks.agg(F.max(F.struct("longest", (-F.col("block")).alias("m"))).alias("x")).first().x
    if first is None or not qblocks.limit(1).count():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    def search(pairs: DataFrame) -> DataFrame:
        # row tells copies of a candidate apart; only what a repeated query finds twice is merged
        found = pairs.select("qids", "queries", "floor", "ids", "vectors", "block").mapInArrow(lambda it: _search(it, turn, k), "query_id long, vec_id long, score long, row long")
        return found.distinct()

    head = blocks.where(F.col("block") == -first.m).select(F.lit(0).alias("one"), "block", "ids", "vectors")
    begun = staged(search(qblocks.withColumn("one", F.lit(0)).withColumn("floor", F.lit(None).cast("binary")).join(F.broadcast(head), "one")), "first")
    floors = begun.groupBy("query_id").agg(F.count("*").alias("c"), F.min("score").cast("double").alias("low")).where(F.col("c") >= k)
    members = qblocks.select("qblock", "qids").mapInArrow(_members, "qblock long, query_id long")
    grouped = members.join(floors, "query_id").groupBy("qblock").agg(F.collect_list(F.struct("query_id", "low")).alias("x"))
    ready = qblocks.join(grouped, "qblock", "left").select("qblock", "qids", F.col("x.query_id").alias("a"), F.col("x.low").alias("b"))
    floor = ready.select("qblock", "qids", F.coalesce("a", F.array().cast("array<long>")), F.coalesce("b", F.array().cast("array<double>"))).mapInArrow(_floors, "qblock long, floor binary")
    ready = staged(qblocks.join(floor, "qblock"), "ready")
    lowest = members.join(floors, "query_id", "left").groupBy("qblock").agg(F.min(F.coalesce("low", F.lit(float("-inf")))).alias("lowest"))
    others = blocks.where(F.col("block") != -first.m).select("block", "longest")
    plan = others.withColumn("spread", F.explode(F.sequence(F.lit(0), F.lit(int(qblocks.count()) - 1))))
    numbered = ready.join(lowest, "qblock").selectExpr("qblock", "qlongest", "lowest").withColumn("spread", F.row_number().over(_by("qblock")) - 1)
    plan = plan.join(numbered, "spread").where("longest * qlongest * (1 + 1e-9) + 1e-6 >= lowest").select("block", "qblock")
    pairs = plan.join(blocks.select("block", "ids", "vectors"), "block").join(ready.select("qblock", "qids", "queries", "floor"), "qblock")
    found = begun.unionByName(search(pairs)) if about.n > BLOCK else begun
    rank = F.row_number().over(_by(F.desc("score"), "vec_id", part="query_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _by(*order, part: str | None = None):
    from pyspark.sql import Window

    return (Window.partitionBy(part) if part else Window.partitionBy(F.lit(0))).orderBy(*order)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            i = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), block)), pa.array(i)], ["qblock", "query_id"])
