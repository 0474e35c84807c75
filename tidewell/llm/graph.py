"""Approximate nearest neighbours by inner product: a robust-pruned directed graph in each shard, searched by beams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import numbered, staged

#: Distinct vectors in a shard at most, edges that pruning leaves, edges from which on a node is pruned again, places in a beam while building, and by how much a pruned edge is longer than the one to its detour.
SHARD, EDGES, ROOM, BEAM, SLACK = 1 << 15, 32, 48, 64, 1.2
#: Places in the beam of a query, queries that go through a graph together, and nodes that each of them expands in one step.
WIDE, TOGETHER, STEP = 128, 512, 4


def directions(v: np.ndarray) -> np.ndarray:
    """Vectors at length 1."""
    return (v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]).astype(np.float32)


def beam_search(v: np.ndarray, out: np.ndarray, q: np.ndarray, start: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query of q the (nodes, distances) of the `beam` nodes of largest inner product that the graph leads to from `start`, largest first; node -1 where there are fewer.

    All queries go in step: each expands its nearest STEP unexpanded nodes, until none is left in its beam. The
    distance is minus the inner product.
    """
    n, most = len(q), out.shape[1] * STEP
    ids = np.full((n, beam), -1, np.int32)
    far = np.full((n, beam), np.inf, np.float32)
    open_ = np.zeros((n, beam), bool)
    seen = np.zeros((n, len(v)), bool)
    ids[:, 0], far[:, 0], open_[:, 0], seen[:, start] = start, -(q @ v[start]), True, True
    live = np.arange(n)
    while len(live):
        rank = np.cumsum(open_[live], 1)
        take = open_[live] & (rank <= STEP)
        r, c = np.nonzero(take)
        open_[live[r], c] = False
        near = np.full((len(live), most), -1, np.int32)
        at = (rank[r, c] - 1)[:, None] * out.shape[1] + np.arange(out.shape[1])
        near[r[:, None], at] = out[ids[live[r], c]]
        # what was seen before, and what two expanded nodes share, is left out
        rows = np.repeat(np.arange(len(live)), most)
        flat = near.ravel()
        ok = np.flatnonzero(flat >= 0)
        ok = ok[~seen[live[rows[ok]], flat[ok]]]
        _, once = np.unique(rows[ok].astype(np.int64) * len(v) + flat[ok], return_index=True)
        ok = ok[once]
        seen[live[rows[ok]], flat[ok]] = True
        d = np.full(len(flat), np.inf, np.float32)
        d[ok] = -np.einsum("ij,ij->i", q[live[rows[ok]]], v[flat[ok]])
        d = d.reshape(len(live), most)
        all_d = np.concatenate([far[live], d], 1)
        all_i = np.concatenate([ids[live], near], 1)
        all_o = np.concatenate([open_[live], d < np.inf], 1)
        best = np.argsort(all_d, 1, kind="stable")[:, :beam]
        far[live] = np.take_along_axis(all_d, best, 1)
        ids[live] = np.where(np.isfinite(far[live]), np.take_along_axis(all_i, best, 1), -1)
        open_[live] = np.take_along_axis(all_o, best, 1)
        live = live[open_[live].any(1)]
    return ids, far


def pruned(v: np.ndarray, node: np.ndarray, pool: np.ndarray) -> np.ndarray:
    """Out-edges of each node among its pool (node -1 is none): the nearest stays, and drops those to which the way over it is shorter by SLACK; and so on up to EDGES."""
    pool = np.sort(np.where(pool == node[:, None], -1, pool), 1)
    pool[:, 1:][pool[:, 1:] == pool[:, :-1]] = -1  # a candidate that came twice
    x = v[pool]
    d = 2 * (np.einsum("ij,ij->i", v[node], v[node])[:, None] - (x @ v[node][:, :, None])[:, :, 0])
    d[pool < 0] = np.inf
    order = np.argsort(d, 1, kind="stable")
    pool, d, x = np.take_along_axis(pool, order, 1), np.take_along_axis(d, order, 1), np.take_along_axis(x, order[:, :, None], 1)
    between = 2 * SLACK * SLACK * (np.einsum("ij,ij->i", v[node], v[node])[:, None, None] - x @ x.transpose(0, 2, 1))
    out = np.full((len(node), EDGES), -1, np.int32)
    left = np.isfinite(d)
    row = np.arange(len(node))
    for k in range(EDGES):
        first = left.argmax(1)
        has = left[row, first]
        if not has.any():
            break
        out[:, k] = np.where(has, pool[row, first], -1)
        left &= between[row, first] > d
        left[row, first] = False
    return out


def built(v: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, int]:
    """The graph (out-edges of each node, -1 for none) over directions, and the node where searches start.

    Nodes enter in batches of at most a sixteenth of the graph so far: each batch searches the graph, prunes what it met
    into edges, and is linked back; a node with more than ROOM edges is pruned again.
    """
    n = len(v)
    start = int(np.argmax(v @ v.mean(0)))
    turn = np.random.default_rng(n).permutation(n)
    turn = np.concatenate([[start], turn[turn != start]])
    out = np.full((n, ROOM), -1, np.int32)
    done = 1
    while done < n:
        batch = turn[done : done + max(8, min(TOGETHER, done // 16))]
        if done < EDGES:  # the first nodes know one another
            found = np.broadcast_to(turn[: done + len(batch)], (len(batch), done + len(batch)))
        else:
            found, _ = beam_search(v, out, v[batch], start, beam)
        out[batch, :EDGES] = pruned(v, batch, found.astype(np.int64))
        # back edges, gathered by the node that they go to
        a, k = np.nonzero(out[batch] >= 0)
        to, back = out[batch][a, k], batch[a]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        nodes, first, count = np.unique(to, return_index=True, return_counts=True)
        pool = np.full((len(nodes), ROOM + int(count.max(initial=0))), -1, np.int64)
        pool[:, :ROOM] = out[nodes]
        pool[np.repeat(np.arange(len(nodes)), count), ROOM + np.arange(len(to)) - np.repeat(first, count)] = back
        pool = np.sort(pool, 1)[:, ::-1]
        pool[:, 1:][pool[:, 1:] == pool[:, :-1]] = -1
        full = (pool >= 0).sum(1) > ROOM
        fits = np.sort(pool[~full], 1)[:, ::-1][:, :ROOM]
        out[nodes[~full], : fits.shape[1]] = fits
        for c in range(0, int(full.sum()), TOGETHER):
            part = np.flatnonzero(full)[c : c + TOGETHER]
            out[nodes[part]] = -1
            out[nodes[part], :EDGES] = pruned(v, nodes[part], pool[part])
        done += len(batch)
    return out, start


def clean(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<float>, own): rows that take part, each with a number of its own."""
    x = F.col("embedding")
    ok = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(x, lambda c: c != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(ok)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v")).withColumn("own", F.monotonically_increasing_id())


def nodes_of(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): each distinct vector with the 2k smallest vec_ids of its copies, each at most k times.

    All copies are equally near, so that no others can be among k nearest: at most k of these have the query's own id.
    """
    copies = rows.groupBy("v", "vec_id").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"))
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    ids = F.array_sort(F.collect_list(F.struct("vec_id", "copies")))
    few = copies.withColumn("place", place).where(F.col("place") <= 2 * k).groupBy("v").agg(ids.alias("ids"))
    return few.select("v", F.slice(F.flatten(F.transform("ids", lambda x: F.array_repeat(x["vec_id"], x["copies"]))), 1, 2 * k).alias("ids"))


def _shard_index(frames: Iterator[pa.Table], dim: int) -> Iterator[pa.RecordBatch]:
    """One shard's rows (shard, v, ids) with node, the edges out of it and whether searches start there."""
    t = pa.concat_tables([pa.Table.from_batches([b]) for b in frames]).combine_chunks()
    v = directions(stacked(t.column("v").combine_chunks(), dim))
    out, start = built(v)
    edges = pa.array([[int(x) for x in row if x >= 0] for row in out], pa.list_(pa.int32()))
    node = np.arange(len(v), dtype=np.int32)
    names = ["shard", "node", "starts", "v", "ids", "edges"]
    whole = pa.table([t.column("shard"), pa.array(node), pa.array(node == start), t.column("v"), t.column("ids"), edges], names)
    yield from whole.to_batches(max_chunksize=4096)


def stacked(col: pa.Array, dim: int) -> np.ndarray:
    """A list column as a matrix of doubles; a shorter vector counts as followed by zeros."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    out = np.zeros((len(col), dim))
    n = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(col)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def index(vectors: DataFrame, k: int, shard: int = SHARD) -> tuple[DataFrame, DataFrame, int, int]:
    """The staged index (shard, node, starts, v, ids, edges) of every row of vectors(vec_id, embedding), the rows that take part, the number of shards and the longest vector's components.

    Distinct vectors are dealt to shards of `shard` at most by their length, those of equal length at random. A graph
    links what lies in like directions and is searched by inner products, which agree the better the more alike a
    shard's lengths are. Each shard's graph is built in one task.
    """
    rows = staged(clean(vectors), "vectors")
    nodes = staged(nodes_of(rows, k), "nodes")
    about = nodes.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    dim, slots = about.dim or 1, max(2, vectors.sparkSession.sparkContext.defaultParallelism)
    shards = max(1, -(-about.n // shard), min(slots, about.n // 2048))
    length = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    placed = numbered(nodes.select("v", "ids", F.round(length, 5).alias("length"), F.xxhash64("v").alias("turn"), F.lit(0).alias("all")), "all", ["length", "turn"], "placed")
    dealt = placed.select(F.floor(F.col("idx") * shards / F.col("n")).cast("int").alias("shard"), "v", "ids")
    made = dealt.groupBy("shard").applyInArrow(lambda t: pa.Table.from_batches(_shard_index(iter(t.to_batches()), dim)), "shard int, node int, starts boolean, v array<float>, ids array<long>, edges array<int>")
    return staged(made, "index"), rows, shards, dim


def _answers(batches: Iterator[pa.RecordBatch], dim: int, k: int, wide: int) -> Iterator[pa.RecordBatch]:
    """Rows come shard by shard, a shard's nodes before its queries: the graph is held, and queries pass through it in groups."""
    shard, parts, graph, waiting = None, [], None, []

    def answer() -> pa.RecordBatch:
        q = np.concatenate([w[2] for w in waiting])
        qid, own = (np.concatenate([w[i] for w in waiting]) for i in (0, 1))
        waiting.clear()
        return searched(graph, qid, own, q, k, wide)

    for batch in batches:
        at = batch.column("at").to_numpy()
        kind = batch.column("kind").to_numpy()
        cuts = np.flatnonzero(np.diff(at) | np.diff(kind)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(at)], strict=True):
            piece = batch.slice(a, b - a)
            if at[a] != shard:
                if waiting:
                    yield answer()
                shard, parts, graph = at[a], [], None
            if kind[a] == 0:
                parts.append(piece)
                continue
            if graph is None:
                graph, parts = held(pa.Table.from_batches(parts), dim), []
            q = stacked(piece.column("v"), dim)
            for c in range(0, len(q), TOGETHER):
                waiting.append((piece.column("qid").to_numpy()[c : c + TOGETHER], piece.column("own").to_numpy()[c : c + TOGETHER], q[c : c + TOGETHER]))
                if sum(len(w[0]) for w in waiting) >= TOGETHER:
                    yield answer()
    if waiting:
        yield answer()


def held(t: pa.Table, dim: int) -> tuple:
    """A shard in memory: original vectors, the same in floats with the longest at length 1, edges, start, and the vec_ids of each node."""
    t = t.sort_by("node").combine_chunks()
    v = stacked(t.column("v"), dim)
    edges = t.column("edges").combine_chunks()
    n = np.diff(edges.offsets.to_numpy())
    out = np.full((len(v), ROOM), -1, np.int32)
    out[np.repeat(np.arange(len(v)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = edges.flatten().to_numpy()
    ids = t.column("ids").combine_chunks()
    start = int(np.flatnonzero(t.column("starts").combine_chunks().to_numpy(zero_copy_only=False))[0])
    return v, (v / np.sqrt(np.einsum("ij,ij->i", v, v).max())).astype(np.float32), out, start, ids.offsets.to_numpy(), ids.flatten().to_numpy()


def searched(graph: tuple, qid: np.ndarray, own: np.ndarray, q: np.ndarray, k: int, wide: int) -> pa.RecordBatch:
    """(query_id, own, vec_id, score) of what a shard holds near the queries: of each query its k best of other ids, scored in doubles on the original vectors."""
    v, scaled, out, start, off, ids = graph
    nodes, _ = beam_search(scaled, out, directions(q), start, min(wide, len(v)))
    r, c = np.nonzero(nodes >= 0)
    node = nodes[r, c]
    score = np.concatenate([np.einsum("ij,ij->i", q[r[a : a + 65536]], v[node[a : a + 65536]]) for a in range(0, len(r), 65536)] or [np.zeros(0)])
    n = off[node + 1] - off[node]
    vec = ids[np.repeat(off[node] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    r, score = np.repeat(r, n), np.repeat(score, n)
    other = vec != qid[r]
    r, score, vec = r[other], score[other], vec[other]
    order = np.lexsort((vec, -score, r))
    r, score, vec = r[order], score[order], vec[order]
    first = np.flatnonzero(np.diff(r, prepend=-1))
    keep = np.arange(len(r)) - np.repeat(first, np.diff(first, append=len(r))) < k
    r, score, vec = r[keep], score[keep], vec[keep]
    return pa.RecordBatch.from_arrays([pa.array(qid[r]), pa.array(own[r]), pa.array(vec), pa.array(score)], ["query_id", "own", "vec_id", "score"])


def neighbours(vectors: DataFrame, k: int = 20, every: int = 20, shard: int = SHARD, wide: int = WIDE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query about its k nearest of all rows but its own, by the largest inner product in doubles.

    Queries are the rows whose vec_id is divisible by `every`. Vectors that are null, empty, all zero or hold a null or
    non-finite component take no part, nor do rows without vec_id; a shorter vector counts as followed by zeros. Ties go
    to the smaller vec_id. Rows that share a query's vec_id are not its candidates; other rows that share a vec_id are
    candidates each, and a query row that is repeated asks once. Other columns are not read. An empty table gives an
    empty result. If there are at most `wide` distinct vectors in a shard, the shard's answer is exact where its graph
    is connected.

    Every row is indexed (see index). Queries go to every shard; a task holds one shard of at most `shard` vectors and
    at most TOGETHER queries at a time, and shards are held in several tasks where there are fewer shards than slots.
    """
    spark = vectors.sparkSession
    table, rows, shards, dim = index(vectors, k, shard)
    spread = max(1, -(-max(2, spark.sparkContext.defaultParallelism) // shards))
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id", "v").agg(F.min("own").alias("own"))
    places = shards * spread
    none = F.lit(None)
    at = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    left = table.select("*", at.alias("copy")).select(
        (F.col("shard") * spread + F.col("copy")).alias("at"), F.lit(0).alias("kind"), "node", "starts", "v", "ids", "edges", none.cast("long").alias("qid"), none.cast("long").alias("own"))
    copy = F.pmod(F.xxhash64("own"), F.lit(spread)).cast("int")
    right = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select(
        (F.col("shard") * spread + copy).alias("at"), F.lit(1).alias("kind"), F.lit(0).alias("node"), none.cast("boolean").alias("starts"), "v", none.cast("array<long>").alias("ids"), none.cast("array<int>").alias("edges"),
        F.col("vec_id").alias("qid"), "own")
    met = left.unionByName(right).repartitionByRange(places, "at").sortWithinPartitions("at", "kind", "node")
    found = met.mapInArrow(lambda it: _answers(it, dim, k, wide), "query_id long, own long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "own").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
