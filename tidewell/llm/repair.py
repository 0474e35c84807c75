"""Repair of conversations' structure by least-cost edits, over blocks of symbols whose effect on cost vectors is tabulated."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import staged

#: States of the target (s?(ua)+)?: nothing yet, after s, after u, after a.
STATES, NOTHING, OPENED, ASKED, ANSWERED = 4, 0, 1, 2, 3
#: Where one more user or assistant turn leads to from each state, inserted or by a new role.
NEXT = (ASKED, ASKED, ANSWERED, ASKED)
#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: A row as a symbol: x has to go; lower case is a sound row by its role's initial (o: another), upper case a truncated one.
SYMBOLS = "xsuaoSUAO"
#: Symbols in a tabulated block, and the rows of a conversation in one chunk, as a power of two. Chunks are composed by groups of 2^CHUNK_BITS too.
BLOCK, CHUNK_BITS = 4, 12
FAR = 10**6


def kept_state(state: int, symbol: str) -> int | None:
    """Where a row that keeps its role leads to, if it may."""
    c = symbol.lower()
    if c == "s":
        return OPENED if state == NOTHING else None
    if c == "u":
        return ASKED if state != ASKED else None
    return ANSWERED if c == "a" and state == ASKED else None


def before(symbol: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Least cost from each state in front of a row, from the least costs behind it."""
    late = TRUNCATED if symbol.isupper() else 0
    out = []
    for s in range(STATES):
        best = DELETE + after[s]
        if symbol != "x":
            best = min(best, REROLE + late + after[NEXT[s]])
            k = kept_state(s, symbol)
            if k is not None:
                best = min(best, late + after[k])
        out.append(best)
    return inserted(out)


def inserted(costs: list[int]) -> tuple[int, ...]:
    """Costs with insertions in front: at most three lead to every state that insertions reach."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


@cache
def tables() -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All cost vectors, less their least cost, that any row sequence leads to, the first being that of the end; and for
    each symbol, then for each block of BLOCK symbols, the vector in front and the cost to add, by the vector behind."""
    end = inserted([0, FAR, FAR, 0])
    vectors, todo, steps = {end: 0}, [end], {}
    while todo:
        v = todo.pop()
        for i, c in enumerate(SYMBOLS):
            w = before(c, v)
            low = min(w)
            n = tuple(x - low for x in w)
            if n not in vectors:
                vectors[n] = len(vectors)
                todo.append(n)
            steps[i, vectors[v]] = vectors[n], low
    one = np.array([[steps[i, v] for v in range(len(vectors))] for i in range(len(SYMBOLS))])
    to, add = one[:, :, 0], one[:, :, 1]
    block_to, block_add = to, add
    for _ in range(BLOCK - 1):  # a symbol in front of each block so far
        front_to, front_add = to[:, block_to], add[:, block_to] + block_add
        block_to, block_add = front_to.reshape(-1, len(vectors)), front_add.reshape(-1, len(vectors))
    return list(vectors), to, add, block_to, block_add


def codes(symbols: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the whole blocks of a text of symbols, and of the symbols that are left at its end."""
    n = np.frombuffer(symbols.translate(str.maketrans(SYMBOLS, "".join(map(chr, range(len(SYMBOLS)))))).encode(), np.uint8).astype(np.int64)
    whole = len(n) // BLOCK * BLOCK
    return n[:whole].reshape(-1, BLOCK) @ len(SYMBOLS) ** np.arange(BLOCK - 1, -1, -1), n[whole:]


def swept(symbols: str, end: int) -> tuple[list[int], int]:
    """Backward over a text of symbols from the vector behind it: the vectors behind its blocks (the rest that fills no block is the last one), and the cost from NOTHING less the least cost behind."""
    vectors, to, add, block_to, block_add = tables()
    blocks, rest = codes(symbols)
    v, cost = end, 0
    for c in rest[::-1].tolist():
        v, cost = int(to[c, v]), cost + int(add[c, v])
    behind = [end] if len(rest) else []
    for b in blocks[::-1].tolist():
        behind.append(v)
        v, cost = int(block_to[b, v]), cost + int(block_add[b, v])
    return behind[::-1], cost + vectors[v][NOTHING]


def mapped(symbols: str) -> list[int]:
    """The vector in front for each vector behind: what a chunk does, whatever follows."""
    _, to, _, block_to, _ = tables()
    blocks, rest = codes(symbols)
    v = np.arange(to.shape[1])
    for c in rest[::-1]:
        v = to[c, v]
    for b in blocks[::-1]:
        v = block_to[b, v]
    return v.tolist()


def traced(symbols: str, state: int, behind: list[int], last: bool) -> tuple[str, int, int]:
    """(edits, state after, cost) of the ASCII-least of the cheapest edits of a chunk that starts in `state`.

    behind are the vectors that swept() gave; each block is expanded backward from the vector behind it into its
    symbols' vectors, and edits are then taken forward, of those that stay cheapest the least letter: D, I, K, R. What is
    inserted after the last row belongs to the chunk that is last.
    """
    vectors, to, add, _, _ = tables()
    out, cost = [], 0
    whole = len(symbols) // BLOCK * BLOCK
    spans = [*range(0, whole, BLOCK), *([whole] if whole < len(symbols) else [])]
    number = {c: i for i, c in enumerate(SYMBOLS)}
    for n, a in enumerate(spans):
        part = symbols[a : a + BLOCK] if a < whole else symbols[whole:]
        at = [behind[n]]
        for c in reversed(part):
            at.append(int(to[number[c], at[-1]]))
        at.reverse()  # at[i] is the vector in front of the block's symbol i
        for i, c in enumerate(part):
            v = vectors[at[i]]
            after = vectors[at[i + 1]]
            shift = int(add[number[c], at[i + 1]])  # what normalising took from the vector in front
            late = TRUNCATED if c.isupper() else 0
            while True:
                need = v[state] + shift
                k = kept_state(state, c)
                if DELETE + after[state] == need:
                    out.append("D")
                    cost += DELETE
                    break
                if INSERT + v[NEXT[state]] == v[state]:
                    out.append("I")
                    cost += INSERT
                    state = NEXT[state]
                elif k is not None and late + after[k] == need:
                    out.append("K")
                    cost += late
                    state = k
                    break
                else:
                    out.append("R")
                    cost += REROLE + late
                    state = NEXT[state]
                    break
    while last and state in (OPENED, ASKED):
        out.append("I")
        cost += INSERT
        state = NEXT[state]
    return "".join(out), state, cost


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): each row after damage by crc32(`conv_id:turn`) % 20, a null as one space; copies is 0 for a dropped row, 2 for a repeated one."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), copies.alias("copies"))


def digest() -> Column:
    """The text's sha256, by which rows are told apart without their texts."""
    return F.unhex(F.sha2("text", 256)).alias("digest")


def ordered_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, at, turn, role, digest, symbol, fault) of the rows after damage, without texts: at ascends in each conversation's order.

    Order is by turn (null first), then role, then the text's sha256, so that only equal rows tie. Rows are dealt by
    ranges of that order: a large conversation fills several partitions.
    """
    bare = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
    narrow = rows.where("copies > 0").select("conv_id", "turn", "role", digest(), fault.alias("fault"), "copies")
    narrow = staged(narrow.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("copies").cast("int").alias("copies")), "turns")
    firsts = narrow.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min(F.struct("turn")).alias("first"))
    met = narrow.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    met = met.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    again = ~F.col("first.turn").eqNullSafe(F.col("turn")) | (F.col("copy") > 1)
    met = met.withColumn("fault", F.when(F.coalesce(F.col("fault") != "blank", F.lit(True)) & again, "duplicate").otherwise(F.col("fault")))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    order = ["conv_id", "turn", "role", "digest", "copy"]
    laid = met.select(*order, "fault", symbol.alias("symbol")).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return staged(laid.drop("copy"), "order")


def chunked(laid: DataFrame) -> DataFrame:
    """One row for at most 2^CHUNK_BITS successive rows of a conversation: their symbols, counts, turns and initials, and the first row's place in the order."""
    rows = F.array_sort(F.collect_list(F.struct("at", "turn", "role", "digest", "symbol")))
    n = lambda kind: F.count_if(F.col("fault") == kind).alias(kind)
    out = laid.groupBy("conv_id", F.shiftright("at", CHUNK_BITS).alias("chunk")).agg(rows.alias("rows"), n("blank"), n("duplicate"), n("truncated"), F.min("turn").alias("low"), F.max("turn").alias("high"))
    initials = F.transform("rows", lambda r: F.substring(r["role"], 1, 1))
    pairs = F.arrays_zip(F.slice(F.col("initials"), F.lit(1), F.size("initials") - 1).alias("a"), F.slice(F.col("initials"), F.lit(2), F.size("initials") - 1).alias("b"))
    illegal = F.size(F.filter(pairs, lambda p: ~F.concat(p["a"], p["b"]).isin("su", "ua", "au")))
    distinct = F.size(F.array_distinct(F.filter(F.transform("rows", lambda r: r["turn"]), lambda t: t.isNotNull())))
    out = out.withColumn("initials", initials)
    return out.select(
        "conv_id", "chunk", F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("symbols"), "blank", "duplicate", "truncated", illegal.cast("long").alias("illegal"), "low", "high", distinct.cast("long").alias("distinct"),
        F.element_at("initials", 1).alias("head"), F.element_at("initials", -1).alias("tail"), F.col("rows")[0]["turn"].alias("turn"), F.col("rows")[0]["role"].alias("role"), F.col("rows")[0]["digest"].alias("digest"))


def scanned(items: DataFrame, start: int, backward: bool) -> DataFrame:
    """(conv_id, i, given) for items(conv_id, i, map array<int>): what the maps of all earlier (backward: later) items of the conversation make of `start`.

    Maps are composed by groups of 2^CHUNK_BITS, group numbers again, until each conversation has one group; then each
    group hands its own given value down to its members.
    """

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maps = []
            for rows in b.column("rows").to_pylist():
                m = np.arange(len(rows[0]["map"]))
                for r in reversed(rows) if backward else rows:
                    m = np.array(r["map"])[m]
                maps.append(m.tolist())
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("up"), pa.array(maps, pa.list_(pa.int32()))], ["conv_id", "i", "map"])

    def handed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            conv, at, given = [], [], []
            for c, rows, g in zip(*(b.column(x).to_pylist() for x in ("conv_id", "rows", "given")), strict=True):
                for r in reversed(rows) if backward else rows:
                    conv.append(c), at.append(r["i"]), given.append(g)
                    g = r["map"][g]
            yield pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(at, pa.int64()), pa.array(given, pa.int32())], ["conv_id", "i", "given"])

    grouped = lambda x: x.groupBy("conv_id", F.shiftright("i", CHUNK_BITS).alias("up")).agg(F.array_sort(F.collect_list(F.struct("i", "map"))).alias("rows"))
    levels = [items]
    while True:
        several = levels[-1].groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        if not several:
            break
        levels.append(staged(grouped(levels[-1]).mapInArrow(composed, "conv_id long, i long, map array<int>"), "maps"))
    given = levels[-1].select("conv_id", "i", F.lit(start).cast("int").alias("given"))
    for level in reversed(levels[:-1]):
        g = given.select(F.col("conv_id").alias("c"), F.col("i").alias("p"), "given")
        met = grouped(level).join(g, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("p"))).select("conv_id", "rows", "given")
        given = staged(met.mapInArrow(handed, "conv_id long, i long, given int"), "given")
    return given


def _vector_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("chunk"), pa.array([mapped(x) for x in b.column("symbols").to_pylist()], pa.list_(pa.int32()))], ["conv_id", "i", "map"])


def _state_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        maps = []
        for text, after in zip(b.column("symbols").to_pylist(), b.column("after").to_pylist(), strict=True):
            behind, _ = swept(text, after)
            maps.append([traced(text, s, behind, False)[1] for s in range(STATES)])
        yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("chunk"), pa.array(maps, pa.list_(pa.int32()))], ["conv_id", "i", "map"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        edits, costs = [], []
        for text, after, state, last in zip(*(b.column(x).to_pylist() for x in ("symbols", "after", "state", "last")), strict=True):
            behind, _ = swept(text, after)
            e, _, cost = traced(text, state, behind, last)
            edits.append(e), costs.append(cost)
        kept = [n for n in b.schema.names if n not in ("symbols", "after", "state", "last")]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in kept), pa.array(edits, pa.string()), pa.array(costs, pa.int64())], [*kept, "edits", "cost"])


class _Conversation:
    """What is known of a conversation while its chunks and rows pass: sums, edits that wait for their rows, and the running hash."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.sums = conv_id, dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost", "distinct"), 0)
        self.low = self.high = self.tail = None
        self.audit, self.waiting, self.at, self.state = [], "", 0, NOTHING
        self.sha, self.begun = hashlib.sha256(), False

    def chunk(self, r: dict) -> None:
        for k in self.sums:
            self.sums[k] += r[k]
        if self.tail is not None:
            self.sums["illegal"] += self.tail + r["head"] not in ("su", "ua", "au")
        if r["low"] is not None:
            self.sums["distinct"] -= r["low"] == self.high  # a turn that both chunks hold
            self.low = r["low"] if self.low is None else self.low
            self.high = r["high"]
        self.tail = r["tail"]
        self.audit.append(r["edits"])
        self.waiting, self.at = self.waiting[self.at :] + r["edits"], 0

    def put(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.begun else "") + f"{role}:{text}").encode())
        self.begun = True

    def turned(self, text: str) -> None:
        self.state = NEXT[self.state]
        self.put("user" if self.state == ASKED else "assistant", text)

    def inserts(self) -> None:
        while self.waiting[self.at : self.at + 1] == "I":
            self.at += 1
            self.turned("")

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.waiting[self.at]
        self.at += 1
        if edit == "K":
            self.state = kept_state(self.state, role[:1])
            self.put(role, text)
        elif edit == "R":
            self.turned(text)

    def result(self) -> tuple:
        self.inserts()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.sums["distinct"]
        return (self.conv_id, gaps, *(self.sums[k] for k in ("blank", "duplicate", "truncated", "illegal", "cost")), "".join(self.audit), self.sha.hexdigest())


RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come conversation by conversation in its order, a chunk's summary before its rows; of a conversation only edits not yet used, the audit and a hash are held."""
    now, done, names = None, [], [x.split()[0] for x in RESULT.split(", ")]

    def out() -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names)
        done.clear()
        return made

    for b in batches:
        for r in b.to_pylist():
            if now is None or now.conv_id != r["conv_id"]:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(r["conv_id"])
            if r["kind"] == 0:
                now.chunk(r)
            else:
                for _ in range(r["copies"]):
                    now.row(r["role"], r["text"])
        if len(done) > 1000:
            yield out()
    if now is not None:
        done.append(now.result())
    if done:
        yield out()


def repair(conversations: DataFrame) -> DataFrame:
    """RESULT for each conv_id (null is one) of conversations(conv_id, turn, role, text): faults after damage, and the cheapest edits to system?, then user and assistant in turn.

    Null roles and texts count as one space. Rows of a conversation come by turn (null first), rows of one turn by role
    and by their text's sha256; equal rows are duplicates of the first. A conversation of which no row is left after
    damage has zeros, an empty audit and the hash of nothing. Roles count by their first character, case-sensitively; an
    empty or null role has none of s, u, a. Texts of any length pass as they are. Other columns are not read. An empty
    table gives an empty result.

    Rows without texts are ordered by ranges and cut into chunks of 2^CHUNK_BITS; the cost vector behind each chunk and
    the state in front of it come from composing the chunks' maps (see scanned), for conversations of several chunks
    alone. Texts are then hashed in a stream of rows sorted by conversation: sha256 has to see a conversation's rows in
    one order, and nothing of them is kept.
    """
    rows = damaged(conversations)
    chunks = staged(chunked(ordered_rows(rows)), "chunks")
    ends = chunks.groupBy(F.col("conv_id").alias("c")).agg(F.max("chunk").alias("end"), F.count("*").alias("n"))
    same = F.col("conv_id").eqNullSafe(F.col("c"))
    several = staged(chunks.select("conv_id", "chunk", "symbols").join(ends.where("n > 1"), same).drop("c", "n"), "several")
    after = scanned(several.select("conv_id", "chunk", "symbols").mapInArrow(_vector_maps, "conv_id long, i long, map array<int>"), 0, True).select(F.col("conv_id").alias("c"), F.col("i").alias("k"), F.col("given").alias("after"))
    here = same & (F.col("chunk") == F.col("k"))
    behind = staged(several.join(after, here).drop("c", "k"), "behind")
    state = scanned(behind.select("conv_id", "chunk", "symbols", "after").mapInArrow(_state_maps, "conv_id long, i long, map array<int>"), NOTHING, False).select(F.col("conv_id").alias("c"), F.col("i").alias("k"), F.col("given").alias("state"))
    known = staged(behind.join(state, here).select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "after", "state", (F.col("chunk") == F.col("end")).alias("last")), "known")
    met = chunks.join(known, here, "left").drop("c", "k")
    met = met.withColumns({"after": F.coalesce("after", F.lit(0)), "state": F.coalesce("state", F.lit(NOTHING)), "last": F.coalesce("last", F.lit(True))})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in met.schema if f.name not in ("symbols", "after", "state", "last")) + ", edits string, cost long"
    pieces = met.mapInArrow(_edits, schema).withColumns({"kind": F.lit(0), "copies": F.lit(0), "text": F.lit(None).cast("string")})
    texts = rows.select("conv_id", "turn", "role", digest(), "text", "copies", F.lit(1).alias("kind"))
    both = pieces.unionByName(texts, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest", "kind", "chunk")
    return both.mapInArrow(_repaired, RESULT)
