"""The hash tree, the repair of conversations and the graph search against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest import DATA
from tidewell.llm import graph, merkle, queries, repair

SF = f"{DATA}/sf0.001"
TURNS = "text2 int, conv_id long, turn long, role string, text string, symbols string, chunk long, kind int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def steps(levels, i):
    for level in levels[:-1]:
        run = level[i // 16 * 16 : i // 16 * 16 + 16]
        yield run[: i % 16], run[i % 16 + 1 :]
        i //= 16


def manifest(rows):
    leaf = lambda r, t: sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r.doc_id, r.source, r.lang, r.n_chars, t)))
    sources = sorted({r.source for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    held = {k: sorted((r for r in rows if r.source == k), key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text))) for k in sources}
    trees = {k: tree([leaf(r, r.text) for r in held[k]]) for k in sources}
    top = tree([trees[k][-1][0] for k in sources])
    out = []
    for n, k in enumerate(sources):
        for i, r in enumerate(held[k]):
            path = [*steps(trees[k], i), *steps(top, n)]
            x = trees[k][0][i]
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
                x = leaf(r, None if r.text is None else r.text.translate(str.maketrans(merkle.UPPER, merkle.LOWER)))
            for a, b in path:
                x = sha("".join([*a, x, *b]))
            out.append((r.doc_id, trees[k][0][i], trees[k][-1][0], top[-1][0], sha("".join("".join(a + b) for a, b in path)), x, x == top[-1][0]))
    return sorted(out, key=repr)


def test_manifest(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.queries()["op11_merkle_manifest"](spark, SF)
    assert sorted(map(tuple, got.collect()), key=repr) == manifest(docs.collect())


@pytest.mark.parametrize("n", [0, 1, 2, 17, 300])
def test_manifest_of_odd_rows(spark, n):
    rng = random.Random(n)
    texts = [None, "", "ABC def", "É" * 70, "x" * 100_000, "same"]
    rows = [(rng.choice([None, 5, 7, *range(40)]), rng.choice(texts), rng.choice([None, "en"]), rng.choice([None, "", "b", "ä", "Z", *["hot"] * 9]), rng.choice([None, 3]), i, i, "k", i) for i in range(n)]
    rows += rows[: n // 4]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, idx int, level int, tree string, path int")
    assert sorted(map(tuple, merkle.manifest(docs).collect()), key=repr) == manifest(docs.collect())


def cheapest(symbols):
    """(cost, edits) with the least edits by comparing whole strings."""
    close = lambda row: [min(row[s], (row[n][0] + 5, "I" + row[n][1])) for s, n in enumerate((2, 2, 3, 2))]
    row = [(0, ""), (999, ""), (999, ""), (0, "")]
    row = close(close(close(row)))
    keeps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    for c in reversed(symbols):
        late, new = 5 if c.isupper() else 0, []
        for s, n in enumerate((2, 2, 3, 2)):
            ways = [(row[s][0] + 2, "D" + row[s][1])]
            if c != "x":
                ways.append((row[n][0] + 1 + late, "R" + row[n][1]))
            if c != "x" and (s, c.lower()) in keeps:
                k = keeps[s, c.lower()]
                ways.append((row[k][0] + late, "K" + row[k][1]))
            new.append(min(ways))
        row = close(close(close(new)))
    return row[0]


def test_edits_by_blocks():
    rng = random.Random(3)
    for _ in range(3000):
        symbols = "".join(rng.choice("xsuaoSUAOuaua") for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 8, 9, 13, 33])))
        behind, cost = repair.swept(symbols, 0)
        edits, _, paid = repair.traced(symbols, 0, behind, True)
        assert (cost, edits) == cheapest(symbols) and paid == cost


def repaired(rows):
    blank = lambda x: " " if x is None else x
    out = {}
    for c, t, role, text in sorted(((r.conv_id, r.turn, blank(r.role), blank(r.text)) for r in rows), key=repr):
        kind = zlib.crc32(f"{blank(c)}:{blank(t)}".encode()) % 20
        text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
        out.setdefault(c, []).extend([(t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1))
    done = []
    for c, kept in out.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), bytes.fromhex(sha(r[2]))))
        counts, seen, symbols = {"x": 0, "d": 0, "t": 0}, set(), ""
        for _, role, text in kept:
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            bare = text.strip(" \t\n\x0b\x0c\r")
            if not bare:
                counts["x"] += 1
                letter = "x"
            elif (role, text) in seen:
                counts["d"] += 1
                letter = "x"
            elif bare[-1] not in ".!?":
                counts["t"] += 1
                letter = letter.upper()
            seen.add((role, text))
            symbols += letter
        cost, audit = cheapest(symbols)
        at, lines, state = 0, [], ""
        for e in audit:
            turn = None
            if e != "I":
                turn, at = kept[at], at + 1
            if e == "D":
                continue
            state = turn[1][:1] if e == "K" else "a" if state == "u" else "u"
            lines.append(f"{turn[1] if e == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{turn[2] if turn else ''}")
        turns = {t for t, _, _ in kept if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        done.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["x"], counts["d"], counts["t"], illegal, cost, audit, sha("\n".join(lines))))
    return sorted(done, key=repr)


def test_repair(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet")
    got = queries.queries()["op12_conversation_repair"](spark, SF)
    assert sorted(map(tuple, got.collect()), key=repr) == repaired(rows.collect())


@pytest.mark.parametrize("bits", [1, 3, 12])
@pytest.mark.parametrize("n", [0, 1, 400])
def test_repair_of_odd_rows(spark, monkeypatch, bits, n):
    monkeypatch.setattr(repair, "CHUNK_BITS", bits)
    rng = random.Random(n)
    texts = [None, "", " \n", "Yes.", "no", "Well?! \n", "a." * 30_000, "é", "one.", "two"]
    rows = [(1, rng.choice([None, 9, 9, 9, 1, 2, 3]), rng.choice([None, *range(60)]), rng.choice(["user", "assistant", "system", None, "", "tool", "User"]), rng.choice(texts), "u", i, i) for i in range(n)]
    rows += rows[: n // 5]
    got = repair.repair(spark.createDataFrame(rows, TURNS)).collect()
    assert sorted(map(tuple, got), key=repr) == repaired(spark.createDataFrame(rows, TURNS).collect())


def nearest(rows, k, every):
    """Brute force: {(query id, vector): scores and ids}."""
    dim = max(len(v) for _, v in rows)
    m = np.array([list(v) + [0.0] * (dim - len(v)) for _, v in rows])
    out = {}
    for (i, v), q in zip(rows, m, strict=True):
        if i % every == 0:
            s = m @ q
            out[i, tuple(v)] = sorted((-x, j) for x, (j, _) in zip(s.tolist(), rows, strict=True) if j != i)[:k]
    return out


def test_graph_search(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, got = nearest(rows, 20, 20), {}
    for r in queries.queries()["op13_graph_neighbours"](spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {i for i, _ in want} and all([g[0] for g in v] == list(range(1, 21)) for v in got.values())
    found = sum(len({j for _, j in w} & {g[1] for g in got[i]}) for (i, _), w in want.items())
    assert found >= 0.98 * 20 * len(want)


def test_graph_recall_over_shards(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(6000, 32)) * rng.gamma(3.0, size=(6000, 1))
    rows = [(i, v) for i, v in enumerate(m.astype(np.float32).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want, found = nearest(rows, 20, 20), {}
    for r in graph.neighbours(df, shard=1500).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = sum(len({j for _, j in w} & found[i]) for (i, _), w in want.items())
    assert hit >= 0.9 * 20 * len(want)


def test_graph_search_of_odd_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (20, [1.0, 0.5], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1), (5, [], 1), (6, [0.0, 0.0], 1), (8, [1.0], 1), (7, [2.0, 2.0], 1), (7, [2.0, 2.0], 1)]
    rows += [(9, [1.5, 0.0], 1)] * 60 + [(40 + i, [1.5, 0.0], 1) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = [(r["rank"], r.vec_id, r.score) for r in graph.neighbours(df, k=4).where("query_id = 0").orderBy("rank").collect()]
    assert got == [(1, 7, 3.0), (2, 7, 3.0), (3, 9, 1.5), (4, 9, 1.5)]
    lone = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in graph.neighbours(lone).collect()] == [(0, 1, 1, 2.0)]
    assert graph.neighbours(df.limit(0)).count() == 0 and graph.neighbours(lone.where("vec_id = 1")).count() == 0
