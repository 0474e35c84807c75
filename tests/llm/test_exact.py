"""Operators against brute force over the smallest tables, or against held-out labels."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import DATA
from pyspark.sql import functions as F
from tidewell.llm import lines as L
from tidewell.llm import packing, queries, wordhash

SF = f"{DATA}/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: queries.queries()[name](spark, SF)


def test_near_duplicates(run, docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d in docs:
        w = WORD.findall((d["text"] or "").translate(lower))
        sets[d["doc_id"]] = set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run("op1_minhash_near_dedup").collect()}
    assert got == {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def test_word_hashes_are_positions_free():
    import pyarrow as pa

    texts = ["b a  b", None, "", "a b\tb"]
    sets = list(wordhash.shingle_sets(pa.array(texts), 2))
    assert [len(s) for s in sets] == [2, 0, 0, 2]
    assert len(set(sets[0]) & set(sets[3])) == 1


@pytest.mark.parametrize("name", ["op2_exact_topk", "op6_license_scan"])
def test_sql(run, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    r = c.execute(queries.oracle_sql()[name])
    names = [d[0] for d in r.description]
    got = run(name)
    assert sorted(got.select(*names).collect()) == sorted(r.fetchall())


def test_top_k_over_many_blocks(spark, monkeypatch):
    from tidewell.llm import topk

    monkeypatch.setattr(topk, "BLOCK", 64)
    monkeypatch.setattr(topk, "QUERIES", 8)
    rng = np.random.default_rng(1)
    v = (rng.normal(size=(900, 24)) * rng.gamma(2.0, size=(900, 1))).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    whole = np.floor(1024 * v.astype(np.float64)).astype(np.int64)
    expected = set()
    for q in range(0, 900, 30):
        s = whole @ whole[q]
        best = sorted((-int(s[j]), j) for j in range(900) if j != q)[:10]
        expected |= {(q, k + 1, j, -x) for k, (x, j) in enumerate(best)}
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, every=30).collect()}
    assert got == expected


def test_mix(run, docs):
    size = {d["doc_id"]: len(WORD.findall(d["text"] or "")) for d in docs}
    source = {d["doc_id"]: d["source"] for d in docs}
    total = Counter()
    for i, s in source.items():
        total[s] += size[i]
    names = sorted(total)
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    full = set()
    while True:
        level = (sum(total.values()) - sum(3 * total[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and level * weight[s] > 3 * total[s]}
        if not over:
            break
        full |= over
    target = {s: 3 * total[s] if s in full else level * weight[s] for s in names}
    rows = run("op3_mixing").collect()
    taken = Counter()
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.source_size == total[source[r.doc_id]] and r.taken <= 3 * r["size"]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    largest = max(size.values())
    assert all(abs(taken[s] - target[s]) <= largest for s in names)
    assert sorted(rows) == sorted(run("op3_mixing").collect())


def test_targets_stop_at_three_times(spark):
    from tidewell.llm.mixing import targets

    rows = spark.createDataFrame([("a", 1), ("b", 1000), ("c", 2), (None, 997)], "source string, source_size long")
    got = {r.source: r.target for r in targets(rows, (5.0, 2.0, 1.0), 3.0).collect()}
    assert got["a"] == 3 and got["c"] == 6 and sum(got.values()) == pytest.approx(2000)
    assert got["b"] / got[None] == pytest.approx(2 / 5)


def test_quality_counts(run, docs):
    got = {r.doc_id: r for r in run("op7_quality_rules").collect()}
    for d in docs:
        text = d["text"] or ""
        w = WORD.findall(text)
        triples = Counter(zip(w, w[1:], w[2:]))
        under = {j for i in range(len(w) - 2) if triples[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
        seen, again = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        r = got[d["doc_id"]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), again, len(under))
        assert r.base_failed == (len(w) < 50 or 100 * len(under) > 50 * len(w)) and (not r.base_failed or not r.kept)


def test_quality_verdict(run):
    label = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    judged = [(label[r.doc_id], r.kept) for r in run("op7_quality_rules").collect() if r.doc_id in label and not r.base_failed]
    assert all(kept for good, kept in judged if good) and sum(not kept for good, kept in judged if not good) >= 0.9 * sum(not good for good, _ in judged)


def test_packing_round_trip(run, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    ids = {d["doc_id"]: np.array([*t.encode(d["text"] or "", add_special_tokens=False).ids, 1], np.uint32) for d in docs}
    at, sequences = defaultdict(list), defaultdict(list)
    for r in run("op8_packing").collect():
        x = ids[r.doc_id]
        assert r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(x[r.start : r.start + r.length].tobytes())
        at[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, spans in [*at.items(), *sequences.items()]:
        end = 0
        for start, n in sorted(spans):
            assert start == end
            end += n
        assert end <= 2048 or i in at
    assert set(at) == set(ids)
    sizes = [sum(n for _, n in s) for s in sequences.values()]
    assert sum(2048 - n for n in sizes if n & n - 1) <= 0.02 * sum(sizes)


@pytest.mark.parametrize("text", ["Ångström İSTANBUL ΣΑΣ", "é ﬁ", "a\x1cb\x85c\xa0d", "<|endoftext|> x", "don't WON'T 12³ ½", "日本語 text", "", "\x00\x01 a"])
def test_tokenizer_words(text):
    from tokenizers import Tokenizer

    words = packing.Words(queries.tokenizer_path())
    assert words.by_word
    assert words([text])[0].tolist() == Tokenizer.from_file(queries.tokenizer_path()).encode(text, add_special_tokens=False).ids


def test_words_of_another_vocabulary():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    words, text = packing.Words(path), "Don't WON'T  split me by word, 12 é"
    assert not words.by_word and words([text])[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_cuts_are_the_best_ones():
    rng = np.random.default_rng(3)
    for _ in range(50):
        places = np.unique(np.append(rng.choice(np.arange(1, 60), 20, False), range(8, 60, 8)))
        costs = rng.integers(0, 5, len(places))
        best = {0: 0}
        for j, c in zip(places.tolist(), costs.tolist()):
            best[j] = min(best[i] + c + 16 - (j - i) for i in best if 0 < j - i <= 16)
        got = packing.cuts(places, costs, 16)
        cost = dict(zip(places.tolist(), costs.tolist()))
        assert got[-1] == places[-1] and sum(cost[b] + 16 - (b - a) for a, b in zip([0, *got], got)) == best[got[-1]]


def test_pages(run):
    import html

    pages = {r["page_id"]: r["html"] for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    for r in run("op9_html_text").collect():
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", p))).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_page_without_article():
    from tidewell.llm.html import main_text

    good = "This is the text of the page and it is as long as it has to be for the rules to see that it was written by someone. " * 3
    page = f"<div id='top-menu'><a href='/'>Home</a></div><h2>A title</h2><p>{good}</p><p>short one</p><p>{good}</p><div class='comments'><p>{good}</p></div><p><a href='x'>more of this kind</a></p>"
    assert main_text(page) == "\n\n".join(["A title", good.strip(), "short one", good.strip()]) or main_text(page).startswith(good.strip())


def test_line_templates(spark):
    same = "a line of boilerplate text that stands in many documents of this corpus"
    own = [" ".join(chr(97 + (i * 5 + j) % 26) * (2 + (i + j) % 4) for j in range(9)) for i in range(12)]
    rows = [(i, f"{own[i]}\n{same}\nPage {i} of 20 in the report number {i * 7}") for i in range(12)]
    out = {r.row.doc_id: r for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0].new_text == rows[0][1] and out[0].n_dropped == 0
    assert all(out[i].new_text == rows[i][1].split("\n")[0] and out[i].n_dropped == 2 for i in range(1, 12))


def test_toxicity_on_held_out_rows(spark):
    label = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{DATA}/sf0.1/labels.parquet").to_pylist()}
    out = queries.queries()["op10_toxicity"](spark, f"{DATA}/sf0.1").collect()
    held = [(label[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in label]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    hit, false = sum(a and b for a, b in held), sum(b and not a for a, b in held)
    assert hit >= 0.9 * sum(a for a, _ in held) and false <= 0.01 * len(held)


def test_secrets(spark):
    from tidewell.llm.secrets import scan

    hexes = [f"{zlib.crc32(bytes([i])):08x}{zlib.crc32(bytes([i, 1])):08x}{i:02x}" for i in range(40)]
    rows = [(i, f"some words password={h} and more words") for i, h in enumerate(hexes)] + [(100 + i, f"write to name{i}.07@mail{i}.example.com or call 47995678898645{i:02d} now") for i in range(40)]
    out = scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.is_secret for r in out if r.doc_id < 100) and not any(r.is_secret for r in out if r.doc_id >= 100)


def test_quality_score(run, docs):
    """The score by hand, with the same hash of every token and pair from another library."""
    from math import log

    import xxhash
    from tidewell.llm import quality as Q

    good = {r["doc_id"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist() if r["quality"] == 1}
    grams, raw, trusted = {}, Counter(), Counter()
    for d in docs:
        h = [xxhash.xxh64_intdigest(t.encode(), 42) for t in re.findall(Q.TOKEN, d["text"] or "")]
        pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(h, h[1:])]
        g = grams[d["doc_id"]] = [x % Q.BUCKETS for x in h + pairs]
        raw.update(g)
        if d["doc_id"] in good:
            trusted.update(g)
    n, m = sum(raw.values()) + Q.BUCKETS, sum(trusted.values()) + Q.BUCKETS
    got = {r.doc_id: (r.score, r.base_failed, r.kept) for r in run("op7_quality_rules").collect()}
    for i, g in grams.items():
        score, failed, kept = got[i]
        assert (score is None) == (not g) and kept == (not failed and (score or 0) >= Q.THRESHOLD)
        assert not g or abs(score - sum(log((trusted[x] + 1) / m) - log((raw[x] + 1) / n) for x in g) / len(g)) < 1e-4


def test_forest_finds_formats_that_it_was_not_shown(spark):
    """Labelled findings without any of one format: the forest tells them from others by their shape and surroundings."""
    from tidewell.llm import secrets

    rng = np.random.default_rng(5)
    hexes, upper, mixed = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"
    pick = lambda of, n: "".join(rng.choice(list(of), n))
    kinds = {
        "token": lambda: f"some words token = {pick(hexes, 40)} and more", "AKIA": lambda: f"the key AKIA{pick(upper, 16)} of the account", "ghp": lambda: f"ghp_{pick(mixed, 36)} was left here",
        "xox": lambda: f"a hook xoxb-{pick(hexes[:10], 12)}-{pick(mixed, 24)} was left", "sk": lambda: f"charge with sk_live_{pick(mixed, 24)} now", "AIza": lambda: f"maps need AIza{pick(mixed, 35)} to load",
    }
    rows = [(1000 * j + i, f()) for j, f in enumerate(kinds.values()) for i in range(50)]
    rows += [(9000 + i, f"write to name{i}.07@mail{i}.example.com or call 47995678898645{i:03d} now, see https://www.example.com/archive/20{i:02d}/page in section12.3.4.5.6.7 of version-2024.11.{i}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets.with_features(secrets.candidates(docs), docs).cache()
    told = secrets.seed_findings(found)
    for j, kind in enumerate(kinds):
        if kind in ("AKIA", "ghp", "xox"):
            out = secrets.scan(docs, told.where(F.col("doc_id").between(1000 * j, 1000 * j + 999) == F.lit(False))).collect()
            held = [r.is_secret for r in out if r.doc_id // 1000 == j and len(r.value) >= 16]
            clean = [r.is_secret for r in out if r.doc_id >= 9000]
            assert len(held) == 50 and sum(held) >= 45 and sum(clean) <= 0.02 * len(clean)


def test_all_trusted_documents_count(spark, monkeypatch):
    """Labelled good documents beyond what is broadcast are counted all the same."""
    from tidewell.llm import quality

    docs = spark.createDataFrame([(i, f"word{i} again word{i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    whole = quality.log_ratios(docs, labels, 256)
    monkeypatch.setattr(quality, "MAX_BROADCAST", 1)
    assert quality.log_ratios(docs, labels, 256) == whole
