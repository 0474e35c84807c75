"""Line dedup by a log-template tree (He et al., "Drain: An Online Log Parsing Approach with Fixed Depth Tree", 2017).

A line goes down the tree by its number of tokens and its leading tokens, tokens with a digit being variable fields.
In each leaf, the line of the most documents is the first template, and lines that agree with it in most places join it;
of the others the line of the most documents is the next template, until every line has one. Templates that recur
across documents are dropped, whatever the length of their lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .shared import discard, semi_join, staged
from .wordhash import Hasher, M3, chunks, mix, powers, spans

#: Leading tokens that the tree looks at, and the share of equal tokens that joins a line to a template of its leaf.
DEPTH, SIMILAR = 3, 0.7
VARIABLE = np.uint64(0x7FB5D329728EA185)


LINE = ("doc_id", "text_hash", "leaf", "line", "row")
LINES = "doc_id long, text_hash long, leaf long, line long, row long"
#: A line in more documents than that is looked up by broadcast rather than by a shuffle, as are all where no more than so many lines recur.
COMMON, FEW = 1 << 16, 1 << 20


def parsed(b: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a run of texts, for every line: its text, first byte, tokens, leaf, hash; and the token hashes with each line's first one."""
    newline = np.flatnonzero(b == 10) + 1
    begin = np.unique(np.concatenate([off[:-1], newline[newline < len(b)]]))
    start, end = spans(b, off)
    digit = np.concatenate([[0], np.cumsum((b >= 48) & (b <= 57))])
    line = np.searchsorted(begin, start, "right") - 1
    n = np.bincount(line, minlength=len(begin))
    # a line of variable fields only has nothing else that could recur: it counts as it is
    field = digit[end] > digit[start]
    field &= np.bincount(line[~field], minlength=len(begin))[line] > 0
    h = np.where(field, VARIABLE, Hasher(b)(start, end))
    first = np.concatenate([[0], np.cumsum(n)])
    p, q = powers(1 << max(20, int(len(h) + 1).bit_length()))
    with np.errstate(over="ignore"):
        c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * p[: len(h)], dtype=np.uint64)])
        whole = mix((c[first[1:]] - c[first[:-1]]) * q[first[:-1]] + n.astype(np.uint64) * M3)
        leaf = n.astype(np.uint64)
        padded = np.concatenate([h, np.zeros(DEPTH, np.uint64)])
        for d in range(DEPTH):
            leaf = mix(leaf * M3 + np.where(n > d, padded[np.minimum(first[:-1] + d, len(padded) - 1)], np.uint64(0)))
    doc = np.searchsorted(off, begin, "right") - 1
    return doc, begin, n, leaf, whole, h, first


def _lines(batches: Iterator[pa.RecordBatch], toks: bool) -> Iterator[pa.RecordBatch]:
    """One row for each distinct line with a token of each text (doc_id, text, its hash): LINES, row being the text's number, and the tokens' short hashes if toks."""
    from pyspark import TaskContext

    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        for i, j, b, off in chunks(batch.column(1)):
            doc, _, n, leaf, whole, h, first = parsed(b, off)
            with np.errstate(over="ignore"):
                _, at = np.unique(mix(whole + doc.astype(np.uint64) * M3), return_index=True)
            at = np.sort(at[n[at] > 0])
            short = (h >> np.uint64(32)).astype(np.uint32)
            columns = [*(batch.column(c).slice(i, j - i).take(pa.array(doc[at])) for c in (0, 2)), pa.array(leaf[at].view(np.int64)), pa.array(whole[at].view(np.int64)), pa.array(row + i + doc[at])]
            if toks:
                columns.append(pa.array([short[first[x] : first[x + 1]].tobytes() for x in at.tolist()], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, [*LINE, "toks"][: len(columns)])
        row += batch.num_rows


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with the first template of their leaf, or none if they do not agree with it."""
    for batch in batches:
        same = [(np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)).mean() >= SIMILAR for x, y in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True)]
        template = pa.compute.if_else(pa.array(same, pa.bool_()), batch.column(4), pa.scalar(None, pa.int64()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], template], ["leaf", "line", "docs", "toks", "template"])


def _lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines that come leaf by leaf with the first earlier template of the leaf that they agree with; any other line is a new template."""
    leaf, seeds, names = None, np.zeros((0, 0), np.uint32), []
    for batch in batches:
        found = []
        for at, line, toks in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            x = np.frombuffer(toks, np.uint32)
            if at != leaf:
                leaf, seeds, names = at, np.zeros((4, len(x)), np.uint32), []
            same = np.flatnonzero((seeds[: len(names)] == x).mean(1) >= SIMILAR)
            if len(same):
                found.append(names[same[0]])
                continue
            if len(names) == len(seeds):
                seeds = np.concatenate([seeds, np.zeros_like(seeds)])
            seeds[len(names)] = x
            names.append(line)
            found.append(line)
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.int64())], ["line", "template"])


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, total, gone = [], [], []
        drops = batch.column(2)
        for i, j, b, off in chunks(batch.column(1)):
            doc, begin, n, _, whole, _, _ = parsed(b, off)
            keys, raw = whole.view(np.int64), b.tobytes()
            at = np.searchsorted(doc, np.arange(j - i + 1))
            for r in range(j - i):
                x, y = int(off[r]), int(off[r + 1])
                drop = drops[i + r].values
                mine = slice(at[r], at[r + 1])
                bad = np.isin(keys[mine], drop.to_numpy()) & (n[mine] > 0) if drop is not None and len(drop) and x < y else np.zeros(0, bool)
                text = raw[x:y].split(b"\n")
                total.append(len(text) if x < y else 0)
                gone.append(int(bad.sum()))
                if bad.any():
                    text = [t for t, d in zip(text, [*bad.tolist(), *[False] * (len(text) - len(bad))]) if not d]
                texts.append(b"\n".join(text).decode())
        texts = pa.array(texts, pa.string())
        if batch.column(1).null_count:
            texts = pa.compute.if_else(batch.column(1).is_null(), pa.scalar(None, pa.string()), texts)
        yield pa.RecordBatch.from_arrays([*batch.columns[3:], texts, pa.array(total, pa.int64()), pa.array(gone, pa.int64())], [*batch.schema.names[3:], "new_text", "n_lines", "n_dropped"])


def templates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, recurring): the distinct lines of each document, and (line, first_doc) of lines whose template is in several documents."""
    source = docs.selectExpr("cast(doc_id as long) doc_id", "text", "xxhash64(text) text_hash")
    lines = staged(source.mapInArrow(lambda it: _lines(it, False), LINES), "lines")
    counts = lines.groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first"), F.min("row").alias("low"), F.max("row").alias("high"))
    counts = staged(counts, "counts")
    leaves = staged(counts.groupBy("leaf").agg(F.count("*").alias("n"), F.max(F.struct("docs", "line")).alias("top")).where("n > 1").select("leaf", F.col("top.line").alias("template")), "leaves")
    # only leaves of several lines need the lines themselves
    full = semi_join(source.mapInArrow(lambda it: _lines(it, True), LINES + ", toks binary"), leaves, "leaf").groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.first("toks").alias("toks"))
    full = staged(full, "tokens")
    seeds = full.join(leaves.withColumnRenamed("leaf", "l"), F.expr("leaf = l and line = template")).select("leaf", "template", F.col("toks").alias("seed"))
    met = full.join(seeds, "leaf").where("line <> template").select("leaf", "line", "docs", "toks", "template", "seed")
    met = staged(met.mapInArrow(_agree, "leaf long, line long, docs long, toks binary, template long"), "met")
    # what the first template leaves is sorted leaf by leaf; a task holds the templates of one leaf only
    rest = met.where("template is null").select("leaf", "line", "toks", "docs").repartition("leaf").sortWithinPartitions("leaf", F.desc("docs"), F.desc("line"))
    joined = met.where("template is not null").select("line", "template").unionByName(rest.mapInArrow(_lead, "line long, template long"))
    named = counts.select("line", "first", "low", "high", "docs").join(joined, "line", "left").withColumn("template", F.coalesce("template", "line"))
    named = staged(named, "named")
    discard(counts, full, leaves, met)
    often = named.groupBy("template").agg(F.min("first").alias("first_doc"), F.min("low").alias("low"), F.max("high").alias("high"))
    often = often.where("low < high").select("template", "first_doc")
    recurring = staged(named.select("line", "template", "docs").join(often, "template").select("line", "first_doc", "docs"), "recurring")
    return lines, recurring


def occurrences(lines: DataFrame, recurring: DataFrame) -> DataFrame:
    """lines with first_doc, where they recur; no task gets all occurrences of a common line.

    Fewer than FEW lines can stand in more than a share of 1 / FEW of all occurrences, so that what is broadcast has
    fewer than FEW rows at any size, and no other line has more than that share.
    """
    n, held = recurring.agg(F.count("*"), F.coalesce(F.sum("docs"), F.lit(0))).first()
    if n <= FEW:
        return lines.join(F.broadcast(recurring), "line")
    most = max(COMMON, held // FEW)
    common, rare = recurring.where(F.col("docs") > most), recurring.where(F.col("docs") <= most)
    common = F.broadcast(common)
    return lines.join(common, "line", "left_anti").join(rare, "line").unionByName(lines.join(common, "line"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """(row, new_text, n_lines, n_dropped) for each row of docs: its columns but the text, and the text without recurring lines.

    Lines end at \\n; tokens are runs of bytes other than 0x20 and 0x09-0x0D. A line with a token belongs to a template
    (see above); a template that is in two documents or more, however short, is dropped from all but the one of the
    smallest doc_id, so that something of each group of copies stays. Other lines stay as they are, in their order,
    as do lines without a token.

    A null text stays null, an empty one empty, with no lines. Rows that share a doc_id count as documents each and lose
    the same lines; rows without doc_id take part, and lose every recurring line that a row with doc_id has. Lines of
    any length count whole. Extra columns pass through. An empty table gives an empty result.
    """
    lines, recurring = templates(docs)
    # by id and text, so that an array holds lines of one text only, also of rows without doc_id
    drop = (
        occurrences(lines.select("doc_id", "text_hash", "line"), recurring).where("not (doc_id <=> first_doc)")
        .groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__of")).agg(F.collect_set("line").alias("__drop"))
    )
    rest = [c for c in docs.columns if c != "text"]
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row"), F.col("doc_id").cast("long").alias("__id"), "text").withColumn("__text", F.xxhash64("text"))
    both = row.join(drop, F.expr("__id <=> __doc and __text = __of"), "left").select("__id", "text", "__drop", "row")
    schema = StructType([StructField("row", docs.select(*(f"`{c}`" for c in rest)).schema), StructField("new_text", StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    return both.mapInArrow(_without, schema)
