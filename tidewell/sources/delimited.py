"""Delimited files read by many tasks, however large one is and wherever its quoted line breaks lie."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.scratch import written

#: Bytes of the table of splits up to which it is broadcast.
MOST = 64 << 20
#: Bytes of small splits that one task reads, one after another.
TASK_BYTES = 32 << 20


class Record:
    """One record that lines are fed to until it ends: its cells, the pieces of a quoted cell that is still open, and whether text follows a closing quote."""

    __slots__ = ("bad", "cells", "parts")

    def __init__(self, parts: list[str] | None = None):
        self.cells, self.parts, self.bad = [], parts, False

    def feed(self, line: str, delimiter: str) -> bool:
        """Whether the record ends with this line. Every character is looked at once."""
        i = 0 if self.parts is None else self._quoted(line, 0, delimiter)
        while 0 <= i <= len(line):
            if line[i : i + 1] == '"':
                self.parts = []
                i = self._quoted(line, i + 1, delimiter)
                continue
            end = line.find(delimiter, i)
            if end < 0:
                self.cells.append(line[i:].removesuffix("\r"))
                break
            self.cells.append(line[i:end])
            i = end + 1
        return i >= 0

    def _quoted(self, line: str, i: int, delimiter: str) -> int:
        """Reads on in a quoted cell: where the next cell begins, past the line's end if there is none, or -1 if the cell stays open."""
        j = line.find('"', i)
        while j >= 0 and line[j + 1 : j + 2] == '"':
            j = line.find('"', j + 2)
        if j < 0:
            self.parts += [line[i:], "\n"]
            return -1
        self.parts.append(line[i:j])
        self.cells.append("".join(self.parts).replace('""', '"'))
        self.parts = None
        end = line.find(delimiter, j + 1)
        end = len(line) if end < 0 else end
        self.bad |= bool(line[j + 1 : end].strip())
        return end + 1


def _blocks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[bool, tuple, list[str]]]:
    """Runs of lines of one split as (whether the split begins, the values of columns, lines), and an end mark without columns."""
    now = None
    for b in batches:
        if not b.num_rows:
            continue
        files, starts, lines = (b.column(n).to_pylist() for n in ("file", "block", "value"))
        cuts = [0, *(i for i in range(1, len(lines)) if starts[i] != starts[i - 1] or files[i] != files[i - 1]), len(lines)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            here = (files[a], starts[a])
            yield here != now, tuple(b.column(n)[a].as_py() for n in columns), lines[a:z]
            now = here
    yield True, (), []


def _surveyed(batches: Iterator[pa.RecordBatch], delimiter: str) -> Iterator[pa.RecordBatch]:
    """A row for each split: the records that begin in it, and whether it ends inside quotes, if it begins outside (0) or inside (1) of them; of a file's first split also the header's cells."""
    names = ["file", "block", "n0", "n1", "open0", "open1", "header"]
    now = None
    for fresh, at, lines in _blocks(batches, ("file", "block")):
        if fresh:
            if now is not None:
                values = [*now, counts[0], counts[1], ways[0] is not None, ways[1] is not None, header]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)
            # a way is the record that a line goes on, or none if it begins one
            now, counts, ways, header = at, [0, 0], [None, Record([])], None
            top = Record() if at and at[1] == 0 else None
            if top is not None:
                lines[0] = lines[0].removeprefix("\ufeff")
        for line in lines:
            if top is not None and top.feed(line, delimiter):
                header, top = top.cells, None
            for w in (0, 1):
                record = ways[w]
                if record is None:
                    counts[w] += 1
                    if '"' not in line:
                        continue
                    record = Record()
                elif '"' not in line:
                    continue
                ways[w] = None if record.feed(line, delimiter) else record
                if ways[w] is not None:
                    ways[w].cells, ways[w].parts = [], []


def _judged(record: Record, names: list[str], wrong: str | None, max_cell: int) -> str | None:
    if wrong is not None:
        return wrong
    if record.bad or record.parts is not None:
        return "ING_MANAGED_CSV_INVALID"
    if len(record.cells) > len(names):
        return "ING_DELIMITED_TOO_MANY_FIELDS"
    return "ING_MANAGED_CELL_TOO_LONG" if max(map(len, record.cells)) > max_cell else None


ROW = "file string, ordinal long, cells array<string>, names array<string>, error_code string"


def _rows(held: list[tuple], one_header: bool) -> pa.RecordBatch:
    """Rows of ROW with no more cells than there are names; names only where files have their own."""
    file, ordinal, cells, names, code = zip(*held, strict=True)
    held.clear()
    text = pa.list_(pa.string())
    cells = [c[: len(n)] for c, n in zip(cells, names, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(file, pa.string()), pa.array(ordinal, pa.int64()), pa.array(cells, text), pa.array([None] * len(cells) if one_header else names, text), pa.array(code, pa.string())],
        ["file", "ordinal", "cells", "names", "error_code"])


def _parsed(batches: Iterator[pa.RecordBatch], delimiter: str, max_cell: int, one_header: bool) -> Iterator[pa.RecordBatch]:
    """The records that begin and end in one split, but for headers."""
    held, size = [], 0
    for fresh, at, lines in _blocks(batches, ("file", "block", "open", "base", "names", "wrong")):
        if fresh:
            if not at:
                break
            file, block, is_open, ordinal, names, wrong = at
            record, own = (Record([]), False) if is_open else (None, True)
            if block == 0:
                lines[0] = lines[0].removeprefix("\ufeff")
        for line in lines:
            if record is None:
                record, own = Record(), True
            if not record.feed(line, delimiter):
                if not own:
                    record.parts = []  # pieces() has the text
                continue
            if own:
                if ordinal:
                    held.append((file, ordinal, record.cells, names, _judged(record, names, wrong, max_cell)))
                    size += len(record.cells)
                ordinal += 1
            record = None
        if size > 100_000 or len(held) > 10_000:
            yield _rows(held, one_header)
            size = 0
    if held:
        yield _rows(held, one_header)


def _pieces(batches: Iterator[pa.RecordBatch], delimiter: str, most: int) -> Iterator[pa.RecordBatch]:
    """(file, block, ordinal, text, chars) of the lines at a split's begin and end that belong to a record of several splits; no text beyond `most` characters."""
    names = ["file", "block", "ordinal", "text", "chars"]
    now, out = None, []

    def kept():
        text = "\n".join(lines_of)
        out.append((now[0], now[1], number, text if size <= most else None, size))

    for fresh, at, lines in _blocks(batches, ("file", "block", "open", "base")):
        if fresh:
            if now is not None and record is not None:
                kept()  # not ended here
            if not at:
                break
            now = at
            number = at[3] - 1 if at[2] else at[3]
            record, lines_of, size = (Record([]), [], 0) if at[2] else (None, [], 0)
            across = at[2]
            if at[1] == 0:
                lines[0] = lines[0].removeprefix("\ufeff")
        for line in lines:
            if record is None:
                record, lines_of, size = Record(), [], 0
            size += len(line) + 1
            if size <= most:
                lines_of.append(line)
            if not record.feed(line, delimiter):
                record.cells, record.parts = [], []
                continue
            if across:
                kept()
            across, record, number = False, None, number + 1
    if out:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _stitched(batches: Iterator[pa.RecordBatch], delimiter: str, max_cell: int, one_header: bool) -> Iterator[pa.RecordBatch]:
    """Records whose pieces lay in several splits; without text they are longer than any may be."""
    for b in batches:
        held = []
        for r in b.to_pylist():
            record = Record()
            if r["text"] is not None:
                for line in r["text"].split("\n"):
                    if record.feed(line, delimiter):
                        break
            code = r["wrong"] or ("ING_MANAGED_CELL_TOO_LONG" if r["text"] is None else _judged(record, r["names"], None, max_cell))
            held.append((r["file"], r["ordinal"], record.cells, r["names"], code))
        if held:
            yield _rows(held, one_header)


def gathered(lines: DataFrame) -> DataFrame:
    """lines with several small splits in a task, where there are more splits than a few for each core: the number of tasks grows with bytes, not with splits."""
    spark = lines.sparkSession
    number, unit = re.match(r"(\d+)([kmgt]?)", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    parts, size = lines.rdd.getNumPartitions(), int(number) << 10 * " kmgt".index(unit or " ")
    return lines.coalesce(max(4 * spark.sparkContext.defaultParallelism, parts * min(size, TASK_BYTES) // TASK_BYTES))


def splits(lines: DataFrame, delimiter: str, max_columns: int, same_header: bool) -> tuple[DataFrame, list[str]]:
    """A staged row for each split (file, block) of the lines: whether it begins (open) and ends (shut is false) inside quotes, the number of its first record (base), its file's names, and what is wrong with them; and the first file's names.

    A split does one of four things to being inside quotes: it ends outside, it ends inside, it leaves it or it turns it.
    So the last split before that ends the same way from both, and the number of turns since, tell how a split begins.
    """
    schema = "file string, block long, n0 long, n1 long, open0 boolean, open1 boolean, header array<string>"
    told = lines.sparkSession.read.schema(schema).parquet(written(lines.mapInArrow(lambda it: _surveyed(it, delimiter), schema), "splits"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("open0") & ~F.col("open1")).cast("int")
    told = told.withColumn("turns", F.sum(turns).over(Window.partitionBy("file").orderBy("block")))
    fixed = F.max(F.when(F.col("open0") == F.col("open1"), F.struct("block", "open0", "turns"))).over(before)
    told = told.withColumn("fixed", fixed).withColumn("so_far", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    since = F.col("so_far") - F.coalesce("fixed.turns", F.lit(0))
    told = told.withColumn("open", F.coalesce("fixed.open0", F.lit(False)) != (since % 2 == 1))
    told = told.withColumn("n", F.when(F.col("open"), F.col("n1")).otherwise(F.col("n0"))).withColumn("shut", ~F.when(F.col("open"), F.col("open1")).otherwise(F.col("open0")))
    told = told.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("names", F.first("header", ignorenulls=True).over(Window.partitionBy("file")))
    clean = F.transform("names", lambda c: F.trim(c))
    told = told.withColumn("names", clean)
    bad = F.col("names").isNull() | F.exists("names", lambda c: c == "") | (F.size(F.array_distinct("names")) < F.size("names")) | (F.size("names") > max_columns)
    told = told.select("file", "block", "open", "shut", "base", "names", bad.alias("bad"))
    told = lines.sparkSession.read.schema(told.schema).parquet(written(told, "splits"))
    first = told.orderBy("file", "block").select("names", "bad").first()
    if first is None or (same_header and first.bad) or (not same_header and not told.where("not bad").limit(1).count()):
        raise ValueError("ING_MANAGED_HEADER_INVALID")
    # one literal instead of an expression for each of many names
    own = F.from_json(F.lit(json.dumps(first.names)), "array<string>") if same_header else F.when(F.col("bad"), F.array().cast("array<string>")).otherwise(F.col("names"))
    other = F.col("bad") | ~F.col("names").eqNullSafe(own) if same_header else F.col("bad")
    return told.withColumn("wrong", F.when(other, "ING_MANAGED_HEADER_INVALID")).withColumn("names", own).drop("bad"), first.names


def read_delimited(spark: SparkSession, path: str, delimiter: str = ",", max_cell: int = 32_767, max_columns: int = 1024, same_header: bool = True) -> DataFrame:
    """(file, ordinal, payload, error_code): rows of delimited files with a unique header, numbered from 1 within their file.

    Records end at line feeds outside quotes, with or without a carriage return; an empty line is a record of one empty
    cell. A row with more fields than the header has ING_DELIMITED_TOO_MANY_FIELDS, one with fewer lacks the keys; an
    empty cell is "". A row in which text follows a closing quote, or whose quotes do not close, has
    ING_MANAGED_CSV_INVALID, one with a cell of more than max_cell characters ING_MANAGED_CELL_TOO_LONG. A file whose
    header is blank in part, not unique or too wide, or does not end in its first split, has ING_MANAGED_HEADER_INVALID in all its rows, and so has one whose
    header differs from the first file's, unless same_header is false: then each file's rows have its own names. If the
    first file's header (or, without same_header, every one) is bad, that is an error here. See release_assets() for
    whole files.

    Files are split by bytes. A first pass tells for each split how it begins, ends and counts if it begins outside and
    if it begins inside quotes; composed over the splits of a file, this gives each one's true begin and first number,
    and the second pass reads it by itself. Records that reach over splits are put together from their pieces; a third
    pass for them is made only where there are any.
    """
    if delimiter not in (",", ";"):
        raise ValueError("ING_MANAGED_DELIMITER_INVALID")
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    lines = gathered(lines)
    told, names = splits(lines, delimiter, max_columns, same_header)
    about = told.agg(F.count("*").alias("n"), F.sum(F.length(F.array_join("names", ",")) + 200).alias("bytes"), F.count_if(F.col("open") | ~F.col("shut")).alias("across")).first()

    def met(told: DataFrame) -> DataFrame:
        # one row a split; where that is too much to send to all tasks, lines are shuffled to their split and sorted again
        if about.bytes <= MOST:
            return lines.join(F.broadcast(told), ["file", "block"])
        numbered = lines.withColumn("line", F.monotonically_increasing_id())
        return numbered.join(told.hint("merge"), ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "line")

    rows = met(told).select("file", "block", "value", "open", "base", "names", "wrong").mapInArrow(lambda it: _parsed(it, delimiter, max_cell, same_header), ROW)
    if not about.across:
        return named(rows, names)
    most = max_columns * (2 * max_cell + 3)
    pieces = met(told.where("open or not shut")).select("file", "block", "value", "open", "base").mapInArrow(lambda it: _pieces(it, delimiter, most), "file string, block long, ordinal long, text string, chars long")
    pieces = spark.read.schema(pieces.schema).parquet(written(pieces, "pieces"))
    sizes = pieces.groupBy("file", "ordinal").agg(F.sum("chars").alias("all"), F.count_if(F.col("text").isNull()).alias("cut"))
    long = sizes.where((F.col("all") > most) | (F.col("cut") > 0)).select("file", "ordinal", F.lit(None).cast("string").alias("text"))
    fit = pieces.join(sizes.where((F.col("all") <= most) & (F.col("cut") == 0)), ["file", "ordinal"])
    whole = fit.groupBy("file", "ordinal").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "\n").alias("text"))
    heads = told.groupBy("file").agg(F.first("names").alias("names"), F.first("wrong").alias("wrong"))
    across = whole.unionByName(long).where("ordinal > 0").join(heads, "file")
    return named(rows.unionByName(across.mapInArrow(lambda it: _stitched(it, delimiter, max_cell, same_header), ROW)), names)


def named(rows: DataFrame, names: list[str]) -> DataFrame:
    """rows of ROW with their cells under their names, which are these where a row has none of its own. Only who reads the payload pays for its maps."""
    own = F.coalesce("names", F.from_json(F.lit(json.dumps(names)), "array<string>"))
    return rows.select("file", "ordinal", F.map_from_arrays(F.slice(own, F.lit(1), F.size("cells")), F.col("cells")).alias("payload"), "error_code")
