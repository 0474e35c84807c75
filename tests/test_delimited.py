"""Delimited files in splits of any size against a reader that takes a file in one piece."""

import random

import pytest
from tidewell.sources import delimited


def one_piece(text, delimiter):
    """(cells, code) of each record, character by character."""
    rows, cells, cell, state, bad = [], [], "", "start", False
    text = text.removeprefix("﻿")
    for c in text if text.endswith("\n") else text + "\n":
        if state == "quoted":
            if c == '"':
                state = "closed"
            else:
                cell += c
        elif state == "closed" and c == '"':
            cell, state = cell + c, "quoted"
        elif c in (delimiter, "\n"):
            cells.append(cell.removesuffix("\r") if c == "\n" and state not in ("closed", "after") else cell)
            cell, state = "", "start"
            if c == "\n":
                rows.append((cells, bad))
                cells, bad = [], False
        elif state in ("closed", "after"):
            bad |= not c.isspace()
            state = "after"
        elif state == "start" and c == '"':
            state = "quoted"
        else:
            cell, state = cell + c, "plain"
    if state == "quoted":
        rows.append((cells, True))
    return rows


def want(text, delimiter, max_cell):
    (names, _), *rows = one_piece(text, delimiter)
    out = {}
    for i, (cells, bad) in enumerate(rows, 1):
        code = "ING_MANAGED_CSV_INVALID" if bad else "ING_DELIMITED_TOO_MANY_FIELDS" if len(cells) > len(names) else "ING_MANAGED_CELL_TOO_LONG" if max(map(len, cells)) > max_cell else None
        out[i] = (dict(zip(names, cells, strict=False)), code)
    return out


def got(df):
    rows = [(r.ordinal, (r.payload, r.error_code)) for r in df.collect()]
    assert len(dict(rows)) == len(rows)
    return dict(rows)


@pytest.mark.parametrize("seed", range(4))
def test_any_split(spark, tmp_path, seed):
    rng = random.Random(seed)
    pieces = ['"', '""', "a", ";", ";", "\n", "\r\n", "é", " ", '"x\ny;z"', '"' + "q" * 40 + '\n\n"', "long" * 12]
    text = "﻿one;two;three\r\n" + "".join(rng.choice(pieces) for _ in range(600))
    text += rng.choice(["", "\n", '"', 'x;"never\nclosed\n'])
    f = tmp_path / "a.csv"
    f.write_bytes(text.encode())
    try:
        for size in ("90b", "900b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            assert got(delimited.read_delimited(spark, str(f), ";", max_cell=60)) == want(text, ";", 60)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_long_cells_in_malformed_rows(spark, tmp_path):
    cell = '"' + 'quoted, "" and\nbroken ' * 1460 + '"'
    f = tmp_path / "a.csv"
    f.write_text(f"a,b\n{cell}\n1,{cell},3\n{cell}x,2\n" + "1,2\n" * 3)
    rows = got(delimited.read_delimited(spark, str(f)))
    assert [rows[i][1] for i in range(1, 7)] == [None, "ING_DELIMITED_TOO_MANY_FIELDS", "ING_MANAGED_CSV_INVALID", None, None, None]
    assert len(rows[1][0]["a"]) > 30_000 and "b" not in rows[1][0]
    f.write_text("a,b\n" + "x" * 40_000 + ",1\n\n")
    assert {k: v[1] for k, v in got(delimited.read_delimited(spark, str(f))).items()} == {1: "ING_MANAGED_CELL_TOO_LONG", 2: None}


def test_splits_that_are_shuffled_to_their_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(delimited, "MOST", 0)
    f = tmp_path / "a.csv"
    f.write_text("a,b\n" + "".join(f'{i},"x\n{i}"\n' for i in range(500)))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        rows = got(delimited.read_delimited(spark, str(f)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows == {i + 1: ({"a": str(i), "b": f"x\n{i}"}, None) for i in range(500)}


def test_files_of_differing_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\nA,Alpha\n")
    (tmp_path / "b.csv").write_text("id,other,more\nB,x,y\n")
    (tmp_path / "c.csv").write_text("id,id\nC,x\n")
    rows = {r.payload.get("id"): (r.payload, r.error_code) for r in delimited.read_delimited(spark, str(tmp_path), same_header=False).collect()}
    assert rows["A"] == ({"id": "A", "name": "Alpha"}, None) and rows["B"] == ({"id": "B", "other": "x", "more": "y"}, None)
    assert [r[1] for r in rows.values() if r[1]] == ["ING_MANAGED_HEADER_INVALID"]
    for text in ("a,a\n1,2\n", "a,\n1,2\n", ",".join(f"c{i}" for i in range(1025)) + "\n1\n"):
        (tmp_path / "d").mkdir(exist_ok=True)
        (tmp_path / "d" / "x.csv").write_text(text)
        with pytest.raises(ValueError, match="ING_MANAGED_HEADER_INVALID"):
            delimited.read_delimited(spark, str(tmp_path / "d"))


def test_small_splits_share_tasks(spark, tmp_path):
    """Tasks grow with the bytes of files, not with the number of their splits."""
    from tidewell.plans.scratch import split_bytes

    (tmp_path / "a.csv").write_text("x\n" + "1\n" * 100_000)
    with split_bytes(spark, 1024):
        lines = spark.read.text(str(tmp_path))
        assert lines.rdd.getNumPartitions() > 100
        assert delimited.gathered(lines).rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
