"""CSV records against Python's reader, under different splits, and what becomes of broken rows."""

import csv
import io
import random

import pytest

from sluice.sources import csv_records, csv_text

PIECES = ["a", "b c", ",", '"', "\n", "\r\n", "é", "", "5 ft", "NA", '""', "\n\n", '",', ' "x" ', "|"]


def table(draw, rows, width=4):
    return [["".join(draw.choice(PIECES) for _ in range(draw.randrange(6))) for _ in range(width)] for _ in range(rows)]


def clean(cell):
    cell = cell.strip(" \t\r\n")
    return None if cell in ("", "NA") else cell


def write(path, rows, end="\r\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL).writerows(rows)
    return str(path)


@pytest.fixture
def splits(spark):
    """Sets the size of splits; small ones cut cells in the middle."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    yield lambda size: [spark.conf.set(n, str(size)) for n in names]
    for n, v in before.items():
        spark.conf.set(n, v)


def cells(scan):
    return [[r[f"c{i}"] for i in range(len(scan.header))] for r in scan.rows.orderBy("_rid").collect()]


@pytest.mark.parametrize("end", ["\r\n", "\n"])
def test_cells_survive_any_split(spark, tmp_path, splits, end):
    header = ["a", "b\nlong, name", 'c "q"', "a"]
    rows = table(random.Random(3), 300)
    # A cell longer than many splits, and one that ends with its file.
    rows[7][1] = "long\n" * 400 + '"' * 7
    rows[-1][3] = "end,\n\nof file"
    path = write(tmp_path / "x.csv", [header, *rows], end)
    wanted = [[clean(x) for x in r] for r in rows]
    seen = set()
    for size in (1 << 27, 4000, 137):
        splits(size)
        scan = csv_records.scan(spark, path)
        assert scan.header == header and scan.problems.isEmpty()
        assert cells(scan) == wanted
        seen.add(tuple(r["_rid"] for r in scan.rows.orderBy("_rid").select("_rid").collect()))
    assert len(seen) == 1  # identities do not depend on splits
    assert csv_records._lines(spark, path).rdd.getNumPartitions() > 20


def test_several_files_and_blank_lines(spark, tmp_path, splits):
    splits(64)
    folder = tmp_path / "many.csv"
    folder.mkdir()
    draw = random.Random(4)
    want = []
    for i in range(3):
        rows = table(draw, 40)
        want += [[clean(x) for x in r] for r in rows]
        write(folder / f"part-{i}.csv", [["a", "b", "c", "d"], *rows], "\n")
    with open(folder / "part-1.csv", "a") as out:
        out.write("\n  \n\n")
    scan = csv_records.scan(spark, str(folder))
    got = cells(scan)
    assert got == want and scan.rows.select("_rid").distinct().count() == len(want)


def test_broken_rows_are_counted(spark, tmp_path, splits):
    text = '﻿uid,b,c\n1,x,y\n2,x\n3,x,y,z,"u,\nv"\n4,5" tall,"6"" wide"\n,,\n5,"a\nb",c\n6,"open,c\n7,x,y\n'
    path = tmp_path / "broken.csv"
    path.write_text(text, encoding="utf-8")
    for size in (1 << 27, 16):
        splits(size)
        scan = csv_records.scan(spark, str(path))
        assert scan.header == ["uid", "b", "c"]
        assert cells(scan) == [["1", "x", "y"], ["4", '5" tall', '6" wide'], [None, None, None], ["5", "a\nb", "c"]]
        problems = {(r.problem, r.n_cells if r.problem != "unclosed" else 0) for r in scan.problems.collect()}
        assert problems == {("short", 2), ("long", 5), ("unclosed", 0)}
        assert set(scan.problems.columns) == {"rid", "problem", "n_cells", "n_chars"}  # no text of theirs


def test_empty_files(spark, tmp_path):
    for name, text, header in (("none", "", []), ("header", "a,b\n", ["a", "b"])):
        (tmp_path / name).write_text(text)
        scan = csv_records.scan(spark, str(tmp_path / name))
        assert scan.header == header and scan.rows.isEmpty() and scan.problems.isEmpty()


def test_second_export(spark, tmp_path):
    path = write(tmp_path / "second.csv", [["UID ", "Fac ility", "z"], ["1", "h\n2", "q"], ["2", None, "q"]])
    got = csv_text.scan_columns(spark, path, ["uid", "facility"])
    assert sorted(map(tuple, got.collect())) == [("1", "h\n2"), ("2", None)]
    assert csv_text.scan_columns(spark, path, ["uid", "nothere"]) is None


def test_counts_match_python(spark):
    lines = ['a,"b",c', '"a', 'b"', '"a""b","c,d"', '5" x,"y"', '""', '"",""', '"""a"""', 'x,"', '",y']
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = [r[0] for r in df.orderBy("i").select(csv_records.edge_quotes(df.line)).collect()]
    assert got == [2, 1, 1, 4, 2, 0, 0, 2, 1, 1]
    whole = [x for i, x in enumerate(lines) if got[i] % 2 == 0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(whole)], "i int, line string")
    counts = [r[0] for r in df.orderBy("i").select(csv_records.cell_count(df.line)).collect()]
    assert counts == [len(next(csv.reader(io.StringIO(x)))) for x in whole]
