"""Quoted line breaks in folders of CSV files, also across the splits of a file."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from longrec.sources import folders, quoting, reports


def put(path, text):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "200")
    yield
    spark.conf.set(name, before)


def scanned(spark, folder, sep=",", required="id"):
    df, skipped = folders.scan_folder(spark, str(folder), required, sep=sep, types={})
    rows = [] if df is None else df.orderBy(*folders.FILE_ORDER).drop("file_start", "file_line").collect()
    by_file = {}
    for r in rows:
        row = r.asDict()
        by_file.setdefault(os.path.basename(row.pop("file")), []).append(row)
    return by_file, {os.path.basename(r["file"]): r["reason"] for r in skipped.collect()}


def test_breaks_inside_quotes(spark, tmp_path):
    put(f"{tmp_path}/a.csv", 'id,note,n\r\n1,"two\r\nlines",5\r\n2,x,6\r\n')
    put(f"{tmp_path}/b.csv", 'id,n\n1,2\n')
    put(f"{tmp_path}/c.csv", '"id","long\nname"\n\n7,"a ""b""\n\n,c"\n8,\n')
    put(f"{tmp_path}/d.csv", 'id,n\n1,"never\n2,3\n')
    put(f"{tmp_path}/e.csv", 'id,n\n1,5" pipe\n2,5"\n3,x "y" z\n')
    put(f"{tmp_path}/f.csv", 'id,n\n1,"a"b\n2,"c"\n')
    got, skipped = scanned(spark, tmp_path)
    rest = {"note": None, "n": None, "long\nname": None}
    assert got == {
        "a.csv": [{**rest, "id": "1", "note": "two\nlines", "n": "5"}, {**rest, "id": "2", "note": "x", "n": "6"}],
        "b.csv": [{**rest, "id": "1", "n": "2"}],
        "c.csv": [{**rest, "id": "7", "long\nname": 'a "b"\n\n,c'}, {**rest, "id": "8"}],
        "e.csv": [{**rest, "id": "1", "n": '5" pipe'}, {**rest, "id": "2", "n": '5"'}, {**rest, "id": "3", "n": 'x "y" z'}],
        "f.csv": [{**rest, "id": "1", "n": '"a"b'}, {**rest, "id": "2", "n": "c"}],
    }
    assert skipped == {"d.csv": "a quoted field never ends"}


@pytest.mark.parametrize("sep", [",", "|"])
def test_random_files(spark, tmp_path, small_splits, sep):
    rng = random.Random(3)
    pieces = ["a", '"', "\n", sep, "bc", " ", '""', "\n\n", "x" * 60]
    wanted = {}
    for k in range(6):
        rows = [["".join(rng.choices(pieces, k=rng.randrange(6))) for _ in range(2)] for _ in range(60)]
        out = io.StringIO()
        writer = csv.writer(out, delimiter=sep, lineterminator="\n")
        writer.writerows([["id", "note"], *([f"r{i}", *r][:2] for i, r in enumerate(rows))])
        put(f"{tmp_path}/f{k}.csv", out.getvalue())
        wanted[f"f{k}.csv"] = [{"id": a, "note": b or None} for a, b in list(csv.reader(io.StringIO(out.getvalue()), delimiter=sep))[1:]]
    got, skipped = scanned(spark, tmp_path, sep)
    assert got == wanted and not skipped


def test_a_long_file_is_cut(spark, tmp_path):
    """The running states are the same where a file is scanned slice by slice."""
    rng = random.Random(5)
    text = "".join(rng.choice(['k,"v\nw"\n', "a,b\n", 'k,"x","y\n"\n', 'k,"\n\n"\n', '"",c\n']) for _ in range(400))
    put(f"{tmp_path}/a.csv", text)
    lines = folders.text_lines(spark, str(tmp_path))
    whole = [quoting.whole_records(lines, ",", split) for split in (None, 50)]
    texts = [[r["line"] for r in records.orderBy(*quoting.FILE_ORDER).collect()] for records, _ in whole]
    assert texts[0] == texts[1] and [next(csv.reader(io.StringIO(t))) for t in texts[0]] == list(csv.reader(io.StringIO(text)))
    assert [unclosed.count() for _, unclosed in whole] == [0, 0]


def test_score_reports_with_breaks(spark, tmp_path):
    put(f"{tmp_path}/r.csv", 'Scale,x\nTotal Score,1,"2\nor so"\nT Score,50\n')
    got = sorted((r["label"], r["position"], r["cell"]) for r in reports.read_labelled_reports(spark, str(tmp_path)).collect())
    assert got == [("T Score", 0, "50"), ("Total Score", 0, "1"), ("Total Score", 1, "2\nor so")]


def test_states_of_a_line(spark):
    cases = {"a,b": 0, 'a,"b': 1, '"a"': 0, '"a""': 1, 'a"b': 0, '"a"x"y,"b': 1, "": 0, '"': 1, '""': 0, '"""': 1, 'a,"b,c",d': 0, None: 0}
    df = spark.createDataFrame([(t, v) for t, v in cases.items()], "line string, wanted int")
    assert df.where(quoting.ends_inside(F.col("line")).cast("int") != F.col("wanted")).count() == 0


def test_lines_are_split_once(spark, tmp_path):
    """Types and filters read the fields as they were written, however many columns there are."""
    put(f"{tmp_path}/a.csv", 'id,note,n\n1,"two\nlines",5\n2,x,6\n')
    df, _ = folders.scan_folder(spark, str(tmp_path), "id")
    assert "regexp_extract_all" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in df.orderBy("id").drop(*folders.FILE_ORDER).collect()] == [(1, "two\nlines", 5), (2, "x", 6)]


def test_many_blocks_and_splits(spark, tmp_path, small_splits):
    """Records that begin blocks and splits earlier keep all of their lines."""
    rows = [[f"r{i}", "\n".join(f"{i} {k}" for k in range(i % 37))] for i in range(120)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    put(f"{tmp_path}/a.csv", out.getvalue())
    for block in (None, 1, 3, 50):
        records, unclosed = quoting.whole_records(folders.text_lines(spark, str(tmp_path)), ",", block)
        got = [next(csv.reader(io.StringIO(r["line"]))) for r in records.orderBy(*quoting.FILE_ORDER).collect()]
        assert got == rows and unclosed.count() == 0
