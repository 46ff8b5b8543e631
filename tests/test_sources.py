import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from longrec.session import broadcast_if_small, collect_small, cut_lineage, shared_dir
from longrec.sources import folders, reports, sinks, tables
from longrec.streaming import jobs, upsert
from longrec.streaming.log import Log


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)
    return str(path)


def test_csv_types_and_null_tokens(spark, tmp_path):
    path = put(f"{tmp_path}/a.csv", 'id,n,x,t,f,e\n1,1,1.5,"a, ""b""",True,\n2,NA,NaN,n/a,False,\n')
    df = tables.read_table(spark, path)
    assert dict(df.dtypes) == {"id": "bigint", "n": "bigint", "x": "double", "t": "string", "f": "boolean", "e": "string"}
    assert rows(df) == [(1, 1, 1.5, 'a, "b"', True, None), (2, None, None, None, False, None)]
    assert {t for _, t in tables.read_text_table(spark, path).dtypes} == {"string"}
    typed = tables.read_table(spark, path, "id int, x double")
    assert rows(typed) == [(1, 1.5), (2, None)]
    assert tables.leading_keys(df, 2) == ["id", "n"]


def test_quoted_line_breaks(spark, tmp_path):
    path = put(f"{tmp_path}/a.csv", 'id,note\n1,"two\nlines"\n2,x\n')
    assert rows(tables.read_text_table(spark, path, multiline=True)) == [("1", "two\nlines"), ("2", "x")]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert rows(tables.nan_to_null(df)) == [(1.0,), (None,)]


def test_folder_scan(spark, tmp_path):
    put(f"{tmp_path}/a.csv", '﻿PIN,Score\r\nA1,1\r\n,\r\n"B, 1",NA\r\n')
    put(f"{tmp_path}/b.csv", "Score,Extra,PIN\n3,x,C1\n")
    put(f"{tmp_path}/c.csv", "PIN,Other\nD1,4\n")
    put(f"{tmp_path}/d.txt", "PIN,Score\nE1,5\n")
    df, skipped = folders.scan_folder(spark, str(tmp_path), "Score")
    got = sorted((r["PIN"], r["Score"], r["Extra"], os.path.basename(r["file"])) for r in df.collect())
    assert got == [("A1", 1, None, "a.csv"), ("B, 1", None, None, "a.csv"), ("C1", 3, "x", "b.csv")]
    assert [os.path.basename(r["file"]) for r in skipped.collect()] == ["c.csv"]
    nothing, skipped = folders.scan_folder(spark, str(tmp_path), "Absent")
    assert nothing is None and skipped.count() == 3


def test_header_of_a_split_file(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "k,v\n" + "".join(f"{i},{i}\n" for i in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert [r["header"] for r in folders.file_headers(spark, str(tmp_path)).collect()] == ["k,v"]
        assert folders.scan_folder(spark, str(tmp_path), "k")[0].count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_file_discovery(spark, tmp_path):
    for name in ("NT01_base.pdf", "nt02_year1.pdf", "XX03_base.pdf", "NT04_base.csv"):
        put(f"{tmp_path}/{name}", "x")
    found = folders.discover_files(spark, str(tmp_path), "NT", "pdf")
    assert sorted((r["subject"], r["visit"]) for r in found.collect()) == [("NT01", "base"), ("nt02", "year1")]
    assert [r["subject"] for r in folders.discover_files(spark, str(tmp_path), "NT", "pdf", ["NT01"]).collect()] == ["NT01"]
    os.utime(f"{tmp_path}/NT01_base.pdf", (time.time() - 86400 * 40,) * 2)
    recent = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(time.time() - 86400))
    late = folders.discover_files(spark, str(tmp_path), "NT", "pdf", modified_after=recent)
    assert [r["subject"] for r in late.collect()] == ["nt02"]


def test_semicolon_reports(spark, tmp_path):
    put(f"{tmp_path}/AB12_s1_job000123/report.csv", "Age;Sex;Brainstem\n40;F;1.5\n")
    put(f"{tmp_path}/ab13_s2_job000124/report.csv", "Sex;Age;Crus I\nM;50;2\n")
    put(f"{tmp_path}/broken/report.csv", "x;y\n1;2\n")
    df, skipped = reports.read_reports(spark, str(tmp_path))
    got = {r["job_id"]: {k: v for k, v in r.asDict().items() if not k.startswith("file")} for r in df.collect()}
    assert got == {
        "job000123": {"Age": "40", "Sex": "F", "Brainstem": 1.5, "Crus I": None, "Patient ID": "AB12_s1", "job_id": "job000123", "Subject": "AB12"},
        "job000124": {"Age": "50", "Sex": "M", "Brainstem": None, "Crus I": 2, "Patient ID": "ab13_s2", "job_id": "job000124", "Subject": "ab13"},
    }
    assert skipped.count() == 1
    (header,) = reports.report_headers(spark, f"{tmp_path}/AB12_s1_job000123").collect()
    assert (header["job_id"], header["header"]) == ("job000123", "Age;Sex;Brainstem") and header["file"].endswith("/report.csv")


def test_report_types(spark):
    headers = spark.createDataFrame([("j1", "a;Brainstem vol"), ("j2", "Crus I"), ("j3", "x"), ("j4", "x")], "job_id string, header string")
    files = spark.createDataFrame([("j3", "a_t2.nii"), ("j3", "b_winterburn_1.nii"), ("j1", "a_t2.nii")], "job_id string, file string")
    assert rows(reports.classify_reports(headers, files)) == [
        ("j1", "subcortical"), ("j2", "ceres"), ("j3", "hips_winterburn_multicontrast"), ("j4", "hips_kulaga_monocontrast")
    ]


@pytest.mark.parametrize("split", [None, 2])
def test_labelled_rows(spark, split):
    lines = spark.createDataFrame(
        [("f", 1, ["Total Score", "1", "", "2"]), ("f", 2, ["other", "9"]), ("f", 3, ["T Score", "50", "71-C"]),
         ("f", 4, ["Total Score (cont)", "3"]), ("f", 5, ["T Score", "nc"]), ("g", 1, ["T Score", "60"])],
        "file string, line int, cells array<string>",
    )
    cells = reports.labelled_cells(lines, ["file"], ["line"], F.col("cells"), ["Total Score", "T Score", "Percentile"], split)
    assert {(r["file"], r["label"], r["width"]) for r in cells.collect()} == {("f", "T Score", 3), ("f", "Total Score", 3), ("g", "T Score", 1)}
    assert rows(cells.drop("width")) == [
        ("f", "T Score", 0, "50"), ("f", "T Score", 1, "71-C"), ("f", "T Score", 2, "nc"),
        ("f", "Total Score", 0, "1"), ("f", "Total Score", 1, "2"), ("f", "Total Score", 2, "3"), ("g", "T Score", 0, "60"),
    ]


def test_scale_count_is_per_report(spark):
    data = [("f", "T Score", 4, i, str(i)) for i in range(4)] + [("g", "T Score", 3, i, str(i)) for i in range(3)]
    cells = spark.createDataFrame(data, "file string, label string, width int, position int, cell string")
    got = reports.report_scores(cells, ["file"], ["x", "a", "b", "c"], ["x"])
    found = {(r["file"], r["cell"]): r["scale"] for r in got.collect()}
    assert [found["f", str(i)] for i in range(4)] == ["x", "a", "b", "c"]
    assert [found["g", str(i)] for i in range(3)] == ["a", "b", "c"]


def test_read_labelled_reports(spark, tmp_path):
    put(f"{tmp_path}/r.csv", 'Scale,x\r\nTotal Score,1,"2, or so",\r\nT Score,50-B\r\nTotal Score,4\r\n')
    got = rows(reports.read_labelled_reports(spark, str(tmp_path)).drop("file", "width"))
    assert got == [("T Score", 0, "50-B"), ("Total Score", 0, "1"), ("Total Score", 1, "2, or so"), ("Total Score", 2, "4")]


def test_upsert(spark):
    old = spark.createDataFrame([("p1", 1), ("p2", 2)], "k string, v int")
    new = spark.createDataFrame([("p2", 5, None), ("p3", None, 6)], "k string, v int, w int")
    once = reports.upsert_reports(old, new, ["k"])
    assert rows(once) == [("p1", 1, None), ("p2", 5, None), ("p3", None, 6)]
    assert rows(reports.upsert_reports(once, new, ["k"])) == rows(once)
    assert rows(reports.upsert_reports(old, new, ["k"], redo=True)) == [("p2", 5, None), ("p3", None, 6)]


def test_ledger(spark):
    jobs = spark.createDataFrame([("j1",), ("j2",)], "job_id string")
    done = spark.createDataFrame([("j1", "x")], "job_id string, type string")
    assert rows(reports.unprocessed(jobs, done)) == [("j2",)]
    assert reports.unprocessed(jobs, done, redo=True).count() == 2
    assert reports.unprocessed(jobs, None).count() == 2


def test_documents(spark, tmp_path):
    df = spark.createDataFrame([("a", "s1", "1.0", None, "z"), ("b", "s2", "x", "2.9", "z")], "id string, s string, q1 string, q2 string, other string")
    out = sinks.answer_document(df, ["id", "s"], {"q1": 1, "q2": 2}, "form", "soc")
    sinks.write_documents(out, f"{tmp_path}/docs")
    read = spark.read.json(f"{tmp_path}/docs")
    got = {r.PersonInformation.IdentificationCode: [(a.QuestionId, a.Value, a.Comments) for a in r.Forms[0].FormInstrument.Answers] for r in read.collect()}
    assert got == {"a_s1": [(1, "1", [])], "b_s2": [(1, "x", []), (2, "2", [])]}


def test_csv_sink_sorts(spark, tmp_path):
    df = spark.range(0, 50, 1, 7).selectExpr("id * 7 % 50 as id", "id as v")
    sinks.write_csv(df, f"{tmp_path}/out", ["id"], sort=True)
    parts = sorted(p for p in os.listdir(f"{tmp_path}/out") if p.endswith(".csv"))
    lines = [line for p in parts for line in open(f"{tmp_path}/out/{p}").read().split("\n")[1:] if line]
    assert [int(line.split(",")[0]) for line in lines] == list(range(50))


def test_csv_sink_puts_keys_first(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame([(1, "k")], "v int, id string"), f"{tmp_path}/out", ["id"])
    assert spark.read.csv(f"{tmp_path}/out", header=True).columns == ["id", "v"]


def batch(spark, data):
    return spark.createDataFrame(data, "Subject string, type string, v int, i int")


STORE = (["Subject", "type"], ["i"])


def stored(spark, store):
    return {(r["Subject"], r["type"], r["v"]) for r in upsert.read_store(spark, store, *STORE).collect()}


def test_store(spark, tmp_path):
    store = f"{tmp_path}/store"
    assert upsert.read_store(spark, store, *STORE) is None
    first = batch(spark, [("a", "x", 1, 1), ("a", "x", 2, 2), ("b", "y", 2, 1)])
    upsert.upsert_batch(first, store, 0, *STORE)
    assert stored(spark, store) == {("a", "x", 2), ("b", "y", 2)}
    second = batch(spark, [("a", "x", 5, 1), ("c", "x", 6, 1)]).withColumn("extra", F.lit("new"))
    for _ in range(2):
        upsert.upsert_batch(second, store, 1, *STORE)
        assert stored(spark, store) == {("a", "x", 5), ("c", "x", 6), ("b", "y", 2)}
    assert {r["extra"] for r in upsert.read_store(spark, store, *STORE).collect()} == {"new", None}
    # a batch writes its own types only
    versions = spark.read.parquet(store).groupBy("type").agg(F.max("version")).collect()
    assert {tuple(r) for r in versions} == {("x", 1), ("y", 0)}
    upsert.upsert_batch(batch(spark, []), store, 2, *STORE)
    upsert.compact(spark, store, 2, *STORE)
    assert stored(spark, store) == {("a", "x", 5), ("c", "x", 6), ("b", "y", 2)}
    # a batch that is retried after the compaction does not come back
    upsert.upsert_batch(first, store, 0, *STORE)
    assert stored(spark, store) == {("a", "x", 5), ("c", "x", 6), ("b", "y", 2)}
    upsert.upsert_batch(batch(spark, [("a", "x", 7, 1), ("n", None, 8, 1)]), store, 3, *STORE)
    assert stored(spark, store) == {("a", "x", 7), ("c", "x", 6), ("b", "y", 2), ("n", None, 8)}
    # doing a type again forgets its earlier rows
    upsert.upsert_batch(batch(spark, [("d", "x", 9, 1)]), store, 4, *STORE, redo=True)
    assert stored(spark, store) == {("d", "x", 9), ("b", "y", 2), ("n", None, 8)}


def test_compacted_store_reads_the_full_version_only(spark, tmp_path):
    store = f"{tmp_path}/store"
    for version in range(3):
        upsert.upsert_batch(batch(spark, [("a", "x", version, 1)]), store, version, *STORE)
    upsert.compact(spark, store, 2, *STORE)
    assert stored(spark, store) == {("a", "x", 2)}
    files = upsert.read_store(spark, store, *STORE).inputFiles()
    assert files and all("level=full" in f for f in files)


def test_writers_count_their_own_batches(spark, tmp_path):
    """A batch number that another writer used, or the same one with other rows, loses nothing."""
    store = f"{tmp_path}/store"
    upsert.upsert_batch(batch(spark, [("a", "x", 1, 1)]), store, 0, *STORE)
    upsert.upsert_batch(batch(spark, [("b", "x", 2, 1)]), store, 1, *STORE)
    upsert.compact(spark, store, 1, *STORE)
    for _ in range(2):
        upsert.upsert_batch(batch(spark, [("c", "x", 3, 1)]), store, 0, *STORE, writer="other")
    upsert.upsert_batch(batch(spark, [("d", "x", 4, 1)]), store, 0, *STORE)
    assert stored(spark, store) == {("a", "x", 1), ("b", "x", 2), ("c", "x", 3), ("d", "x", 4)}
    # the retry took no version: 0 and 1, the compaction, and the two other batches
    assert Log(spark, store).state().version == 4
    with pytest.raises(ValueError, match="order_by"):
        upsert.upsert_batch(batch(spark, [("a", "x", 1, 1)]), store, 2, ["Subject"])


def test_a_writer_at_work_holds_the_compaction_back(spark, tmp_path):
    store = f"{tmp_path}/store"
    upsert.upsert_batch(batch(spark, [("a", "x", 1, 1)]), store, 0, *STORE)
    log = Log(spark, store)
    slow = log.allocate()
    upsert.upsert_batch(batch(spark, [("a", "x", 9, 1), ("b", "x", 2, 1)]), store, 1, *STORE)
    upsert.compact(spark, store, None, *STORE)
    assert log.base() == 0 and stored(spark, store) == {("a", "x", 9), ("b", "x", 2)}
    rows = batch(spark, [("a", "x", 5, 1), ("s", "x", 7, 1)]).withColumn("part", F.lit("tx"))
    log.publish(slow, upsert._write(rows, store, "delta", slow, slow), "slow", 0, "")
    # its version is older than that of the batch in between
    assert stored(spark, store) == {("a", "x", 9), ("b", "x", 2), ("s", "x", 7)}
    upsert.compact(spark, store, None, *STORE)
    upsert.compact(spark, store, 0, *STORE)
    assert stored(spark, store) == {("a", "x", 9), ("b", "x", 2), ("s", "x", 7)}
    with pytest.raises(RuntimeError, match="given up"):
        log.publish(slow, [], "slow", 1, "")


def test_vacuum(spark, tmp_path):
    store = f"{tmp_path}/store"
    for k in range(3):
        upsert.upsert_batch(batch(spark, [("a", "x", k, 1), ("b", f"y{k}", k, 1)]), store, k, *STORE)
    upsert.compact(spark, store, None, *STORE)
    upsert.upsert_batch(batch(spark, [("a", "x", 9, 1)]), store, 3, *STORE)
    abandoned = Log(spark, store).allocate()
    upsert._write(batch(spark, [("lost", "x", 0, 1)]).withColumn("part", F.lit("tx")), store, "delta", abandoned, abandoned)
    wanted = {("a", "x", 9), ("b", "y0", 0), ("b", "y1", 1), ("b", "y2", 2)}
    assert upsert.vacuum(spark, store) == 0 and stored(spark, store) == wanted
    assert upsert.vacuum(spark, store, older_than_hours=-1) > 0
    assert stored(spark, store) == wanted
    # nothing but live folders is left: the y parts were full already where they had no delta
    left = {p for p, _, files in os.walk(store) if any(f.endswith(".parquet") for f in files)}
    assert len(left) == len(upsert.read_store(spark, store, *STORE).inputFiles()) and not any(f"write={abandoned}" in p for p in left)
    assert sorted(n.split(".")[1] for n in os.listdir(f"{store}/_log") if not n.startswith(".")) == ["entry", "state"]
    upsert.upsert_batch(batch(spark, [("a", "x", 9, 1)]), store, 3, *STORE)
    assert stored(spark, store) == wanted


def test_store_of_changing_types(spark, tmp_path):
    store, big = f"{tmp_path}/store", 9007199254740993
    upsert.upsert_batch(spark.createDataFrame([("a", "x", 1, 1)], "Subject string, type string, v int, i int"), store, 0, *STORE)
    upsert.upsert_batch(spark.createDataFrame([("b", "x", big, 1)], "Subject string, type string, v long, i int"), store, 1, *STORE)
    assert stored(spark, store) == {("a", "x", 1), ("b", "x", big)}
    upsert.upsert_batch(spark.createDataFrame([("c", "x", "t", 1)], "Subject string, type string, v string, i int"), store, 2, *STORE)
    upsert.compact(spark, store, None, *STORE)
    assert stored(spark, store) == {("a", "x", "1"), ("b", "x", str(big)), ("c", "x", "t")}


def test_types_that_paths_escape(spark, tmp_path):
    store = f"{tmp_path}/store"
    odd = ["a/b=c", "50% {x}*[1]?", "é", "2020-01-01", "07", "n"]
    upsert.upsert_batch(batch(spark, [("s", kind, k, 1) for k, kind in enumerate(odd)]), store, 0, *STORE)
    assert stored(spark, store) == {("s", kind, k) for k, kind in enumerate(odd)}


def test_stream_with_a_new_checkpoint(spark, tmp_path):
    """Its batches begin at 0 again and are batches of their own."""
    store = f"{tmp_path}/store"
    for k in range(2):
        folder = f"{tmp_path}/in{k}"
        batch(spark, [("a", "x", k, 1), (f"s{k}", "x", k, 1)]).coalesce(1).write.parquet(folder)
        new = spark.readStream.schema("Subject string, type string, v int, i int").parquet(folder)
        upsert.stream_upserts(new, store, f"{tmp_path}/mark{k}", *STORE).awaitTermination()
        upsert.compact(spark, store, None, *STORE)
    assert stored(spark, store) == {("a", "x", 1), ("s0", "x", 0), ("s1", "x", 1)}


def test_stream(spark, tmp_path):
    folder, store, mark = (f"{tmp_path}/{n}" for n in ("in", "store", "mark"))
    for data in ([("a", "x", 1, 1), ("b", "x", 2, 1)], [("a", "x", 9, 1)]):
        batch(spark, data).coalesce(1).write.mode("append").parquet(folder)
        new = spark.readStream.schema("Subject string, type string, v int, i int").parquet(folder)
        upsert.stream_upserts(new, store, mark, ["Subject"], ["i"]).awaitTermination()
    assert {(r["Subject"], r["v"]) for r in upsert.read_store(spark, store, ["Subject"], ["i"]).collect()} == {("a", 9), ("b", 2)}


def test_shared_folder_comes_from_the_session(spark):
    folder = shared_dir(spark, "x")
    assert "/x-" in folder and folder != shared_dir(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir", "") or "/")


def test_cut_lineage_keeps_odd_columns(spark):
    df = spark.createDataFrame([("a", 1, None)], "`a b(c)` string, `x.y=z;,` int, t timestamp_ntz").withColumn("none", F.lit(None))
    assert cut_lineage(df).collect() == df.collect()
    assert cut_lineage(df.drop("none")).collect() == df.drop("none").collect()
    assert cut_lineage(df.drop("none").limit(0)).columns == df.columns[:3]


def test_size_guards(spark):
    with pytest.raises(ValueError):
        collect_small(spark.range(11), 10)
    assert len(collect_small(spark.range(10), 10)) == 10
    hinted = broadcast_if_small(spark.range(10), 10)._jdf.queryExecution().logical().toString()
    plain = broadcast_if_small(spark.range(11), 10)._jdf.queryExecution().logical().toString()
    assert "Hint" in hinted and "Hint" not in plain


def job(folder, name, text, *more):
    put(f"{folder}/{name}/report.csv", text)
    for file in more:
        put(f"{folder}/{name}/{file}", "x")


def test_stream_of_jobs(spark, tmp_path):
    folder, store, mark = (f"{tmp_path}/{n}" for n in ("in", "store", "mark"))

    def run():
        jobs.stream_jobs(spark, folder, store, mark).awaitTermination()
        return {(r["job_id"], r["Subject"], r["type"], r["v"]) for r in jobs.stored_reports(spark, store).collect()}

    job(folder, "A1_s1_job000001", 'Age;Sex;Brainstem;v\n40;F;1;"two\nlines"\n', "native_t2.nii")
    job(folder, "A2_s1_job000002", "Age;Sex;v\n41;M;2\n", "native_t2.nii", "notes.csv")
    first = {("job000001", "A1", "subcortical", "two\nlines"), ("job000002", "A2", "hips_kulaga_multicontrast", "2")}
    assert run() == first
    # the first job again under another name, a new one for a known patient, and one of the same batch twice
    job(f"{folder}/later", "A1_s1_job000001", "Age;Sex;Brainstem;v\n40;F;1;changed\n")
    job(f"{folder}/later", "A2_s1_job000003", "Age;Sex;v\n41;M;9\n", "native_t2.nii")
    job(f"{folder}/x", "A4_s1_job000004", "Age;Sex;v\n50;F;first\n")
    job(f"{folder}/y", "A4_s1_job000004", "Age;Sex;v\n50;F;second\n")
    put(f"{folder}/none/report.csv", "Age;Sex;v\n1;F;0\n")
    second = {("job000001", "A1", "subcortical", "two\nlines"), ("job000003", "A2", "hips_kulaga_multicontrast", "9"), ("job000004", "A4", "hips_kulaga_monocontrast", "first")}
    assert run() == second
    assert run() == second
    # all of it again under a new checkpoint
    jobs.stream_jobs(spark, folder, store, f"{tmp_path}/other").awaitTermination()
    assert run() == second
    assert {r["job_id"] for r in jobs.known_jobs(spark, store).collect()} == {f"job00000{k}" for k in range(1, 5)}
