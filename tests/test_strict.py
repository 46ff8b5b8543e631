"""Look-alike input, both sides of each switch by size, and exact arithmetic."""

import math

import pytest
from conftest import dicts, rows
from pyspark.sql import functions as F

from longrec.functions import dates, values
from longrec.names import renamed_columns
from longrec.operators import columns, ordered, regression, reshape
from longrec.operators.recode import apply_numeric_types, plan_numeric_types
from longrec.sources import folders, reports, tables
from longrec.streaming import upsert


def texts(spark, *data):
    return spark.createDataFrame([(k, t) for k, t in enumerate(data)], "k int, t string")


def test_numbers(spark):
    df = texts(spark, "12d", "3F", "0x1p3", "NaN", "Infinity", "", None, " 7 ", "-.5", "+1.", "1e3", "1 2", "12345678901234567")
    got = [r["n"] for r in df.orderBy("k").select(values.to_number(F.col("t")).alias("n")).collect()]
    assert got == [None] * 7 + [7.0, -0.5, 1.0, 1000.0, None, 12345678901234567.0]


def test_long_integers_keep_their_digits(spark):
    df = texts(spark, "12345678901234567", "9007199254740993", "1")
    (plan,) = plan_numeric_types(df, ["t"])
    assert (plan.kind, plan.lost) == ("long", 0)
    assert [r["t"] for r in apply_numeric_types(df, [plan]).orderBy("k").collect()] == [12345678901234567, 9007199254740993, 1]
    (mixed,) = plan_numeric_types(texts(spark, "12345678901234567", "0.5", "12d"), ["t"])
    assert (mixed.kind, mixed.lost) == ("double", 2)
    (huge,) = plan_numeric_types(texts(spark, "123456789012345678901234567890", "1"), ["t"])
    assert (huge.kind, huge.lost) == ("double", 1)
    assert dict(tables.infer_types(texts(spark, "123456789012345678901", "1")).dtypes)["t"] == "string"
    assert dict(tables.infer_types(texts(spark, "1D", "2F")).dtypes)["t"] == "string"


def test_ties(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (-0.125,), (2.5,), (1.005,)], "v double")
    both = df.select(values.fixed_text(F.col("v"), 2).alias("up"), values.fixed_text(F.col("v"), 2, "even").alias("even")).collect()
    assert [r["even"] for r in both] == [f"{v:.2f}" for v in (0.125, 0.375, -0.125, 2.5, 1.005)]
    assert [r["up"] for r in both] == ["0.13", "0.38", "-0.13", "2.50", "1.00"]
    with pytest.raises(ValueError):
        values.fixed_text(F.col("v"), 2, "down")


def test_dates(spark):
    same = ["2019-01-05", "1/5/2019", "01/05/19", "2019/01/05", "20190105", "Jan 5, 2019", "JANUARY 5, 2019", "5 jan 2019", "5 January 2019"]
    df = texts(spark, *same, "1/5/2019 3:00", "1/5/2019 13:00:07", "Smarch 5, 2019", "20191345", "5")
    got = [r["d"] for r in df.orderBy("k").select(dates.parse_date(F.col("t")).cast("string").alias("d")).collect()]
    assert got == ["2019-01-05 00:00:00"] * len(same) + ["2019-01-05 03:00:00", "2019-01-05 13:00:07", None, None, None]


def test_renames_happen_at_once(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert columns.rename_by_table(df, {"a": "b", "b": "a"}).columns == ["b", "a", "c"]
    assert columns.rename_by_table(df, {"a": "b", "b": "d", "c": None, "x": "y"}).columns == ["b", "d", "c"]
    with pytest.raises(ValueError):
        renamed_columns(df, {"a": "c"})
    boxes = spark.createDataFrame([(1, 2)], "old___1 int, new___1 int")
    with pytest.raises(ValueError):
        columns.rename_with_families(boxes, {"old": "new"}, ["new"])
    assert columns.with_families(["x", "x___1", "x___1___2", "xy___1"], ["x"]) == ["x", "x___1", "x___1___2"]


LONG = [("a", 1, 5), ("a", 2, 6), ("b", None, 7), ("b", None, 8), ("c", 2, None), (None, 1, 9)]


@pytest.mark.parametrize("many", [0, 1_000])
def test_pivot_branches_agree(spark, monkeypatch, many):
    monkeypatch.setattr(reshape, "MANY_LABELS", many)
    df = spark.createDataFrame(LONG, "id string, label int, v int")
    got = dicts(reshape.simple_flatten(df, ["id"], "label", "s"), "id")
    assert got == {"a": {"s1_v": 5, "s2_v": 6}, "b": {"s1_v": None, "s2_v": None}, "c": {"s1_v": None, "s2_v": None}, None: {"s1_v": 9, "s2_v": None}}
    twice = spark.createDataFrame([*LONG, ("a", 1, 6)], "id string, label int, v int")
    with pytest.raises(Exception, match="more than one row"):
        reshape.simple_flatten(twice, ["id"], "label", "s").collect()
    with pytest.raises(ValueError):
        reshape.simple_flatten(df, ["id"], "label", "s", max_sessions=1)


@pytest.mark.parametrize("split", [None, 2])
def test_previous_values_and_places(spark, split):
    data = [("a", t, t * 10) for t in range(7)] + [("b", 1, None), ("b", 2, 5), (None, 1, 1), (None, 2, 2)]
    df = spark.createDataFrame(data, "id string, t int, v int")
    got = rows(ordered.previous_values(df, ["id"], {"v": "before"}, ["t"], split))
    wanted = [("a", t, t * 10, (t - 1) * 10 if t else None) for t in range(7)] + [("b", 1, None, None), ("b", 2, 5, None)]
    assert got == sorted([*wanted, (None, 1, 1, None), (None, 2, 2, None)], key=repr)
    placed = ordered.sorted_numbers(df, ["v", "id", "t"]).collect()
    in_order = sorted(data, key=lambda r: (r[2] is not None, r[2] or 0, r[0] is not None, r[0] or "", r[1]))
    assert [tuple(r)[:3] for r in sorted(placed, key=lambda r: r["position"])] == in_order
    assert sorted(r["position"] for r in placed) == list(range(1, len(data) + 1))
    assert ordered.sorted_numbers(df.limit(0), ["t"]).count() == 0


def test_subjects_without_values_have_a_row(spark):
    df = spark.createDataFrame([("a", 1, 1.0, None), ("a", 2, 3.0, None), ("b", 1, None, 2.0)], "id string, x int, u double, w double")
    got = {(r["id"], r["variable"]): (r["slope"], r["count"], r["x_s1"]) for r in regression.subject_slopes(df, "id", "x", ["u", "w"], ["x"]).collect()}
    assert got == {("a", "u"): (2.0, 2, 1), ("a", "w"): (None, None, None), ("b", "u"): (None, None, None), ("b", "w"): (None, None, None)}


@pytest.mark.parametrize(("r", "n"), [(1e-3, 1e6), (5e-6, 1e10), (1.6e-5, 1e9)])
def test_p_of_many_rows(r, n):
    normal = math.erfc(abs(r) * math.sqrt(n - 2) / math.sqrt(1 - r * r) / math.sqrt(2))
    assert regression.two_sided_p(r, n) == pytest.approx(normal, abs=5e-7)


def test_trend_points_in_steps(spark, monkeypatch):
    monkeypatch.setattr(regression, "TREND_STEP", 3)
    df = spark.createDataFrame([("g", "v", 0.01, 1.0, 8.0, 2.0, 1.0), ("h", "v", 0.01, 4.0, 4.0, 1.0, 0.0)], "g string, variable string, p double, x_min double, x_max double, slope double, intercept double")
    got = rows(regression.trend_points(df, "g"))
    assert got == sorted([("g", "v", x, 2.0 * x + 1) for x in range(1, 9)] + [("h", "v", 4, 4.0)], key=repr)


def test_csv_fields(spark):
    lines = ['a,"b,c",d', '"x ""y""",,', '', '"open,b', '"",1', "one"]
    got = [r["f"] for r in texts(spark, *lines).orderBy("k").select(tables.csv_fields(F.col("t")).alias("f")).collect()]
    assert got == [["a", "b,c", "d"], ['x "y"', None, None], [None], ['"open', "b"], [None, "1"], ["one"]]
    bars = texts(spark, 'a|"b|c"|d').select(tables.csv_fields(F.col("t"), "|").alias("f")).first()["f"]
    assert bars == ["a", "b|c", "d"]


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_folder_headers(spark, tmp_path):
    put(tmp_path / "a.csv", '\n\nid,"a,b",c\n1,2,x\nid,"a,b",c\n')
    put(tmp_path / "b.csv", "c,id\ny,3\n")
    df, skipped = folders.scan_folder(spark, str(tmp_path), "id")
    assert df.columns[:3] == ["c", "id", "a,b"] or set(df.columns[:3]) == {"id", "a,b", "c"}
    got = rows(df.select("id", "`a,b`", "c"))
    assert got == sorted([("1", "2", "x"), ("id", "a,b", "c"), ("3", None, "y")], key=repr) and skipped.count() == 0
    typed, _ = folders.scan_folder(spark, str(tmp_path), "id", types={"id": "string"})
    assert typed.count() == 3


def test_jobs_with_several_reports(spark, tmp_path):
    from longrec.plans import measures

    put(tmp_path / "AB12_s1_job000123/report_a.csv", "Age;Sex;Brainstem\n40;F;1\n")
    put(tmp_path / "AB12_s1_job000123/report_b.csv", "Age;Sex;Crus I\n40;F;2\n")
    put(tmp_path / "AB12_s1_job000123/other.csv", "Age;Sex;x\n40;F;9\n")
    got = {r["type"]: (r["Brainstem"], r["Crus I"]) for r in measures.collect_report_folder(spark, str(tmp_path)).collect()}
    assert got == {"subcortical": (1, None), "ceres": (None, 2)}


def test_store_keeps_types(spark, tmp_path):
    data = [("a", t, i) for i, t in enumerate(["007", "7", "2019-01-01", None, "", "a/b"])]
    df = spark.createDataFrame(data, "Subject string, type string, v int")
    store = f"{tmp_path}/store"
    upsert.upsert_batch(df, store, 0, ["Subject", "type"], ["v"])
    upsert.compact(spark, store, 0, ["Subject", "type"], ["v"])
    read = upsert.read_store(spark, store, ["Subject", "type"], ["v"])
    assert dict(read.dtypes)["type"] == "string" and rows(read.select("Subject", "type", "v")) == sorted(data, key=repr)


def test_other_widths_are_rejected(spark):
    cells = spark.createDataFrame(
        [(key, "Total Score", width, p, str(p)) for key, width in (("whole", 21), ("short", 17), ("odd", 20)) for p in range(width)],
        "id string, label string, width int, position int, cell string",
    )
    scored = reports.report_scores(cells, ["id"])
    assert {r["id"] for r in scored.collect()} == {"whole", "short"} and scored.where("scale is null").count() == 0
    assert rows(reports.rejected_reports(cells, ["id"])) == [("odd", "Total Score", 20)]


def test_scratch_has_an_owner(spark):
    from longrec import session

    kept = session.cut_lineage(spark.range(3))
    assert kept.count() == 3
    session.remove_scratch(spark)
    spark.catalog.clearCache()
    with pytest.raises(Exception, match="(?i)not.*exist|no such file"):
        kept.collect()
    assert session.cut_lineage(spark.range(2)).count() == 2


def test_one_shuffle_gives_the_same(spark):
    data = [("a", 2, 5.0), ("a", 1, None), ("a", None, None), ("b", 1, None), (None, 1, 7.0), (None, 2, 8.0)]
    df = spark.createDataFrame(data, "id string, t int, v double")
    for operator in (lambda **k: ordered.first_valid(df, ["id"], ["v"], ["t"], **k), lambda **k: ordered.group_size(df, ["id"], "n", **k)):
        assert rows(operator(one_shuffle=True)) == rows(operator())
        assert operator(one_shuffle=True)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_exact_slopes_of_huge_numbers(spark):
    df = spark.createDataFrame([("a", 1, 1e20), ("a", 2, 3e20), ("b", 1, 1.25), ("b", 2, 3.75)], "id string, x int, v double")
    got = {r["id"]: r["slope"] for r in regression.subject_slopes(df, "id", "x", ["v"], ["x"], decimals=(0, 2)).collect()}
    assert got == {"a": pytest.approx(2e20), "b": 2.5}
