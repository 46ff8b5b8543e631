import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from longrec import fixed_values as fixed
from longrec.functions import dates, labels, records, sentences, values
from longrec.operators import recode, regression, scoring


def one(spark, schema, data, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_age(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        data = [
            ("2000-01-01 00:00", "2001-01-01 00:00"), ("2000-01-01 23:00", "2000-01-02 01:00"),
            ("2000-01-01 12:00", "2000-01-01 00:00"), (None, "2000-01-01 00:00"), ("2021-03-13 12:00", "2021-03-14 12:00"),
        ]
        got = one(spark, "a string, b string", data, dates.age(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")))
        assert got == [(366 / 365.25,), (0.0,), (-1 / 365.25,), (None,), (1 / 365.25,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_date(spark):
    data = [("2015-02-03",), (" 2/3/2015",), ("2/3/15",), ("2015-02-30",), ("soon",), (None,), ("2015-02-03 10:30",)]
    got = [None if r[0] is None else r[0].isoformat(" ", "minutes") for r in one(spark, "t string", data, dates.parse_date(F.col("t")))]
    assert got == ["2015-02-03 00:00"] * 3 + [None] * 3 + ["2015-02-03 10:30"]


DATES = {
    "Jan 5 2019": "2019-01-05 00:00", "5-Jan-2019": "2019-01-05 00:00", "01-02-2019": "2019-01-02 00:00", "1/2/2019 3:00 PM": "2019-01-02 15:00",
    "2019-01": "2019-01-01 00:00", "13/1/2019": "2019-01-13 00:00", "5 january 2019": "2019-01-05 00:00", "20190105": "2019-01-05 00:00",
    "2019-01-05T10:00:00Z": "2019-01-05 10:00", "1.2.2019": "2019-01-02 00:00", "Saturday, January 5, 2019": "2019-01-05 00:00", "1/2/75": "1975-01-02 00:00",
    "Sept 3rd,  2020 11:59:58 p.m.": "2020-09-03 23:59", "2019-Jan-05": "2019-01-05 00:00", "May 2019": "2019-05-01 00:00", "12/31/2019 12:05 am": "2019-12-31 00:05",
    "2019-01-05 10:00:00+02:00": "2019-01-05 10:00", "31/31/2019": None, "2019-13-01": None, "29-Feb-2019": None, "1/2/2019 13:00 PM": None,
    "123456789": None, "": None, "12:30": None, "Jun 31 2019": None, "k|2019|1|5||||": None,
}


def test_dates_of_many_shapes(spark):
    texts = list(DATES)
    got = [None if r[0] is None else r[0].isoformat(" ", "minutes") for r in one(spark, "t string", [(t,) for t in texts], dates.parse_date(F.col("t")))]
    assert dict(zip(texts, got)) == DATES
    swapped = one(spark, "t string", [("1/2/2019",), ("1/13/2019",)], dates.parse_date(F.col("t"), day_first=True))
    assert [str(r[0].date()) for r in swapped] == ["2019-02-01", "2019-01-13"]


def test_date_plans(spark):
    df = spark.createDataFrame(
        [("13/1/2019", "1/13/2019", "1/2/2019", "x", 1), ("2/3/2019", "2/3/2019", "2/2/2019", "13/1/2019", 2), (None, None, None, "1/13/2019", 3)],
        "d string, m string, o string, b string, n int",
    )
    plans = {p.column: (p.day_first, p.ambiguous, p.values, p.unread, p.open) for p in dates.plan_dates(df, ["d", "m", "o", "b"])}
    assert plans == {"d": (True, False, 2, 0, 1), "m": (False, False, 2, 0, 1), "o": (False, True, 2, 0, 1), "b": (False, False, 3, 1, 0)}
    read = dates.read_dates(df, ["d", "o", "n"], day_first=True).orderBy("n").head(2)
    assert [str(r["d"].date()) for r in read] == ["2019-01-13", "2019-03-02"] and str(read[0]["o"].date()) == "2019-02-01" and read[0]["n"] == 1
    assert dates.plan_dates(df, []) == []


def test_session_number(spark):
    got = one(spark, "k string, e string", [("SUB_2015_x", "2018_arm_1"), ("SUB_2019_x", "2018_arm_1")],
              dates.session_number(labels.leading_year(F.col("k")), labels.event_year(F.col("e"))))
    assert got == [(4,), (None,)]


def test_clinic_label(spark):
    data = [("stable_patient",), ("2015_clinic",), ("mini_clinic_3x",)]
    assert one(spark, "e string", data, labels.clinic_label(F.col("e"))) == [("0",), ("2015",), ("mc3",)]
    assert one(spark, "e string", [("2015_arm_1",)], labels.strip_event_tail(F.col("e"))) == [("2015",)]


def test_pins(spark):
    data = [("SUBJ001",), ("SUBJ 001_s2",), ("subj001-S2",), ("SUBJ012s3 parent",), ("SUBJ0012",), ("abc",), (None,)]
    got = one(spark, "p string", data, labels.pin_subject(F.col("p")), labels.pin_session(F.col("p")))
    assert got == [
        ("SUBJ001", "1"), ("SUBJ001", "2"), ("SUBJ001", "2"), ("SUBJ012", "3"), ("SUBJ0012", "1"), (None, "1"), (None, None)
    ]


def test_instruments(spark):
    data = [("TB Oral Reading Test",), ("Crystallized Composite v2",), ("Other",)]
    assert one(spark, "i string", data, labels.map_instrument(F.col("i"), fixed.SUBJECT_INSTRUMENTS)) == [
        ("oral_reading",), ("crystal_cog",), ("Other",)
    ]
    assert one(spark, "i string", [("a b",)], labels.map_instrument(F.col("i"), {"a": "1", "b": "2"})) == [("2",)]


def test_measure_code(spark):
    data = [("Finger Tap Mean Peak Velocity",), ("Finger Tap Peak Velocity COV",), ("Right Tap Mean",), ("peakVelocity x",)]
    got = [r[0] for r in one(spark, "m string", data, labels.measure_code(F.col("m"), fixed.MEASURE_FIXES))]
    assert got == ["ft_mpv", "ft_pvcv", "at_m", "pv_x"]


def test_recode(spark):
    mapping = values.parse_choices("1, 2 | 2, 3 |")
    assert mapping == {"1": "2", "2": "3"}
    assert values.parse_choices("a | 2, b, c") == {"a": "a", "2": "b, c"}
    got = one(spark, "v string", [("1",), ("2",), ("9",), (None,)], values.recode(F.col("v"), mapping))
    assert got == [("2",), ("3",), ("9",), (None,)]
    got = one(spark, "c string", [("1, 2 | 2, 3, x |",)], values.choices_map(F.col("c")))
    assert got == [({"1": "2", "2": "3, x"},)]


def test_merges(spark):
    df = spark.createDataFrame([(0, None), (None, 1), (None, None), (0, 0)], "a int, b int")
    assert [r[0] for r in df.select(values.any_of(["a", "b"])).collect()] == [0, 1, None, 0]
    df = spark.createDataFrame([(1, 0, 1), (0, 0, 1), (None, None, 0), (1, 0, None)], "x_l int, x_r int, x_tng int")
    merged = recode.merge_columns(df, {"x": ["x_l", "x_r", "x_tng"]}, {"x": recode.graded_merge})
    assert [r[0] for r in merged.collect()] == [3, 1, 0, None] and merged.columns == ["x"]


def test_flags_and_bands(spark):
    t = F.col("t")
    got = one(spark, "t int", [(64,), (65,), (69,), (70,), (None,)], values.range_flag(t, 65, 69), values.range_flag(t, 70, 100))
    assert got == [(0, 0), (1, 0), (1, 0), (0, 1), (0, 0)]
    got = one(spark, "t int", [(50,), (51,), (70,), (71,), (40,), (None,)], values.percentile_band(t))
    assert [r[0] for r in got] == ["<= 50", "54", "98", "> 98", None, None]
    got = one(spark, "t int", [(64,), (65,), (70,)], values.borderline_flag(t), values.clinical_flag(t))
    assert got == [(0, 0), (1, 0), (0, 1)]
    got = one(spark, "s string", [("71-C",), ("66-B",), ("50",), ("nc",)], *values.tscore_parts(F.col("s")))
    assert got == [("71", 1, 0), ("66", 0, 1), ("50", 0, 0), (None, 0, 0)]


def test_text_values(spark):
    data = [("1.0",), ("2.7",), ("x",), (None,), ("NaN",)]
    assert [r[0] for r in one(spark, "v string", data, values.plain_answer(F.col("v")))] == ["1", "2", "x", None, "NaN"]
    assert [r[0] for r in one(spark, "v string", data, values.to_number(F.col("v")))] == [1.0, 2.7, None, None, None]
    beyond = [("1e400",), ("-1e999",), ("1e308",)]
    got = one(spark, "v string", beyond, values.to_number(F.col("v")), values.typed_option(F.col("v")), values.plain_answer(F.col("v")))
    assert [r[0] for r in got] == [None, None, 1e308] and [r[1] for r in got] == ["1e400", "-1e999", "1.0E308"]
    assert [r[2] for r in got] == ["1e400", "-1e999", "1e308"]


def test_fixed_text(spark):
    numbers = [40.595, 1.005, 0.125, 0.0, 12.0, 2.675, 0.999, 1e-9, 19.955, -1.239, 1234.5678]
    got = [r[0] for r in one(spark, "v double", [(n,) for n in numbers], values.fixed_text(F.col("v"), 2))]
    for n, text in zip(numbers, got):
        # Python rounds the same binary value; only exact ties go up here
        assert text == ("0.13" if n == 0.125 else f"{n:.2f}")


def test_lookup(spark):
    raw = spark.createDataFrame([("a", 0), ("a", 1), ("a", 9), ("a", -1)], "scale string, raw int")
    norms = spark.createDataFrame([("a", 0, 50), ("a", 1, 66)], "scale string, raw int, tscore int")
    scored = scoring.lookup_scores(raw, norms)
    assert {r["raw"]: r["tscore"] for r in scored.collect()} == {0: 50, 1: 66, 9: None, -1: None}
    assert rows(scoring.unmatched_scores(scored)) == [("a", 2, -1, 9)]


def test_sentences(spark):
    data = [
        ("Date", 5.126, "n1", "2015-03-07", ""), ("Date", 5.126, "n1", "2015-03-07", "2014-12-01"), ("Age", 5.16, "", "", ""),
        ("Month", 1.0, "", "2015-03-07", ""), ("Year", 1.0, "", "2015-03-07", ""), ("Clinic dx", 1.0, "", "2015-03-07", ""),
        ("Dx age unknown", None, "", "", ""), ("No dx", None, "n", None, None), ("?", None, "n", "", ""),
    ]
    text = sentences.diagnosis_text(F.col("r"), F.col("a"), F.col("n"), F.col("d"), F.col("e"))
    got = [r[0] for r in one(spark, "r string, a double, n string, d string, e string", data, text)]
    head = '<span style="color:#0e1f8a;">Diagnosis:</span> '
    middle = '<br /><br /><span style="color:#0e1f8a;">Notes:</span> '
    assert got == [
        head + "The <i>actual dx date</i> is March 7, 2015; age = 5.13." + middle + "n1",
        head + "The <i>actual dx date</i> is December 1, 2014; age = 5.13." + middle + "n1",
        head + "<i>Estimated age</i> at dx = 5.2" + middle,
        head + "<i>Estimated</i> dx at <i>March 2015</i>; age = 1.00" + middle,
        head + "<i>Estimated</i> dx in <i>year 2015</i> (used March 7, 2015); age = 1.00" + middle,
        head + "<i>Clinic dx</i> at the 2015 clinic (March 2015); age = 1.00" + middle,
        head + "Diagnosis present, but age unknown" + middle,
        head + "No diagnosis" + middle + "n",
        head + middle + "n",
    ]


def test_cards(spark):
    df = spark.createDataFrame([(1, 2, None), (0, 2, 1), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(records.symptom_card(["a", "b", "c"])).collect()] == ["019", "021", "999"]
    head = records.record_head(F.lit("verylongsubject_s1"), F.lit(2.0), F.lit(7.9), "01")
    assert df.select(head).first()[0] == "verylongs1" + "01" + "2" + "07"


def slopes(spark, data, **options):
    df = spark.createDataFrame(data, "id string, i int, x double, y double")
    got = regression.subject_slopes(df, "id", "x", ["y"], ["i"], **options)
    return {r["id"]: (r["slope"], r["rmse"], r["nrmse"], r["count"], r["x_s1"]) for r in got.collect()}


@pytest.mark.parametrize("decimals", [None, (0, 2)])
def test_slopes(spark, decimals):
    data = [("line", k, float(k), 2.0 * k) for k in (1, 2, 3)]
    data += [("two", 1, 1.0, 3.0), ("two", 2, 2.0, 5.0), ("one", 1, 1.0, 3.0), ("one", 2, 2.0, None)]
    data += [("flat", k, 1.0, float(k)) for k in (1, 2, 3)] + [("level", k, float(k), 4.0) for k in (1, 2, 3)]
    data += [("bent", 1, 1.0, 1.0), ("bent", 2, 2.0, 2.0), ("bent", 3, 3.0, 2.0)]
    got = slopes(spark, data, decimals=decimals)
    assert got["line"] == (2.0, 0.0, 0.0, 3, 1.0)
    assert got["two"] == (2.0, 0.0, 0.0, 2, 1.0)
    assert got["one"] == (None, None, None, None, None)
    assert got["flat"][0] is None and got["flat"][1] is None
    assert got["level"] == (0.0, 0.0, None, 3, 1.0)
    rmse = math.sqrt((1 / 6) / 3)
    assert got["bent"][0] == pytest.approx(0.5) and got["bent"][1] == pytest.approx(rmse) and got["bent"][2] == pytest.approx(rmse)


def test_first_x_and_group_are_of_the_first_value(spark):
    df = spark.createDataFrame([("a", 1, 1.0, None, "p"), ("a", 2, 2.0, 5.0, "q"), ("a", 3, 3.0, 6.0, "r")], "id string, i int, x double, y double, g string")
    row = regression.subject_slopes(df, "id", "x", ["y"], ["i"], group="g").first()
    assert (row["x_s1"], row["g"], row["slope"]) == (2.0, "q", 1.0)


def test_p_values():
    # two-sided t distribution: (t, degrees of freedom, p) from printed tables
    for t, df, p in ((12.706, 1, 0.05), (4.303, 2, 0.05), (2.228, 10, 0.05), (2.750, 30, 0.01), (1.980, 120, 0.05), (1.0, 1, 0.5)):
        r = t / math.sqrt(df + t * t)
        assert regression.two_sided_p(r, df + 2) == pytest.approx(p, abs=2e-4)
    assert regression.two_sided_p(1.0, 5) == 0.0
    assert regression.two_sided_p(0.0, 5) == 1.0
    assert regression.two_sided_p(0.5, 2) == 1.0
    assert regression.two_sided_p(float("nan"), 5) is None


def test_group_regression_label_and_trend(spark):
    df = spark.createDataFrame([("g", float(x), 2.0 * x + (1 if x == 2 else 0)) for x in range(1, 6)] + [("h", 1.0, 1.0)], "g string, x double, y double")
    fitted = regression.group_regression(df, "x", ["y"], "g")
    got = {r["g"]: r for r in fitted.collect()}
    assert got["g"]["label"] == f"g (R^2 = {got['g']['r2']:.2f}, p = {got['g']['p']:.2f})"
    points = regression.trend_points(fitted, "g", 0.05).collect()
    assert sorted(p["x"] for p in points) == [1, 2, 3, 4, 5]
    assert all(p["y"] == pytest.approx(got["g"]["slope"] * p["x"] + got["g"]["intercept"]) for p in points)


def test_typing(spark):
    df = spark.createDataFrame([("1", "1.5", "x", "1", None), ("2.0", "y", None, "2", None)], "a string, b string, c string, compass31_d string, e string")
    plan = recode.plan_numeric_types(df, df.columns, ["compass31"])
    assert [(p.column, p.kind, p.lost) for p in plan] == [("a", "long", 0), ("b", "double", 1)]
    typed = recode.apply_numeric_types(df, plan)
    assert rows(typed) == sorted([(1, 1.5, "x", "1", None), (2, None, None, "2", None)], key=repr)


def test_p_values_as_expression(spark):
    """The expression and the function of single numbers, which evaluates the fraction in another way."""
    pairs = [(r, n) for n in (2, 3, 4, 7, 50, 1000, 10**6, 10**9) for r in (0.0, 1.0, -1.0, 0.5, -0.9, 0.999, 1e-3, 1e-5, float("nan"), None)]
    pairs += [((2 * t / (n - 2)) ** 0.5, n) for n in (50, 1000, 10**6, 10**9) for t in (1e-9, 0.3, 0.74, 0.76, 1.6, 5.0)]
    df = spark.createDataFrame(pairs, "r double, n long")
    for r, n, p in df.select("r", "n", regression.p_value(F.col("r"), F.col("n"))).collect():
        wanted = regression.two_sided_p(r, n)
        assert p == (wanted if wanted is None else pytest.approx(wanted, rel=max(1e-12, 1e-16 * n), abs=1e-290))
    plan = df.select(regression.p_value(F.col("r"), F.col("n")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
