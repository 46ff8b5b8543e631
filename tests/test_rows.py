import pytest
from conftest import dicts, rows
from pyspark.sql import functions as F

from longrec.operators import ages, columns, joins, predicates


@pytest.fixture
def answers(spark):
    return spark.createDataFrame(
        [(1, "1", None, 2), (2, None, 1, 2), (3, "1", None, None), (4, None, None, None), (5, "x", 1, None)],
        "id int, a string, b1 int, b2 int",
    )


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_require_all_and_any(answers):
    assert ids(predicates.require_all(answers, ["a", "b"])) == [1, 5]
    assert ids(predicates.require_all(answers, ["a", "b"], numeric=True)) == [1]
    assert ids(predicates.require_any(answers, ["a", "b"])) == [1, 2, 3, 5]
    assert ids(predicates.require_any(answers, ["a"], numeric=True)) == [1, 3]


def test_requests(answers):
    with pytest.raises(ValueError, match="zz"):
        predicates.require_all(answers, ["a", "zz"])
    # exact name before form, form before prefix
    assert columns.resolve_variables(["a", "b1", "b2"], ["a", "b"], {"a": ["b1"], "b": ["b2", "gone"]}) == (["a"], [["b2"]])
    # a request without any column of the table keeps no row
    assert ids(predicates.require_all(answers, ["form"], {"form": ["gone"]})) == []
    assert ids(predicates.require_any(answers, ["a", "form"], {"form": ["gone"]})) == [1, 3, 5]


def test_attended(spark):
    df = spark.createDataFrame(
        [("stable", None, None), ("2015", 1.0, None), ("2016", None, None), ("2017", 3.0, 1)], "event string, n double, missed int"
    )
    kept = predicates.keep_attended(df, "n", "missed", "event")
    assert rows(kept) == [("2015", 1, None), ("stable", 0, None)]


def test_imaging_or_stable(spark):
    df = spark.createDataFrame([(1, 0.0, "2015"), (2, 3.0, "2016"), (3, None, "0"), (4, None, "2017")], "id int, age double, label string")
    assert ids(df.where(predicates.imaging_or_stable("age", "label"))) == [2, 3]


def test_completed(spark):
    df = spark.createDataFrame([(1, 0), (2, 2), (3, None)], "id int, flag int")
    assert ids(predicates.completed(df, "flag")) == [2, 3]
    assert ids(predicates.completed(df, "other")) == [1, 2, 3]


def test_parents_and_mismatches(spark):
    df = spark.createDataFrame([(1, "x Parent"), (2, "x"), (3, None)], "id int, pin string")
    parent, subject = predicates.parent_rows(df, "pin")
    assert ids(parent) == [1] and ids(subject) == [2, 3]
    files = spark.createDataFrame([("e_s2.csv", "A1_S2"), ("e_s2.csv", "A2"), ("f_S2.csv", "B1 s2"), ("g.csv", "C1")], "file string, pin string")
    assert rows(predicates.file_mismatches(files, "file", "pin")) == [("e_s2.csv", True)]


def test_checks(spark):
    df = spark.createDataFrame([("stable",), ("2015",), ("2016",)], "event string")
    predicates.check_year_count(df, "event", 2)
    for n in (1, 3):
        with pytest.raises(ValueError):
            predicates.check_year_count(df, "event", n)
    with pytest.raises(ValueError, match="no data"):
        predicates.check_not_empty(df.where("event = 'x'"))


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, k string")
    known = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    assert ids(predicates.with_keys(df, known, ["k"])) == [1]
    assert ids(predicates.without_keys(df, known, ["k"])) == [2, 3]


def test_enrich_and_undo(spark):
    df = spark.createDataFrame([(1, "old", 5), (2, "old2", 6)], "id int, dob string, v int")
    other = spark.createDataFrame([(1, "new", "F")], "key int, dob string, sex string")
    both = joins.enrich_left(df, other, ["id"], ["key"], ["dob", "sex"])
    assert both.columns == ["id", "dob_original", "v", "dob", "sex"]
    assert rows(both) == [(1, "old", 5, "new", "F"), (2, "old2", 6, None, None)]
    assert rows(joins.undo_enrich(both, ["dob", "sex"])) == [(1, "old", 5), (2, "old2", 6)]
    # fields that are already gone are no problem
    assert joins.undo_enrich(both.drop("sex"), ["dob", "sex"]).columns == ["id", "dob", "v"]


def test_merge_fill(spark):
    base = spark.createDataFrame([("k1", None, 0), ("k2", 1, 0)], "k string, v int, w int")
    new = spark.createDataFrame([("k1", 9, "a"), ("k2", 8, "b"), ("k3", 7, "c")], "k string, v int, x string")
    merged = joins.merge_fill(base, new, ["k"])
    assert merged.columns == ["k", "v", "w", "x"]
    assert rows(merged) == [("k1", 9, 0, "a"), ("k2", 1, 0, "b"), ("k3", 7, None, "c")]


def test_densify(spark):
    df = spark.createDataFrame([("a", "2018", 1), ("a", "2020", 2), ("b", "2019", 3)], "id string, event string, v int")
    assert rows(joins.densify(df, "id", "event", ["2018", "2019"])) == [
        ("a", "2018", 1), ("a", "2019", None), ("b", "2018", None), ("b", "2019", 3)
    ]


def test_union_missing_widens(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2.5, 3)], "k double, v int")
    assert rows(joins.union_missing(a, b)) == [(1.0, "x"), (2.5, "3")]


def test_ages(spark):
    df = spark.createDataFrame(
        [("a", 1, "2000-01-01", "2010-01-01"), ("a", 2, None, "1/1/2011"), ("a", 3, "1999-01-01", "later")],
        "id string, i int, dob string, session_date string",
    )
    aged = ages.with_age(df, "id", "dob", "session_date", "session_age", ["i"])
    assert aged.columns == ["id", "i", "dob", "session_age", "session_date"]
    found = {r["i"]: r["session_age"] for r in aged.collect()}
    assert found == {1: 3653 / 365.25, 2: 4018 / 365.25, 3: None}
    assert {str(r["dob"]) for r in aged.collect()} == {"2000-01-01 00:00:00"}
    with pytest.raises(Exception):
        ages.with_age(df.withColumn("dob", F.lit("soon")), "id", "dob", "session_date", "session_age", ["i"]).collect()


def test_onset_of_zero_counts(spark):
    df = spark.createDataFrame([("a", "s1", 0.0, 5.0), ("a", "s2", 9.0, 6.0), ("b", "s1", None, 7.0)], "id string, s string, onset double, age double")
    onset = ages.onset_ages(df, "id", "s", "onset")
    timed = ages.with_duration(df, onset, "id", "age", "db")
    assert sorted((r["id"], r["s"], r["dx_db_duration"]) for r in timed.collect()) == [("a", "s1", 5.0), ("a", "s2", 6.0), ("b", "s1", None)]


def test_column_helpers(spark):
    names = ["id", "age", "session_age", "box___1", "box___2", "boxes"]
    assert columns.matching(names, "age") == ["age"]
    assert columns.searching(names, ["age", "box_"]) == ["age", "session_age", "box___1", "box___2"]
    assert columns.with_families(names, ["box", "age"]) == ["box___1", "box___2", "age"]
    df = spark.createDataFrame([(1, 2, 3, 4, 5, 6)], ", ".join(f"{n} int" for n in names))
    # whole names only
    assert columns.rename_from_lines(df, ["age,years", "x", ""]).columns[1:3] == ["years", "session_age"]
    assert columns.rename_with_families(df, {"box": "kind", "age": "years"}, ["kind"]).columns == [
        "id", "years", "session_age", "kind___1", "kind___2", "boxes"
    ]
    with pytest.raises(ValueError, match="duplicate"):
        columns.rename_by_rules(df, [(lambda c: c.endswith("age"), lambda c: "age")])
    assert columns.insert_before(df, "box___1", "age", F.lit(9)).columns == ["id", "session_age", "age", "box___1", "box___2", "boxes"]
    assert columns.drop_empty_columns(df.withColumn("none", F.lit(None).cast("int"))).columns == names
    assert columns.drop_matching(df, "box", unless="es").columns == ["id", "age", "session_age", "boxes"]
    assert dicts(columns.only_where(df, F.col("id") == 2, ["age"]), "id")[1]["age"] is None
