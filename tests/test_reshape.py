import pytest
from conftest import dicts, rows
from pyspark.sql import functions as F

from longrec.operators import reshape


@pytest.fixture
def long(spark):
    return spark.createDataFrame(
        [("a", 0, None, "F"), ("a", 1, 5.0, None), ("a", 2, 7.0, None), ("b", 0, None, "M"), ("c", 1, 9.0, None)],
        "id string, session int, v double, sex string",
    )


def test_flatten(long):
    wide = reshape.flatten(long, "id", "session", "s")
    assert wide.columns == ["id", "s0_sex", "s1_v", "s2_v"]
    assert rows(wide) == [("a", "F", 5.0, 7.0), ("b", "M", None, None)]


def test_flatten_refuses_duplicates(spark, long):
    with pytest.raises(Exception, match="more than one row"):
        reshape.flatten(long.unionByName(long), "id", "session").collect()
    assert reshape.flatten(long.unionByName(long), "id", "session", agg=F.max).count() == 2


def test_flatten_text_sessions_and_bookkeeping(spark):
    df = spark.createDataFrame(
        [("a", "0", "x", 0), ("a", "2015", "y", 1), ("a", "mc1", "z", 2)], "id string, clinic_year string, v string, session_number int"
    )
    wide = reshape.flatten(df, "id", "clinic_year", "c")
    assert wide.columns == ["id", "c0_v", "c2015_session_number", "c2015_v", "cmc1_session_number", "cmc1_v"]


def test_stable_row_without_values_keeps_its_subject(spark):
    df = spark.createDataFrame([("a", 0, None, None), ("a", 1, 1, None), ("b", 0, None, 3)], "id string, s int, v int, w int")
    assert dicts(reshape.flatten(df, "id", "s", "s"), "id") == {"a": {"s0_w": None, "s1_v": 1}, "b": {"s0_w": 3, "s1_v": None}}


def test_column_order(spark):
    df = spark.createDataFrame([("a", 1, 1, 2), ("a", 2, 3, 4), ("a", 10, 5, 6)], "id string, s int, z int, b int")
    assert reshape.simple_flatten(df, ["id"], "s", "s", sort=True).columns == [
        "id", "s1_b", "s1_z", "s2_b", "s2_z", "s10_b", "s10_z"
    ]
    assert reshape.simple_flatten(df, ["id"], "s", "s", sort=False).columns == [
        "id", "s1_z", "s2_z", "s10_z", "s1_b", "s2_b", "s10_b"
    ]


def test_simple_flatten_drops_empty_cells(spark):
    df = spark.createDataFrame([("a", 1, 1, None), ("b", 2, None, 4)], "id string, s int, v int, w int")
    assert reshape.simple_flatten(df, ["id"], "s").columns == ["id", "1_v", "2_w"]


def test_expand(spark):
    df = spark.createDataFrame([("a", "F", 5, None, 3)], "id string, sex string, s1_v int, s2_v int, s10_v int")
    long, renamed = reshape.expand(df, "id")
    assert renamed == {"sex": "s1_sex"}
    assert long.columns == ["id", "session_number", "sex", "v"]
    assert rows(long) == [("a", "s1", "F", 5), ("a", "s10", None, 3)]


def test_expand_refuses_clashing_names(spark):
    with pytest.raises(ValueError):
        reshape.expand(spark.createDataFrame([("a", 1, 2)], "id string, v int, s1_v int"), "id")


def test_expand_widens_mixed_types(spark):
    df = spark.createDataFrame([("a", 1, 2.5, "x", 3)], "id string, s1_v int, s2_v double, s1_w string, s2_w int")
    long = reshape.expand(df, "id")[0]
    assert dict(long.dtypes) == {"id": "string", "session_number": "string", "v": "double", "w": "string"}
    assert rows(long) == [("a", "s1", 1.0, "x"), ("a", "s2", 2.5, "3")]


def test_there_and_back(spark):
    long = spark.createDataFrame(
        [("a", "s1", 1, "x"), ("a", "s2", None, "y"), ("b", "s1", 3, None), ("b", "s12", 4, "z")],
        "id string, session_number string, v int, w string",
    )
    wide = reshape.simple_flatten(long, ["id"], "session_number")
    back = reshape.expand(wide, "id")[0].select(*long.columns)
    assert rows(back) == rows(long)


def test_row_order_does_not_matter(spark, long):
    shuffled = long.orderBy(F.rand(3))
    assert rows(reshape.flatten(shuffled, "id", "session", "s")) == rows(reshape.flatten(long, "id", "session", "s"))


def test_direction(spark, long):
    assert reshape.reshape_direction(long, "id") == "flatten"
    assert reshape.reshape_direction(long.where("session = 0"), "id") == "expand"
    one_null = spark.createDataFrame([(None,), ("a",)], "id string")
    assert reshape.reshape_direction(one_null, "id") == "expand"
    wide = reshape.reshape(long)
    assert wide.columns == ["id", "s0_sex", "s1_v", "s2_v"]


def test_suffixes(spark):
    df = spark.createDataFrame([("a", 1, 2)], "id string, v_s1 int, v_s12 int")
    assert rows(reshape.reshape(df)) == [("a", "s1", 1), ("a", "s12", 2)]


def test_double_flatten(spark):
    df = spark.createDataFrame(
        [("a", "1", "vocab", 1, None), ("a", "2", "vocab", 2, 5), ("b", "1", "list", 3, 4)],
        "id string, session string, inst string, unadj int, ageadj int",
    )
    wide = reshape.double_flatten(df, "id", "session", "inst")
    assert wide.columns == ["id", "s1_list_ageadj", "s1_list_unadj", "s1_vocab_unadj", "s2_vocab_ageadj", "s2_vocab_unadj"]
    assert dicts(wide, "id")["a"] == {
        "s1_list_ageadj": None, "s1_list_unadj": None, "s1_vocab_unadj": 1, "s2_vocab_ageadj": 5, "s2_vocab_unadj": 2
    }


def test_too_many_sessions(spark):
    df = spark.range(20).selectExpr("id", "id as s", "id as v")
    with pytest.raises(ValueError, match="long form"):
        reshape.profile_sessions(df, "s", ["v"], max_sessions=10)


def test_long_transpose(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", None, "y")], "id string, n int, t string")
    assert rows(reshape.long_transpose(df, "id")) == [("n", "a", "1"), ("n", "b", None), ("t", "a", "x"), ("t", "b", "y")]


def test_many_labels_are_gathered(spark, long, monkeypatch):
    few = rows(reshape.flatten(long, "id", "session", "s"))
    df = long.select("id", "session", "v")
    plain = rows(reshape.simple_flatten(df, ["id"], "session"))
    monkeypatch.setattr(reshape, "MANY_LABELS", 1)
    assert rows(reshape.flatten(long, "id", "session", "s")) == few
    assert rows(reshape.simple_flatten(df, ["id"], "session")) == plain
    with pytest.raises(Exception, match="more than one row"):
        reshape.simple_flatten(df.unionByName(df), ["id"], "session").collect()
    assert rows(reshape.simple_flatten(df.unionByName(df), ["id"], "session", agg=F.max)) == plain
