"""Types that hold the values of several columns."""

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import types as T

from longrec.operators import joins, reshape
from longrec.operators.common_types import common, exact_in_double

LONG = 9007199254740993


def kind(text):
    return T.StructType.fromDDL(f"x {text}")["x"].dataType


@pytest.mark.parametrize(
    ("types", "wanted"),
    [
        (["int", "bigint"], "bigint"), (["tinyint", "smallint", "int"], "int"), (["bigint", "decimal(10,2)"], "decimal(21,2)"),
        (["decimal(38,0)", "decimal(10,5)"], "string"), (["int", "double"], "double"), (["double", "bigint", "int"], "string"),
        (["float", "double"], "double"), (["bigint", "string"], "string"), (["void", "int"], "int"), (["date", "timestamp_ntz"], "timestamp_ntz"),
        (["boolean", "int"], "string"), (["bigint", "double", "decimal(5,0)"], "string"),
    ],
)
def test_common(spark, types, wanted):
    assert common([kind(t) for t in types]).simpleString() == wanted
    assert common([kind(t) for t in reversed(types)]).simpleString() == wanted


def test_exact_in_double(spark):
    df = spark.createDataFrame([(LONG, 5, Decimal("0.10"), Decimal("0.1234567890123456789"), None), (1, None, None, None, None)],
                               "a long, b long, c decimal(10,2), d decimal(38,19), e long")
    assert exact_in_double(df, ["a", "b", "c", "d", "e"]) == {"a": False, "b": True, "c": True, "d": False, "e": True}


def test_union_keeps_whole_numbers(spark):
    def table(value, ddl):
        return spark.createDataFrame([(value,)], f"x {ddl}")

    def union(*tables):
        df = joins.union_missing(*tables)
        return df.dtypes[0][1], {r[0] for r in df.collect()}

    assert union(table(LONG, "long"), table(1, "int")) == ("bigint", {LONG, 1})
    assert union(table(1, "int"), table(LONG, "long"), table(Decimal("0.5"), "decimal(3,1)")) == ("decimal(20,1)", {Decimal(LONG), Decimal(1), Decimal("0.5")})
    assert union(table(LONG, "long"), table(0.5, "double")) == ("string", {str(LONG), "0.5"})
    assert union(table(7, "long"), table(0.5, "double")) == ("double", {7.0, 0.5})
    assert union(table(0.5, "double"), table(7, "int"), table("x", "string")) == ("string", {"0.5", "7", "x"})


def test_expand_keeps_whole_numbers(spark):
    df = spark.createDataFrame([("a", LONG, 2, 1.5, 3)], "id string, s1_x long, s2_x int, s1_y double, s2_y long")
    long, _ = reshape.expand(df, "id")
    assert dict(long.dtypes) == {"id": "string", "session_number": "string", "x": "bigint", "y": "double"}
    assert rows(long) == [("a", "s1", LONG, 1.5), ("a", "s2", 2, 3.0)]
