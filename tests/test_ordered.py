import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from longrec.operators import ordered

YEARS = [
    ([2010, 2011, 2012, 2015, 2016, 2017], 3, 1, False, [2010, 2011, 2012]),
    ([2010, 2011, 2012, 2015, 2016, 2017], 3, 1, True, [2010, 2011, 2012, 2015, 2016, 2017]),
    ([2010, 2012, 2014], 2, 1, False, []),
    ([2010, 2012, 2014], 2, 2, False, [2010, 2012]),
    ([2010, 2013, 2014, 2015], 3, 1, False, [2013, 2014, 2015]),
    ([2010, 2011], 3, 1, False, []),
    ([None, 2010, 2011, 2012], 3, 1, False, [None, 2010, 2011]),
    ([None, 2010, 2011], 3, 1, False, []),
    ([None, 2010, 2012, 2014], 3, 1, False, [None]),
    # a repeated year breaks the run, a later null year is left out
    ([2010, 2011, 2011, 2012], 2, 1, True, [2010, 2011, 2011, 2012]),
    ([2010, None, 2011], 2, 1, True, [2010, 2011]),
]


def year_rows(spark, years):
    return spark.createDataFrame([("a", i, y) for i, y in enumerate(years)], "id string, i int, year int")


@pytest.mark.parametrize("years,n,skip,keep_all,expected", YEARS)
def test_consecutive_years(spark, years, n, skip, keep_all, expected):
    df = year_rows(spark, years)
    kept = ordered.consecutive_years(df, ["id"], "year", ["i"], n, skip, keep_all)
    assert [r["year"] for r in sorted(kept.collect(), key=lambda r: r["i"])] == expected


@pytest.mark.parametrize("years,n,skip,keep_all,expected", [c for c in YEARS if len(c[0]) > 3])
def test_consecutive_years_in_slices(spark, years, n, skip, keep_all, expected):
    df = year_rows(spark, years)
    kept = ordered.consecutive_years(df, ["id"], "year", ["i"], n, skip, keep_all, split_above=2)
    assert [r["year"] for r in sorted(kept.collect(), key=lambda r: r["i"])] == expected


def test_consecutive_years_needs_two(spark):
    with pytest.raises(ValueError):
        ordered.consecutive_years(year_rows(spark, [2010]), ["id"], "year", ["i"], 1)


def test_order_is_required(spark):
    df = year_rows(spark, [2010])
    for call in (
        lambda: ordered.forward_fill(df, ["id"], ["year"], []),
        lambda: ordered.keep_last(df, ["id"], []),
        lambda: ordered.first_valid(df, ["id"], ["year"], []),
    ):
        with pytest.raises(ValueError):
            call()


def values(spark, vs):
    return spark.createDataFrame([("a", i, v) for i, v in enumerate(vs)], "id string, i int, v int")


def by_order(df):
    return [r["v"] for r in sorted(df.collect(), key=lambda r: r["i"])]


def test_fills(spark):
    df = values(spark, [None, 5, None, 7])
    assert by_order(ordered.first_valid(df, ["id"], ["v"], ["i"])) == [5, 5, 5, 5]
    assert by_order(ordered.forward_fill(df, ["id"], ["v"], ["i"])) == [None, 5, 5, 7]
    assert by_order(ordered.backward_fill(df, ["id"], ["v"], ["i"])) == [5, 5, 7, 7]
    assert by_order(ordered.running_sum(df.fillna(1, ["v"]), ["id"], "v", ["i"], "v2").drop("v").withColumnRenamed("v2", "v")) == [0, 1, 6, 7]


def test_first_valid_without_any(spark):
    assert by_order(ordered.first_valid(values(spark, [None, None]), ["id"], ["v"], ["i"])) == [None, None]


def test_null_order_comes_first(spark):
    df = spark.createDataFrame([("a", None, 1, 3), ("a", 1, 2, 4)], "id string, i int, j int, v int")
    for order in (["i"], ["i", "j"]):
        assert {r["v"] for r in ordered.first_valid(df, ["id"], ["v"], order).collect()} == {3}


def test_rows_without_subject_have_no_first_value(spark):
    df = spark.createDataFrame([(None, 1, 3), ("a", 1, 4)], "id string, i int, v int")
    assert rows(ordered.first_valid(df, ["id"], ["v"], ["i"])) == [("a", 1, 4), (None, 1, None)]


def hot_table(spark, n=400, seed=7):
    """One subject holds most rows, one key is null, values are sparse and years repeat."""
    pick = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if pick.random() < 0.7 else pick.choice(["a", "b", "c", None])
        data.append((key, i, pick.choice([None, None, i]), 2000 + i // 9 + pick.choice([0, 0, 1])))
    pick.shuffle(data)
    return spark.createDataFrame(data, "id string, i int, v int, year int")


def test_slices_equal_plain_windows(spark):
    df = hot_table(spark)
    for scan in (
        lambda split: ordered.forward_fill(df, ["id"], ["v"], ["i"], split_above=split),
        lambda split: ordered.backward_fill(df, ["id"], ["v"], ["i"], split_above=split),
        lambda split: ordered.running_sum(df, ["id"], "year", ["i"], "s", split_above=split),
        lambda split: ordered.consecutive_years(df, ["id"], "year", ["i"], 2, keep_all=True, split_above=split),
    ):
        assert rows(scan(None)) == rows(scan(25))


def test_slices_without_a_key_list(spark, monkeypatch):
    monkeypatch.setattr(ordered, "MAX_LISTED_KEYS", 0)
    df = hot_table(spark)
    assert rows(ordered.forward_fill(df, ["id"], ["v"], ["i"], split_above=25)) == rows(
        ordered.forward_fill(df, ["id"], ["v"], ["i"], split_above=None)
    )


def test_slices_are_bounded(spark):
    short, sliced = ordered.split_long_groups(hot_table(spark), ["id"], ["i"], 60)
    assert {r["id"] for r in short.select("id").distinct().collect()} == {"a", "b", "c", None}
    sizes = [r["count"] for r in sliced.groupBy(ordered.SLICE).count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 120


def test_keep_last_and_first_rows(spark):
    df = hot_table(spark)
    plain = {}
    for r in sorted(df.collect(), key=lambda r: r["i"]):
        plain.setdefault(r["id"], []).append(tuple(r))
    assert rows(ordered.keep_last(df, ["id"], ["i"])) == sorted((v[-1] for v in plain.values()), key=repr)
    assert rows(ordered.first_rows(df, ["id"], ["i"], 3)) == sorted((r for v in plain.values() for r in v[:3]), key=repr)
    sizes = {r["id"]: r["n"] for r in ordered.group_size(df, ["id"], "n").collect()}
    assert sizes == {k: len(v) for k, v in plain.items() if k is not None} | {None: None}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    years=st.lists(st.lists(st.integers(2000, 2012), min_size=1, max_size=9, unique=True), min_size=1, max_size=12),
    n=st.integers(2, 4),
    skip=st.integers(1, 2),
)
def test_every_kept_run_is_long_enough(spark, years, n, skip):
    data = [(k, y) for k, ys in enumerate(years) for y in ys]
    df = spark.createDataFrame(data, "id int, year int")
    kept = {}
    for r in ordered.consecutive_years(df, ["id"], "year", ["year"], n, skip, True, split_above=None).collect():
        kept.setdefault(r["id"], []).append(r["year"])
    for k, ys in enumerate(years):
        expected, run = [], []
        for y in sorted(ys) + [None]:
            if run and (y is None or y - run[-1] != skip):
                expected += run if len(run) >= n else []
                run = []
            run.append(y)
        assert sorted(kept.get(k, [])) == expected


def test_forward_fill_twice_changes_nothing(spark):
    once = ordered.forward_fill(hot_table(spark), ["id"], ["v"], ["i"])
    assert rows(ordered.forward_fill(once, ["id"], ["v"], ["i"])) == rows(once)


def test_one_sketch_for_a_chain(spark, monkeypatch):
    data = [(f"k{i % 7}" if i % 3 else "long", i, i if i % 5 == 0 else None, None if i % 4 else f"v{i}") for i in range(300)] + [(None, 1, 2, "n")]
    df = spark.createDataFrame(data, "k string, o int, a int, b string")

    def chain(split, sketch):
        filled = ordered.forward_fill(df, ["k"], ["a"], ["o"], split, sketch)
        filled = ordered.backward_fill(filled, ["k"], ["b"], ["o"], split, sketch)
        return rows(ordered.running_sum(filled, ["k"], "o", ["o"], "s", split, sketch).select("k", "o", "a", "b", "s"))

    plain = chain(None, None)
    counted, count = [], ordered.key_sketch
    monkeypatch.setattr(ordered, "key_sketch", lambda *a: counted.append(a) or count(*a))
    for split in (20, 60, 1000):
        sketch = ordered.key_sketch(df, ["k"], split)
        counted.clear()
        assert chain(split, sketch) == plain and not counted
        assert chain(split, None) == plain and len(counted) == 3
        # one made for a smaller bound serves too, one for a larger bound or other keys does not
        assert chain(split, count(df, ["k"], 5)) == plain and len(counted) == 3
        assert chain(split, count(df, ["o"], 1)) == plain and len(counted) == 6
    # keys of one bucket are told apart by exact counts
    monkeypatch.setattr(ordered, "KEY_BUCKETS", 1)
    assert count(df, ["k"], 60).buckets == (0,) and chain(60, None) == plain
    monkeypatch.setattr(ordered, "MAX_LISTED_KEYS", 0)
    assert chain(20, None) == plain
