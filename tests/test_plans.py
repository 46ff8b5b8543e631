"""The physical plans are the ones we want."""

import re

import pytest

from pyspark.sql import functions as F

from longrec.operators import joins, ordered, predicates, regression, reshape

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def events(spark):
    return spark.read.parquet(f"{DATA}/events.parquet")


def shuffles(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_top_rows_are_limited_before_the_shuffle(spark):
    for df in (
        ordered.first_rows(events(spark), ["user_id"], ["ts"], 2),
        ordered.keep_last(events(spark), ["user_id"], ["ts"]),
    ):
        text = plan(df)
        assert text.count("WindowGroupLimit") == 2 and "Partial" in text and shuffles(text) == 1


def test_fills_shuffle_once(spark):
    assert shuffles(plan(ordered.forward_fill(events(spark), ["user_id"], ["value"], ["ts"]))) == 1
    assert shuffles(plan(ordered.backward_fill(events(spark), ["user_id"], ["value"], ["ts"]))) == 1


def test_year_runs_shuffle_once(spark):
    df = events(spark).withColumn("year", F.year("ts"))
    assert shuffles(plan(ordered.consecutive_years(df, ["user_id"], "year", ["ts"], 2))) == 1


def test_first_valid_is_a_partial_aggregate(spark):
    text = plan(ordered.first_valid(events(spark), ["user_id"], ["value"], ["event_id"]))
    assert "partial_min_by" in text and "Window" not in text
    # the aggregate reads its three columns only
    assert re.search(r"ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>", text)


def test_pivot_shuffles_once_and_combines_first(spark):
    df = events(spark).select("user_id", "event_type", "value")
    text = plan(reshape.simple_flatten(df, ["user_id"], "event_type", agg=F.max))
    assert shuffles(text) == 1 and "partial_max" in text


def test_unique_numbers_pivot_in_a_hash_aggregate(spark):
    df = spark.read.parquet(f"{DATA}/orders.parquet").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(
        F.max("o_totalprice").alias("top")
    )
    text = plan(reshape.simple_flatten(df, ["o_custkey"], "y"))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_expand_is_narrow(spark):
    df = spark.read.parquet(f"{DATA}/customer.parquet")
    assert "Exchange" not in plan(reshape.expand(df, "c_custkey")[0])


def test_key_filters_reach_the_scan(spark):
    df = events(spark).withColumn("v", F.when(F.col("event_type") == "view", F.col("value")))
    filled = ordered.forward_fill(df, ["user_id"], ["v"], ["ts"], split_above=None).where("user_id = 3")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(user_id,3\)", plan(filled))
    kept = predicates.subjects_in(events(spark), "event_type", ["view", "click"]).select("event_id")
    assert re.search(r"PushedFilters: \[[^\]]*In\(event_type", plan(kept))
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan(kept)


def test_no_python_and_no_products(spark):
    """Nothing runs in Python, and no operator multiplies tables."""
    from longrec import queries as registry

    skipped = {"stream_upserts", "upsert_store", "store_writers", "stream_of_jobs"}
    python, products = [], []
    for name, run in registry.QUERIES.items():
        if name in skipped:
            continue
        text = plan(run(spark, DATA))
        if "EvalPython" in text or "InPandas" in text:
            python.append(name)
        if "CartesianProduct" in text or "BroadcastNestedLoopJoin" in text:
            products.append(name)
    assert python == []
    assert products == []


def test_slopes_are_one_aggregate(spark):
    df = spark.read.parquet(f"{DATA}/orders.parquet").withColumn("year", F.year("o_orderdate"))
    text = plan(regression.subject_slopes(df, "o_custkey", "year", ["o_totalprice"], ["o_orderkey"]))
    assert shuffles(text) == 1 and "Window" not in text


def test_density_explodes_per_subject(spark):
    text = plan(joins.densify(events(spark).select("user_id", "event_type").distinct(), "user_id", "event_type", ["view", "x"]))
    assert "Generate explode" in text


def test_migration_counts_while_it_writes(spark, monkeypatch):
    """No aggregate of its own is run over the migrated rows."""
    from pyspark.sql.classic.dataframe import DataFrame

    from longrec.queries import jobs

    wanted = sorted(map(repr, jobs.job_migrate(spark, DATA).collect()))
    monkeypatch.setattr(DataFrame, "agg", lambda *a: pytest.fail("an aggregate over a whole table"))
    migrated, plan = jobs.migrated(spark, DATA)
    assert {t.column for t in plan} >= {"visits", "price"}
    monkeypatch.undo()
    assert sorted(map(repr, migrated.collect())) == wanted
