"""Column selection and renaming on the driver tables."""

from pyspark.sql import functions as F

from longrec.functions import dates
from longrec.operators import columns
from longrec.operators.recode import ChangeMap, Change, Dictionary, dropped_columns, rename_changed
from longrec.operators.reshape import suffix_to_prefix
from longrec.queries import query, table


@query("columns_matching", "select o_orderkey, o_orderstatus, o_orderdate, o_orderpriority from orders")
def columns_matching(spark, d):
    """Names that begin with the pattern; the first match alone; search anywhere."""
    df = table(spark, d, "orders")
    begins = columns.matching(df.columns, "o_order")
    assert columns.first_matching(df.columns, "o_order") == begins[0]
    return df.select(*begins)


@query("columns_searching", "select l_returnflag, l_linestatus, l_shipdate, l_extendedprice from lineitem")
def columns_searching(spark, d):
    df = table(spark, d, "lineitem")
    return df.select(*columns.searching(df.columns, ["flag", "status$", "date", "price"]))


@query("keep_mapped_columns", "select c_custkey, c_acctbal from customer")
def keep_mapped_columns(spark, d):
    return columns.keep_mapped(table(spark, d, "customer"), ["c_acctbal", "c_custkey", "c_phone"])


@query("extract_fields", "select l_orderkey, l_linenumber, l_quantity, l_shipdate, l_tax from lineitem")
def extract_fields(spark, d):
    return columns.extract_fields(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_ship", "l_tax"])


@query(
    "rename_common_columns",
    "select o_custkey study_id, o_orderdate session_date, o_orderkey session_number, o_totalprice from orders",
)
def rename_common_columns(spark, d):
    names = ["o_custkey", None, None, "o_orderdate", "o_orderkey"]
    df = table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    there = columns.rename_common(df, names)
    back = columns.rename_common(there, names, back=True)
    assert back.columns == df.columns
    return columns.rename_common(back, names)


@query("rename_by_table", "select p_partkey part, p_brand brand, p_size from part")
def rename_by_table(spark, d):
    df = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    return columns.rename_by_table(df, {"p_partkey": "part", "p_brand": "brand", "p_size": None})


@query("rename_from_lines", "select s_suppkey id, s_name, s_nationkey country, s_acctbal balance from supplier")
def rename_from_lines(spark, d):
    """Whole names only: a line for ``s_n`` leaves ``s_name`` alone."""
    return columns.rename_from_lines(
        table(spark, d, "supplier"), ["s_suppkey,id", "s_n,x", "s_nationkey,country", "", "s_acctbal,balance"]
    )


@query("rename_by_rules", "select p_partkey, p_name, p_brand, p_type p_kind, p_size, p_retailprice price from part")
def rename_by_rules(spark, d):
    return columns.rename_by_rules(
        table(spark, d, "part"),
        [
            (lambda c: "type" in c, lambda c: c.replace("type", "kind")),
            (lambda c: "retail" in c, lambda c: c[2:].replace("retail", "")),
        ],
    )


@query("suffix_to_prefix", "select user_id, max(value) s1_top, min(value) s2_low from events group by user_id")
def suffix_to_prefix_names(spark, d):
    df = table(spark, d, "events").groupBy("user_id").agg(F.max("value").alias("top_s1"), F.min("value").alias("low_s2"))
    return df.withColumnsRenamed(suffix_to_prefix(df.columns))


_BOXES = ("click", "purchase", "view")


def _boxes(spark, d):
    """A checkbox family per user, a calculated field and an unknown column."""
    return table(spark, d, "events").groupBy("user_id").agg(
        *[F.max((F.col("event_type") == t).cast("int")).alias(f"seen___{i + 1}") for i, t in enumerate(_BOXES)],
        F.sum("value").alias("total"),
        F.max("value").alias("top"),
        F.min("ts").alias("first_seen"),
        F.count(F.lit(1)).alias("stray"),
    )


_DICTIONARY = Dictionary(
    tuple(
        {"name": n, "form": f, "type": t, "label": n, "choices": None}
        for n, f, t in (("kinds", "activity", "checkbox"), ("total", "activity", "calc"), ("highest", "activity", "text"), ("first_seen", "activity", "text"))
    )
)
_CHANGES = ChangeMap((Change("seen", "kinds"), Change("top", "highest"), Change("first_seen", "first_seen", drop=True)))


@query(
    "rename_checkbox_families",
    "select user_id, "
    + ", ".join(f"cast(max(case when event_type = '{t}' then 1 else 0 end) as integer) kinds___{i + 1}" for i, t in enumerate(_BOXES))
    + ", max(value) highest from events group by user_id",
)
def rename_checkbox_families(spark, d):
    """Families follow their field; flagged, calculated and unknown columns are dropped."""
    df = rename_changed(_boxes(spark, d), _CHANGES, _DICTIONARY)
    return df.drop(*dropped_columns(df.columns, _CHANGES, _DICTIONARY, ["user_id"]))


@query("columns_of_forms", "select user_id, " + ", ".join(f"cast(max(case when event_type = '{t}' then 1 else 0 end) as integer) seen___{i + 1}" for i, t in enumerate(_BOXES)) + ", max(value) top from events group by user_id")
def columns_of_forms(spark, d):
    """The fields of a form with their checkbox families."""
    df = _boxes(spark, d)
    return df.select("user_id", *columns.family_union(df.columns, {"activity": ["seen", "top"]}, ["activity"]))


@query("constant_columns", "select s_suppkey, 1 yes_no, 'complete' as state from supplier")
def constant_columns(spark, d):
    return columns.with_constants(table(spark, d, "supplier").select("s_suppkey"), {"yes_no": 1, "state": "complete"})


@query("insert_before", "select o_orderkey, cast(year(o_orderdate) as integer) order_year, o_orderdate from orders")
def insert_before(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    placed = columns.insert_before(df, "o_orderdate", "order_year", F.year("o_orderdate"))
    assert placed.columns.index("order_year") == placed.columns.index("o_orderdate") - 1
    return placed


@query("drop_named_columns", "select l_orderkey, l_extendedprice from lineitem")
def drop_named_columns(spark, d):
    """Present or not, by name and by pattern with an exception."""
    df = table(spark, d, "lineitem").drop("l_comment", "l_suppkey", "l_partkey", "l_linenumber")
    return columns.drop_matching(df, r"l_(quantity|discount|tax|return|line|ship|extended)", unless="price")


@query(
    "only_stable_rows",
    "select o_orderkey, o_orderstatus, case when o_orderstatus = 'F' then o_totalprice end o_totalprice, "
    "case when o_orderstatus = 'F' then o_orderpriority end o_orderpriority from orders",
)
def only_stable_rows(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return columns.only_where(df, F.col("o_orderstatus") == "F", ["o_totalprice", "o_orderpriority"])


@query("year_of_date", "select o_orderkey, cast(year(o_orderdate) as integer) order_year from orders")
def year_of_date(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("order_year"))


@query(
    "best_age",
    "select p_partkey, case when p_size > 25 then p_retailprice / 100 else p_size / 2.0::double end age from part",
)
def best_age(spark, d):
    """The imaging age where there is one above 0, else the session age."""
    imaging = F.when(F.col("p_size") > 25, F.col("p_retailprice") / 100).otherwise(0.0)
    return table(spark, d, "part").select("p_partkey", dates.best_age(imaging, F.col("p_size") / 2.0).alias("age"))
