"""Reshaping."""

from pyspark.sql import functions as F

from longrec.operators import columns, reshape
from longrec.operators.joins import stable_left_long
from longrec.queries import query, table

LINES = range(1, 8)
YEARS = range(1995, 2002)
TYPES = ("click", "error", "purchase", "signup", "view")
_BOTH = [("l_discount", "discount"), ("l_quantity", "quantity")]


def _lines(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount")
    )


_WIDE = "select l_orderkey, " + ", ".join(
    f"max(case when l_linenumber = {k} then {c} end) s{k}_{n}" for k in LINES for c, n in _BOTH
) + " from lineitem group by l_orderkey"


def _wide(spark, d):
    return reshape.simple_flatten(_lines(spark, d), ["l_orderkey"], "l_linenumber", "s", agg=F.max)


@query("flatten_sessions", _WIDE)
def flatten_sessions(spark, d):
    """Lines of an order side by side; lines may repeat, so the largest value is taken."""
    return _wide(spark, d)


@query(
    "expand_sessions",
    f"with w as ({_WIDE}) "
    + " union all ".join(
        f"select l_orderkey, 's{k}' session_number, s{k}_discount discount, s{k}_quantity quantity from w "
        f"where s{k}_discount is not null or s{k}_quantity is not null"
        for k in LINES
    ),
)
def expand_sessions(spark, d):
    return reshape.expand(_wide(spark, d), "l_orderkey")[0]


def _arms(spark, d):
    """Customers as the stable arm, their order years as sessions."""
    stable = table(spark, d, "customer").select(
        "c_custkey", F.lit(0).alias("session"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")
    )
    yearly = (
        table(spark, d, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"), (F.year("o_orderdate") - 1994).alias("session"))
        .agg(F.max("o_totalprice").alias("top"), F.count(F.lit(1)).alias("orders"))
    )
    return stable.unionByName(yearly, allowMissingColumns=True)


_YEARLY = """select o_custkey, cast(year(o_orderdate) - 1994 as integer) session, max(o_totalprice) top, count(*) orders
  from orders group by 1, 2"""


@query(
    "flatten_stable_long",
    f"""with y as ({_YEARLY}) select c_custkey, any_value(c_mktsegment) s0_segment, any_value(c_nationkey) s0_nation, """
    + ", ".join(f"max(case when session = {k - 1994} then {v} end) s{k - 1994}_{v}" for k in YEARS for v in ("top", "orders"))
    + " from customer left join y on o_custkey = c_custkey group by c_custkey",
)
def flatten_stable_long(spark, d):
    return reshape.flatten(_arms(spark, d), "c_custkey", "session", "s")


@query(
    "stable_left_long",
    "select c_custkey, c_mktsegment, n, top from customer left join "
    "(select o_custkey, count(*) n, max(o_totalprice) top from orders group by 1) on o_custkey = c_custkey",
)
def stable_left(spark, d):
    long = (
        table(spark, d, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    )
    return stable_left_long(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), long, "c_custkey")


def _sessions(spark, d):
    """(subject, session, top): session 0 is the first year."""
    return (
        table(spark, d, "orders")
        .groupBy("o_custkey", (F.year("o_orderdate") - 1995).alias("session"))
        .agg(F.max("o_totalprice").alias("top"))
    )


_FROM_FIRST = "select o_custkey, " + ", ".join(
    f"max(case when year(o_orderdate) = {y} then o_totalprice end) s{y - 1995}_top" for y in YEARS
) + " from orders group by o_custkey having count(*) filter (year(o_orderdate) = 1995) > 0"


@query("auto_reshape_wide", _FROM_FIRST)
def auto_reshape_wide(spark, d):
    """Several rows per subject: becomes wide."""
    return reshape.reshape(_sessions(spark, d))


@query(
    "auto_reshape_long",
    f"with w as ({_FROM_FIRST}) "
    + " union all ".join(f"select o_custkey, 's{y - 1995}' session_number, s{y - 1995}_top top from w where s{y - 1995}_top is not null" for y in YEARS),
)
def auto_reshape_long(spark, d):
    """One row per subject with session suffixes: becomes long."""
    wide = reshape.reshape(_sessions(spark, d), "flatten")
    suffixed = wide.withColumnsRenamed({c: "top_" + c.split("_")[0] for c in wide.columns[1:]})
    return reshape.reshape(suffixed)


@query("reshape_direction", "select case when count(*) = count(distinct o_custkey) then 'expand' else 'flatten' end direction, count(*) as rows from orders")
def reshape_direction(spark, d):
    orders = table(spark, d, "orders")
    return orders.agg(F.lit(reshape.reshape_direction(orders, "o_custkey")).alias("direction"), F.count(F.lit(1)).alias("rows"))


@query(
    "double_flatten",
    "select user_id, "
    + ", ".join(
        f"max(case when event_type = '{t}' and ceil(day(ts) / 8.0) = {w} then value end) s{w}_{t}_top, "
        f"max(case when event_type = '{t}' and ceil(day(ts) / 8.0) = {w} then event_id end) s{w}_{t}_last"
        for w in (1, 2, 3, 4)
        for t in TYPES
    )
    + " from events group by user_id",
)
def double_flatten(spark, d):
    """Week of the month, then event type, side by side."""
    rows = table(spark, d, "events").select(
        "user_id", F.ceil(F.dayofmonth("ts") / 8.0).cast("int").alias("week"), "event_type",
        F.col("event_id").alias("last"), F.col("value").alias("top"),
    )
    return reshape.double_flatten(rows, "user_id", "week", "event_type", "s", agg=F.max)


@query(
    "blocks_wide",
    "select l_suppkey, "
    + ", ".join(
        f"max(case when l_returnflag = '{b}' and l_linestatus = '{m}' then {c} end) {b.lower()}_{m.lower()}_{s}"
        for b in "ANR" for m in "FO" for c, s in (("l_quantity", "left"), ("l_tax", "right"))
    )
    + " from lineitem group by l_suppkey",
)
def blocks_wide(spark, d):
    rows = table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(
        F.max("l_quantity").alias("Left"), F.max("l_tax").alias("Right")
    )
    return reshape.blocks_wide(rows, "l_suppkey", "l_returnflag", "l_linestatus", ["Left", "Right"])


@query(
    "long_transpose",
    " union all ".join(
        f"select '{c}' variable, c_custkey, cast({c} as varchar) as value from customer"
        for c in ("c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    ),
)
def long_transpose(spark, d):
    return reshape.long_transpose(table(spark, d, "customer"), "c_custkey")


@query(
    "transpose_small",
    "select 'n_name' variable, " + ", ".join(f"max(case when n_nationkey = {k} then n_name end) \"{k}\"" for k in range(25))
    + " from nation union all select 'n_regionkey', "
    + ", ".join(f"max(case when n_nationkey = {k} then cast(n_regionkey as varchar) end)" for k in range(25)) + " from nation",
)
def transpose_small(spark, d):
    """Nations as columns; the number of rows is checked first."""
    return reshape.transpose_small(table(spark, d, "nation"), "n_nationkey")


@query(
    "drop_empty_columns",
    "select user_id, " + ", ".join(f"max(value) filter (event_type = '{t}') {t}" for t in TYPES) + " from events group by user_id",
)
def drop_empty_columns(spark, d):
    """Refunds are planned for but never occur."""
    wide = table(spark, d, "events").groupBy("user_id").pivot("event_type", [*TYPES, "refund"]).agg(F.max("value"))
    return columns.drop_empty_columns(wide, keep=["user_id"])


@query(
    "column_order_by_session",
    "select user_id, " + ", ".join(
        f"max({v}) filter (event_type = '{t}') c{t}_{v}" for t in TYPES for v in ("event_id", "value")
    ) + " from events group by user_id",
)
def column_order_by_session(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", "value", "event_id")
    return reshape.simple_flatten(rows, ["user_id"], "event_type", "c", sort=True, agg=F.max)


@query(
    "default_session_names",
    "select c_custkey, c_nationkey, c_mktsegment from customer",
)
def default_session_names(spark, d):
    """Give unprefixed names a session, reshape, and take it away again."""
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    long, renamed = reshape.expand(rows, "c_custkey")
    return reshape.drop_default_session(reshape.simple_flatten(long, ["c_custkey"], "session_number"), renamed)
