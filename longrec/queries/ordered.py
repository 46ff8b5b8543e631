"""Ordered operators."""

from pyspark.sql import functions as F

from longrec.operators import ages, ordered
from longrec.queries import query, table

# A value that most rows lack: the amount of purchases.
_PURCHASE = "case when event_type = 'purchase' then value end"


def _purchases(spark, d):
    return table(spark, d, "events").select(
        "event_id", "ts", "user_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount")
    )


def _sixteenth(rows):
    """A size all of five keys exceed."""
    return rows.count() // 16


def _order_years(spark, d):
    """One row per customer and order year, so no customer has more rows than there are years."""
    return table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("order_year")).distinct()


def _runs(rows, key, year, order, n, skip=1, first=None):
    """Islands of years in SQL."""
    limit = f"where rn <= {first}" if first else ""
    return f"""
with y as ({rows}),
b as (select *, case when {year} - lag({year}) over (partition by {key} order by {order}) = {skip} then 0 else 1 end brk from y),
r as (select *, sum(brk) over (partition by {key} order by {order} rows unbounded preceding) run from b),
s as (select *, count(*) over (partition by {key}, run) size from r),
k as (select *, row_number() over (partition by {key} order by {order}) rn from s where size >= {n})
select * exclude (brk, run, size, rn) from k {limit}"""


_YEARS = "select distinct o_custkey, cast(year(o_orderdate) as integer) order_year from orders"


@query("consecutive_years", _runs(_YEARS, "o_custkey", "order_year", "order_year", 3, first=3))
def consecutive_years(spark, d):
    return ordered.consecutive_years(
        _order_years(spark, d), ["o_custkey"], "order_year", ["order_year"], 3, split_above=None
    )


@query("consecutive_years_keep_all", _runs(_YEARS, "o_custkey", "order_year", "order_year", 3))
def consecutive_years_keep_all(spark, d):
    return ordered.consecutive_years(
        _order_years(spark, d), ["o_custkey"], "order_year", ["order_year"], 3, keep_all=True, split_above=None
    )


@query("consecutive_years_skip", _runs(_YEARS, "o_custkey", "order_year", "order_year", 2, skip=2, first=2))
def consecutive_years_skip(spark, d):
    return ordered.consecutive_years(
        _order_years(spark, d), ["o_custkey"], "order_year", ["order_year"], 2, skip=2, split_above=None
    )


@query(
    "consecutive_years_agnostic",
    f"""
with y as ({_YEARS}),
b as (select *, case when order_year - lag(order_year) over (partition by o_custkey order by order_year) = 1 then 0 else 1 end brk from y),
r as (select *, sum(brk) over (partition by o_custkey order by order_year rows unbounded preceding) run from b),
s as (select *, count(*) over (partition by o_custkey, run) size from r),
k as (select c_custkey as o_custkey, cast(null as integer) order_year from customer
        where (select count(*) from y where y.o_custkey = c_custkey) >= 3
      union all select o_custkey, order_year from s where size >= 3),
n as (select *, row_number() over (partition by o_custkey order by order_year nulls first) rn from k)
select o_custkey, order_year from n where rn <= 3""",
)
def consecutive_years_agnostic(spark, d):
    stable = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.lit(None).cast("int").alias("order_year")
    )
    return ordered.consecutive_years(
        stable.unionByName(_order_years(spark, d)), ["o_custkey"], "order_year", ["order_year"], 3, split_above=None
    )


@query(
    "consecutive_years_long_groups",
    _runs(
        "select o_orderkey, o_orderdate, o_orderpriority, cast(year(o_orderdate) as integer) order_year from orders",
        "o_orderpriority", "order_year", "o_orderdate, o_orderkey", 2,
    ),
)
def consecutive_years_long_groups(spark, d):
    """Five keys hold all rows: scanned in slices."""
    rows = table(spark, d, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", F.year("o_orderdate").alias("order_year")
    )
    return ordered.consecutive_years(
        rows, ["o_orderpriority"], "order_year", ["o_orderdate", "o_orderkey"], 2, keep_all=True,
        split_above=_sixteenth(rows),
    )


@query(
    "first_valid",
    f"""select event_id, ts, user_id,
  first_value({_PURCHASE} ignore nulls) over (partition by user_id order by event_id
    rows between unbounded preceding and unbounded following) amount from events""",
)
def first_valid(spark, d):
    return ordered.first_valid(_purchases(spark, d), ["user_id"], ["amount"], ["event_id"])


@query(
    "forward_fill",
    f"""select event_id, ts, user_id, last_value({_PURCHASE} ignore nulls) over (partition by user_id
  order by ts, event_id rows between unbounded preceding and current row) amount from events""",
)
def forward_fill(spark, d):
    return ordered.forward_fill(_purchases(spark, d), ["user_id"], ["amount"], ["ts", "event_id"])


@query(
    "backward_fill",
    f"""select event_id, ts, user_id, first_value({_PURCHASE} ignore nulls) over (partition by user_id
  order by ts, event_id rows between current row and unbounded following) amount from events""",
)
def backward_fill(spark, d):
    return ordered.backward_fill(_purchases(spark, d), ["user_id"], ["amount"], ["ts", "event_id"])


def _large(spark, d):
    return table(spark, d, "events").select(
        "event_id", "ts", "event_type", F.when(F.col("value") >= 100, F.col("value")).alias("large")
    )


@query(
    "forward_fill_long_groups",
    """select event_id, ts, event_type, last_value(case when value >= 100 then value end ignore nulls) over (
  partition by event_type order by ts, event_id rows between unbounded preceding and current row) large from events""",
)
def forward_fill_long_groups(spark, d):
    """Five keys hold all rows: filled in slices with a carried value."""
    rows = _large(spark, d)
    return ordered.forward_fill(rows, ["event_type"], ["large"], ["ts", "event_id"], split_above=_sixteenth(rows))


@query(
    "backward_fill_long_groups",
    """select event_id, ts, event_type, first_value(case when value >= 100 then value end ignore nulls) over (
  partition by event_type order by ts, event_id rows between current row and unbounded following) large from events""",
)
def backward_fill_long_groups(spark, d):
    rows = _large(spark, d)
    return ordered.backward_fill(rows, ["event_type"], ["large"], ["ts", "event_id"], split_above=_sixteenth(rows))


@query(
    "dedupe_keep_last",
    """select event_id, ts, user_id, event_type, value from (
  select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) rn from events) where rn = 1""",
)
def dedupe_keep_last(spark, d):
    rows = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ordered.keep_last(rows, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "first_rows",
    """select o_custkey, o_orderkey, o_totalprice from (
  select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) rn from orders) where rn <= 3""",
)
def first_rows(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return ordered.first_rows(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], 3).drop("o_orderdate")


@query(
    "group_size",
    "select l_orderkey, l_linenumber, l_partkey, count(*) over (partition by l_orderkey, l_linenumber) group_size from lineitem",
)
def group_size(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return ordered.group_size(rows, ["l_orderkey", "l_linenumber"])


@query(
    "first_of_subject",
    f"""select user_id, first(ts order by ts, event_id) filter (({_PURCHASE}) is not null) first_ts,
  first({_PURCHASE} order by ts, event_id) filter (({_PURCHASE}) is not null) first_amount from events group by user_id""",
)
def first_of_subject(spark, d):
    """The first row with a value: its time and its value."""
    order = ["ts", "event_id"]
    dated = F.when(F.col("amount").isNotNull(), F.col("ts"))
    return (
        _purchases(spark, d)
        .groupBy("user_id")
        .agg(ordered.earliest(dated, order).alias("first_ts"), ordered.earliest("amount", order).alias("first_amount"))
    )


@query(
    "running_offset",
    """select conv_id, turn, cast(coalesce(sum(length(text)) over (partition by conv_id order by turn
  rows between unbounded preceding and 1 preceding), 0) as bigint) text_start from conversations""",
)
def running_offset(spark, d):
    """Where each turn starts in its conversation's text."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.length("text").cast("long").alias("size"))
    return ordered.running_sum(rows, ["conv_id"], "size", ["turn"], "text_start").drop("size")


@query(
    "session_age",
    """with s as (select *, first_value(case when event_type = 'signup' then ts end ignore nulls) over (
  partition by user_id order by ts, event_id rows between unbounded preceding and unbounded following) dob from events)
select event_id, user_id, dob, floor((epoch_us(ts) - epoch_us(dob)) / 86400000000.0) / 365.25 session_age, ts from s""",
)
def session_age(spark, d):
    """Age since the first signup, put before the date."""
    rows = table(spark, d, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") == "signup", F.col("ts")).alias("dob"), "ts"
    )
    return ages.with_age(rows, "user_id", "dob", "ts", "session_age", ["ts", "event_id"])
