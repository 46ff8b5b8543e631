"""Filters, joins and aggregates."""

from pyspark.sql import functions as F

from longrec.functions import dates, values
from longrec.operators import ages, joins, predicates, recode
from longrec.queries import query, table

TYPES = ("click", "error", "purchase", "signup", "view")

# -- filters ------------------------------------------------------------------------------


@query("key_filter_regex", "select p_partkey, p_brand from part where regexp_matches(p_brand, '#(1|2)\\d$')")
def key_filter_regex(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_brand").where(predicates.key_matches("p_brand", r"#(1|2)\d$"))


@query(
    "attended_sessions",
    """with s as (select event_id, user_id, event_type as event,
  case when event_type in ('signup', 'error') then null else day(ts) end number,
  case when value > 100 then 1 end missed from events)
select event_id, user_id, event, cast(case when event = 'signup' then 0 else number end as integer) session, missed
from s where (event = 'signup' or number is not null) and missed is null""",
)
def attended_sessions(spark, d):
    """Signups are the stable rows; errors have no session number; large values mark missed ones."""
    rows = table(spark, d, "events").select(
        "event_id", "user_id", F.col("event_type").alias("event"),
        F.when(~F.col("event_type").isin("signup", "error"), F.dayofmonth("ts").cast("double")).alias("session"),
        F.when(F.col("value") > 100, 1).alias("missed"),
    )
    return predicates.keep_attended(rows, "session", "missed", "event", stable="signup")


@query("date_present", "select o_orderkey, o_orderdate as visit from orders where o_orderstatus <> 'P'")
def date_present(spark, d):
    """Text dates in two formats; anything else is no date."""
    text = (
        F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "M/d/yyyy"))
        .otherwise("pending")
    )
    rows = table(spark, d, "orders").select("o_orderkey", dates.parse_date(text).alias("visit"))
    return rows.where(F.col("visit").isNotNull())


_DAYS_SQL = "select user_id, cast(ts as date) as day, " + ", ".join(
    f"max(value) filter (event_type = '{t}') {t}" for t in TYPES
) + " from events group by 1, 2"


def _days(spark, d):
    """Event types side by side per user and day; most days lack some."""
    rows = table(spark, d, "events").select("user_id", F.col("ts").cast("date").alias("day"), "event_type", "value")
    return rows.groupBy("user_id", "day").pivot("event_type", list(TYPES)).agg(F.max("value"))


_FORMS = {"sales": ["click", "purchase"]}


@query(
    "require_all",
    f"with w as ({_DAYS_SQL}) select * from w where view is not null and (click is not null or purchase is not null) "
    "and (signup is not null)",
)
def require_all(spark, d):
    """An exact column, a form and a prefix."""
    return predicates.require_all(_days(spark, d), ["view", "sales", "sign"], _FORMS)


@query(
    "require_any",
    f"with w as ({_DAYS_SQL}) select * from w where view is not null or click is not null or purchase is not null",
)
def require_any(spark, d):
    return predicates.require_any(_days(spark, d), ["view", "sales"], _FORMS)


@query(
    "require_all_numeric",
    "with p as (select event_id, case when event_type = 'error' then 'n/a' else cast(value as varchar) end answer from events) "
    "select event_id, answer from p where try_cast(answer as double) is not null",
)
def require_all_numeric(spark, d):
    answer = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    return predicates.require_all(table(spark, d, "events").select("event_id", answer.alias("answer")), ["answer"], numeric=True)


@query("drop_all_null", f"with w as ({_DAYS_SQL}) select * from w where click is not null or error is not null")
def drop_all_null(spark, d):
    return predicates.drop_all_null(_days(spark, d), ["click", "error"])


@query(
    "subjects_in_table",
    "select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')",
)
def subjects_in_table(spark, d):
    wanted = table(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return predicates.subjects_in(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", wanted)


@query("subjects_in_list", "select c_custkey, c_mktsegment from customer where c_mktsegment in ('BUILDING', 'MACHINERY')")
def subjects_in_list(spark, d):
    return predicates.subjects_in(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", ["BUILDING", "MACHINERY"])


@query("with_orders", "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey)")
def with_orders(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return predicates.with_keys(table(spark, d, "customer").select("c_custkey"), orders, ["c_custkey"])


@query(
    "without_orders",
    "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'P')",
)
def without_orders(spark, d):
    """Customers without an order in process."""
    orders = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return predicates.without_keys(table(spark, d, "customer").select("c_custkey"), orders, ["c_custkey"])


@query(
    "imaging_or_stable",
    "select o_orderkey, case when o_orderstatus = 'P' then '0' else cast(year(o_orderdate) as varchar) end as label, "
    "case when o_orderpriority = '1-URGENT' then o_totalprice else 0 end age from orders "
    "where o_orderstatus = 'P' or o_orderpriority = '1-URGENT'",
)
def imaging_or_stable(spark, d):
    """Stable rows stay although their label is text."""
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", "0").otherwise(F.year("o_orderdate").cast("string")).alias("label"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).otherwise(0.0).alias("age"),
    )
    return rows.where(predicates.imaging_or_stable("age", "label"))


@query("non_empty_forms", f"with w as ({_DAYS_SQL}) select * from w where coalesce(click, 0) + coalesce(view, 0) <> 0")
def non_empty_forms(spark, d):
    return _days(spark, d).where(predicates.non_empty_form(["click", "view"]))


@query(
    "complete_demographics",
    f"with w as ({_DAYS_SQL}) select user_id, day, (signup is not null and view is not null) usable from w",
)
def complete_demographics(spark, d):
    usable, rejected = predicates.complete_demographics(_days(spark, d), ["signup", "view"])
    keep = ["user_id", "day"]
    return usable.select(*keep, F.lit(True).alias("usable")).unionByName(rejected.select(*keep, F.lit(False).alias("usable")))


@query("completed_forms", "select doc_id, quality from labels where quality <> 0")
def completed_forms(spark, d):
    return predicates.completed(table(spark, d, "labels").select("doc_id", "quality"), "quality")


@query(
    "parent_and_subject_rows",
    "select p_partkey, case when lower(p_name) like '%ring%' then 'parent' else 'subject' end as who from part",
)
def parent_and_subject_rows(spark, d):
    parent, subject = predicates.parent_rows(table(spark, d, "part"), "p_name", "RING")
    return parent.select("p_partkey", F.lit("parent").alias("who")).unionByName(
        subject.select("p_partkey", F.lit("subject").alias("who"))
    )


@query(
    "file_mismatches",
    "select source as file, true mismatch from documents where upper(source) like '%SRC1%' group by source "
    "having bool_or(upper(lang) not like '%SRC1%')",
)
def file_mismatches(spark, d):
    rows = table(spark, d, "documents").select(F.col("source").alias("file"), "lang")
    return predicates.file_mismatches(rows, "file", "lang", "src1")


@query("year_count_check", "select cast(count(distinct year(o_orderdate)) - 1 as bigint) most from orders")
def year_count_check(spark, d):
    """The largest number of years the range check lets through."""
    years = table(spark, d, "orders").select(F.year("o_orderdate").alias("event"))
    predicates.check_year_count(years, "event", 3)
    predicates.check_not_empty(years)
    return years.agg((F.countDistinct("event") - 1).alias("most"))


# -- joins --------------------------------------------------------------------------------

_ENRICHED = """select o_orderkey, o_custkey, o_orderstatus, o.balance balance_original, c_acctbal balance, c_mktsegment segment
from (select *, o_totalprice balance from orders) o left join customer on c_custkey = o_custkey"""


def _enriched(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").alias("balance"))
    people = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return joins.enrich_left(orders, people, ["o_custkey"], ["c_custkey"], ["balance", "segment"])


@query("enrich_left", _ENRICHED)
def enrich_left(spark, d):
    return _enriched(spark, d)


@query("undo_enrich", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice balance from orders")
def undo_enrich(spark, d):
    return joins.undo_enrich(_enriched(spark, d), ["balance", "segment"])


@query(
    "merge_fill",
    """with b as (select o_custkey as id, max(o_totalprice) filter (o_orderstatus = 'F') top, count(*) n from orders group by 1),
i as (select user_id as id, max(value) top, min(value) low from events group by 1)
select id, coalesce(b.top, i.top) top, n, low from b full join i using (id)""",
)
def merge_fill(spark, d):
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("top"), F.count(F.lit(1)).alias("n")
    )
    events = table(spark, d, "events").groupBy(F.col("user_id").alias("id")).agg(
        F.max("value").alias("top"), F.min("value").alias("low")
    )
    return joins.merge_fill(orders, events, ["id"])


@query("mapping_join", "select n_nationkey, n_name, n_regionkey, r_name from nation join region on n_regionkey = r_regionkey")
def mapping_join(spark, d):
    regions = table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return joins.join_mappings(table(spark, d, "nation"), regions, ["n_regionkey"])


@query(
    "densify",
    """with e as (select user_id, event_type, count(*) n from events group by 1, 2)
select u.user_id, t.event_type, e.n from (select distinct user_id from events) u
cross join (values ('click'), ('purchase'), ('refund')) t(event_type)
left join e on e.user_id = u.user_id and e.event_type = t.event_type""",
)
def densify(spark, d):
    """Every user with every listed type, one of which never occurs."""
    counted = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return joins.densify(counted, "user_id", "event_type", ["click", "purchase", "refund"])


@query(
    "onset_duration",
    """with s as (select user_id, day(ts) as day, event_type, max(value) value from events group by 1, 2, 3),
o as (select user_id, min(value) dx_age from s where event_type = 'signup' group by 1)
select s.user_id, s.day, s.event_type, s.value age, s.value - o.dx_age dx_db_duration from s left join o using (user_id)""",
)
def onset_duration(spark, d):
    """Values since the smallest signup value; an onset of 0 would count."""
    rows = table(spark, d, "events").groupBy("user_id", F.dayofmonth("ts").cast("long").alias("day"), "event_type").agg(
        F.max("value").alias("age")
    )
    onset = ages.onset_ages(rows, "user_id", "event_type", "age", "signup")
    return ages.with_duration(rows, onset, "user_id", "age", "db")


@query(
    "union_missing",
    "select s_suppkey as key, s_name as name, s_acctbal balance, null as segment from supplier "
    "union all select c_custkey, c_name, c_acctbal, c_mktsegment from customer",
)
def union_missing(spark, d):
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    people = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    return joins.union_missing(suppliers, people)


# -- aggregates ---------------------------------------------------------------------------


@query("distinct_counts", "select count(distinct o_custkey) subjects, count(distinct year(o_orderdate)) - 1 as years from orders")
def distinct_counts(spark, d):
    return table(spark, d, "orders").agg(
        F.countDistinct("o_custkey").alias("subjects"), (F.countDistinct(F.year("o_orderdate")) - 1).alias("years")
    )


@query(
    "merge_sources",
    "select p_brand merge_var, list_sort(list(distinct p_type)) old_vars from part group by p_brand",
)
def merge_sources(spark, d):
    """Result variable -> sources, from a change map of brands and types."""
    changes = table(spark, d, "part").select(F.col("p_brand").alias("merge_var"), F.col("p_type").alias("old_var")).distinct()
    return recode.merge_sources(changes)


def _labelled(spark, d):
    """Documents with their labels where they have any."""
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")


@query(
    "merge_any",
    """select doc_id, cast(case when quality is null and toxic is null then null
  when coalesce(quality, 0) <> 0 or coalesce(toxic, 0) <> 0 then 1 else 0 end as bigint) flagged
from documents left join labels using (doc_id)""",
)
def merge_any(spark, d):
    return recode.merge_columns(_labelled(spark, d), {"flagged": ["quality", "toxic"]})


@query(
    "merge_graded",
    """with w as (select user_id, cast(ts as date) as day,
  max(case when event_type = 'click' then 1 when event_type = 'view' then 0 end) act_l,
  max(case when event_type = 'purchase' then 1 end) act_r,
  max(case when event_type in ('error', 'signup') then 1 end) act_tng from events group by 1, 2)
select user_id, day, cast(case when coalesce(act_l, 0) + coalesce(act_r, 0) > 0 then 2 else 0 end + act_tng as bigint) act from w""",
)
def merge_graded(spark, d):
    kind = F.col("event_type")
    rows = table(spark, d, "events").groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.max(F.when(kind == "click", 1).when(kind == "view", 0)).alias("act_l"),
        F.max(F.when(kind == "purchase", 1)).alias("act_r"),
        F.max(F.when(kind.isin("error", "signup"), 1)).alias("act_tng"),
    )
    return recode.merge_columns(rows, {"act": ["act_l", "act_r", "act_tng"]}, {"act": recode.graded_merge})


@query("row_minimum", f"with w as ({_DAYS_SQL}) select user_id, day, least(click, error, view) low from w")
def row_minimum(spark, d):
    return _days(spark, d).select("user_id", "day", values.row_minimum(["click", "error", "view"]).alias("low"))


_TEXTS = """select event_id, case when event_type = 'error' then 'none' else json_extract_string(props, '$.k') end k,
  cast(value as varchar) amount, event_type as kind, json_extract_string(props, '$.k') compass31_k from events"""


def _texts(spark, d):
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "error", "none").otherwise(k).alias("k"),
        F.col("value").cast("string").alias("amount"), F.col("event_type").alias("kind"), k.alias("compass31_k"),
    )


@query(
    "numeric_typing",
    f"with t as ({_TEXTS}) select event_id, try_cast(k as bigint) k, try_cast(amount as double) amount, kind, compass31_k from t",
)
def numeric_typing(spark, d):
    """Whole numbers become integers, others doubles; a column without numbers stays text."""
    df = _texts(spark, d)
    plan = recode.plan_numeric_types(df, ["k", "amount", "kind", "compass31_k"], excluded=["compass31"])
    return recode.apply_numeric_types(df, plan)


@query(
    "numeric_typing_losses",
    f"with t as ({_TEXTS}) select 'amount' as column_name, 'double' kind, count(amount) - count(try_cast(amount as double)) lost from t "
    "union all select 'k', 'long', count(k) - count(try_cast(k as double)) from t",
)
def numeric_typing_losses(spark, d):
    """How many values each typed column loses."""
    df = _texts(spark, d)
    plan = recode.plan_numeric_types(df, ["k", "amount", "kind", "compass31_k"], excluded=["compass31"])
    return spark.createDataFrame([(t.column, t.kind, t.lost) for t in plan], "column_name string, kind string, lost long")


@query(
    "session_numbers",
    """with s as (select 'CUST_' || (1994 + c_nationkey % 7) || '_' || c_custkey as study_id, c_custkey from customer),
g as (select study_id, c_custkey, y.event_name from s cross join (values ('1998_arm_1'), ('1999_arm_1')) y(event_name)),
o as (select o_custkey, year(o_orderdate) || '_arm_1' as event_name, count(*) n from orders group by 1, 2)
select g.study_id, g.event_name, o.n, cast(regexp_extract(g.study_id, '_(\\d{4})_', 1) as integer) start_year,
  cast(left(g.event_name, 4) as integer) clinic_year,
  nullif(cast(left(g.event_name, 4) as integer) - cast(regexp_extract(g.study_id, '_(\\d{4})_', 1) as integer) + 1, 0) session_number
from g left join o on o.o_custkey = g.c_custkey and o.event_name = g.event_name""",
)
def session_numbers(spark, d):
    """Every customer in two clinics, with the session counted from a start year in the key."""
    from longrec.plans.sessions import number_sessions

    key = F.concat(F.lit("CUST_"), (F.lit(1994) + F.col("c_nationkey") % 7).cast("string"), F.lit("_"), F.col("c_custkey").cast("string"))
    people = table(spark, d, "customer").select("c_custkey", key.alias("study_id"))
    counted = table(spark, d, "orders").groupBy(
        F.col("o_custkey").alias("c_custkey"), F.concat(F.year("o_orderdate").cast("string"), F.lit("_arm_1")).alias("event_name")
    ).agg(F.count(F.lit(1)).alias("n"))
    rows = people.join(counted, "c_custkey", "left").select("study_id", "event_name", "n")
    return number_sessions(rows, ["1998_arm_1", "1999_arm_1"])
