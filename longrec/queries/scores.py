"""Scoring and regression."""

from pyspark.sql import functions as F

from longrec.operators import regression, reshape, scoring
from longrec.queries import query, table

# -- questionnaire scores -----------------------------------------------------------------

_SCALES_SQL = "(values ('sale', 'click'), ('sale', 'purchase'), ('use', 'view'), ('use', 'error'), ('start', 'signup')) s(scale, question)"


def _scales(spark):
    return spark.createDataFrame(
        [("sale", "click"), ("sale", "purchase"), ("use", "view"), ("use", "error"), ("start", "signup")], "scale string, question string"
    )


def _raw(spark, d):
    answers = table(spark, d, "events").select(
        "user_id", F.col("event_type").alias("question"), F.round(F.col("value") * 100).cast("long").alias("answer")
    )
    return scoring.raw_scores(answers, _scales(spark), ["user_id"], "question", "answer")


_RAW = f"""select user_id, scale, cast(sum(cast(round(value * 100) as bigint)) as bigint) raw
from events join {_SCALES_SQL} on question = event_type group by 1, 2"""


@query("raw_scores", _RAW)
def raw_scores(spark, d):
    """Event types as questions, values in cents as answers."""
    return _raw(spark, d)


@query(
    "composite_scores",
    f"""with r as ({_RAW}) select * from r union all
select user_id, composite, cast(sum(raw) as bigint) from r join (values ('activity', 'sale'), ('activity', 'use'), ('all', 'sale'),
  ('all', 'use'), ('all', 'start')) c(composite, part) on part = scale group by 1, 2""",
)
def composite_scores(spark, d):
    composites = spark.createDataFrame(
        [("activity", "sale"), ("activity", "use"), ("all", "sale"), ("all", "use"), ("all", "start")], "composite string, scale string"
    )
    return scoring.composite_scores(_raw(spark, d), composites, ["user_id"])


_NORMS_SQL = """select p_brand as scale, p_size as raw, cast(30 + round(count(*) * 2 + p_size) as integer) tscore from part
  where p_size <= 45 group by 1, 2"""


def _scored(spark, d):
    """Norms by brand and size; sizes above 45 have none."""
    part = table(spark, d, "part")
    norms = part.where(F.col("p_size") <= 45).groupBy(F.col("p_brand").alias("scale"), F.col("p_size").alias("raw")).agg(
        (F.lit(30) + F.count(F.lit(1)) * 2 + F.first("p_size")).cast("int").alias("tscore")
    )
    return scoring.lookup_scores(part.select("p_partkey", F.col("p_brand").alias("scale"), F.col("p_size").alias("raw")), norms)


@query(
    "lookup_score_band",
    f"""with n as ({_NORMS_SQL}), s as (select p_partkey, p_brand as scale, p_size as raw, tscore from part
  left join n on n.scale = p_brand and n.raw = p_size)
select *, case when tscore = 50 then '<= 50' when tscore < 50 then null when tscore >= 71 then '> 98'
  else cast([50, 54, 58, 62, 66, 69, 72, 75, 78, 81, 84, 86, 88, 90, 92, 93, 94, 95, 96, 97, 98][tscore - 49] as varchar) end band,
  case when tscore >= 70 then 1 else 0 end clinical, case when tscore between 65 and 69 then 1 else 0 end borderline from s""",
)
def lookup_score_band(spark, d):
    return scoring.with_bands(_scored(spark, d))


@query(
    "unmatched_scores",
    f"""with n as ({_NORMS_SQL}) select p_brand as scale, count(*) as rows, min(p_size) lowest, max(p_size) highest from part
left join n on n.scale = p_brand and n.raw = p_size where tscore is null group by 1""",
)
def unmatched_scores(spark, d):
    """Quality report of raw scores without a norm."""
    return scoring.unmatched_scores(_scored(spark, d))


@query(
    "raw_score_columns",
    "select l_orderkey, "
    + ", ".join(
        " + ".join(f"coalesce(max(case when l_linenumber = {k} then l_quantity end), 0)" for k in ks) + f" raw_{n}"
        for n, ks in (("front", (1, 2, 3)), ("back", (4, 5, 6, 7)))
    )
    + " from lineitem group by 1",
)
def raw_score_columns(spark, d):
    wide = table(spark, d, "lineitem").groupBy("l_orderkey").pivot("l_linenumber", list(range(1, 8))).agg(F.max("l_quantity"))
    questions = [f"q{k}" for k in range(1, 8)]
    scored = scoring.raw_score_columns(
        wide.toDF("l_orderkey", *questions), {"front": questions[:3], "back": questions[3:]}, "raw_{}"
    )
    return scored.drop(*questions)


# -- regression ---------------------------------------------------------------------------

_SLOPES = """with o as (select o_custkey, year(o_orderdate) x, cast(round(o_totalprice * 100) as hugeint) y, o_totalprice, o_orderdate, o_orderkey, c_mktsegment
  from orders join customer on c_custkey = o_custkey),
s as (select o_custkey, count(*) n, sum(x)::hugeint sx, sum(y) sy, sum(x * x)::hugeint sxx, sum(y * y) syy, sum(x * y) sxy, max(o_totalprice) - min(o_totalprice) spread,
  first(x order by o_orderdate, o_orderkey) fx, any_value(c_mktsegment) g from o group by 1),
f as (select *, n * sxy - sx * sy num, n * sxx - sx * sx dx, n * syy - sy * sy dy from s),
r as (select *, case when n > 1 and dx > 0 then cast(num as double) / cast(dx as double) / 100.0 end slope,
  case when n > 1 and dx > 0 then sqrt(cast(dy * dx - num * num as double) / cast(dx as double) / n / 10000.0 / n) end rmse from f)"""


def _slopes(spark, d):
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    rows = (
        table(spark, d, "orders")
        .select("o_custkey", F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("price"), "o_orderdate", "o_orderkey")
        .join(people, "o_custkey")
    )
    return regression.subject_slopes(
        rows, "o_custkey", "year", ["price"], ["o_orderdate", "o_orderkey"], group="segment", decimals=(0, 2)
    )


@query(
    "subject_slopes",
    _SLOPES + """ select o_custkey, case when n > 1 then g end segment, cast(case when n > 1 then fx end as integer) year_s1, 'price' variable,
  slope, round(rmse, 6) rmse, case when spread > 0 then round(rmse / spread, 6) end nrmse, case when n > 1 then n end count from r""",
)
def subject_slopes(spark, d):
    """Price over year per customer, from exact sums of cents."""
    fitted = _slopes(spark, d)
    return fitted.withColumns({"rmse": F.round("rmse", 6), "nrmse": F.round("nrmse", 6)})


@query(
    "subject_slopes_wide",
    _SLOPES + """ select o_custkey, case when n > 1 then n end price_count, slope price_slope, cast(case when n > 1 then fx end as integer) price_year_s1 from r""",
)
def subject_slopes_wide(spark, d):
    return reshape.slopes_wide(_slopes(spark, d).select("o_custkey", "variable", "slope", "count", "year_s1"), ["o_custkey"], variables=["price"])


def _regressions(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_returnflag", "l_quantity", F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount")
    )
    return regression.group_regression(rows, "l_quantity", ["price", "discount"], "l_returnflag")


_FITS = " union all ".join(
    f"""select l_returnflag, '{v}' variable, count(*) n, regr_slope({c}, l_quantity) slope, regr_intercept({c}, l_quantity) intercept,
  corr({c}, l_quantity) r, min(l_quantity) x_min, max(l_quantity) x_max from lineitem group by 1"""
    for c, v in (("l_extendedprice", "price"), ("l_discount", "discount"))
)


@query(
    "group_regression",
    f"""with f as ({_FITS}) select l_returnflag, variable, n, round(slope, 6) slope, round(intercept, 4) intercept,
  round(r, 8) r, round(r * r, 8) r2 from f""",
)
def group_regression(spark, d):
    return _regressions(spark, d).select(
        "l_returnflag", "variable", "n", F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"),
        F.round("r", 8).alias("r"), F.round("r2", 8).alias("r2"),
    )


# Two-sided p by Simpson's rule over the t density.
_P = f"""with f as ({_FITS}), t as (select *, n - 2 df, abs(r) * sqrt((n - 2) / (1 - r * r)) t from f),
g as (select l_returnflag, variable, any_value(r) r, any_value(n) n, any_value(least(t, 40.0)) / 2000.0 / 3.0 *
  sum(case when i = 0 or i = 2000 then 1 when i % 2 = 1 then 4 else 2 end
    * pow(1 + pow(least(t, 40.0) * i / 2000.0, 2) / df, -(df + 1) / 2.0)
    * exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0)) / sqrt(df * pi())) area
  from t, range(0, 2001) k(i) group by 1, 2)"""


@query(
    "group_regression_p",
    _P + " select l_returnflag, variable, round(1 - 2 * area, 6) p, printf('%s (R^2 = %.2f, p = %.2f)', l_returnflag, r * r, 1 - 2 * area) as label from g",
)
def group_regression_p(spark, d):
    """The p-value against numerical integration, and the legend label."""
    return _regressions(spark, d).select("l_returnflag", "variable", F.round("p", 6).alias("p"), "label")


@query(
    "trend_points",
    f"""with f as ({_FITS}) select l_returnflag, variable, x, round(slope * x + intercept, 3) y
from f, lateral (select unnest(generate_series(cast(x_min as bigint), cast(x_max as bigint))) x)""",
)
def trend_points(spark, d):
    """All groups: the limit on p is above 1."""
    return regression.trend_points(_regressions(spark, d), "l_returnflag", limit=1.5).withColumn("y", F.round("y", 3))
