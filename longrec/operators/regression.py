"""Per-subject and per-group linear regression."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longrec.names import col
from longrec.functions.values import regression_label

#: Numbers of a trend line that are made at a time.
TREND_STEP = 100_000

#: Type of exact sums.
WIDE = "decimal(38,0)"


def unpivot(df: DataFrame, ids: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """(ids, variable, y), one row per variable."""
    return df.unpivot(list(ids), [col(v).cast("double").alias(v) for v in variables], "variable", "y")


def subject_slopes(
    df: DataFrame,
    subject: str,
    x: str,
    variables: Sequence[str],
    order_by: Sequence[str],
    group: str | None = None,
    decimals: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per subject and variable: slope, rmse, nrmse, count, first x and first group.

    Fewer than two points give nulls, a constant x has no slope.  ``decimals`` states how many
    decimal places x and y have; the sums are then exact integers and equal in any engine, or doubles
    where a number has more than 18 digits.
    A subject without any value of a variable has a row of nulls for it.  Aggregates only, so a subject with very
    many rows is reduced before the shuffle.
    """
    ids = list(dict.fromkeys([subject, x, *([group] if group else []), *order_by]))
    names = {c: f"__{i}" for i, c in enumerate(ids)}
    # ids are copied so that x or the order may also be listed as variables
    source = df.select(*[col(c).alias(a) for c, a in names.items()], *[col(v) for v in variables])
    long = unpivot(source, list(names.values()), variables)
    xs, y = F.col(names[x]).cast("double"), F.col("y")
    ordered = [names[c] for c in order_by]
    stats = [
        F.count(F.when(xs.isNotNull(), y)).alias("n"),
        F.min("y").alias("low"),
        F.max("y").alias("high"),
    ]
    # x and group of the first row with a y; numbers under a single order key stay hash aggregates
    stats.append(_of_first_value(F.col(names[x]), ordered).alias("first_x"))
    if group:
        stats.append(_of_first_value(F.col(names[group]), ordered).alias("first_group"))
    stats += [F.regr_slope(y, xs).alias("sl"), F.regr_sxx(y, xs).alias("sxx")]
    stats += [F.regr_syy(y, xs).alias("syy"), F.regr_sxy(y, xs).alias("sxy")]
    if decimals is not None:
        a = F.round(xs * 10 ** decimals[0]).try_cast("decimal(18,0)")
        b = F.round(y * 10 ** decimals[1]).try_cast("decimal(18,0)")
        sums = {"ex": a, "ey": b, "exx": a * a, "eyy": b * b, "exy": a * b}
        pair = xs.isNotNull() & y.isNotNull()
        stats += [F.sum(F.when(pair, e)).cast(WIDE).alias(name) for name, e in sums.items()]
        stats.append(F.count(F.when(pair, a + b)).alias("exact"))
    grouped = long.groupBy(names[subject], "variable").agg(*stats)
    slope, sse = _double_fit()
    if decimals is not None:
        # numbers of over 18 digits have no exact sums
        exact = F.col("exact") == F.col("n")
        slope, sse = (F.when(exact, a).otherwise(b) for a, b in zip(_exact_fit(*decimals), (slope, sse), strict=True))
    fitted = grouped.withColumns({"slope": F.when(F.col("n") > 1, slope), "sse": F.when(F.col("n") > 1, sse)})
    rmse = F.sqrt(F.col("sse") / F.col("n"))
    enough = F.col("n") > 1
    return fitted.select(
        F.col(names[subject]).alias(subject),
        *([F.when(enough, F.col("first_group")).alias(group)] if group else []),
        F.when(enough, F.col("first_x")).alias(f"{x}_s1"),
        "variable",
        "slope",
        rmse.alias("rmse"),
        F.try_divide(rmse, F.col("high") - F.col("low")).alias("nrmse"),
        F.when(enough, F.col("n")).alias("count"),
    )


def _of_first_value(value: Column, order_by: Sequence[str]) -> Column:
    """Aggregate: ``value`` in the first row that has a y."""
    found = F.col("y").isNotNull()
    if len(order_by) == 1:
        order = F.col(order_by[0])
        undated = F.min(F.when(found & order.isNull(), value))
        return F.when(F.count(F.when(found & order.isNull(), 1)) > 0, undated).otherwise(F.min_by(value, F.when(found, order)))
    return F.min_by(value, F.when(found, F.struct(*order_by)))


def _double_fit() -> tuple[Column, Column]:
    sse = F.greatest(F.lit(0.0), F.col("syy") - F.col("sxy") * F.col("sxy") / F.nullif(F.col("sxx"), F.lit(0.0)))
    has_slope = F.col("sxx") > 0
    return F.when(has_slope, F.col("sl")), F.when(has_slope, F.when(F.col("n") == 2, 0.0).otherwise(sse))


def _exact_fit(x_places: int, y_places: int) -> tuple[Column, Column]:
    """Slope and squared error from integer sums: one division at the end.

    Products of over 38 digits, which take groups of very many points, are done in doubles.
    """
    n = F.col("n").cast(WIDE)

    def difference(a: Column, b: Column, c: Column, d: Column) -> tuple[Column, Column]:
        exact = F.try_subtract(F.try_multiply(a, b), F.try_multiply(c, d))
        rounded = a.cast("double") * b.cast("double") - c.cast("double") * d.cast("double")
        return exact, F.coalesce(exact.cast("double"), rounded)

    sums = {name: F.col(name) for name in ("ex", "ey", "exx", "eyy", "exy")}
    num, num_value = difference(n, sums["exy"], sums["ex"], sums["ey"])
    dx, dx_value = difference(n, sums["exx"], sums["ex"], sums["ex"])
    dy, dy_value = difference(n, sums["eyy"], sums["ey"], sums["ey"])
    divisor = F.nullif(dx_value, F.lit(0.0))
    slope = num_value / divisor * (10.0**x_places) / (10.0**y_places)
    residual = F.try_subtract(F.try_multiply(dy, dx), F.try_multiply(num, num)).cast("double") / divisor
    residual = F.coalesce(residual, dy_value - num_value * (num_value / divisor))
    sse = F.greatest(F.lit(0.0), residual) / F.col("n") / 10.0 ** (2 * y_places)
    return slope, F.when(dx_value > 0, sse)


def group_regression(df: DataFrame, x: str, variables: Sequence[str], group: str) -> DataFrame:
    """One row per group and variable: n, slope, intercept, r, r2, p and the x range.

    Pairs with a missing value are left out.
    """
    source = df.select(col(x).cast("double").alias("__x"), col(group).alias("__g"), *[col(v) for v in variables])
    long = unpivot(source, ["__x", "__g"], variables).where("__x is not null and y is not null")
    fitted = long.groupBy("__g", "variable").agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope("y", "__x").alias("slope"),
        F.regr_intercept("y", "__x").alias("intercept"),
        F.corr("y", "__x").alias("r"),
        F.min("__x").alias("x_min"),
        F.max("__x").alias("x_max"),
    )
    return (
        fitted.withColumnRenamed("__g", group)
        .withColumn("r2", F.col("r") * F.col("r"))
        .withColumn("p", p_value(F.col("r"), F.col("n")))
        .withColumn("label", regression_label(F.col(group).cast("string"), F.col("r"), F.col("p")))
    )


def trend_points(regressions: DataFrame, group: str, limit: float = 0.05) -> DataFrame:
    """Points of the trend line on the whole numbers of the x range, where p is below the limit.

    A range is exploded in two steps, so that no array holds more than about ``TREND_STEP`` numbers or steps.
    """
    low, high = F.col("x_min").cast("long"), F.col("x_max").cast("long")
    steps = F.sequence(F.lit(0).cast("long"), F.floor((high - low) / TREND_STEP))
    start = low + F.col("__step") * TREND_STEP
    return (
        regressions.where(F.col("p") < limit)
        .withColumn("__step", F.explode(steps))
        .withColumn("x", F.explode(F.sequence(start, F.least(high, start + (TREND_STEP - 1)))))
        .select(group, "variable", "x", (F.col("slope") * F.col("x") + F.col("intercept")).alias("y"))
    )


#: Steps of the continued fraction: from 3 points to 10 ** 9, it has converged after 60 of them.
FRACTION_STEPS = 80
#: The ratio of gammas is taken this far up, where its series has all digits, and brought back by a product.
GAMMA_SHIFT = 24
_TINY = 1e-300


def _let(value: Column, function) -> Column:
    """``function`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, as a fold over the recurrence of its convergents.

    The state is the last convergent and the two numbers before it, all divided by the last denominator.
    """

    def step(state, k):
        m = k.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))

        def after(v):
            whole = v["below"] + v["odd"]
            last = (v["above"] + v["odd"] * state["last"]) / whole
            near = F.abs(last - state["last"]) < 1e-16 * F.abs(last)
            return F.struct((v["above"] / whole).alias("above"), (v["below"] / whole).alias("below"), last.alias("last"), near.alias("done"))

        def before(e):
            above, below = state["last"] + e * state["above"], 1.0 + e * state["below"]
            return _let(F.struct(above.alias("above"), below.alias("below"), odd.alias("odd")), after)

        return F.when(state["done"], state).otherwise(_let(even, before))

    first = 1.0 / (1.0 - (a + b) * x / (a + 1.0))
    start = F.struct(first.alias("above"), first.alias("below"), first.alias("last"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(FRACTION_STEPS)), start, step, lambda s: s["last"])


def _log_gamma_ratio(a: Column) -> Column:
    """log(gamma(a + 1/2) / gamma(a))."""
    z = a + float(GAMMA_SHIFT)
    series = 0.5 * F.log(z) - 1 / (8 * z) + 1 / (192 * z**3) - 1 / (640 * z**5) + 17 / (14336 * z**7) - 31 / (18432 * z**9)
    back = F.aggregate(
        F.sequence(F.lit(0), F.lit(GAMMA_SHIFT - 1)), F.lit(0.0), lambda total, j: total + F.log1p(-0.5 / (a + j.cast("double") + 0.5))
    )
    return series + back


def p_value(r: Column, n: Column) -> Column:
    """Two-sided p of a Pearson correlation: P(|T| > t) with n - 2 degrees of freedom, as an expression.

    The relative error is about 10 ** -17 for each point: the fraction is as sensitive to its terms.
    """
    a, b, y = (n - 2).cast("double") / 2.0, F.lit(0.5), r * r
    x = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - y))  # df / (df + t^2)
    front = F.exp(_log_gamma_ratio(a) - 0.5 * math.log(math.pi) + a * F.log1p(-y) + 0.5 * F.log(y))
    # the fraction converges on one side of the bulk of the distribution, the other is its complement
    direct = x < (a + 1.0) / (a + b + 2.0)
    one, two = F.when(direct, a).otherwise(b), F.when(direct, b).otherwise(a)
    tail = front * _beta_fraction(one, two, F.when(direct, x).otherwise(y)) / one
    inside = F.when(direct, tail).otherwise(1.0 - tail)
    known = r.isNotNull() & n.isNotNull() & ~F.isnan(r) & (n >= 2)
    return F.when(known, F.when(n == 2, 1.0).when((x <= 0) | (x >= 1), x).otherwise(inside))


def two_sided_p(r: float, n: float) -> float | None:
    """``p_value`` of one pair of numbers."""
    if r is None or n is None or math.isnan(r) or n < 2:
        return None
    x, a, b = min(max(1.0 - r * r, 0.0), 1.0), (n - 2) / 2.0, 0.5
    if n == 2 or x in (0.0, 1.0):
        return 1.0 if n == 2 else x
    # for large a the difference of the log-gammas loses its digits: its series does not
    ratio = math.lgamma(a + b) - math.lgamma(a) if a < 100 else 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) - 1 / (640 * a**5)
    front = math.exp(ratio - math.lgamma(b) + a * math.log1p(-r * r) + b * math.log(r * r))
    direct = x < (a + 1.0) / (a + b + 2.0)
    one, two, at = (a, b, x) if direct else (b, a, r * r)
    c, d = 1.0, 1.0 / (1.0 - (one + two) * at / (one + 1.0) or _TINY)
    h, m = d, 0
    while m < 1 or abs(d * c - 1.0) >= 1e-15:
        m += 1
        for step in (m * (two - m) * at / ((one + 2 * m - 1) * (one + 2 * m)), -(one + m) * (one + two + m) * at / ((one + 2 * m) * (one + 2 * m + 1))):
            d, c = 1.0 / (1.0 + step * d or _TINY), 1.0 + step / c or _TINY
            h *= d * c
    tail = front * h / one
    return tail if direct else 1.0 - tail
