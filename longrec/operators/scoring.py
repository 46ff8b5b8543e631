"""Questionnaire scoring: raw sums, composites, norm lookup, bands and flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longrec.names import col
from longrec.functions.values import borderline_flag, clinical_flag, percentile_band, range_flag
from longrec.operators.predicates import answer_sum
from longrec.session import broadcast_if_small


def raw_scores(answers: DataFrame, scales: DataFrame, keys: Sequence[str], question: str, value: str) -> DataFrame:
    """Long form: (keys, scale, raw) from answers and a (scale, question) table.

    The scales are counted and broadcast where they are few, so that the answers are shuffled
    only once, as partial sums.
    """
    asked = answers.join(broadcast_if_small(scales), question, "inner")
    return asked.groupBy(*keys, "scale").agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias("raw"))


def composite_scores(raw: DataFrame, composites: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raw scores of composites from a (composite, scale) table, added to those of the scales."""
    summed = (
        raw.join(broadcast_if_small(composites), "scale", "inner")
        .groupBy(*keys, "composite")
        .agg(F.sum("raw").alias("raw"))
        .select(*keys, F.col("composite").alias("scale"), "raw")
    )
    return raw.select(*keys, "scale", "raw").unionByName(summed)


def raw_score_columns(df: DataFrame, scales: Mapping[str, Sequence[str]], template: str) -> DataFrame:
    """Wide form: sum of the listed columns, nulls as 0; an existing raw column is kept."""
    new = {
        template.format(scale): answer_sum(columns)
        for scale, columns in scales.items()
        if template.format(scale) not in df.columns
    }
    return df.withColumns(new)


def lookup_scores(raw: DataFrame, norms: DataFrame) -> DataFrame:
    """Add ``tscore`` from a (scale, raw, tscore) table; raw scores outside it give null.

    A raw score that most rows share cannot skew the join: norms are broadcast if they are few,
    and the row side of a left join can be split if they are not.
    """
    return raw.join(broadcast_if_small(norms), ["scale", "raw"], "left")


def unmatched_scores(scored: DataFrame) -> DataFrame:
    """Quality report: raw scores without a norm, per scale."""
    return (
        scored.where(F.col("raw").isNotNull() & F.col("tscore").isNull())
        .groupBy("scale")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("raw").alias("lowest"), F.max("raw").alias("highest"))
    )


def with_bands(scored: DataFrame, unbanded: Iterable[str] = ()) -> DataFrame:
    """Add percentile band and the clinical and borderline flags."""
    t = F.col("tscore")
    band = F.when(~F.col("scale").isin(list(unbanded)), percentile_band(t)) if unbanded else percentile_band(t)
    return scored.withColumns({"band": band, "clinical": clinical_flag(t), "borderline": borderline_flag(t)})


def with_range_flags(df: DataFrame, flags: Mapping[str, tuple[float, float]], wanted: Iterable[str]) -> DataFrame:
    """Add the wanted ``<score>.<flag>`` columns from inclusive ranges, in one projection."""
    wanted = set(wanted)
    columns = {
        name: range_flag(col(name.split('.')[0]), low, high)
        for name, (low, high) in flags.items()
        if name in wanted
    }
    return df.withColumns(columns)
