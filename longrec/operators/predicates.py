"""Row filters.  All are narrow; key filters reach the scan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longrec.functions.values import to_number
from longrec.names import col
from longrec.operators.columns import resolve_variables
from longrec.session import SMALL_ROWS


def key_matches(key: str, pattern: str) -> Column:
    """The pattern occurs anywhere in the key."""
    return F.col(key).rlike(pattern)


def attended(session: str, missed: str, event: str, stable: str = "stable") -> tuple[Column, Column]:
    """(filter, session number) of attended sessions; a stable row without number is session 0."""
    number = F.when(F.col(event) == stable, F.coalesce(F.col(session), F.lit(0))).otherwise(F.col(session))
    return number.isNotNull() & F.col(missed).isNull(), number.cast("int")


def keep_attended(df: DataFrame, session: str, missed: str, event: str, stable: str = "stable") -> DataFrame:
    """Rows of sessions that took place, with an integer session number."""
    kept, number = attended(session, missed, event, stable)
    return df.where(kept).withColumn(session, number)


def _value(column: str, numeric: bool) -> Column:
    c = col(column)
    return to_number(c) if numeric else c


def has_all(exact: Sequence[str], groups: Sequence[Sequence[str]], numeric: bool = False) -> Column:
    """Every exact column holds a value, and every group holds at least one."""
    tests = [_value(c, numeric).isNotNull() for c in exact]
    tests += [has_any(g, (), numeric) for g in groups]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def has_any(exact: Sequence[str], groups: Sequence[Sequence[str]], numeric: bool = False) -> Column:
    """At least one column, exact or grouped, holds a value."""
    names = [*exact, *[c for g in groups for c in g]]
    return reduce(lambda a, b: a | b, [_value(c, numeric).isNotNull() for c in names], F.lit(False))


def require_all(df: DataFrame, requested: Sequence[str], forms: dict | None = None, numeric: bool = False) -> DataFrame:
    """Rows with data for every request; a request without columns in the table keeps none."""
    return df.where(has_all(*resolve_variables(df.columns, requested, forms), numeric))


def require_any(df: DataFrame, requested: Sequence[str], forms: dict | None = None, numeric: bool = False) -> DataFrame:
    """Rows with data for at least one request."""
    return df.where(has_any(*resolve_variables(df.columns, requested, forms), numeric))


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows that are null in all of ``columns``."""
    return df.where(has_any(columns, ()))


def subjects_in(df: DataFrame, key: str, subjects: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of listed subjects: a literal list, or a table of any size."""
    if isinstance(subjects, DataFrame):
        wanted = subjects.select(F.col(subjects.columns[0]).alias(key)).distinct()
        return df.join(wanted, key, "left_semi")
    if len(subjects) > SMALL_ROWS:
        raise ValueError("pass a long subject list as a DataFrame")
    return df.where(F.col(key).isin(list(subjects)))


def without_keys(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``known``; a null key never is.

    The known keys are reduced before the shuffle: a key that fills a third of ``known`` arrives
    once per task.
    """
    return df.join(known.select(*keys).distinct(), list(keys), "left_anti")


def with_keys(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``known``."""
    return df.join(known.select(*keys).distinct(), list(keys), "left_semi")


def imaging_or_stable(age: str, label: str, stable: str = "0") -> Column:
    """Imaging sessions (age above 0) and the stable rows."""
    return (F.col(age) > 0.0) | (F.col(label).cast("string") == stable)


def answer_sum(columns: Sequence[str]) -> Column:
    """Sum of answers, nulls as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(col(c), F.lit(0)) for c in columns])


def non_empty_form(columns: Sequence[str]) -> Column:
    """A form with any non-zero answer."""
    return answer_sum(columns) != 0


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the condition, all others); null counts as not met."""
    met = F.coalesce(condition, F.lit(False))
    return df.where(met), df.where(~met)


def complete_demographics(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rejected rows) by presence of all demographics."""
    return split_by(df, has_all(columns, ()))


def completed(df: DataFrame, flag: str) -> DataFrame:
    """Rows of completed forms; a table without the flag is left alone, a null flag is not 0."""
    if flag not in df.columns:
        return df
    return df.where(F.col(flag).isNull() | (F.col(flag) != 0))


def parent_rows(df: DataFrame, key: str, token: str = "parent") -> tuple[DataFrame, DataFrame]:
    """(parent rows, subject rows) by a token in the key, in any case."""
    return split_by(df, F.lower(F.col(key)).contains(token.lower()))


def file_mismatches(df: DataFrame, file: str, key: str, token: str = "S2") -> DataFrame:
    """Files named for a session that hold a key without it."""
    marked = df.where(F.upper(F.col(file)).contains(token.upper()))
    return (
        marked.groupBy(file)
        .agg(F.max(~F.upper(F.col(key)).contains(token.upper())).alias("mismatch"))
        .where("mismatch")
    )


def check_year_count(df: DataFrame, event: str, n: int) -> None:
    """``n`` must lie between 2 and the number of events besides the stable one."""
    row = df.agg(F.countDistinct(event).alias("events"), F.max(F.col(event).isNull()).alias("null")).first()
    events = row["events"] + bool(row["null"])
    if not 2 <= n <= events - 1:
        raise ValueError(f"consecutive years must be between 2 and {events - 1}, not {n}")


def check_not_empty(df: DataFrame) -> DataFrame:
    """Fail early where the selections left no row."""
    if df.isEmpty():
        raise ValueError("no data to return: the selections have filtered out all rows")
    return df
