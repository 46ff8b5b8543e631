"""Session ages and diagnosis durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longrec.names import col
from longrec.functions import dates
from longrec.functions.values import to_number
from longrec.operators.columns import insert_before
from longrec.operators.joins import subject_lookup
from longrec.operators.ordered import attach, earliest, first_valid


def _as_moment(df: DataFrame, column: str, strict: bool) -> DataFrame:
    if not isinstance(df.schema[column].dataType, T.StringType):
        return df
    return df.withColumn(column, F.col(column).cast("timestamp_ntz")) if strict else dates.read_dates(df, [column])


def with_age(
    df: DataFrame, key: str, birth: str, date: str, name: str, order_by: Sequence[str]
) -> DataFrame:
    """Insert the age at ``date`` immediately before it.

    The birth date is the subject's first known one, written to all of its rows.  A date that
    cannot be read is missing; a birth date that cannot be read is an error.
    """
    filled = first_valid(_as_moment(df, birth, strict=True), [key], [birth], order_by)
    return insert_age(filled, birth, date, name)


def insert_age(df: DataFrame, birth: str, date: str, name: str) -> DataFrame:
    """The age alone, where every row already has its birth date."""
    dated = _as_moment(_as_moment(df, date, strict=False), birth, strict=True)
    return insert_before(dated, date, name, dates.age(F.col(birth), F.col(date)))


def birth_dates(df: DataFrame, key: str, birth: str, order_by: Sequence[str]) -> DataFrame:
    """(subject, first known birth date): one row per subject."""
    return _as_moment(df, birth, strict=True).groupBy(key).agg(earliest(birth, order_by).alias(birth))


def replace_birth(df: DataFrame, births: DataFrame, key: str, birth: str) -> DataFrame:
    """Write the subject's birth date to all of its rows."""
    found = births.withColumnRenamed(birth, "__birth")
    joined = attach(df, found, [key], ["__birth"])
    return joined.select(*[F.col("__birth").alias(birth) if c == birth else col(c) for c in df.columns])


def with_age_and_duration(
    df: DataFrame, key: str, session: str, birth: str, date: str, onset: str, kind: str, order_by: Sequence[str],
    first_session: str = "s1",
) -> DataFrame:
    """``session_age`` and ``dx_<kind>_duration`` from one aggregate and one join per subject."""
    dated = _as_moment(_as_moment(df, date, strict=False), birth, strict=True)
    number = to_number(F.col(onset))
    facts = dated.groupBy(key).agg(
        earliest(birth, order_by).alias("__birth"),
        F.min(F.when(F.col(session) == first_session, number)).alias("__onset"),
    )
    joined = attach(dated, facts, [key], ["__birth", "__onset"]).drop(birth).withColumnRenamed("__birth", birth)
    aged = insert_before(joined, date, "session_age", dates.age(F.col(birth), F.col(date)))
    duration = dates.duration(F.col("session_age"), F.col("__onset"))
    return aged.withColumn(f"dx_{kind}_duration", duration).drop("__onset")


def onset_ages(df: DataFrame, key: str, session: str, onset: str, first_session: str = "s1") -> DataFrame:
    """(subject, onset age) as recorded in the first session; one row per subject."""
    return (
        df.where(F.col(session) == first_session)
        .groupBy(key)
        .agg(F.min(to_number(F.col(onset))).alias("dx_age"))
    )


def with_duration(df: DataFrame, onset: DataFrame, key: str, age: str, kind: str) -> DataFrame:
    """Add ``dx_<kind>_duration``: age minus onset age, null where there is no onset age."""
    joined = subject_lookup(df, onset, key, ["dx_age"])
    return joined.withColumn(f"dx_{kind}_duration", dates.duration(F.col(age), F.col("dx_age"))).drop("dx_age")
