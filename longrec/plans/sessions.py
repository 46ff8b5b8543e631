"""Jobs on session tables: exports, conversion, extraction, numbering and renaming."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longrec.functions import dates, labels
from longrec.operators import ages, columns, joins, ordered, predicates, reshape
from longrec.session import cut_lineage


def format_sessions(
    df: DataFrame,
    order_by: Sequence[str],
    key: str = "study_id",
    key_pattern: str | None = None,
    event: str = "event_name",
    session: str = "session_number",
    missed: str = "missed_session",
    year: str = "session_year",
    consecutive: int | None = None,
    birth: str = "dob",
    session_date: str = "clinic_date",
    imaging_date: str = "mri_date",
    imaging_age: str = "mri_age",
    imaging_only: bool = False,
    flatten_by: str | None = None,
    sort_by: str = "variable",
    transpose: bool = False,
    drop: Sequence[str] = ("repeat_instrument", "repeat_instance"),
) -> DataFrame:
    """Longitudinal export, optionally one row per subject by ``session`` or ``clinic``.

    Ages are computed where the dates are there and the ages are not.
    """
    rows = df.drop(*drop)
    if key_pattern:
        rows = rows.where(predicates.key_matches(key, key_pattern))
    rows = rows.withColumn(event, labels.strip_event_tail(F.col(event)))
    if consecutive is not None:
        predicates.check_year_count(rows, event, consecutive)
    wanted = {
        name: date
        for date, name in ((session_date, "session_age"), (imaging_date, imaging_age))
        if birth in rows.columns and date in rows.columns and name not in rows.columns
    }
    # birth dates come from all rows, ages are needed for the kept ones only
    births = ages.birth_dates(rows, key, birth, order_by) if wanted else None
    rows = predicates.keep_attended(rows, session, missed, event)
    if consecutive is not None:
        rows = ordered.consecutive_years(rows, [key], year, order_by, consecutive)
    if births is not None:
        rows = ages.replace_birth(rows, births, key, birth)
        for name, date in wanted.items():
            rows = ages.insert_age(rows, birth, date, name)

    rows = rows.withColumn("clinic_year", labels.clinic_label(F.col(event)))
    rows = rows.withColumnRenamed("session_age", "clinic_age")
    rows = rows.drop(birth, session_date, imaging_date, event)
    if imaging_only:
        rows = rows.where(predicates.imaging_or_stable(imaging_age, "clinic_year"))
    if flatten_by:
        by, prefix = {"session": (session, "s"), "clinic": ("clinic_year", "c")}[flatten_by]
        # the reshape looks at the rows twice: once for its columns, once for the values
        rows = predicates.check_not_empty(cut_lineage(rows))
        rows = reshape.flatten(rows, key, by, prefix, sort_by != "variable", bookkeeping=("clinic_year", session))
    else:
        predicates.check_not_empty(rows)
    return reshape.long_transpose(rows, key) if transpose else rows


#: Date fields an enrichment table contributes.
DURATION_FIELDS = ("dob", "db_dx_date", "physicalexam_date")


def format_cohort(
    df: DataFrame,
    key: str = "study_id",
    key_pattern: str | None = None,
    exam_date: str = "physicalexam_date",
    birth: str = "dob",
    onset_age: str = "db_onset_age",
    kind: str = "db",
    require_all: Sequence[str] = (),
    require_any: Sequence[str] = (),
    forms: Mapping[str, Sequence[str]] | None = None,
    enrichment: DataFrame | None = None,
    duration: bool = False,
    consecutive: int | None = None,
    long: bool = False,
    transpose: bool = False,
) -> DataFrame:
    """Tracked-cohort export from one row per subject.

    The sessions of a subject are ordered by exam date and session.
    """
    rows = df.where(predicates.key_matches(key, key_pattern)) if key_pattern else df
    if require_all:
        rows = predicates.require_all(rows, require_all, dict(forms or {}))
    if require_any:
        rows = predicates.require_any(rows, require_any, dict(forms or {}))
    fields: list[str] = []
    if enrichment is not None and (duration or consecutive):
        pattern = r"\w*(" + "|".join(DURATION_FIELDS) + ")"
        fields = columns.matching([c for c in enrichment.columns if c != key], pattern)
        rows = joins.enrich_left(rows, enrichment, [key], [key], fields)

    session = "session_number"
    names = [key, None, birth, exam_date, session]
    rows, prefixed = reshape.expand(rows, key, session)
    rows = columns.rename_common(rows, names)
    subject, date = columns.COMMON_COLUMNS[0], "session_date"
    rows = dates.read_dates(rows, [date])
    rows = rows.where(F.col(date).isNotNull())
    order = [date, session]
    if duration:
        rows = ages.with_age_and_duration(rows, subject, session, "dob", date, onset_age, kind, order).drop("session_age")
    if consecutive:
        rows = rows.withColumn("session_year", F.year(date))
        rows = ordered.consecutive_years(rows, [subject], "session_year", order, consecutive).drop("session_year")
    rows = columns.rename_common(rows, names, back=True)
    if not long:
        rows = reshape.simple_flatten(cut_lineage(rows), [key], session)
        rows = reshape.drop_default_session(rows, prefixed)
    if fields:
        rows = joins.undo_enrich(rows, DURATION_FIELDS if long else fields)
    return reshape.long_transpose(rows, key) if transpose else rows


def convert(df: DataFrame, direction: str | None = None, sort: bool = True) -> DataFrame:
    """One row per session <-> one row per subject; the direction is seen from the keys."""
    return reshape.reshape(df, direction, sort)


def extract_and_merge(
    df: DataFrame, patterns: Sequence[str], merge_with: DataFrame | None = None, key_count: int = 2
) -> DataFrame:
    """Fields matching the patterns, optionally filled into another table with the same keys."""
    keys = df.columns[:key_count]
    picked = columns.extract_fields(df, keys, patterns)
    return picked if merge_with is None else joins.merge_fill(merge_with, picked, keys)


def number_sessions(
    df: DataFrame,
    events: Sequence[str],
    key: str = "study_id",
    event: str = "event_name",
    name: str = "session_number",
    key_pattern: str = r"^[A-Za-z]+_(\d{4})_",
) -> DataFrame:
    """One row per subject and listed event with the session number counted from the start year."""
    return joins.densify(df, key, event, events).withColumns(
        {
            "start_year": labels.leading_year(F.col(key), key_pattern),
            "clinic_year": labels.event_year(F.col(event)),
        }
    ).withColumn(name, dates.session_number(F.col("start_year"), F.col("clinic_year")))


def rename(df: DataFrame, lines: Iterable[str]) -> DataFrame:
    """Rename columns from ``old,new`` lines."""
    return columns.rename_from_lines(df, lines)
