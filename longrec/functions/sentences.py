"""Diagnosis sentences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longrec.fixed_values import DIAGNOSES, LABEL_HEADING
from longrec.functions.values import fixed_text
from longrec.names import col


def diagnosis_text(rule: Column, age: Column, notes: Column, date: Column, estimate: Column) -> Column:
    """The label of a diagnosis: one of seven sentences by date rule, then the notes.

    ``date`` and ``estimate`` are ``yyyy-MM-dd`` texts; the estimate wins where it is complete.
    An unknown rule gives no sentence.
    """
    chosen = F.when(F.length(estimate) > 6, estimate).when(F.length(date) > 6, date)
    day = chosen.try_cast("date")
    year, month, number = F.date_format(day, "yyyy"), F.date_format(day, "MMMM"), F.date_format(day, "d")
    one, two = fixed_text(age, 1), fixed_text(age, 2)
    full = F.concat(month, F.lit(" "), number, F.lit(", "), year)
    short = F.concat(month, F.lit(" "), year)

    # fixed values: the wording of the sentences
    sentence = (
        F.when(rule == "Date", F.concat(F.lit("The <i>actual dx date</i> is "), full, F.lit("; age = "), two, F.lit(".")))
        .when(rule == "Age", F.concat(F.lit("<i>Estimated age</i> at dx = "), one))
        .when(rule == "Month", F.concat(F.lit("<i>Estimated</i> dx at <i>"), short, F.lit("</i>; age = "), two))
        .when(
            rule == "Year",
            F.concat(
                F.lit("<i>Estimated</i> dx in <i>year "), year, F.lit("</i> (used "), full, F.lit("); age = "), two
            ),
        )
        .when(
            rule == "Clinic dx",
            F.concat(F.lit("<i>Clinic dx</i> at the "), year, F.lit(" clinic ("), short, F.lit("); age = "), two),
        )
        .when(rule == "Dx age unknown", F.lit("Diagnosis present, but age unknown"))
        .when(rule == "No dx", F.lit("No diagnosis"))
    )
    heading = LABEL_HEADING
    return F.concat(
        F.lit(heading.format("Diagnosis")),
        F.coalesce(sentence, F.lit("")),
        F.lit("<br /><br />"),
        F.lit(heading.format("Notes")),
        F.coalesce(notes, F.lit("")),
    )


def with_diagnosis_texts(df: DataFrame, codes: Sequence[str] = DIAGNOSES) -> DataFrame:
    """Add ``<code>_dx_label`` for every diagnosis, in one projection.

    A diagnosis has the columns ``<code>_dx_date_rule``, ``_dx_age``, ``_dx_date_notes``,
    ``_dx_date`` and ``_dx_date_est``.
    """
    parts = ("dx_date_rule", "dx_age", "dx_date_notes", "dx_date", "dx_date_est")
    return df.withColumns({f"{c}_dx_label": diagnosis_text(*[col(f"{c}_{p}") for p in parts]) for c in codes})
