"""Identifiers, event labels and instrument labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from longrec.fixed_values import PIN_PATTERN


def _found(value: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


def clinic_label(event: Column) -> Column:
    """Label of a clinic event: ``0`` stable, ``mc<k>`` mini clinic, else the leading year."""
    head = F.substring(event, 1, 4)
    return F.when(head == "stab", F.lit("0")).when(
        head == "mini", F.concat(F.lit("mc"), F.substring(event, 13, 1))
    ).otherwise(head)


def strip_event_tail(event: Column) -> Column:
    """Drop ``_arm_<k>``."""
    return F.regexp_replace(event, "_arm_.", "")


def strip_prefix_text(value: Column, text: str) -> Column:
    """Remove a literal text wherever it occurs."""
    return F.replace(value, F.lit(text), F.lit(""))


def leading_year(key: Column, pattern: str = r"^[A-Za-z]+_(\d{4})_") -> Column:
    """Start year held in a subject key."""
    return _found(key, pattern, 1).try_cast("int")


def event_year(event: Column) -> Column:
    """Year of an event such as ``2018_arm_1``."""
    return _found(event, r"^(\d{4})_arm_1", 1).try_cast("int")


def pin_subject(pin: Column) -> Column:
    """Subject part of a test PIN, without spaces, in upper case; null where there is none."""
    return F.upper(F.replace(_found(pin, PIN_PATTERN, 1), F.lit(" "), F.lit("")))


def pin_session(pin: Column) -> Column:
    """Session digit of a test PIN; ``1`` where there is none."""
    return F.when(pin.isNotNull(), F.coalesce(_found(pin, PIN_PATTERN, 2), F.lit("1")))


def session_token(pin: Column) -> Column:
    """The first ``s`` with an optional digit, in lower case; ``1`` where there is none."""
    return F.coalesce(F.lower(_found(pin, r"(?i)(s\d?)", 1)), F.lit("1"))


def split_key(key: Column) -> tuple[Column, Column]:
    """(subject, event) of a composite key, split at the first underscore."""
    parts = F.split(key, "_", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def path_patient(path: Column, pattern: str = r"[A-Z]+\d+_s\d") -> Column:
    """Patient id in a path, matched in any case."""
    return _found(path, f"(?i)({pattern})", 1)


def path_job(path: Column) -> Column:
    """Job id in a path."""
    return _found(path, r"(job\d{6})", 1)


def patient_subject(patient: Column) -> Column:
    """Subject part of a patient id."""
    return F.substring_index(patient, "_", 1)


def map_instrument(label: Column, mapping: dict[str, str]) -> Column:
    """Variable of an instrument label by substring; later entries win, unknown labels stay."""
    chosen = None
    for text, variable in reversed(mapping.items()):
        test = label.contains(text)
        chosen = F.when(test, F.lit(variable)) if chosen is None else chosen.when(test, F.lit(variable))
    return label if chosen is None else chosen.otherwise(label)


def measure_code(label: Column, fixes: Sequence[tuple[str, str]]) -> Column:
    """Initials of the words of a measure, split after two letters, with text fixes applied.

    A word starts after a space, underscore, dot or dash, and at every capital.
    """
    spaced = F.regexp_replace(F.regexp_replace(label, r"[_.\-]", " "), "([A-Z])", " $1")
    words = F.filter(F.split(F.trim(spaced), r"\s+"), lambda w: w != "")
    initials = F.array_join(F.transform(words, lambda w: F.lower(F.substring(w, 1, 1))), "")
    code = F.concat(F.substring(initials, 1, 2), F.lit("_"), F.substring(initials, 3, 1000))
    for old, new in fixes:
        code = F.replace(code, F.lit(old), F.lit(new))
    return code
