"""Column selection and renaming.

All of this is name logic on the driver followed by one ``select``; rows are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longrec.names import col, renamed_columns

#: Canonical names of the columns shared by the jobs, in the order renames are given.
COMMON_COLUMNS = ("study_id", "session_year", "dob", "session_date", "session_number")


def matching(columns: Iterable[str], pattern: str) -> list[str]:
    """Names whose beginning matches ``pattern``."""
    return [c for c in columns if re.match(pattern, c)]


def first_matching(columns: Iterable[str], pattern: str) -> str | None:
    """The first name whose beginning matches."""
    return next(iter(matching(columns, pattern)), None)


def searching(columns: Iterable[str], patterns: Sequence[str]) -> list[str]:
    """Names that contain a match of any pattern; pattern by pattern, each name once."""
    names = list(columns)
    return list(dict.fromkeys(c for p in patterns for c in names if re.search(p, c)))


def with_families(columns: Iterable[str], variables: Iterable[str]) -> list[str]:
    """Each variable with its checkbox columns ``variable___<k>``.

    A column belongs to the family of its own name, and to those of the names before each ``___`` in it.
    """
    families: dict[str, list[str]] = {}
    for c in columns:
        parts = c.split("___")
        for size in range(1, len(parts) + 1):
            families.setdefault("___".join(parts[:size]), []).append(c)
    return list(dict.fromkeys(c for v in variables for c in families.get(v, [])))


def resolve_variables(
    columns: Sequence[str], requested: Sequence[str], forms: dict[str, Sequence[str]] | None = None
) -> tuple[list[str], list[list[str]]]:
    """Exact columns and column groups for a list of requests.

    A request is an exact column, else a form name, else a prefix pattern.  Requests that name
    nothing are an error.
    """
    forms = forms or {}
    unknown = [v for v in requested if v not in forms and not matching(columns, v)]
    if unknown:
        raise ValueError(f"variables not in the data: {unknown}")
    exact = [v for v in requested if v in columns]
    groups = [
        [c for c in forms[v] if c in columns] if v in forms else matching(columns, v)
        for v in requested
        if v not in columns
    ]
    return exact, groups


def keep_mapped(df: DataFrame, allowed: Iterable[str]) -> DataFrame:
    """Only the columns of a whitelist, in table order."""
    names = set(allowed)
    return df.select(*[col(c) for c in df.columns if c in names])


def extract_fields(df: DataFrame, keys: Sequence[str], patterns: Sequence[str]) -> DataFrame:
    """The keys and, request by request, the columns that match from their beginning."""
    names = [c for c in df.columns if c not in keys]
    found = dict.fromkeys(c for p in patterns for c in matching(names, p))
    return df.select(*keys, *[col(c) for c in found])


def rename_common(df: DataFrame, names: Sequence[str | None], back: bool = False) -> DataFrame:
    """Rename study columns to the canonical ones, or ``back``; ``None`` skips a position."""
    pairs = [(old, new) for old, new in zip(names, COMMON_COLUMNS) if old is not None]
    return renamed_columns(df, {new: old for old, new in pairs} if back else dict(pairs))


def rename_by_table(df: DataFrame, mapping: dict[str, str | None]) -> DataFrame:
    """Rename from a mapping; a missing target keeps the name."""
    return renamed_columns(df, mapping)


def rename_with_families(df: DataFrame, mapping: dict[str, str], checkbox: Iterable[str]) -> DataFrame:
    """Rename; where the target is a checkbox field, every ``old___k`` follows."""
    boxes = set(checkbox)
    expanded = {}
    for old, new in mapping.items():
        if new in boxes:
            expanded |= {c: new + c[len(old):] for c in df.columns if c.startswith(old + "___")}
        else:
            expanded[old] = new
    return renamed_columns(df, expanded)


Rule = tuple[Callable[[str], bool], Callable[[str], str]]


def rename_by_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Apply (test, change) rules one after another; duplicate results are an error."""
    names = list(df.columns)
    for test, change in rules:
        names = [change(c) if test(c) else c for c in names]
    doubled = sorted({c for c in names if names.count(c) > 1})
    if doubled:
        raise ValueError(f"renaming gives duplicate columns: {doubled}")
    return df.toDF(*names)


def rename_from_lines(df: DataFrame, lines: Iterable[str]) -> DataFrame:
    """Rename from ``old,new`` lines; whole names only, short or broken lines are skipped."""
    pairs = [line.strip().split(",") for line in lines if len(line.strip()) >= 4]
    return renamed_columns(df, {p[0]: p[1] for p in pairs if len(p) > 1})


def with_constants(df: DataFrame, values: dict) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def insert_before(df: DataFrame, before: str, name: str, value: Column) -> DataFrame:
    """Put a new column immediately before an existing one."""
    columns: list = []
    for c in df.columns:
        if c == name:
            continue
        if c == before:
            columns.append(value.alias(name))
        columns.append(col(c))
    return df.select(*columns)


def filled_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Columns with at least one value: one aggregate over all of them."""
    names = list(columns or df.columns)
    row = df.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(names)]).first()
    return [c for i, c in enumerate(names) if row[f"n{i}"]]


def drop_empty_columns(df: DataFrame, keep: Sequence[str] = (), filled: Sequence[str] | None = None) -> DataFrame:
    """Drop columns that are null in every row; pass ``filled`` to save the job."""
    present = set(filled if filled is not None else filled_columns(df, [c for c in df.columns if c not in keep]))
    return df.select(*[col(c) for c in df.columns if c in present or c in keep])


def drop_matching(df: DataFrame, pattern: str, unless: str | None = None) -> DataFrame:
    """Drop columns that match from their beginning, except those that contain ``unless``."""
    return df.drop(*[c for c in matching(df.columns, pattern) if unless is None or unless not in c])


def only_where(df: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
    """Null ``columns`` on the rows where the condition does not hold."""
    return df.withColumns({c: F.when(condition, col(c)) for c in columns})


def family_union(columns: Sequence[str], forms: dict[str, Sequence[str]], names: Sequence[str]) -> list[str]:
    """Completion flags and fields (with families) of the named forms."""
    flags = [f"{form}_complete" for form in names if f"{form}_complete" in columns]
    fields = [v for form in names for v in forms.get(form, ())]
    return list(dict.fromkeys(flags + with_families(columns, fields)))
