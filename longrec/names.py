"""Column names as they are: export names may contain dots and spaces."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def renamed_columns(df: DataFrame, mapping: Mapping[str, str | None]) -> DataFrame:
    """All renames at once, so names may be swapped; two columns of one name are an error.

    A missing target keeps the name, and names that are not in the table are skipped.
    """
    names = [mapping.get(c) or c for c in df.columns]
    doubled = sorted({c for c in names if names.count(c) > 1} - {c for c in df.columns if df.columns.count(c) > 1})
    if doubled:
        raise ValueError(f"renaming gives duplicate columns: {doubled}")
    return df.toDF(*names)
