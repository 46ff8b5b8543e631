"""CSV scans.

Text is read as text; null tokens are normalised in the same narrow projection.  Types come
from a schema or from one statistics pass, never from file order.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longrec.functions.values import WHOLE_NUMBER, exact_number
from longrec.names import col
from longrec.fixed_values import NULL_TOKENS
from longrec.session import collect_small


def _csv(spark: SparkSession, sep: str, multiline: bool):
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", False)
    )


def null_tokens_to_null(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Null for every text that stands for a missing value."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~col(c).isin(list(tokens)), col(c)) for c in texts})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means missing: store it as null."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(f"`{c}`"), col(c)) for c in floats})


def read_text_table(spark: SparkSession, path, sep: str = ",", multiline: bool = False) -> DataFrame:
    """All columns as text.  ``multiline`` is for quoted line breaks and makes files unsplittable."""
    return null_tokens_to_null(_csv(spark, sep, multiline).csv(path))


def read_table(
    spark: SparkSession, path, schema: T.StructType | str | None = None, sep: str = ",", multiline: bool = False
) -> DataFrame:
    """Typed columns: by ``schema``, else a column is numeric only if all of its values are."""
    if schema is not None:
        text = read_text_table(spark, path, sep, multiline)
        wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        return nan_to_null(
            text.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in wanted.fields])
        )
    return infer_types(read_text_table(spark, path, sep, multiline))


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number or flag types for text columns whose values all fit: one aggregate.

    Whole numbers too long for either number type stay text, so that no digit is lost.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    texts = [c for c in texts if columns is None or c in columns]
    if not texts:
        return df
    tests: list[Column] = []
    for i, c in enumerate(texts):
        value = col(c)
        tests += [
            F.count(value).alias(f"v{i}"),
            F.count(F.when(value.rlike(WHOLE_NUMBER), value.try_cast("long"))).alias(f"l{i}"),
            F.count(exact_number(value)).alias(f"d{i}"),
            F.count(F.when(value.isin("True", "False", "TRUE", "FALSE", "true", "false"), 1)).alias(f"b{i}"),
        ]
    row = df.agg(*tests).first()
    casts = {}
    for i, c in enumerate(texts):
        rows = row[f"v{i}"]
        kinds = [k for k, n in (("long", row[f"l{i}"]), ("double", row[f"d{i}"]), ("boolean", row[f"b{i}"])) if n == rows]
        if rows and kinds:
            casts[c] = col(c).cast(kinds[0])
    return nan_to_null(df.withColumns(casts))


def csv_fields(line: Column, sep: str = ",") -> Column:
    """The fields of a CSV line as an array, of any number, without their quotes; empty ones are null.

    One pass of a pattern that never looks back over the line.  ``sep`` is one character.
    """
    s = re.escape(sep)
    pattern = f'("[^"]*(?:""[^"]*)*"|[^{s}]*){s}'
    found = F.regexp_extract_all(F.concat(line, F.lit(sep)), F.lit(pattern), F.lit(1))

    def bare(field: Column) -> Column:
        inner = F.replace(F.substr(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))
        quoted = field.startswith('"') & field.endswith('"') & (F.length(field) > 1)
        return F.nullif(F.when(quoted, inner).otherwise(field), F.lit(""))

    return F.transform(found, bare)


def leading_keys(df: DataFrame, count: int) -> list[str]:
    """Key columns by position."""
    return df.columns[:count]


def read_header_lines(spark: SparkSession, path) -> list[str]:
    """Lines of a small text file such as a rename list."""
    return [r["value"].rstrip("\r") for r in collect_small(spark.read.text(path))]
