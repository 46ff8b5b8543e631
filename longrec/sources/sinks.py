"""Sinks: CSV folders, nested documents and fixed-width text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longrec.names import col
from longrec.functions.values import plain_answer


def write_csv(
    df: DataFrame, path: str, keys: Sequence[str] = (), mode: str = "errorifexists", sort: bool = False
) -> None:
    """CSV folder with the key columns first, optionally sorted by them over all files."""
    rest = [c for c in df.columns if c not in keys]
    ordered = df.orderBy(*keys) if sort else df
    ordered.select(*keys, *[col(c) for c in rest]).write.mode(mode).csv(path, header=True)


def answer_document(
    df: DataFrame, keys: Sequence[str], question_ids: Mapping[str, int], form_id: str, society_id: str
) -> DataFrame:
    """(id, document): one nested JSON document per row.

    Answers follow the column order; missing values and unmapped columns give none.  Numeric
    text is cut to its integer part.  The id joins the keys with ``_``.
    """
    def answer(column: str) -> Column:
        value = col(column).cast("string")
        return F.when(
            value.isNotNull(),
            F.struct(
                F.lit(int(question_ids[column])).alias("QuestionId"),
                plain_answer(value).alias("Value"),
                F.array().cast("array<string>").alias("Comments"),
            ),
        )

    asked = [c for c in df.columns if c in question_ids and c not in keys]
    answers = F.filter(F.array(*[answer(c) for c in asked]), lambda a: a.isNotNull())
    patient = F.concat_ws("_", *[col(k).cast("string") for k in keys])
    form = F.struct(
        F.struct(F.lit(form_id).alias("Id"), answers.alias("Answers")).alias("FormInstrument"),
        F.struct(F.lit(society_id).alias("Id")).alias("Society"),
    )
    document = F.struct(F.struct(patient.alias("IdentificationCode")).alias("PersonInformation"), F.array(form).alias("Forms"))
    return df.select(patient.alias("id"), F.to_json(document).alias("document"))


def write_documents(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON document per line."""
    documents.select("document").write.mode(mode).text(path)


def write_records(records: DataFrame, column: str, path: str, mode: str = "errorifexists") -> None:
    """Fixed-width records as text; the lines of a record stay together."""
    records.select(column).write.mode(mode).text(path)
