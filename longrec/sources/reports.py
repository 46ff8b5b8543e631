"""Report files: classification, labelled rows, ledgers and upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from longrec.fixed_values import COMPETENCE_SCALES, REPORT_ROWS, REPORT_SCALES
from longrec.functions.labels import patient_subject, path_job, path_patient
from longrec.operators.joins import union_missing
from longrec.operators.ordered import SPLIT_ABOVE, attach, keep_last, running_sum
from longrec.operators.predicates import without_keys
from longrec.session import cut_lineage
from longrec.sources.folders import FILE_ORDER, file_headers, line_records, scan_folder
from longrec.sources.tables import csv_fields

REPORT_KEYS = ("Subject", "Patient ID", "Age", "Sex", "type")


def read_reports(
    spark: SparkSession,
    folder: str | Sequence[str],
    required: str = "Age",
    patient_pattern: str = r"[A-Z]+\d+_s\d",
    glob: str = "report*.csv",
) -> tuple[DataFrame | None, DataFrame]:
    """(rows of ``;``-separated reports, skipped files); headers may differ between files.

    Only files named like a report are read: a job's other tables are none.

    Patient, subject and job come from the path.  Keys stay text.
    """
    rows, skipped = scan_folder(spark, folder, required, glob, sep=";")
    if rows is None:
        return None, skipped
    path = F.col("file")
    texts = {c: F.col(c).cast("string") for c in ("Age", "Sex") if c in rows.columns}
    return rows.withColumns(texts).withColumns(
        {
            "Patient ID": path_patient(path, patient_pattern),
            "Subject": patient_subject(path_patient(path, patient_pattern)),
            "job_id": path_job(path),
        }
    ), skipped


def report_headers(spark: SparkSession, folder: str | Sequence[str], glob: str = "report*.csv") -> DataFrame:
    """(job_id, file, header) of the reports of a folder."""
    return file_headers(spark, folder, glob, sep=";").where("header is not null").select(path_job(F.col("file")).alias("job_id"), "file", "header")


def job_files(spark: SparkSession, folder: str | Sequence[str]) -> DataFrame:
    """(job_id, file) of everything that came with a job; listing only."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder if isinstance(folder, str) else list(folder))
    return listed.select(
        path_job(F.col("_metadata.file_path")).alias("job_id"), F.col("_metadata.file_name").alias("file")
    )


def report_type(header: Column, rules: Sequence[tuple[str, str]], fallback: Column) -> Column:
    """Type by the first rule whose text occurs in the header, else the fallback."""
    chosen = None
    for text, label in rules:
        test = header.contains(text)
        chosen = F.when(test, F.lit(label)) if chosen is None else chosen.when(test, F.lit(label))
    return fallback if chosen is None else chosen.otherwise(fallback)


#: Header text -> report type, and file endings -> parts of the remaining type.
TYPE_RULES = (("Brainstem", "subcortical"), ("Crus", "ceres"))
METHOD_FILES = ("%winterburn%.nii", "winterburn", "kulaga")
CONTRAST_FILES = ("%t2.nii", "multicontrast", "monocontrast")


def classify_reports(
    headers: DataFrame,
    files: DataFrame,
    job: str = "job_id",
    rules: Sequence[tuple[str, str]] = TYPE_RULES,
    stem: str = "hips",
    method: tuple[str, str, str] = METHOD_FILES,
    contrast: tuple[str, str, str] = CONTRAST_FILES,
    by: Sequence[str] = (),
) -> DataFrame:
    """(job, by, type) from a (job, by, header) and a (job, file) table.

    Each report is typed by its own header; one without a known text by the files that came with the
    job.  ``by`` names what tells the reports of a job apart, such as their file.
    """
    seen = files.groupBy(job).agg(
        F.max(F.col("file").like(method[0])).alias("__method"),
        F.max(F.col("file").like(contrast[0])).alias("__contrast"),
    )
    method_part = F.when(F.coalesce("__method", F.lit(False)), method[1]).otherwise(method[2])
    contrast_part = F.when(F.coalesce("__contrast", F.lit(False)), contrast[1]).otherwise(contrast[2])
    fallback = F.concat_ws("_", F.lit(stem), method_part, contrast_part)
    return headers.join(seen, job, "left").select(job, *by, report_type(F.col("header"), rules, fallback).alias("type"))


def unprocessed(jobs: DataFrame, reports: DataFrame | None, job: str = "job_id", redo: bool = False) -> DataFrame:
    """Jobs that no earlier report contains; all of them with ``redo``."""
    return jobs if redo or reports is None else without_keys(jobs, reports, [job])


def upsert_reports(
    old: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str] = REPORT_KEYS,
    order_by: Sequence[str] = (),
    redo: bool = False,
) -> DataFrame:
    """Old and new rows by name; for each key the new row wins, and among equals the last one.

    Both sides are reduced to one row per key before the shuffle.
    """
    batch = "__batch"
    rows = new.withColumn(batch, F.lit(1))
    if old is not None and not redo:
        rows = union_missing(old.withColumn(batch, F.lit(0)), rows)
    return keep_last(rows, keys, [batch, *order_by]).drop(batch)


def labelled_cells(
    lines: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    cells: Column,
    labels: Sequence[str],
    split_above: int | None = SPLIT_ABOVE,
) -> DataFrame:
    """(keys, label, width, position, cell) of the rows whose first cell starts with a label.

    Non-empty cells after the first are appended line by line; ``position`` counts from 0 over
    the report, ``width`` is the number of cells the label has there.  The offset of a line is
    the number of cells on the lines before it, so no report is gathered into one value.
    """
    found = F.coalesce(*[F.when(F.get("__cells", F.lit(0)).startswith(t), F.lit(t)) for t in labels])
    rest = F.filter(F.slice("__cells", 2, F.greatest(F.size("__cells") - 1, F.lit(0))), lambda c: c.isNotNull() & (c != ""))
    marked = (
        lines.select(*keys, *order_by, cells.alias("__cells"))
        .withColumn("label", found)
        .where(F.col("label").isNotNull())
        .withColumn("__rest", rest)
        .withColumn("__size", F.size("__rest"))
    )
    widths = marked.groupBy(*keys, "label").agg(F.sum("__size").cast("int").alias("width"))
    # joined first: the running sum then finds its rows in place
    marked = attach(marked, widths, [*keys, "label"], ["width"])
    placed = running_sum(marked, [*keys, "label"], "__size", order_by, "__offset", split_above)
    return placed.select(*keys, "label", "width", "__offset", F.posexplode("__rest").alias("__i", "cell")).select(
        *keys, "label", "width", (F.col("__offset") + F.col("__i")).cast("int").alias("position"), "cell"
    )


def report_scores(
    cells: DataFrame,
    keys: Sequence[str],
    scales: Sequence[str] = REPORT_SCALES,
    optional: Sequence[str] = COMPETENCE_SCALES,
    rows: Mapping[str, str] = REPORT_ROWS,
) -> DataFrame:
    """(keys, score_type, scale, cell): the position within a report names the scale.

    A report whose rows have as many cells as there are scales without the optional ones is read against the
    shorter list.  Reports with any other width are left out; ``rejected_reports`` names them.
    """
    short = [s for s in scales if s not in optional]
    cells = without_keys(cells, rejected_reports(cells, keys, scales, optional), keys)
    listed = F.when(F.col("width") == len(short), F.lit(list(short))).otherwise(F.lit(list(scales)))
    kind = F.try_element_at(F.create_map(*[F.lit(x) for p in rows.items() for x in p]), F.col("label"))
    return cells.select(
        *keys, F.coalesce(kind, F.col("label")).alias("score_type"), F.get(listed, F.col("position")).alias("scale"), "cell"
    )


def rejected_reports(
    cells: DataFrame, keys: Sequence[str], scales: Sequence[str] = REPORT_SCALES, optional: Sequence[str] = COMPETENCE_SCALES
) -> DataFrame:
    """(keys, label, width) of the rows whose cells are neither all scales nor all but the optional ones."""
    widths = [len(scales), len([s for s in scales if s not in optional])]
    return cells.where(~F.col("width").isin(widths)).select(*keys, "label", "width").distinct()


def read_labelled_reports(spark: SparkSession, path: str | Sequence[str], split_above: int | None = SPLIT_ABOVE) -> DataFrame:
    """(file, label, width, position, cell) of CSV score reports below a folder, or of a list of files.

    Lines are ordered by split and by number within their split, so files stay splittable; line breaks inside quotes are
    part of their cell.  Files whose quotes never close are left out.
    """
    found = cut_lineage(file_headers(spark, path, "*"))
    lines, _, _ = line_records(spark, path, found, "*")
    cells = F.transform(csv_fields(F.col("line")), lambda c: F.trim(c))
    return labelled_cells(lines, ["file"], FILE_ORDER[1:], cells, list(REPORT_ROWS), split_above)
