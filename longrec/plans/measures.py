"""Jobs on measures: blocks, slopes, group regressions and report collection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longrec.names import col
from longrec import fixed_values as fixed
from longrec.functions import labels
from longrec.operators import columns, predicates, regression, reshape
from longrec.sources import reports
from longrec.sources.folders import FILE_ORDER


def import_blocks(df: DataFrame, key: str = "record_id", block: str = "block", measure: str = "measure") -> DataFrame:
    """One row per subject: ``block<k>_<code>_<side>`` from a table of three blocks.

    Only the left and right averages are kept.
    """
    sides = {c: c.lower().removesuffix(" avg").removesuffix("_avg") for c in df.columns}
    sides = {c: side for c, side in sides.items() if side in ("left", "right")}
    rows = df.where(F.col(measure).isNotNull()).select(
        key,
        F.concat(F.lit("block"), F.col(block).cast("string")).alias("block"),
        labels.measure_code(F.col(measure), fixed.MEASURE_FIXES).alias("code"),
        *[col(c).alias(side) for c, side in sides.items()],
    )
    wide = reshape.blocks_wide(rows, key, "block", "code", list(sides.values()))
    suffix, old, new = fixed.IRREGULAR_BLOCK_SUFFIX
    named = columns.rename_by_rules(wide, [(lambda c: c.endswith(suffix), lambda c: c.replace(old, new))])
    return columns.with_constants(named, {f"block_{i}_kinematics_complete": 1 for i in (1, 2, 3)})


def slopes(
    df: DataFrame,
    x: str,
    order_by: Sequence[str],
    subject: str | None = None,
    variables: Sequence[str] | None = None,
    group: str | None = None,
    wide: bool = True,
) -> DataFrame:
    """Slope statistics per subject, one row per subject unless ``wide`` is off.

    The first two columns are the keys; all other columns but x and group are variables.
    """
    key = subject or df.columns[0]
    chosen = list(variables or [c for c in df.columns[2:] if c not in (x, group) and c not in order_by])
    rows = predicates.drop_all_null(df, chosen)
    fitted = regression.subject_slopes(rows, key, x, chosen, order_by, group)
    if not wide:
        return fitted
    keys = [key, *([group] if group else [])]
    return reshape.slopes_wide(fitted, keys, variables=chosen)


def group_tables(
    df: DataFrame, x: str, group: str, patterns: Sequence[str] = (), limit: float = 0.05, keys: int = 2
) -> tuple[DataFrame, DataFrame]:
    """(regression per group and variable, trend points of the significant ones)."""
    names = [c for c in df.columns[keys:] if c not in (x, group)]
    chosen = columns.searching(names, patterns) if patterns else names
    fitted = regression.group_regression(df, x, chosen, group)
    return fitted, regression.trend_points(fitted, group, limit)


def collect_reports(
    rows: DataFrame,
    headers: DataFrame,
    files: DataFrame,
    old: DataFrame | None,
    order_by: Sequence[str],
    redo: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Old and new report rows with their type; jobs already reported are not taken again.

    ``rows`` carry ``job_id``; ``headers`` and ``files`` say what came with each job.  Where a job
    has several reports, ``by`` tells them apart in ``rows`` and ``headers``.
    """
    fresh = reports.unprocessed(rows, old, "job_id", redo)
    types = reports.classify_reports(headers, files, by=by)
    typed = fresh.join(types, ["job_id", *by], "left")
    return reports.upsert_reports(old, typed, reports.REPORT_KEYS, order_by, redo)


def collect_report_folder(
    spark: SparkSession,
    folder: str,
    old: DataFrame | None = None,
    patient_pattern: str = r"[A-Z]+\d+_s\d",
    redo: bool = False,
) -> DataFrame | None:
    """The same from a folder of unpacked jobs; ``None`` where there is nothing old or new.

    Within a batch the last row in file order wins.
    """
    rows, _ = reports.read_reports(spark, folder, patient_pattern=patient_pattern)
    if rows is None:
        return old
    collected = collect_reports(
        rows, reports.report_headers(spark, folder), reports.job_files(spark, folder), old, FILE_ORDER, redo, by=["file"]
    )
    return collected.drop(*FILE_ORDER)
