"""Folder scans: many files with differing headers, and file discovery by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longrec.names import col
from longrec.operators.predicates import drop_all_null
from longrec.session import broadcast_if_small, collect_small, cut_lineage
from longrec.sources.quoting import FILE_ORDER, ends_inside, whole_records
from longrec.sources.tables import csv_fields, infer_types, null_tokens_to_null

#: Distinct column names a folder may have.
MAX_COLUMNS = 10_000
#: Files that a scan may be given as a list.
MAX_LISTED_FILES = 100_000


def text_lines(spark: SparkSession, source: str | Sequence[str], glob: str = "*") -> DataFrame:
    """``FILE_ORDER`` and line of all files below a folder, or of the files of a list."""
    marked = F.col("value").startswith("\ufeff") | F.col("value").contains("\r")
    return (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .text(source if isinstance(source, str) else list(source))
        .select(
            # most lines need no pattern
            F.when(marked, F.regexp_replace("value", "^\ufeff|\r$", "")).otherwise(F.col("value")).alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("file_start"),
        )
        .withColumn("file_line", F.monotonically_increasing_id())
    )


def file_headers(spark: SparkSession, source: str | Sequence[str], glob: str = "*.csv", sep: str = ",") -> DataFrame:
    """(file, header, header_line, broken): the first line of every file that is not blank, and its number.

    ``broken`` says whether any line ends inside quotes.  Lines are numbered inside their split, headers stand in first
    splits, and each file is reduced to one row before the shuffle.
    """
    lines = text_lines(spark, source, glob).withColumn("__top", (F.col("file_start") == 0) & (F.trim("line") != ""))
    top = F.when(F.col("__top"), F.col("file_line"))
    return lines.groupBy("file").agg(
        F.min_by("line", top).alias("header"), F.min(top).alias("header_line"), F.max(ends_inside(F.col("line"), sep)).alias("broken")
    )


def line_records(
    spark: SparkSession, source: str | Sequence[str], headers: DataFrame, glob: str = "*.csv", sep: str = ","
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records as ``FILE_ORDER`` and line, headers by record, files whose quotes never close).

    Only files with a line that ends inside quotes are put together from their lines; all others are read line by line.
    """
    lines, names = text_lines(spark, source, glob), ["file", "header", "header_line"]
    plain, broken = headers.where("not broken").select(*names), headers.where("broken").select("file")
    if broken.isEmpty():
        return lines, plain.where("header is not null"), broken
    records, unclosed = whole_records(lines.join(broadcast_if_small(broken), "file", "left_semi"), sep)
    records, unclosed = cut_lineage(records), cut_lineage(unclosed)
    top = F.when(F.trim("line") != "", F.struct("file_start", "file_line"))
    joined = records.groupBy("file").agg(F.min_by("line", top).alias("header"), F.min(top)["file_line"].alias("header_line"))
    whole = lines.join(broadcast_if_small(broken), "file", "left_anti").unionByName(records)
    return whole, plain.unionByName(joined).where("header is not null"), unclosed


def scan_folder(
    spark: SparkSession, folder: str | Sequence[str], required: str, glob: str = "*.csv", sep: str = ",",
    types: Mapping[str, str] | None = None, max_columns: int = MAX_COLUMNS,
) -> tuple[DataFrame | None, DataFrame]:
    """(rows of all usable files with the columns of ``FILE_ORDER``, skipped files).

    Files without the required column, and those whose quotes never close, are skipped and reported.  All files are one scan: each
    record is split once and its fields go to the columns its own file's header names.  Rows
    without any value are dropped.  ``folder`` may be a list of files.

    The folder is read once for the headers and once for the rows; both are written out, and the types are found from the rows
    unless ``types`` (column to type, text where it names none) is given.  Files with
    line breaks inside quotes are read once more, and their records are written out.
    """
    found = cut_lineage(file_headers(spark, folder, glob, sep))
    lines, headers, unclosed = line_records(spark, folder, found, glob, sep)
    headers = headers.withColumn("names", F.transform(csv_fields(F.col("header"), sep), lambda c: F.trim(c)))
    usable = F.coalesce(F.array_contains("names", required), F.lit(False))
    skipped = headers.where(~usable).select("file", F.lit(f"no column named {required}").alias("reason"))
    skipped = skipped.unionByName(unclosed.select("file", F.lit("a quoted field never ends").alias("reason")))
    kept = headers.where(usable)
    columns = collect_small(
        kept.select(F.posexplode("names").alias("place", "name"))
        .where(F.coalesce(F.col("name"), F.lit("")) != "")
        .groupBy("name")
        .agg(F.min("place").alias("place"))
        .orderBy("place", "name"),
        max_columns,
    )
    if not columns:
        return None, skipped
    names = [c["name"] for c in columns]
    # where each column of the result stands in a file, found once per file
    places = F.transform(F.lit(names), lambda c: F.array_position("names", c).cast("int"))
    kept = kept.select("file", "header_line", places.alias("places"))
    lines = lines.join(broadcast_if_small(kept), "file")
    rows = lines.where((F.col("file_start") > 0) | (F.col("file_line") > F.col("header_line")))
    split = rows.select(*FILE_ORDER, "places", csv_fields(F.col("line"), sep).alias("fields"))
    # written out, as the filters and types below would else split each line again for every column
    own = F.array(*[F.get("fields", F.get("places", F.lit(i)) - 1) for i in range(len(names))])
    split = cut_lineage(split.select(*FILE_ORDER, own.alias("fields")))
    rows = split.select(*[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(names)], *FILE_ORDER)
    rows = drop_all_null(null_tokens_to_null(rows), names)
    if types is not None:
        return rows.withColumns({c: col(c).cast(types[c]) for c in names if c in types}), skipped
    return infer_types(rows, names), skipped


def parse_file_names(files: DataFrame, prefix: str, subjects: Sequence[str] = ()) -> DataFrame:
    """Add subject and visit to a (path, file) listing; other names are left out.

    Names are ``<prefix><digits>_<visit>.<extension>``, in any case.
    """
    pattern = rf"(?i)({prefix}\d+)_(\w+)\.\w+"
    named = files.where(F.col("file").rlike(pattern)).select(
        "path",
        "file",
        F.regexp_extract("file", pattern, 1).alias("subject"),
        F.regexp_extract("file", pattern, 2).alias("visit"),
    )
    return named.where(F.col("subject").isin(list(subjects))) if subjects else named


def discover_files(
    spark: SparkSession,
    folder: str,
    prefix: str,
    extension: str,
    subjects: Sequence[str] = (),
    modified_after: str | None = None,
) -> DataFrame:
    """(path, file, subject, visit) of the files below a folder, optionally only recent ones.

    Listing only: file contents are never read.
    """
    reader = (
        spark.read.format("binaryFile").option("pathGlobFilter", f"*.{extension}").option("recursiveFileLookup", True)
    )
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    found = reader.load(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file")
    )
    return parse_file_names(found, prefix, subjects)


def chosen_paths(files: DataFrame, max_files: int = MAX_LISTED_FILES) -> list[str]:
    """The paths of chosen files, for a scan that opens these and no others.

    More than ``max_files`` are refused, as their list comes to the driver: choose fewer at a time.
    """
    return [unquote(r["path"]) for r in collect_small(files.select("path"), max_files)]
