"""A stream of report jobs: ledger, typing and store in one micro-batch.

The stream lists the files that arrive; no content passes through it.  Of each micro-batch the report files are read as one
scan of just these files, jobs that the ledger knows are left out, the rest is typed and added to the store.  The ledger is a
store of its own beside that of the reports, since a job's rows may be replaced by later ones there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from longrec.functions.labels import path_job
from longrec.operators.ordered import first_rows
from longrec.sources import reports
from longrec.sources.folders import FILE_ORDER, chosen_paths
from longrec.streaming import upsert

#: Files that one micro-batch takes; their list comes to the driver.
FILES_PER_BATCH = 10_000
LISTED = "path string, modificationTime timestamp, length long, content binary"


def arriving_files(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """(path, file, job_id, changed) of the files that arrive below a folder, as a stream; listing only."""
    listed = (
        spark.readStream.format("binaryFile").schema(LISTED).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch).load(folder)
    )
    path = F.col("path")
    return listed.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), path_job(path).alias("job_id"), F.col("modificationTime").alias("changed"))


def add_jobs(
    arrived: DataFrame, store: str, batch: int, writer: str, report_pattern: str = r"^report.*\.csv$", patient_pattern: str = r"[A-Z]+\d+_s\d",
    redo: bool = False,
) -> None:
    """Read the reports among ``arrived`` files, leave out jobs the store has, type the others and store them.

    A job is typed by its reports' headers and by all that lies in their folders by now.  Of a job that was sent twice in one
    batch the folder whose path comes first counts.  Rows of files without the columns of a report are left out.
    """
    spark, job = arrived.sparkSession, "job_id"
    found = arrived.where(F.col("file").rlike(report_pattern) & F.col(job).isNotNull())
    fresh = reports.unprocessed(found, known_jobs(spark, store), job, redo).withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
    first = first_rows(fresh.select(job, "folder").distinct(), [job], ["folder"], 1)
    paths = chosen_paths(fresh.join(first, [job, "folder"]).select("path"), FILES_PER_BATCH)
    if not paths:
        return
    rows, _ = reports.read_reports(spark, paths, patient_pattern=patient_pattern, glob="*")
    if rows is None:
        return
    folders = sorted({p.rsplit("/", 1)[0] for p in paths})
    types = reports.classify_reports(reports.report_headers(spark, paths, "*"), reports.job_files(spark, folders), by=["file"])
    typed = rows.join(types, [job, "file"], "left")
    upsert.upsert_batch(typed, store, batch, reports.REPORT_KEYS, FILE_ORDER, redo=redo, writer=writer)
    # a batch that fails in between is run again, and finds its rows stored
    done = typed.groupBy(job, "type").agg(F.min("file").alias("file"))
    upsert.upsert_batch(done, ledger_of(store), batch, [job], ["type"], writer=writer)


def ledger_of(store: str) -> str:
    return f"{store.rstrip('/')}-jobs"


def known_jobs(spark: SparkSession, store: str) -> DataFrame | None:
    """(job_id, type, file) of all jobs ever added; ``None`` where there is none."""
    return upsert.read_store(spark, ledger_of(store), ["job_id"])


def stream_jobs(
    spark: SparkSession, folder: str, store: str, checkpoint: str, patient_pattern: str = r"[A-Z]+\d+_s\d", redo: bool = False,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Add all jobs that arrived below ``folder`` since the checkpoint, then stop.

    A batch that is run again after a failure finds its rows in the store and its jobs in the ledger, and adds nothing.
    """
    writer = upsert.stream_writer(spark, checkpoint)

    def add(arrived: DataFrame, batch: int) -> None:
        add_jobs(arrived, store, batch, writer, patient_pattern=patient_pattern, redo=redo)

    return (
        arriving_files(spark, folder, files_per_batch).writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stored_reports(spark: SparkSession, store: str) -> DataFrame | None:
    """The collected reports, without the places they were read from."""
    rows = upsert.read_store(spark, store, reports.REPORT_KEYS)
    return None if rows is None else rows.drop(*FILE_ORDER)
