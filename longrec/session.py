"""Session, shared folders and the small-table guards used by the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Largest metadata table that may come to the driver or be broadcast.
SMALL_ROWS = 100_000


def get_session(app: str = "longrec", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> tempfile.TemporaryDirectory:
    """A temporary folder for a local master, removed when the program ends."""
    return tempfile.TemporaryDirectory(prefix="longrec-", ignore_cleanup_errors=True)


def _scratch(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_scratch().name
    return f"{base.rstrip('/')}/longrec-{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below one folder of the application.

    The cluster names the parent in ``spark.checkpoint.dir``.  Only a local master may fall
    back to a temporary folder of its own.
    """
    return f"{_scratch(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application, once its results are written.

    DataFrames that read them cannot be used after that.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame, observed: Mapping[str, Column] | None = None) -> DataFrame | tuple[DataFrame, dict]:
    """``df`` written once to the shared folder and read back; ``remove_scratch`` removes it.

    A Parquet table, so that each later pass reads its own columns only.  It outlives lost
    executors.  Column types Parquet cannot hold make it a reliable checkpoint instead.

    With ``observed`` (names and aggregates) the result is a pair: the table, and the values of the aggregates, which are
    gathered while it is written.
    """
    spark = df.sparkSession
    if observed is not None:
        seen = Observation()
        names = {f"a{i}": name for i, name in enumerate(observed)}
        watched = df.observe(seen, *[column.alias(a) for a, column in zip(names, observed.values(), strict=True)]) if observed else df
        table = cut_lineage(watched)
        values = seen.get if observed else {}
        return table, {name: values[a] for a, name in names.items()}
    if any("void" in kind or "interval" in kind or "variant" in kind for _, kind in df.dtypes):
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoint"))
        return df.checkpoint(eager=True)
    path = shared_dir(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def collect_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> list:
    """Rows of a metadata table, refusing anything larger than ``max_rows``."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} metadata rows")
    return rows


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Add a broadcast hint only after counting; a larger side is left to AQE."""
    counted = df.limit(max_rows + 1).count()
    return F.broadcast(df) if counted <= max_rows else df
