"""Small helpers that the corpus operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable

import longrec
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from longrec.session import cut_lineage, shared_dir

__all__ = ["apart_from", "cut_lineage", "free_name", "possibly_in", "read_table", "shared_dir", "ship", "text_or_empty"]

#: Bits of the filters that go to all executors by broadcast: 4 MB at most, whatever the input.
FILTER_BITS = 1 << 25
#: Rows of text that go to a Python worker at a time.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    """A text column with nulls as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name (case aside)."""
    return apart_from(wanted, df.columns)


def apart_from(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores added where a column of a result has it already (case aside)."""
    names = {c.lower() for c in taken}
    while name.lower() in names:
        name += "_"
    return name


def possibly_in(rows: DataFrame, keys: list[str], wanted: DataFrame, hit: str) -> DataFrame:
    """``rows`` with a boolean ``hit``: false only where the keys are surely not in ``wanted``.

    A bitmap of fixed size over the hashes of the wanted keys (columns in the order of ``keys``) is
    broadcast.  It keeps wide rows that no join can change out of the shuffle; rows with ``hit`` still need the exact
    join.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS)) + 1
    slots = wanted.select((F.pmod(F.xxhash64(*wanted.columns), F.lit(FILTER_BITS)) + 1).alias("slot"))
    bits = slots.groupBy(F.bitmap_bucket_number("slot").alias(f"{hit}_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias(f"{hit}_bits")
    )
    marked = rows.withColumn(f"{hit}_part", F.bitmap_bucket_number(slot)).withColumn(f"{hit}_bit", F.bitmap_bit_position(slot))
    marked = marked.join(F.broadcast(bits), f"{hit}_part", "left")
    place = F.floor(F.col(f"{hit}_bit") / 8).cast("int") + 1
    byte = F.conv(F.hex(F.substring(F.col(f"{hit}_bits"), place, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, F.col(f"{hit}_bit") % 8) == 1, F.lit(False))
    return marked.withColumn(hit, found).drop(f"{hit}_part", f"{hit}_bit", f"{hit}_bits")


def ship(spark: SparkSession) -> None:
    """Give the executors this library, which the functions that run in tasks import.

    Spark's own file distribution sends it once per application.  Rows here are whole texts, so unless the
    session sets it, the number of rows of an Arrow batch is lowered too: it bounds the memory of a task.
    """
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    context = spark.sparkContext
    if getattr(context, "_longrec_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(longrec.__file__))
    folder = tempfile.TemporaryDirectory(prefix="longrec-")
    path = os.path.join(folder.name, "longrec.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for place, _, names in os.walk(root):
            for name in (n for n in names if n.endswith(".py")):
                full = os.path.join(place, name)
                archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._longrec_shipped = folder
