"""Incremental reports as a Parquet store, for batches and for streams.

Rows lie under ``write / level / version / part``.  The part is the type behind a letter, so that a reader takes none for a
number or a date; the type itself is a column like any other.  A batch writes its own rows only, one per key, as a
*delta*.  Its version is allocated (``log``) and gives the order; the number of the batch only tells, with the name of its
writer, whether the same rows were written before.  So several writers may each count their batches from 0 on.

The log lists the live folders with their schemas: a reader opens the newest *full* folder of a type and the deltas
after it, nothing else, and keeps the last row per key.  Compaction writes a new full folder beside the old
ones, which readers follow from then on; ``vacuum`` removes what no reader needs any more.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from longrec.names import col
from longrec.operators.joins import union_missing
from longrec.operators.ordered import keep_last
from longrec.sources.reports import REPORT_KEYS
from longrec.streaming.log import Files, Folder, Log

PART, LEVEL, VERSION = "part", "level", "version"
DELTA, FULL = "delta", "full"
#: Live folders that a reader lists on the driver.
MAX_PARTS = 100_000
#: Hours that a write or a read may take before ``vacuum`` removes what it uses.
RETENTION_HOURS = 24.0


def _part(kind: str) -> Column:
    """``t`` and the type, or ``n`` for rows without one."""
    return F.when(F.col(kind).isNull(), F.lit("n")).otherwise(F.concat(F.lit("t"), F.col(kind).cast("string")))


def _rows(spark: SparkSession, store: str, folders: Sequence[Folder], max_parts: int) -> DataFrame | None:
    """The rows of some folders, with their part and version; folders of one schema are one scan."""
    if len(folders) > max_parts:
        raise ValueError(f"the store has {len(folders)} live folders, more than {max_parts}; compact it")
    by_schema: dict[str, list[str]] = {}
    for folder in folders:
        by_schema.setdefault(folder.schema, []).append(f"{store.rstrip('/')}/{folder.path}")
    frames = []
    for schema, paths in by_schema.items():
        kind = T.StructType.fromJson(json.loads(schema))
        kind = kind.add(PART, "string").add(LEVEL, "string").add(VERSION, "long")
        rows = spark.read.schema(kind).option("basePath", store).parquet(*paths)
        frames.append(rows.select(*[col(f.name) for f in kind.fields]))
    return union_missing(*frames) if frames else None


def read_store(
    spark: SparkSession, store: str, keys: Sequence[str] = REPORT_KEYS, order_by: Sequence[str] = (), max_parts: int = MAX_PARTS
) -> DataFrame | None:
    """One row per key, the last one written; ``None`` for an empty store.

    A store of more than ``max_parts`` live folders is refused, as their list comes to the driver.
    """
    rows = _rows(spark, store, Log(spark, store).state().live(), max_parts)
    return None if rows is None else keep_last(rows, keys, [VERSION, *order_by]).drop(PART, LEVEL, VERSION)


def _write(rows: DataFrame, store: str, level: str, own: int, place: int) -> list[Folder]:
    """``rows``, which have a part, in folders of the write's own; ``place`` is their version in the order."""
    spark, below = rows.sparkSession, f"write={own}/{LEVEL}={level}/{VERSION}={place}"
    rows.write.mode("overwrite").partitionBy(PART).parquet(f"{store.rstrip('/')}/{below}")
    schema = T.StructType([f for f in rows.schema.fields if f.name != PART]).json()
    named = [name for name, is_folder, _ in Files(spark, store).names(below) if is_folder and name.startswith(f"{PART}=")]
    return [Folder(f"{below}/{name}", name.removeprefix(f"{PART}="), schema, place, level == FULL) for name in named]


def _digest(rows: DataFrame) -> list[Column]:
    """Aggregates that tell batches apart by their rows, in any order."""
    columns = [col(c) for c in sorted(rows.columns)]
    hashed = [F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)") for seed in (1, 2)]
    return [F.count("*").alias("n"), *[F.sum(h).alias(f"h{i}") for i, h in enumerate(hashed)]]


def _text(values: Mapping) -> str:
    return "-".join(str(values[k]) for k in ("n", "h0", "h1"))


def upsert_batch(
    new: DataFrame,
    store: str,
    batch: int,
    keys: Sequence[str] = REPORT_KEYS,
    order_by: Sequence[str] = (),
    kind: str = "type",
    redo: bool = False,
    writer: str = "batch",
) -> None:
    """Add one batch; the same rows again under the same writer and batch change nothing.

    Other rows under a number that was used before are a batch of their own, so none is lost.  The cost is that of the
    batch, not of the store.  ``order_by`` says which of a batch's rows of one key is the last.  With ``redo`` the rows
    stored before for the batch's types are no longer valid.
    """
    if not order_by:
        raise ValueError("order_by must say which of several rows of a key is the last")
    log, last = Log(new.sparkSession, store), keep_last(new, keys, order_by)
    before = log.state().done.get(writer, {}).get(str(batch))
    if before is not None and before == _text(last.agg(*_digest(last)).first().asDict()):
        return
    version, seen = log.allocate(), Observation()
    try:
        rows = last.observe(seen, *_digest(last)).withColumn(PART, _part(kind))
        folders = _write(rows, store, FULL if redo else DELTA, version, version)
        log.publish(version, folders, writer, batch, _text(seen.get))
    except BaseException:
        log.give_up(version)
        raise


def compact(
    spark: SparkSession, store: str, version: int | None = None, keys: Sequence[str] = REPORT_KEYS, order_by: Sequence[str] = (),
    max_parts: int = MAX_PARTS,
) -> None:
    """Write what is valid up to ``version`` (where null: the newest) as full folders, and sum up the log.

    Versions from the first that another writer still works on stay as they are.
    """
    log = Log(spark, store)
    own = log.allocate()
    try:
        settled = log.settled(own)
        upto, state = max(settled if version is None else min(version, settled), log.base()), log.state()
        live = state.live(upto)
        # a part that is one full folder stays as it is
        single = {f.part for f in live if f.full} - {f.part for f in live if not f.full}
        rows, folders = _rows(spark, store, [f for f in live if f.part not in single], max_parts), []
        if rows is not None:
            last = keep_last(rows, keys, [VERSION, *order_by]).drop(LEVEL, VERSION)
            folders = _write(last, store, FULL, own, upto)
        log.publish_state(own, upto, log.upto(upto, [f for f in live if f.part in single] + folders))
    except BaseException:
        log.give_up(own)
        raise


def vacuum(spark: SparkSession, store: str, older_than_hours: float = RETENTION_HOURS) -> int:
    """Remove folders that are not live, intents, and entries that a later one sums up; how many went.

    Only what has not changed for so many hours goes, so that readers and writers at work keep theirs.
    """
    log, before = Log(spark, store), time.time() - older_than_hours * 3600
    files, gone = log.files, log.clean(older_than_hours * 3600)
    live = {f.path for f in log.state().live()}
    for write, _, _ in files.names(""):
        if not write.startswith("write="):
            continue
        found = [
            (f"{write}/{level}/{version}/{part}", changed)
            for level, _, _ in files.names(write) for version, _, _ in files.names(f"{write}/{level}")
            for part, is_folder, changed in files.names(f"{write}/{level}/{version}") if is_folder
        ]
        dead = [path for path, changed in found if path not in live and changed <= before]
        for path in dead:
            files.remove(path)
        if len(dead) == len(found) and all(changed <= before for _, changed in found) and files.changed(write) <= before:
            files.remove(write)
        gone += len(dead)
    return gone


def stream_writer(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives as long as the checkpoint folder: a new checkpoint is a new writer."""
    files = Files(spark, checkpoint)
    files.create("writer", uuid.uuid4().hex)
    return files.read("writer")


def stream_upserts(
    new: DataFrame,
    store: str,
    checkpoint: str,
    keys: Sequence[str] = REPORT_KEYS,
    order_by: Sequence[str] = (),
    kind: str = "type",
) -> StreamingQuery:
    """Add every micro-batch of a stream, then stop when the available files are done."""
    writer = stream_writer(new.sparkSession, checkpoint)
    return (
        new.writeStream.foreachBatch(lambda rows, batch: upsert_batch(rows, store, batch, keys, order_by, kind, writer=writer))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
