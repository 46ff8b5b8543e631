"""Whitening directions of embeddings, by QR of blocks of centred rows and a bidiagonal solver.

Entries become whole numbers, floor(scale * entry), so that counts, sums and deviations are exact.  The directions are fitted on
each distinct vector once: blocks of centred rows are reduced to triangles by QR, ``MERGE`` triangles at a time until one is left, which
needs no more memory than a block and ``MERGE`` triangles; Householder reflections, dqds and twisted
factorisations (``bidiagonal``) take its singular values and right singular vectors, on the driver, whose work depends on the
dimension only.  The covariance itself is never formed.

Rows of one vector are combined before the shuffle that makes the vectors distinct, so copies meet as one row of each task.

Defined results: rows are left out whose vector is null, holds null or non-finite entries or such that pass the range of whole numbers,
or has another length than most vectors (of equally frequent lengths the greatest); ids may be null or repeat, and each remaining row has its own
result; components without variance are left out, so equal vectors only, or no vectors, give an empty result; of components with the
same variance any orthonormal directions are given, the same for all rows; a sum of squares beyond the range of a long is null; long vectors cost
the square of their length on the driver; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from longrec.llm import bidiagonal
from longrec.llm.common import cut_lineage, ship

#: Triangles that one task of a merge stacks.
MERGE = 16
#: Rows that one QR stacks.
BLOCK_ROWS = 2_000
#: Components with less than this part of the greatest variance have none: it is the rounding of the blocks.
NO_VARIANCE = 1e-24
WIDTHS = (("short", np.int16, pa.int16()), ("int", np.int32, pa.int32()), ("long", np.int64, pa.int64()))
LONG = 1 << 63


def whole_numbers(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x of all entries, first entry of each row, length of each row: -1 where the vector does not count)."""
    offsets = np.frombuffer(vectors.buffers()[1], np.int32)[vectors.offset : vectors.offset + len(vectors) + 1].astype(np.int64)
    body = vectors.values.cast(pa.float64())
    entries = body.to_numpy(zero_copy_only=False)  # nulls become NaN
    with np.errstate(invalid="ignore", over="ignore"):
        x = np.floor(entries * scale)
        wrong = ~(np.abs(x) < LONG)
    bad = np.concatenate([[0], np.cumsum(wrong)])
    missing = vectors.is_null().to_numpy(zero_copy_only=False) | (bad[offsets[1:]] > bad[offsets[:-1]])
    return np.where(wrong, 0, x).astype(np.int64), offsets[:-1], np.where(missing, -1, np.diff(offsets))


def _rows(vectors: pa.Array, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows that count, their x as a matrix)."""
    x, first, length = whole_numbers(vectors, scale)
    rows = np.flatnonzero(length == dim)
    return rows, x[first[rows][:, None] + np.arange(dim)]


@dataclass
class Whitening:
    """What fitting found: n, S, the variances e and unit directions of the components, and their trace."""

    dim: int
    scale: float
    n: int
    sums: list[int]
    variances: np.ndarray
    directions: np.ndarray  # dim x components
    trace: float
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n in double precision; whole numbers are subtracted first."""
        return self._scaled(x).astype(np.float64) / self.n

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        """n*x - S: exact, as Python's whole numbers where a long might not do."""
        most = int(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.sums), default=0)
        if most * most * self.dim < LONG:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def deviations(self, x: np.ndarray) -> pa.Array:
        squares = (self._scaled(x) ** 2).sum(axis=1)
        return pa.array([v if v < LONG else None for v in squares.tolist()], pa.int64())

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.directions / np.sqrt(self.variances)


def _profile(vectors: DataFrame, scale: float) -> tuple[int, int, int]:
    """(length of most vectors, how many have it, their greatest absolute entry)."""

    def run(batches):
        for batch in batches:
            x, first, length = whole_numbers(batch.column(0), scale)
            size = np.abs(x)
            most = [int(size[f : f + n].max(initial=0)) for f, n in zip(first.tolist(), length.tolist(), strict=True)]
            keep = length >= 0
            yield pa.RecordBatch.from_arrays([pa.array(length[keep]), pa.array(np.array(most, np.int64)[keep])], ["length", "most"])

    found = vectors.mapInArrow(run, "length long, most long")
    row = found.groupBy("length").agg(F.count("*").alias("n"), F.max("most").alias("most")).orderBy(F.desc("n"), F.desc("length")).head()
    return (row["length"], row["n"], row["most"]) if row else (0, 0, 0)


def _distinct(vectors: DataFrame, dim: int, most: int, scale: float) -> DataFrame:
    """Each distinct vector once, in the narrowest whole numbers that hold all entries."""
    name, kind, arrow = next(w for w in WIDTHS if most < 1 << (8 * w[1]().itemsize - 1))

    def run(batches):
        for batch in batches:
            _, x = _rows(batch.column(0), dim, scale)
            flat = pa.array(x.astype(kind).ravel(), arrow)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * dim, pa.int32()), flat)], ["x"])

    return cut_lineage(vectors.mapInArrow(run, f"x array<{name}>").distinct())


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim).astype(np.int64)


def _totals(fit_rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(n, sums of the dimensions), exact: tasks add up to a bound, Spark adds the parts as decimals."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(0), dim)
            exact = x.sum(axis=0) if int(np.abs(x).max(initial=0)) * len(x) < LONG else x.astype(object).sum(axis=0)
            high, low = zip(*(divmod(int(v), 1 << 32) for v in exact), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, dim), pa.int32()), pa.array([len(x), *low], pa.int64()), pa.array([0, *high], pa.int64())],
                ["place", "low", "high"],
            )

    total = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("low", "high")]
    parts = {r["place"]: int(r["high"]) * (1 << 32) + int(r["low"]) for r in fit_rows.mapInArrow(run, "place int, low long, high long").groupBy("place").agg(*total).collect()}
    return parts.get(-1, 0), [parts.get(k, 0) for k in range(dim)]


def _triangle(fit_rows: DataFrame, model: Whitening) -> np.ndarray:
    """R of all centred rows, by QR of blocks and of the triangles of ``MERGE`` tasks at a time."""
    dim, schema = model.dim, "task long, triangle array<double>"

    def record(task: int, r: np.ndarray) -> pa.Table:
        flat = np.zeros((dim, dim))
        flat[: len(r)] = r
        return pa.table({"task": pa.array([task], pa.int64()), "triangle": pa.array([flat.ravel()], pa.list_(pa.float64()))})

    def reduce_rows(batches):
        r, waiting = np.zeros((0, dim)), []
        for batch in batches:
            waiting.append(model.centred(_matrix(batch.column(0), dim)))
            if sum(map(len, waiting)) >= BLOCK_ROWS:
                r, waiting = np.linalg.qr(np.concatenate([r, *waiting]), mode="r"), []
        r = np.linalg.qr(np.concatenate([r, *waiting, np.zeros((1, dim))]), mode="r")
        yield from record(TaskContext.get().partitionId() // MERGE, r).to_batches()

    def merge(key, table):
        stacked = np.array(table.column("triangle").to_pylist(), np.float64).reshape(-1, dim)
        return record(key[0].as_py() // MERGE, np.linalg.qr(stacked, mode="r"))

    triangles = cut_lineage(fit_rows.mapInArrow(reduce_rows, schema))
    while triangles.count() > 1:
        triangles = cut_lineage(triangles.groupBy("task").applyInArrow(merge, schema))
    row = triangles.head()
    return np.array(row["triangle"]).reshape(dim, dim) if row else np.zeros((dim, dim))


def _identity_error(fit_rows: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity; means are taken off first."""
    dim, k = model.dim, len(model.variances)
    if not k:
        return 0.0

    def add_up(function, size):
        def run(batches):
            total = np.zeros(size)
            for batch in batches:
                total += function(model.whiten(_matrix(batch.column(0), dim)))
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["place", "total"])

        sums = fit_rows.mapInArrow(run, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
        return np.array([r["total"] for r in sums.orderBy("place").collect()])

    mean = add_up(lambda w: w.sum(axis=0), k) / model.n
    moments = add_up(lambda w: ((w - mean).T @ (w - mean)).ravel(), k * k).reshape(k, k) / model.n
    return float(np.abs(moments - np.eye(k)).max())


def fit(rows: DataFrame, vector_col: str = "embedding", components: int | None = None, scale: float = 256.0) -> Whitening:
    """Directions of the ``components`` largest variances (all where null)."""
    ship(rows.sparkSession)
    vectors = rows.select(F.col(vector_col).alias("vector"))
    dim, counted, most = _profile(vectors, scale)
    if not counted or not dim:
        return Whitening(0, scale, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    fit_rows = _distinct(vectors, dim, most, scale)
    n, sums = _totals(fit_rows, dim)
    model = Whitening(dim, scale, n, sums, np.zeros(0), np.zeros((dim, 0)), 0.0)
    squares, directions = bidiagonal.singular(_triangle(fit_rows, model), components)
    variances = squares / n
    some = int((variances[: directions.shape[1]] > NO_VARIANCE * variances[0]).sum())
    model.variances, model.directions, model.trace = variances[:some], directions[:, :some], float(variances.sum())
    model.identity_error = _identity_error(fit_rows, model)
    return model


def whiten(rows: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, deviation, whitened: an array with a number for each component) of the rows that count.

    ``deviation`` is the exact sum of (n*x - S) squared.
    """
    ship(rows.sparkSession)
    narrow = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    kind = to_arrow_type(narrow.schema["id"].dataType)

    def run(batches):
        for batch in batches:
            keep, x = _rows(batch.column("vector"), model.dim, model.scale)
            flat = model.whiten(x)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * flat.shape[1], pa.int32()), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(keep)).cast(kind), model.deviations(x), lists], ["id", "deviation", "whitened"])

    schema = f"id {narrow.schema['id'].dataType.simpleString()}, deviation long, whitened array<double>"
    if not model.n or not len(model.variances):
        return rows.sparkSession.createDataFrame([], schema)
    return narrow.mapInArrow(run, schema)


def whitened_rows(rows: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error."""
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.variances)) if len(model.variances) else F.lit(None).cast("array<double>")
    spread = whiten(rows, model, id_col, vector_col).select("id", "deviation", F.posexplode("whitened").alias("place", "value"))
    return spread.select(
        F.col("id").alias(id_col), (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        F.col("value").alias("whitened"), F.get(explained, F.col("place")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
