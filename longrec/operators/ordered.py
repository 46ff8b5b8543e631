"""Ordered per-subject operators.

Files have an order, DataFrames do not: every function takes ``order_by``, a list of column
names sorted ascending with nulls first, which should end in a unique tiebreak.

*Long groups.*  A window runs one key in one task.  Operators that need each row's
predecessors therefore look for keys above ``split_above`` rows first, by a sketch that a chain of operators
can share (``key_sketch``).  Those rows are
range-partitioned by key and order into contiguous slices, cut off from their lineage, scanned
slice by slice and completed with one summary row per slice.  All other keys use one plain
window.  Operators that only need a winner per key are aggregates or ranked windows, which
Spark reduces on the map side, so they need no splitting.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from longrec.names import col
from longrec.session import cut_lineage

#: Keys with more rows than this are scanned in slices.
SPLIT_ABOVE = 2_000_000
#: Up to this many long keys are sent to every task as a broadcast list.
MAX_LISTED_KEYS = 10_000
#: Buckets that the rows of keys are counted in.
KEY_BUCKETS = 1 << 17

SLICE = "__slice"


def _ordering(order_by: Sequence[str]) -> list[Column]:
    if not order_by:
        raise ValueError("order_by is required: a DataFrame has no row order of its own")
    return [F.col(c).asc_nulls_first() for c in order_by]


def _descending(order_by: Sequence[str]) -> list[Column]:
    if not order_by:
        raise ValueError("order_by is required: a DataFrame has no row order of its own")
    return [F.col(c).desc_nulls_last() for c in order_by]


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality between two aliased sides: a null subject is a subject like any other."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def attach(
    df: DataFrame, per_key: DataFrame, keys: Sequence[str], columns: Sequence[str], null_keys: bool = False
) -> DataFrame:
    """Left join one row per key back to the rows.

    Unlike below a window, AQE can split the row side of a hot key here.  Rows without a key get
    nulls unless ``null_keys``; plain equality keeps the rows partitioned by the keys for what
    follows.
    """
    left, right = df.alias("rows"), per_key.alias("per_key")
    if null_keys:
        on = same_keys("rows", "per_key", keys)
    else:
        on = reduce(lambda a, b: a & b, [F.col(f"rows.`{k}`") == F.col(f"per_key.`{k}`") for k in keys])
    return left.join(right, on, "left").select("rows.*", *[F.col(f"per_key.`{c}`") for c in columns])


def earliest(column: str | Column, order_by: Sequence[str]) -> Column:
    """Aggregate: the first non-null value of ``column`` in order."""
    value = col(column) if isinstance(column, str) else column
    if len(order_by) == 1:
        # fixed-width buffers keep this a hash aggregate
        order = F.col(order_by[0])
        undated = F.min(F.when(order.isNull(), value))
        return F.coalesce(undated, F.min_by(value, F.when(value.isNotNull(), order)))
    return F.min_by(value, F.when(value.isNotNull(), F.struct(*order_by)))


def of_first_row(column: str | Column, order_by: Sequence[str]) -> Column:
    """Aggregate: the value of the first row in order, missing or not."""
    value = col(column) if isinstance(column, str) else column
    if len(order_by) == 1:
        order = F.col(order_by[0])
        undated = F.min(F.when(order.isNull(), value))
        return F.when(F.count(F.when(order.isNull(), 1)) > 0, undated).otherwise(F.min_by(value, order))
    return F.min_by(value, F.struct(*order_by))


def latest(column: str | Column, order_by: Sequence[str]) -> Column:
    """Aggregate: the last non-null value of ``column`` in order."""
    value = col(column) if isinstance(column, str) else column
    if len(order_by) == 1:
        order = F.col(order_by[0])
        undated = F.max(F.when(order.isNull(), value))
        return F.coalesce(F.max_by(value, F.when(value.isNotNull(), order)), undated)
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*order_by)))


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [col(k).isNotNull() for k in keys])


def first_valid(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order_by: Sequence[str], one_shuffle: bool = False
) -> DataFrame:
    """Replace every value of ``columns`` by the subject's first non-null one.

    Rows without a subject have no first value.  The table is read twice and joined, which Spark can split at
    a subject with very many rows; with ``one_shuffle`` it is read once, and a subject's rows meet in one task.
    """
    ordering = _ordering(order_by)
    if one_shuffle:
        whole = W.partitionBy(*keys).orderBy(*ordering).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        first = {c: F.when(_has_key(keys), F.first(col(c), ignorenulls=True).over(whole)) for c in columns}
        return df.select(*[first[c].alias(c) if c in columns else col(c) for c in df.columns])
    firsts = df.groupBy(*keys).agg(*[earliest(c, order_by).alias(f"__first_{c}") for c in columns])
    joined = attach(df, firsts, keys, [f"__first_{c}" for c in columns])
    return joined.select(*[col(f"__first_{c}").alias(c) if c in columns else col(c) for c in df.columns])


def group_size(df: DataFrame, keys: Sequence[str], name: str = "group_size", one_shuffle: bool = False) -> DataFrame:
    """Add the number of rows of the row's key; null where a key column is null.

    ``one_shuffle`` as in ``first_valid``.
    """
    if one_shuffle:
        return df.withColumn(name, F.when(_has_key(keys), F.count(F.lit(1)).over(W.partitionBy(*keys))))
    return attach(df, df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)), keys, [name])


def first_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of each key; Spark limits each key before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*_ordering(order_by)))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the last in order."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*_descending(order_by)))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= 1).drop("__rank")


# -- scans over long groups ---------------------------------------------------------------


@dataclass(frozen=True)
class KeySketch:
    """Which keys may have more than ``above`` rows: those of the listed buckets, no others.

    Rows are counted by a hash of their key into a fixed number of buckets, so the sketch costs the same whatever the number of keys.
    It holds for every table with the same rows of a key or fewer, so one sketch serves a chain of operators that
    add columns or leave rows out.
    """

    keys: tuple[str, ...]
    above: int
    buckets: tuple[int, ...]

    def suspects(self, df: DataFrame) -> DataFrame:
        """The rows of keys in the listed buckets."""
        if len(self.buckets) <= MAX_LISTED_KEYS:
            return df.where(_key_bucket(self.keys).isin(list(self.buckets)))
        listed = df.sparkSession.createDataFrame([(b,) for b in self.buckets], "__bucket long")
        return df.withColumn("__bucket", _key_bucket(self.keys)).join(F.broadcast(listed), "__bucket", "left_semi").drop("__bucket")


def _key_bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*[col(k) for k in keys]), F.lit(KEY_BUCKETS))


def key_sketch(df: DataFrame, keys: Sequence[str], above: int = SPLIT_ABOVE) -> KeySketch:
    """One count by bucket, combined before the shuffle; only full buckets come to the driver."""
    counted = df.groupBy(_key_bucket(keys).alias("__bucket")).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > above)
    return KeySketch(tuple(keys), above, tuple(sorted(r["__bucket"] for r in counted.select("__bucket").collect())))


def split_long_groups(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], split_above: int | None, sketch: KeySketch | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """``(short, sliced)``: rows of ordinary keys, and rows of long keys with a slice number.

    Slices are contiguous in (keys, order) and hold about ``split_above`` rows.  Where no key
    is long, ``short`` is ``df`` itself and the second part is ``None``.  Keys are counted exactly only where ``sketch``, or one
    that is made here, suspects them.
    """
    if split_above is None:
        return df, None
    if sketch is None or sketch.keys != tuple(keys) or sketch.above > split_above:
        sketch = key_sketch(df, keys, split_above)
    if not sketch.buckets:
        return df, None
    long_keys = sketch.suspects(df).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > split_above)
    found = long_keys.limit(MAX_LISTED_KEYS + 1).collect()
    if not found:
        return df, None
    listed = long_keys.select(*keys)
    if len(found) <= MAX_LISTED_KEYS:
        long_count = sum(r["__n"] for r in found)
        short_list = df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in found], listed.schema)
        listed = F.broadcast(short_list)
    else:
        long_count = long_keys.agg(F.sum("__n")).first()[0]
    on = same_keys("rows", "listed", keys)
    rows, listed = df.alias("rows"), listed.alias("listed")
    long_rows = rows.join(listed, on, "left_semi")
    slices = max(2, math.ceil(long_count / split_above))
    sliced = long_rows.repartitionByRange(slices, *keys, *_ordering(order_by)).withColumn(
        SLICE, F.spark_partition_id()
    )
    return rows.join(listed, on, "left_anti"), cut_lineage(sliced)


def carry_in(
    sliced: DataFrame, keys: Sequence[str], summaries: dict[str, Column], carries: dict[str, Column]
) -> DataFrame:
    """Add to each row what the earlier slices of its key hand over.

    ``summaries`` aggregates a slice; ``carries`` combines the summaries of the slices before,
    as window expressions that are given the frame "all earlier slices".
    """
    earlier = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    per_slice = (
        sliced.groupBy(*keys, SLICE)
        .agg(*[e.alias(n) for n, e in summaries.items()])
        .select(*keys, SLICE, *[e.over(earlier).alias(n) for n, e in carries.items()])
    )
    return attach(sliced, per_slice, [*keys, SLICE], list(carries), null_keys=True)


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order_by: Sequence[str],
    split_above: int | None = SPLIT_ABOVE,
    sketch: KeySketch | None = None,
) -> DataFrame:
    """Fill nulls with the last earlier value of the same subject."""
    short, sliced = split_long_groups(df, keys, order_by, split_above, sketch)
    upto = W.partitionBy(*keys).orderBy(*_ordering(order_by)).rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = short.withColumns({c: F.last(col(c), ignorenulls=True).over(upto) for c in columns})
    if sliced is None:
        return filled
    carried = carry_in(
        sliced,
        keys,
        {f"__s_{c}": latest(c, order_by) for c in columns},
        {f"__c_{c}": F.last(col(f"__s_{c}"), ignorenulls=True) for c in columns},
    )
    local = (
        W.partitionBy(*keys, SLICE).orderBy(*_ordering(order_by)).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    done = carried.withColumns(
        {c: F.coalesce(F.last(col(c), ignorenulls=True).over(local), col(f"__c_{c}")) for c in columns}
    )
    return filled.unionByName(done.select(*[col(c) for c in df.columns]))


def backward_fill(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order_by: Sequence[str],
    split_above: int | None = SPLIT_ABOVE,
    sketch: KeySketch | None = None,
) -> DataFrame:
    """Fill nulls with the next later value of the same subject.

    Read in descending order: a frame that ends at the last row would be evaluated anew for
    every row.
    """
    short, sliced = split_long_groups(df, keys, order_by, split_above, sketch)
    back = W.partitionBy(*keys).orderBy(*_descending(order_by)).rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = short.withColumns({c: F.last(col(c), ignorenulls=True).over(back) for c in columns})
    if sliced is None:
        return filled
    later = W.partitionBy(*keys).orderBy(F.col(SLICE).desc()).rowsBetween(W.unboundedPreceding, -1)
    per_slice = (
        sliced.groupBy(*keys, SLICE)
        .agg(*[earliest(c, order_by).alias(f"__s_{c}") for c in columns])
        .select(*keys, SLICE, *[F.last(col(f"__s_{c}"), ignorenulls=True).over(later).alias(f"__c_{c}") for c in columns])
    )
    carried = attach(sliced, per_slice, [*keys, SLICE], [f"__c_{c}" for c in columns], null_keys=True)
    local = (
        W.partitionBy(*keys, SLICE).orderBy(*_descending(order_by)).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    done = carried.withColumns(
        {c: F.coalesce(F.last(col(c), ignorenulls=True).over(local), col(f"__c_{c}")) for c in columns}
    )
    return filled.unionByName(done.select(*[col(c) for c in df.columns]))


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    order_by: Sequence[str],
    name: str,
    split_above: int | None = SPLIT_ABOVE,
    sketch: KeySketch | None = None,
) -> DataFrame:
    """Add the sum of ``column`` over the subject's rows *before* the current one."""
    short, sliced = split_long_groups(df, keys, order_by, split_above, sketch)
    before = W.partitionBy(*keys).orderBy(*_ordering(order_by)).rowsBetween(W.unboundedPreceding, -1)
    summed = short.withColumn(name, F.coalesce(F.sum(column).over(before), F.lit(0)))
    if sliced is None:
        return summed
    carried = carry_in(sliced, keys, {"__s": F.sum(column)}, {"__c": F.sum("__s")})
    local = W.partitionBy(*keys, SLICE).orderBy(*_ordering(order_by)).rowsBetween(W.unboundedPreceding, -1)
    done = carried.withColumn(
        name, F.coalesce(F.sum(column).over(local), F.lit(0)) + F.coalesce(F.col("__c"), F.lit(0))
    )
    return summed.unionByName(done.select(*[col(c) for c in summed.columns]))


def previous_values(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], order_by: Sequence[str], split_above: int | None = SPLIT_ABOVE,
    sketch: KeySketch | None = None,
) -> DataFrame:
    """Add, under new names, the values of the subject's row before the current one.

    ``columns`` maps columns to the names of their earlier values.  Rows are numbered slice by slice and
    joined with their successors, so one subject may hold any share of the table.  Rows without a key
    have no predecessor.
    """
    place = "__place"
    numbered = cut_lineage(running_sum(df.withColumn("__one", F.lit(1)), keys, "__one", order_by, place, split_above, sketch).drop("__one"))
    before = numbered.select(*keys, (F.col(place) + 1).alias(place), *[col(c).alias(new) for c, new in columns.items()])
    return attach(numbered, before, [*keys, place], list(columns.values())).drop(place)


def sorted_numbers(df: DataFrame, order_by: Sequence[str], name: str = "position") -> DataFrame:
    """Add the place of each row, from 1, in the order of the whole table.

    The table is sorted by ranges and written out; numbers run within a range and start where the
    ranges before it end.  Only the sizes of the ranges come together.
    """
    part, row = "__part", "__row"
    placed = df.orderBy(*_ordering(order_by)).withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()})
    placed = cut_lineage(placed)
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("__n"), F.min(row).alias("__first"))
    before = F.coalesce(F.sum("__n").over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(part, "__first", before.alias("__before"))
    number = F.col(row) - F.col("__first") + F.col("__before") + 1
    return placed.join(F.broadcast(starts), part).withColumn(name, number).drop(part, row, "__first", "__before")


def consecutive_years(
    df: DataFrame,
    keys: Sequence[str],
    year: str,
    order_by: Sequence[str],
    n: int,
    skip: int = 1,
    keep_all: bool = False,
    split_above: int | None = SPLIT_ABOVE,
    sketch: KeySketch | None = None,
) -> DataFrame:
    """Rows of runs of at least ``n`` years that are ``skip`` apart.

    A first row without a year is the subject's year-agnostic row: it is kept in front of the
    runs and counts as one of the first ``n`` rows.  Later rows without a year are dropped.
    Without ``keep_all`` only the first ``n`` of the kept rows are returned.
    """
    if n < 2:
        raise ValueError("n must be at least 2")
    short, sliced = split_long_groups(df, keys, order_by, split_above, sketch)
    kept = _year_runs(short, list(keys), year, order_by, n, skip)
    if sliced is not None:
        kept = kept.unionByName(_sliced_year_runs(sliced, list(keys), year, order_by, n, skip))
    return kept if keep_all else first_rows(kept, keys, order_by, n)


def _year_runs(df, keys, year, order_by, n, skip):
    ordered = W.partitionBy(*keys).orderBy(*_ordering(order_by))
    whole = W.partitionBy(*keys)
    marked = (
        df.withColumn("__agnostic", (F.row_number().over(ordered) == 1) & F.col(year).isNull())
        .where(F.col("__agnostic") | F.col(year).isNotNull())
        .withColumn("__before", F.lag(year).over(ordered))
        .withColumn("__break", F.coalesce(F.col(year) - F.col("__before") != skip, F.lit(True)).cast("int"))
        .withColumn("__run", F.sum("__break").over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .withColumn("__dated", F.count(year).over(whole))
    )
    sized = marked.withColumn("__size", F.count(F.lit(1)).over(W.partitionBy(*keys, "__run")))
    kept = sized.where(
        (F.col("__agnostic") & (F.col("__dated") >= n)) | (~F.col("__agnostic") & (F.col("__size") >= n))
    )
    return kept.select(*[col(c) for c in df.columns])


def _sliced_year_runs(sliced, keys, year, order_by, n, skip):
    columns = [c for c in sliced.columns if c != SLICE]
    local = W.partitionBy(*keys, SLICE).orderBy(*_ordering(order_by))
    slice_order = W.partitionBy(*keys).orderBy(SLICE)

    first_slice = sliced.groupBy(*keys).agg(F.min(SLICE).alias("__first_slice"), F.count(year).alias("__dated"))
    marked = (
        attach(sliced, first_slice, keys, ["__first_slice", "__dated"], null_keys=True)
        .withColumn(
            "__agnostic",
            (F.col(SLICE) == F.col("__first_slice"))
            & (F.row_number().over(local) == 1)
            & F.col(year).isNull(),
        )
        .where(F.col("__agnostic") | F.col(year).isNotNull())
    )
    last_years = (
        marked.groupBy(*keys, SLICE)
        .agg(latest(year, order_by).alias("__last"))
        .withColumn("__carried", F.lag("__last").over(slice_order))
    )
    broken = (
        attach(marked, last_years, [*keys, SLICE], ["__carried"], null_keys=True)
        .withColumn("__before", F.coalesce(F.lag(year).over(local), F.col("__carried")))
        .withColumn("__break", F.coalesce(F.col(year) - F.col("__before") != skip, F.lit(True)).cast("int"))
        .withColumn("__run", F.sum("__break").over(local.rowsBetween(W.unboundedPreceding, W.currentRow)))
    )
    numbered = carry_in(broken, keys, {"__s": F.sum("__break")}, {"__c": F.sum("__s")}).withColumn(
        "__run", F.col("__run") + F.coalesce(F.col("__c"), F.lit(0))
    )
    sizes = numbered.groupBy(*keys, "__run").agg(F.count(F.lit(1)).alias("__size"))
    sized = attach(numbered, sizes, [*keys, "__run"], ["__size"], null_keys=True)
    kept = sized.where(
        (F.col("__agnostic") & (F.col("__dated") >= n)) | (~F.col("__agnostic") & (F.col("__size") >= n))
    )
    return kept.select(*[col(c) for c in columns])
