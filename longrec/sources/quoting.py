"""Records of text tables whose quoted fields hold line breaks, without giving up the splits of a file.

A line that begins outside of quotes ends either outside or inside a quoted field, and so does one that begins inside; so a line is
one of four maps on these two states, and what a line begins with follows from those before it.  The maps are composed by running sums
over the lines of a block, a piece of a split, for both states that the block may begin with; a block is one such map again, and the
maps of the blocks of a file tell which of the two it was.  So files of any length are read by many tasks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from longrec.session import broadcast_if_small, cut_lineage

#: Lines of a split whose states are composed together: a window keeps as many rows in memory.
BLOCK_LINES = 1 << 12

#: Where a row came from: ordered by these columns, rows stand as in their files.
FILE_ORDER = ["file", "file_start", "file_line"]


def ends_inside(line: Column, sep: str = ",") -> Column:
    """Whether a line that begins outside of quotes ends inside a quoted field.

    Quotes count where they begin a field; inside it two of them stand for one.  No part of the pattern is tried twice.
    """
    s = re.escape(sep)
    left = F.regexp_replace(line, f'(^|{s})"[^"]*+(?:""[^"]*+)*+"[^{s}]*+', "$1")
    begins = line.startswith('"') | line.contains(f'{sep}"')
    return F.coalesce(begins & left.rlike(f'(^|{s})"'), F.lit(False))


def whole_records(lines: DataFrame, sep: str = ",", block_lines: int | None = BLOCK_LINES) -> tuple[DataFrame, DataFrame]:
    """(records: ``FILE_ORDER`` of their first line and their text as ``line``, files whose last quote never closes).

    Records of these files are not among the first.  A record is as long as its quotes say; its lines come together.  Lines that are
    records on their own are only read.  The lines are shuffled once, by blocks, and written out with both of their states.
    """
    file, order, block = FILE_ORDER[:1], FILE_ORDER[1:], ["file", "file_start", "__block"]
    outside = ends_inside(F.col("line"), sep)
    # a line inside a field reads like one that begins with a quote
    inside = ~F.col("line").contains('"') | ends_inside(F.concat(F.lit('"'), F.col("line")), sep)
    number = F.expr(f"file_line div {block_lines}") if block_lines else F.lit(0).cast("long")
    lines = lines.select(*FILE_ORDER, number.alias("__block"), "line", outside.cast("int").alias("__out"), inside.cast("int").alias("__in"))
    own = W.partitionBy(*block).orderBy("file_line")
    upto = own.rowsBetween(W.unboundedPreceding, W.currentRow)
    states = _composed(lines, own)
    # the first line of the record that a line belongs to, unless that stands in an earlier block
    states = states.withColumns({
        f"__first{e}": F.last(F.when(F.col(f"__before{e}") == 0, F.col("file_line")), ignorenulls=True).over(upto) for e in (0, 1)
    })
    states = cut_lineage(states.select(*FILE_ORDER, "__block", "line", *[f"__{name}{e}" for name in ("before", "after", "first") for e in (0, 1)]))
    # one row for each block
    ends = {f"__{name}": F.max_by(f"__after{e}", "file_line") for name, e in (("out", 0), ("in", 1))}
    blocks = states.groupBy(*block).agg(*[e.alias(n) for n, e in ends.items()], F.max("__first0").alias("__first0"), F.max("__first1").alias("__first1"))
    in_file = W.partitionBy(*file).orderBy("file_start", "__block")
    found = _composed(blocks, in_file).withColumn("__first", F.when(F.col("__before0") == 0, F.col("__first0")).otherwise(F.col("__first1")))
    first = F.when(F.col("__first").isNotNull(), F.struct("file_start", F.col("__first").alias("file_line")))
    carried = F.last(first, ignorenulls=True).over(in_file.rowsBetween(W.unboundedPreceding, -1))
    found = cut_lineage(found.select(*block, F.col("__before0").alias("__entry"), F.col("__after0").alias("__exit"), carried.alias("__carried")))
    last = found.groupBy(*file).agg(F.max_by("__exit", F.struct("file_start", "__block")).alias("__exit"))
    unclosed = last.where("__exit = 1").select(*file)
    entries = found.join(unclosed, file, "left_anti").select(*block, "__entry", "__carried")

    def chosen(name: str) -> Column:
        return F.when(F.col("__entry") == 0, F.col(f"__{name}0")).otherwise(F.col(f"__{name}1"))

    here = F.struct("file_start", chosen("first").alias("file_line"))
    placed = states.join(broadcast_if_small(entries), block).select(
        *FILE_ORDER, "line", ((chosen("before") == 0) & (chosen("after") == 0)).alias("__alone"),
        F.when(chosen("first").isNotNull(), here).otherwise(F.col("__carried")).alias("__first"),
    )
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, "line"))), lambda x: x["line"]), "\n")
    joined = placed.where("not __alone").groupBy(*file, "__first").agg(text.alias("line"))
    joined = joined.select(*file, *[F.col(f"__first.{c}").alias(c) for c in order], "line")
    return placed.where("__alone").select(*FILE_ORDER, "line").unionByName(joined), unclosed


def _composed(rows: DataFrame, own: WindowSpec) -> DataFrame:
    """Add what stands before and after each row of its window, where the window begins outside (0) or inside (1) of a field.

    ``__out`` and ``__in`` are what a row leaves of these two states.
    """
    upto = own.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = own.rowsBetween(W.unboundedPreceding, -1)
    swaps = F.sum((F.col("__out") > F.col("__in")).cast("int"))
    rows = rows.withColumns({"__swaps": swaps.over(upto), "__swapped": F.coalesce(swaps.over(before), F.lit(0))})
    # what a row leaves whatever it began with, with the swaps up to there taken back
    fixed = F.when(F.col("__out") == F.col("__in"), (F.col("__out") + F.col("__swaps")) % 2)
    rows = rows.withColumns({"__fixed": F.last(fixed, ignorenulls=True).over(upto), "__set": F.last(fixed, ignorenulls=True).over(before)})
    states = {"after": ("__fixed", "__swaps"), "before": ("__set", "__swapped")}
    found = {f"__{n}{e}": ((F.coalesce(last, F.lit(e)) + F.col(turns)) % 2).cast("int") for n, (last, turns) in states.items() for e in (0, 1)}
    return rows.withColumns(found).drop("__swaps", "__swapped", "__fixed", "__set")
