"""Deletion of repeated passages of whole lines by hashes of windows of lines.

A window is the shortest run of lines with at least ``min_words`` words that begins at a line, or that ends at one.
The least line hash of each window is its fingerprint, so two equal runs of that many words
are sure to share fingerprints, wherever they stand.  Windows whose fingerprint occurs once are dropped, which only
saves work; the others are grouped by two hashes of all their lines in order, and the lines of every window but
the first of its group are deleted.  No positions are joined and no match is extended: a longer run is the union of its
overlapping windows.  In the same text a window counts as repeated only if it begins after the first one ends, so a run that
overlaps itself keeps its first copy.

Blank lines count for nothing and stay; lines are compared without blanks at their ends.
"Earlier" is the order of (id, text hash, line), null ids first.

Defined results: null texts count as empty and come back as empty; a text whose every line
is deleted comes back with its blank lines only; rows with the same id and text are one document: each
of them gets its result; texts of fewer words than ``min_words`` never change; long texts are read whole; an empty table gives
an empty result; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longrec.llm.common import cut_lineage, possibly_in, text_or_empty

DOCUMENT = ("id", "text_hash")


def _lines(rows: DataFrame) -> DataFrame:
    """(id, text_hash, pos, h, h2, words) of each line that is not blank, each once.

    Repeated rows are combined before the shuffle.
    """
    lines = rows.select(*DOCUMENT, F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("line", F.trim("line"))
    lines = lines.withColumn("words", F.regexp_count("line", F.lit(r"\S+")).cast("long")).where("words > 0")
    return lines.select(*DOCUMENT, "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2"), "words").distinct()


def _windows(lines: DataFrame, min_words: int) -> DataFrame:
    """(id, text_hash, side, f, k, k2, lines): fingerprint, content hashes and line numbers of each window."""
    in_order = Window.partitionBy(*DOCUMENT).orderBy("pos")
    lines = lines.withColumn("upto", F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    lines = lines.withColumn("before", F.col("upto") - F.col("words"))
    sides = []
    for side, order, frame in (("from", "before", (0, min_words - 1)), ("to", "upto", (1 - min_words, 0))):
        over = Window.partitionBy(*DOCUMENT).orderBy(order).rangeBetween(*frame)
        windows = lines.select(
            *DOCUMENT, F.lit(side).alias("side"), F.min("h").over(over).alias("f"), F.sum("words").over(over).alias("size"),
            F.collect_list(F.struct("pos", "h", "h2")).over(over).alias("lines"),
        ).where(F.col("size") >= min_words)
        sides.append(windows.select(
            *DOCUMENT, "side", "f", F.xxhash64(F.col("lines.h")).alias("k"), F.xxhash64(F.lit(1), F.col("lines.h2")).alias("k2"),
            F.col("lines.pos").alias("lines"),
        ))
    return cut_lineage(sides[0].unionByName(sides[1]))


def _place() -> Column:
    return F.struct(*DOCUMENT, F.col("lines")[0].alias("start"), F.element_at("lines", -1).alias("end"))


def _repeated(windows: DataFrame) -> DataFrame:
    """Windows that equal an earlier one, which does not reach into them."""
    places = windows.groupBy("f").agg(F.min(_place()).alias("low"), F.max(_place()).alias("high"))
    common = cut_lineage(places.where("low != high").select("f"))
    candidates = windows.join(common, "f", "left_semi")
    content = ["side", "k", "k2"]
    equal = candidates.groupBy(*content).agg(F.min(_place()).alias("low"), F.max(_place()).alias("high"))
    first = cut_lineage(equal.where("low != high").select(*content, "low"))
    elsewhere = ~(F.col("id").eqNullSafe(F.col("low.id")) & (F.col("text_hash") == F.col("low.text_hash")))
    apart = elsewhere | (F.col("lines")[0] > F.col("low.end"))
    return candidates.join(first, content).where((_place() > F.col("low")) & apart)


def deleted_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """(id, text_hash, deleted): the line numbers (from 0) that go, of documents that lose any."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    repeated = _repeated(_windows(_lines(rows), min_words))
    lines = repeated.select(*DOCUMENT, F.explode("lines").alias("pos")).distinct()
    return cut_lineage(lines.groupBy(*DOCUMENT).agg(F.collect_list("pos").alias("deleted")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """``docs`` with the repeated passages deleted from its texts, and ``n_deleted`` lines that went.

    ``n_deleted`` gets underscores if ``docs`` has that name already.
    """
    taken, counted = {c.lower() for c in docs.columns}, "n_deleted"
    while counted in taken:
        counted += "_"
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names)
    found = deleted_lines(rows, at[id_col], at[text_col], min_words)
    rows = rows.withColumns({"key": F.col(at[id_col]), "hash": F.xxhash64(text_or_empty(at[text_col]))})
    rows = possibly_in(rows, ["key", "hash"], found.select(*DOCUMENT), "hit")
    same = F.col("key").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash"))
    changed = rows.where("hit").join(found, same, "left")
    text = text_or_empty(at[text_col])
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("deleted"))
    cleaned = F.when(F.col("deleted").isNull(), text).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))

    def result(part: DataFrame, new_text: Column, count: Column) -> DataFrame:
        columns = [new_text.alias(text_col) if n == at[text_col] else F.col(n).alias(c) for c, n in at.items()]
        return part.select(*columns, count.alias(counted))

    same_text = result(rows.where("not hit"), text, F.lit(0))
    return same_text.union(result(changed, cleaned, F.coalesce(F.size("deleted"), F.lit(0))))
