"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Each step keeps only the rows that still share their key with another row, so the next, dearer
key is needed for fewer rows.  Steps exchange narrow rows (id and digests), counts are combined
before the shuffle, and the surviving keys are written out between the steps, so that Spark can
split the joins with them where one key holds much of the table.

Defined results:

* a null text counts as empty; empty texts are equal to each other;
* of equal texts the row with the largest id stays; a null id is smaller than every other;
* rows with the same id and the same text are copies like any others: ``classify`` gives one
  row for each of them and marks exactly one as kept, ``keep_one`` returns exactly one;
* an empty table gives an empty result; ``classify`` ignores other columns, ``keep_one`` keeps
  them unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longrec.llm.common import apart_from, cut_lineage, possibly_in, text_or_empty

#: Characters of a text that the second step hashes.
PREFIX_CHARS = 256


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _keys(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int, *more: Column) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("prefix"),
        *more,
    )


def _shared(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has, as a table of their own."""
    return cut_lineage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))


def surviving_keys(keys: DataFrame) -> DataFrame:
    """(bytes, prefix) that several rows share, from the (bytes, prefix) of all rows."""
    same_length = _shared(keys, "bytes")
    return _shared(keys.join(same_length, "bytes", "left_semi"), "bytes", "prefix")


def shared_texts(full: DataFrame) -> DataFrame:
    """(bytes, prefix, sha, group_size, keep_id) of the texts that several rows have."""
    groups = full.groupBy("bytes", "prefix", "sha").agg(
        F.count(F.lit(1)).alias("group_size"), F.max("id").alias("keep_id")
    )
    return cut_lineage(groups.where("group_size > 1"))


def classify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    As every row is to carry its digest, the one scan of the texts makes all three keys and
    writes them out; the steps then refine the groups on that narrow table.  An id column named like one
    of the result gets underscores.
    """
    sha = _sha(text_or_empty(text_col)).alias("sha")
    rows = cut_lineage(_keys(docs, id_col, text_col, prefix_chars, sha))
    id_col = apart_from(id_col, ("keep_id", "group_size", "kept", "text_sha256"))
    survivors = surviving_keys(rows.select("bytes", "prefix"))
    groups = shared_texts(rows.join(survivors, ["bytes", "prefix"], "left_semi"))
    joined = rows.join(groups, ["bytes", "prefix", "sha"], "left")
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    result = joined.select(
        F.col("id").alias(id_col),
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return _one_kept(result, rows, id_col)


def _one_kept(result: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    """Only one of several rows with the same id and text is the kept one."""
    repeated = cut_lineage(
        rows.groupBy(F.col("id"), F.col("sha")).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    )
    if repeated.isEmpty():
        return result
    again = repeated.select(F.col("id").alias("rid"), F.col("sha").alias("rsha"), "times")
    same = F.col(id_col).eqNullSafe(F.col("rid")) & (F.col("text_sha256") == F.col("rsha"))
    single = result.join(again, same, "left_anti")
    groups = result.join(again, same).groupBy(id_col, "keep_id", "group_size", "kept", "text_sha256").agg(
        F.max("times").alias("times")
    )
    several = groups.select(
        id_col, "keep_id", "group_size", "kept", "text_sha256", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy")
    ).withColumn("kept", F.col("kept") & (F.col("copy") == 1))
    return single.unionByName(several.drop("copy"))


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """The rows of ``docs`` without the other copies; all columns stay.

    The first scan makes lengths and prefix hashes.  The second hashes the whole content only of
    rows that share both with another row and groups them.  In the last, rows that share nothing
    pass as they are, and only the others are joined with the decisions.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    id_name, text_name = (names[docs.columns.index(c)] for c in (id_col, text_col))
    rows = docs.toDF(*names)
    text = F.coalesce(F.col(text_name), F.lit(""))
    keys = cut_lineage(_keys(rows, id_name, text_name, prefix_chars).select("bytes", "prefix"))
    survivors = surviving_keys(keys)
    keyed = rows.withColumns(
        {"bytes": F.octet_length(text).cast("long"), "prefix": F.xxhash64(F.substring(text, 1, prefix_chars))}
    )
    hashed = possibly_in(keyed, ["bytes", "prefix"], survivors, "hit").withColumn("sha", F.when(F.col("hit"), _sha(text)))
    alike = hashed.where("hit").select(F.col(id_name).alias("id"), "bytes", "prefix", "sha")
    alike = alike.join(survivors, ["bytes", "prefix"], "left_semi")
    counted = cut_lineage(alike.groupBy("id", "sha").agg(F.count(F.lit(1)).alias("times")))
    kept = cut_lineage(
        counted.groupBy("sha").agg(F.sum("times").alias("size"), F.max(F.struct("id")).alias("top")).where("size > 1")
    )
    keep = F.col("id").eqNullSafe(F.col("top.id"))
    decided = counted.join(kept, "sha").where(~keep | (F.col("times") > 1))
    decided = decided.select(F.col("id").alias("did"), F.col("sha").alias("dsha"), keep.alias("keep"))
    same = F.col(id_name).eqNullSafe(F.col("did")) & (F.col("sha") == F.col("dsha"))
    joined = hashed.where("hit").join(cut_lineage(decided), same, "left")
    single = hashed.where("not hit").select(*names).unionByName(joined.where("dsha is null").select(*names))
    row = F.struct(*names)
    repeated = joined.where("keep").groupBy("sha").agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return single.unionByName(repeated).toDF(*docs.columns)
