"""Labelled texts, all of them or bounded samples, and columns of scores by a model fitted on one."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longrec.llm.common import possibly_in, ship, text_or_empty
from longrec.llm.words import passes

#: A text above this part of a sample's bytes is not taken, so a few long texts are not the whole sample.
LARGEST_SHARE = 1 / 4


def labelled_rows(
    docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(place, label 0 or 1, text, lang) of every row of ``docs`` with a label; ``place`` is a hash of id and text.

    Labels are left out and combined as in ``labelled_sample``.  Texts without a label stay out of the shuffle.
    """
    own_id = F.col(id_col).cast(docs.schema[id_col].dataType).alias("sample_id")
    labelled = labels.where(learn & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    labelled = labelled.groupBy(own_id).agg((F.max(label_col) > 0).cast("int").alias("label")).where("sample_id is not null")
    rows = docs.select(F.col(id_col).alias("sample_id"), text_or_empty(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = possibly_in(rows, ["sample_id"], labelled.select("sample_id"), "hit").where("hit").drop("hit")
    return rows.join(labelled, "sample_id").select(F.xxhash64("sample_id", "text").alias("place"), "label", "text", "lang")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, learn: Column, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str | None = None, max_rows: int = 10_000, max_bytes: int = 64 << 20,
) -> pa.Table:
    """(label, text, lang) of at most ``max_rows`` rows and ``max_bytes`` of text, on the driver.

    Of the labelled ids that ``docs`` has, those with the smallest hashes are taken, so a rerun takes the same.  They are chosen by the
    lengths of their texts, which are read for the chosen only.  A text above ``LARGEST_SHARE`` of ``max_bytes``
    is left out, one that does not fit any more is skipped, and the next are tried.  Rows where
    ``learn`` does not hold, and those with a null id or label, are left out too; of several labels of
    one id the largest counts.
    """
    ids = F.col("sample_id")
    labelled = (
        labels.where(learn & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("sample_id"))
        .agg(F.max(label_col).cast("int").alias("label"))
    )
    present = docs.select(F.col(id_col).alias("sample_id")).join(labelled, "sample_id").groupBy("sample_id").agg(F.max("label").alias("label"))
    chosen = present.orderBy(F.xxhash64(ids), ids).limit(max_rows)
    lang = F.col(lang_col) if lang_col else F.lit(None)
    rows = docs.select(F.col(id_col).alias("sample_id"), text_or_empty(text_col).alias("text"), lang.cast("string").alias("lang"))
    # at most max_rows narrow rows
    rows = rows.join(F.broadcast(chosen), "sample_id").where(F.octet_length("text") <= int(max_bytes * LARGEST_SHARE))
    rows = rows.withColumn("row_hash", F.xxhash64("text", "lang"))
    narrow = rows.groupBy("sample_id", "row_hash").agg(F.max(F.octet_length("text")).alias("bytes"), F.count("*").alias("copies"))
    left, room, taken, copies = max_rows, max_bytes, [], {}
    for row in narrow.orderBy(F.xxhash64(ids), ids, "row_hash").limit(max_rows).collect():
        fitting = min(row["copies"], left, room // max(row["bytes"], 1))
        if fitting:
            left, room = left - fitting, room - fitting * row["bytes"]
            taken.append((row["sample_id"], row["row_hash"], len(taken)))
            copies[len(taken) - 1] = fitting
    id_type = rows.schema["sample_id"].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame(taken, f"sample_id {id_type}, row_hash long, place int")
    texts = rows.join(F.broadcast(wanted), ["sample_id", "row_hash"]).dropDuplicates(["place"])
    table = texts.select("place", "label", "text", "lang").toArrow().sort_by("place")
    repeated = np.repeat(np.arange(table.num_rows), [copies[p] for p in table["place"].to_pylist()])
    return table.drop_columns(["place"]).take(pa.array(repeated, pa.int64()))


def score_column(docs: DataFrame, model, text_col: str = "text") -> Column:
    """The model's score of each whole text (null texts count as empty), 0 to 1."""
    ship(docs.sparkSession)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        scores = np.zeros(len(texts))
        for first, end, data, offsets in passes(texts):
            scores[first:end] = model.scores(data, offsets)
        return pa.array(scores)

    return score(text_or_empty(text_col))


def crc32_of_id(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary"))
