"""A training corpus from documents, in stages that are written and read again.

Each stage gets the documents its predecessor kept and returns the columns of documents; the
last returns the pieces of packed sequences.  The toxicity classifier learns from the labels of documents
whose crc32(doc_id) mod 3 is not 1, so the others can judge it.

Defined results: a null text counts as empty everywhere, is an exact copy of other empty ones, and is packed as the end id
alone; of repeated rows one stays; long texts are read whole; null ids and languages stay as they are; columns
beyond those of documents, whatever their names, stay up to the last stage; empty documents, labels or benchmark tables leave their
stage without effect.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from longrec.llm import decontamination, exact_dedup, ngram_join, packing, toxicity
from longrec.llm.common import cut_lineage, read_table
from longrec.llm.samples import crc32_of_id


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), learn=crc32_of_id() % 3 != 1)
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts, that with the largest id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of similar texts, that with the smallest id."""
    return ngram_join.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs, edits allowed."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: Trained models and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the rows of the last."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
