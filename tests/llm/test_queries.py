"""Registered queries against their SQL and contracts, and the pipeline stage by stage."""

import re

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_dedup import brute_near

import __spark_entry__ as entry_points
import corpus_pipeline
from check_queries import compare, connect
from longrec.llm import exact_dedup, packing, queries, token_counts
from longrec.llm.decontamination import word_lists
from longrec.session import cut_lineage

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = set(entry_points.queries())
    assert {re.match(r"op(\d+)_", n)[1] for n in queries.QUERIES} == {str(n) for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    assert compare(spark, connect(SF), SF, name, queries.QUERIES[name], queries.ORACLES[name]) == ""


COLUMNS = {
    "op2_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
                    "sequence_id": "bigint", "offset": "bigint"},
    "op6_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
    "op12_embedding_whitening": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                 "explained": "double", "identity_error": "double"},
    "op9_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    found = dict(df.dtypes)
    assert {c: found[c] for c in COLUMNS[name]} == COLUMNS[name]
    if name == "op12_embedding_whitening":
        assert df.count() == 4 * spark.read.parquet(f"{SMALL}/embeddings.parquet").count()
        return
    ids = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert df.select("doc_id").distinct().count() == ids
    if name != "op5_packing":
        assert df.count() == ids
    if "score" in found:
        limit = 0.7 if name == "op2_toxicity" else 0.3
        wrong = ~F.col("score").between(0, 1) | (F.col("predicted") != (F.col("score") >= limit).cast("int"))
        assert df.where(wrong).count() == 0


def test_stages(spark):
    stages = [name for name, _ in corpus_pipeline.STAGES]
    assert stages == ["toxicity", "exact_dedup", "ngram_join", "decontamination", "packing"]
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    kept, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, SF))
        if name != "packing":
            assert docs.columns == documents.columns
            kept[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    everything = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    gone = set(everything) - set(kept["toxicity"])
    assert gone and len(gone - toxic) < 0.1 * len(everything)
    last_of_text = {}
    for i, text in kept["toxicity"].items():
        last_of_text[text] = max(last_of_text.get(text, i), i)
    assert set(kept["exact_dedup"]) == set(last_of_text.values())
    assert set(kept["ngram_join"]) == {i for i, _, c in brute_near(list(kept["exact_dedup"].items())) if i == c}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    needles = [" ".join(map(str, w)) for w in word_lists(pa.array(items))]
    texts = dict(zip(kept["ngram_join"], (f" {' '.join(map(str, w))} " for w in word_lists(pa.array(list(kept["ngram_join"].values())))), strict=True))
    holding = {i for i, t in texts.items() if any(f" {n} " in t for n in needles)}
    assert holding and not holding & set(kept["decontamination"])
    assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(kept["decontamination"])


def test_pipeline_on_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_ids_named_like_results(spark):
    """The id of a row keeps its name, or gets underscores where the result has a column of that name."""
    for name, run in (
        ("start", lambda df, c: packing.pack(df, public_tokenizers.path("word_bpe_49k.json"), c)),
        ("N_tokens", lambda df, c: token_counts.count_tokens(df, public_tokenizers.path("byte_bpe_50k.json"), c)),
        ("kept", lambda df, c: exact_dedup.classify(df, c)),
    ):
        docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (2, None), (None, "x")], f"{name} long, text string")
        got = run(docs, name)
        assert sorted(map(repr, (r[f"{name}_"] for r in got.collect()))) == ["1", "2", "2", "None"]
        assert len({c.lower() for c in got.columns}) == len(got.columns)


ODD = [
    (1, None, "en", None, None), (2, "", None, "x", 0), (None, "some words of a text", "de", "x", 1), (3, "long text " * 40_000, "en", "x", 5),
    (4, "a b c d e f", "fr", "y", 6), (4, "a b c d e f", "fr", "y", 6), (5, "A b c  d e f", "en", "y", 7), (6, "z " * 30, "xx", "y", 8),
]


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and columns named like those of the stages."""
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({"score": F.lit("own"), "id": F.col("doc_id"), "kept": F.lit(False), "component_id": F.lit(1)})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, k % 2, k % 2) for k in range(7)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    bench = spark.createDataFrame([(1, "z z z z z z z z z"), (2, None), (3, "")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows, gone = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = cut_lineage(stage(spark, rows, str(tmp_path)))
        assert after.columns == docs.columns
        gone[name], rows = rows.count() - after.count(), after
    # of rows 1 and 2, and of the copies 4, one stays; 5 is a near copy of 4; 6 holds the benchmark item
    assert gone["exact_dedup"] == 2 and gone["ngram_join"] == 1 and gone["decontamination"] == 1
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in rows.collect()} == {2, None, 3, 4}
