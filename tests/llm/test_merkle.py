"""The manifest against a direct construction of the trees."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from longrec.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(leaves, fanout):
    """(root, the siblings (left, right) of each leaf on its way up)."""
    proofs, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            first = place - place % fanout
            proofs[k].append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + fanout])))
        nodes = [digest("".join(nodes[k : k + fanout])) for k in range(0, len(nodes), fanout)]
        at = [place // fanout for place in at]
    return nodes[0], proofs


def brute(rows, fanout):
    """(id, leaf, subroot, root, proof) of rows (id, part, text)."""
    parts = defaultdict(list)
    for row in rows:
        parts[row[1]].append((row[0] is not None, row[0] or 0, leaf_of(row), row[0]))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {p: climb([r[2] for r in sorted(parts[p], key=lambda r: r[:3])], fanout) for p in names}
    root, tops = climb([trees[p][0] for p in names], fanout)
    result = []
    for p, top in zip(names, tops, strict=True):
        for row, proof in zip(sorted(parts[p], key=lambda r: r[:3]), trees[p][1], strict=True):
            result.append((row[3], row[2], trees[p][0], root, tuple(proof + top)))
    return sorted(result, key=repr)


def build(spark, rows, fanout, block_levels, partitions=5):
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, leaf string").repartition(partitions)
    leaf = merkle.record_hash(["doc_id", "source", "text"])
    return merkle.manifest(docs, "source", ["doc_id"], leaf, ["doc_id"], fanout, block_levels)


def plain(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.proof))) for r in df.collect()), key=repr)


ODD = [
    (None, "a", "x"), (None, "a", None), (1, None, ""), (1, None, ""), (2, None, "long " * 50_000), (3, "", "é"), (3, "", "É"), (4, "é", "z"), (5, "z", "z"),
    (5, "Z", "-"), (5, "a", "3:abc"),
]


@pytest.mark.parametrize(("fanout", "levels", "sizes"), [(2, 1, (1, 2, 3, 37)), (2, 2, (4, 5, 21)), (3, 1, (29, 3, 9)), (4, 2, (70, 16, 17)), (16, 2, (300, 16, 15))])
def test_trees(spark, fanout, levels, sizes):
    rows = ODD + [(k * 7 % n, f"part{p}", f"text {k}") for p, n in enumerate(sizes) for k in range(n)]
    got = build(spark, rows, fanout, levels)
    assert plain(got) == brute(rows, fanout)
    again = got.select(merkle.fold(F.col("leaf"), F.col("proof")).alias("up"), "root", merkle.proof_digest(F.col("proof")).alias("proof_hash"), "proof")
    for row in again.collect():
        assert row["up"] == row["root"]
        assert row["proof_hash"] == digest("".join(s["left"] + s["right"] for s in row["proof"]))


def test_rows_that_are_alike(spark):
    rows = [(7, "a", "same")] * 90 + [(1, "b", "other")]
    assert plain(build(spark, rows, 2, 2, 8)) == brute(rows, 2)


def test_many_parts(spark):
    rows = [(1, f"part {k}", str(k)) for k in range(40)]
    assert plain(build(spark, rows, 2, 1)) == brute(rows, 2)


def test_small_tables(spark):
    assert build(spark, ODD, 16, 2).limit(0).count() == 0 and build(spark, ODD[:1], 16, 2).head().proof == []
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert merkle.manifest(empty, "source", ["doc_id"], merkle.record_hash(["text"]), ["doc_id"]).count() == 0
    with pytest.raises(ValueError, match="carry"):
        merkle.manifest(empty, "source", ["doc_id"], merkle.record_hash(["text"]), ["Leaf"])


def test_a_changed_row_leads_elsewhere(spark):
    row = build(spark, ODD, 2, 1).where("doc_id = 4").select(merkle.fold(F.lit(digest("other")), F.col("proof")).alias("up"), "root").head()
    assert row["up"] != row["root"]
