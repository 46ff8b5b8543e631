"""Benchmark passages in documents against the exact edit distance of all windows."""

import pickle

import numpy as np
import pyarrow as pa
import pytest

from longrec.llm import decontamination as deco
from longrec.llm.words import passes


def words_of(rng, n, vocabulary=400):
    return [f"w{i}" for i in rng.zipf(1.3, n) % vocabulary]


def brute(text, item, most):
    """The least distance of an item to a run of the text, and whether it is near enough."""
    a, b = deco.word_lists(pa.array([item, text]))
    row = np.zeros(len(b) + 1, int)
    for i, w in enumerate(a, 1):
        new = np.concatenate([[i], np.minimum(row[:-1] + (b != w), row[1:] + 1)])
        row = np.minimum.accumulate(new - np.arange(len(b) + 1)) + np.arange(len(b) + 1)
    return int(row.min()) if row.min() <= most else None


def planted(seed=5, items=30):
    rng = np.random.default_rng(seed)
    bench = [" ".join(words_of(rng, int(rng.integers(8, 60)))) for _ in range(items)]
    docs = []
    for k in range(90):
        body = words_of(rng, int(rng.integers(0, 150)))
        if k % 3:
            own = bench[k % items].split()
            for _ in range(int(len(own) * 0.2 * (k % 4) / 3)):
                at = int(rng.integers(len(own)))
                own[at : at + 1] = [["new%d" % k], [], ["new%d" % k, own[at]]][int(rng.integers(3))]
            at = int(rng.integers(len(body) + 1))
            body[at:at] = own
        docs.append(" ".join(body))
    return bench, docs


def frames(spark, bench, docs):
    d = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(docs)], "doc_id long, text string, item string, distance int")
    return d, spark.createDataFrame([(100 + k, t, "x") for k, t in enumerate(bench)], "item_id long, text string, doc_id string")


def test_recall_and_exactness(spark):
    bench, docs = planted()
    d, b = frames(spark, bench, docs)
    got = {(r.doc_id, r.item_id): r.distance for r in deco.matches(d, b).collect()}
    near = {}
    for k, text in enumerate(docs):
        for j, item in enumerate(bench):
            distance = brute(text, item, int(len(item.split()) * 0.2 + 1e-9))
            if distance is not None:
                near[(k, 100 + j)] = distance
    assert set(got) <= set(near) and len(near) > 50
    assert len(got) >= 0.95 * len(near)
    assert all(got[pair] >= near[pair] for pair in got)
    assert sum(got[p] == near[p] for p in got) >= 0.95 * len(got)
    kept = deco.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {doc for doc, _ in got}


def test_blocks_give_the_same(spark, monkeypatch):
    bench, docs = planted(items=12)
    d, b = frames(spark, bench, docs)
    whole = {(r.doc_id, r.item_id) for r in deco.matches(d, b, target_recall=0.99).where("distance = 0").collect()}
    monkeypatch.setattr(deco, "BLOCK_WORDS", 100)
    assert {(r.doc_id, r.item_id) for r in deco.matches(d, b, target_recall=0.99).where("distance = 0").collect()} == whole


def test_blocks_drop_the_same(spark, monkeypatch):
    bench, docs = planted(items=12)
    d, b = frames(spark, bench, docs + [None])
    whole = {r.doc_id for r in deco.drop_contaminated(d, b, max_edit_share=0.0).collect()}
    monkeypatch.setattr(deco, "BLOCK_WORDS", 100)
    kept = deco.drop_contaminated(d, b, max_edit_share=0.0)
    assert kept.columns == d.columns and 0 < len(whole) < len(docs)
    assert {r.doc_id for r in kept.collect()} == whole


def test_an_index_is_as_large_as_its_words():
    items = [np.arange(20 * k + 1, 20 * k + 21, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for k in range(3_000)]
    index = deco.ItemIndex(items, 0.0, 0.95, 5, 3)
    assert sum(len(pickle.dumps(x)) for x in vars(index).values()) < 100 * 20 * len(items)


ITEM = "One, two three FOUR five six séven eight nine ten"


def test_edges(spark):
    docs = [
        (1, f"before {ITEM.upper()} after"), (2, None), (3, ""), (None, ITEM), (4, "one two"), (4, f"{ITEM} {ITEM}"), (5, "one two three four"),
        (6, "filler " * 50_000 + ITEM), (7, ITEM.replace("five", "5").replace("nine", "")),
    ]
    items = [(1, ITEM), (None, ITEM), (2, None), (3, ""), (4, "too short"), (1, ITEM)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in deco.matches(d, b).collect()), key=repr)
    ids = {1: 1, None: 0, 4: 0, 6: 50_000}
    wanted = [(i, j, 0, 10, at) for i, at in ids.items() for j in (1, 1, None)] + [(7, j, 2, 10, 0) for j in (1, 1, None)]
    assert got == sorted(wanted, key=repr)
    assert deco.matches(d.limit(0), b).count() == 0 and deco.matches(d, b.limit(0)).count() == 0
    assert deco.drop_contaminated(d, b.limit(0)).count() == len(docs)


@pytest.mark.parametrize("pass_bytes", [64, 1 << 21])
def test_windows_stay_in_their_text(monkeypatch, pass_bytes):
    monkeypatch.setattr(deco, "PASS_BYTES", pass_bytes)
    index = deco.ItemIndex(deco.word_lists(pa.array([ITEM])), 0.0, 0.95, 5, 3)
    half = ITEM.split()
    texts = [" ".join(half[:5]), " ".join(half[5:]), ITEM]
    found = [first + t for first, _, data, offsets in passes(pa.array(texts), pass_bytes) for t in index.find(data, offsets)[0]]
    assert found == [2]


def test_short_items_and_scripts_without_blanks(spark):
    chinese, thai = "\u4eca\u5929\u5929\u6c14\u5f88\u597d\u6211\u4eec\u53bb\u516c\u56ed", "\u0e2a\u0e27\u0e31\u0e2a\u0e14\u0e35\u0e0a\u0e32\u0e27\u0e42\u0e25\u0e01"
    items = [(1, chinese), (2, thai), (3, "Forty-two"), (4, "one \u201ctwo\u201d\u2014three four\u2026five"), (5, "\u3002 \u2014"), (6, "a b c d")]
    docs = [
        (1, f"\u6211\u8bf4{chinese}\u3002\u597d"), (2, f"abc{chinese.replace(chinese[4], '')}abc"), (3, chinese[:5]), (4, f"x {thai}\u0e01"), (5, "is forty two."),
        (6, "forty twos, fortytwo, forty, two"), (7, "one two three four five"), (8, "a b c x d"), (9, "z A, b; c d"), (10, "\u3002 \u2014"),
    ]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.distance, r.item_words) for r in deco.matches(d, b, target_recall=0.99).collect()}
    assert got == {
        (1, 1): (0, 11), (2, 1): (1, 11), (4, 2): (0, len(thai)), (5, 3): (0, 2), (6, 3): (0, 2), (7, 4): (0, 5), (9, 6): (0, 4),
    }
    assert {r.doc_id for r in deco.drop_contaminated(d, b, target_recall=0.99).collect()} == {3, 8, 10}


def test_words_alike_to_polynomials(spark):
    """Words that collide under polynomials modulo powers of two are different words."""
    def word(n, a, b):
        return "".join(a if bin(k).count("1") % 2 == 0 else b for k in range(n))

    one, other = ([word(n, *signs) for n in (1024, 2048, 1024, 2048, 4096)] for signs in ("ab", "ba"))
    d, b = frames(spark, [" ".join(one)], [" ".join(one), " ".join(other), " ".join(one[:4])])
    assert [(r.doc_id, r.item_id, r.distance) for r in deco.matches(d, b).orderBy("doc_id").collect()] == [(0, 100, 0), (2, 100, 1)]


def test_target_out_of_reach(monkeypatch):
    monkeypatch.setattr(deco, "PLANS", ((3, 1),))
    with pytest.raises(ValueError, match="no plan"):
        deco.plan_walks(30, 6, 0.95, 1)
