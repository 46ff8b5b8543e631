"""Token counts and packing against the tokenizers on whole texts."""

import json
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from longrec.llm import packing, token_counts, tokens, words

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"
EDGE = [
    (1, "a b c"), (2, None), (2, ""), (None, "hello <|endoftext|> wörld " * 3), (3, "x y " * 50_000), (4, "abcd" * 50_000),
    (5, "It's  THE end.\n\n\tİİ é ΑΣ ok., a.b ... <|EndOfText|>"), (5, "tail "), (6, " ́x"), (7, "1,234.5 don't."),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, id string, task int")


def whole(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(list(texts), add_special_tokens=False)]


def encode(encoder, texts):
    return [x.tolist() for _, _, data, offsets in words.passes(pa.array(texts, pa.string())) for x in encoder.encode(data, offsets, 2)]


def rows_of(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return EDGE + [(r.doc_id + 100, r.text) for r in docs.limit(400).collect()]


def test_counts(spark):
    rows = rows_of(spark)
    got = token_counts.count_tokens(frame(spark, rows), BYTES, limit=20).collect()
    wanted = [(i, len((t or "").encode()), len(ids), len(ids) > 20) for (i, t), ids in zip(rows, whole(BYTES, [t or "" for _, t in rows]), strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_counts_empty(spark):
    assert token_counts.count_tokens(frame(spark, EDGE).limit(0), BYTES).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .,'\n\t  é1<|>", max_size=60), st.integers(1, 12))
def test_split_is_safe(text, size):
    pieces = list(tokens.split_safely(text, size))
    assert "".join(pieces) == text
    assert sum(whole(BYTES, pieces), []) == whole(BYTES, [text])[0]


def test_words_are_encoded_once(monkeypatch, tmp_path):
    own = tmp_path / "own.json"
    with open(BYTES) as file:
        own.write_text(file.read())
    tokenizer, encoded = Tokenizer.from_file(str(own)), []

    class Recorder:
        def to_str(self):
            return tokenizer.to_str()

        def encode_batch_fast(self, texts, add_special_tokens):
            encoded.extend(texts)
            return tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    monkeypatch.setattr(tokens, "load", lambda path: Recorder())
    order = random.Random(3)
    texts = [" ".join(order.choices([f"word{k}" for k in range(50)] + ["été.", "fin,\n", "Ende"], k=400)) for _ in range(20)]
    counts = [token_counts._counts(iter(texts), str(own), len(texts)).tolist() for _ in range(2)]
    assert counts == [[len(ids) for ids in whole(BYTES, texts)]] * 2
    assert 0 < sum(map(len, encoded)) < sum(map(len, texts)) / 20


ODD = "aZéÿß.,'-_(<|>*09 \n\t\r\x0b\x1c\x85\xa0\u3000\u2009\u200b\u0301ªµ×÷中ا한😀"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*ODD, "'s", "'ll", "<|endoftext|>", "  ", "the", "don't"]), max_size=20).map("".join), max_size=4))
def test_run_lengths(texts):
    tokenizer = tokens.load(BYTES)
    wanted = [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    assert tokens.run_lengths(BYTES).count(texts) == list(map(len, wanted))
    for text, ids in zip(texts, wanted, strict=True):
        runs = tokens._RUNS.findall(text)
        assert "".join(runs) == text and [i for run in runs for i in tokenizer.encode(run, add_special_tokens=False).ids] == ids


def test_run_lengths_after_forgetting(monkeypatch):
    monkeypatch.setattr(tokens, "GENERATION_BYTES", 20_000)
    lengths = tokens.RunLengths(BYTES)
    for k in range(12):
        texts = [f"plain words, word{j} number {j * k}. {'long' * 40 * j}" for j in range(40)] + ["", "plain"]
        assert lengths.count(texts) == [len(ids) for ids in whole(BYTES, texts)]
        assert lengths.nbytes <= 20_000 and max(map(len, lengths._recent | lengths._before)) <= tokens.LONGEST_RUN


@pytest.mark.parametrize("change", [
    lambda described: described["pre_tokenizer"].update(add_prefix_space=True),
    lambda described: described["pre_tokenizer"].update(use_regex=False),
    lambda described: described["added_tokens"][0].update(content="two words"),
    lambda described: described["added_tokens"][0].update(content="ends."),
    lambda described: described["added_tokens"][0].update(rstrip=True),
    lambda described: described.update(normalizer={"type": "Replace", "pattern": {"String": "s\n"}, "content": "z"}),
])
def test_run_lengths_of_other_tokenizers(tmp_path, change):
    with open(BYTES) as file:
        described = json.load(file)
    change(described)
    own = tmp_path / "own.json"
    own.write_text(json.dumps(described))
    texts = ["two words\nends.\nand two words, ends.", "\nwords\n\n<|endoftext|> \n after", "that ends. "]
    assert tokens.RunLengths(str(own)).count(texts) == [len(ids) for ids in whole(str(own), texts)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aAbIİΣςé̇ .,'!\n\t é1sdt", max_size=60))
def test_word_ids(text):
    assert encode(tokens.word_ids(WORDS), [text, "", text]) == [x + [2] for x in whole(WORDS, [text, "", text])]


def test_word_ids_after_forgetting(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", 2_000)
    encoder = tokens.WordIds(WORDS)
    for k in range(8):
        texts = [f"word{j} number {j * k}, and more. plain words" for j in range(40)]
        assert encode(encoder, texts) == [x + [2] for x in whole(WORDS, texts)]
    assert encoder.nbytes < 20_000


def thue_morse(length, first="a", second="b"):
    """Texts of this kind collide under polynomials modulo powers of two."""
    return "".join(first if bin(k).count("1") % 2 == 0 else second for k in range(length))


def test_words_alike_to_polynomials(spark):
    pairs = [thue_morse(n, *signs) for n in (64, 1024, 2048) for signs in ("ab", "ba")]
    for _, _, data, offsets in words.passes(pa.array([" ".join(pairs)])):
        own = words.Words(data, offsets, words.SPACES)
        assert len(set(own.hashes.tolist())) == len(set(own.check_hash(own.starts, own.ends).tolist())) == len(pairs)
    rows = list(enumerate(pairs))
    check_packing(packing.pack(frame(spark, rows).coalesce(1), WORDS).collect(), rows, 4096)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAbé ", max_size=150), max_size=6))
def test_hashes_of_words(texts):
    """Equal for equal lower-cased words, whatever their length and place; else different."""
    seen = {}
    for _, _, data, offsets in words.passes(pa.array(texts, pa.string())):
        own = words.Words(data, offsets, words.SPACES, latin=False)
        body = data.tobytes().lower()
        for a, b, first, second in zip(own.starts, own.ends, own.hashes, own.check_hash(own.starts, own.ends), strict=True):
            assert seen.setdefault(body[a:b], (first, second)) == (first, second)
    assert len({h for h, _ in seen.values()}) == len({h for _, h in seen.values()}) == len(seen)


def test_word_ids_of_one_hash(monkeypatch):
    """Runs that share their first hash are told apart by the second."""
    monkeypatch.setattr(words.Words, "span_hash", lambda self, a, b: ((b - a) % 3).astype(np.uint64))
    texts = ["one two three four", "six seven, two. one ten", "one two"]
    encoder = tokens.WordIds(WORDS)
    assert encode(encoder, texts[:1]) == [whole(WORDS, texts[:1])[0] + [2]]
    assert encode(encoder, texts[2:]) == [whole(WORDS, texts[2:])[0] + [2]]


def check_packing(got, rows, capacity):
    wanted = defaultdict(list)
    for (i, _), ids in zip(rows, whole(WORDS, [t or "" for _, t in rows]), strict=True):
        wanted[i].append(np.array(ids + [2], "<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(wanted)
    for doc, own in wanted.items():
        sizes = sorted(len(x) for x in own)
        assert sum(r.length for r in pieces[doc]) == sum(sizes) and {r.doc_tokens for r in pieces[doc]} == set(sizes)
        if len(own) == 1:
            at = 0
            for r in sorted(pieces[doc], key=lambda r: r.start):
                assert r.start == at and r.ids_crc32 == zlib.crc32(own[0][at : at + r.length].tobytes())
                at += r.length
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    return padding / max(sum(r.length for r in got), 1)


@pytest.mark.parametrize(("capacity", "windows", "parts"), [(4096, 64, 3), (64, 2, 5), (256, 1, 40)])
def test_packing(spark, capacity, windows, parts):
    rows = rows_of(spark)
    got = packing.pack(frame(spark, rows).repartition(parts), WORDS, capacity=capacity, open_windows=windows).collect()
    padding = check_packing(got, rows, capacity)
    assert padding < (0.02 if capacity > 1000 else 0.3)


def test_packing_empty(spark):
    assert packing.pack(frame(spark, EDGE).limit(0), WORDS).count() == 0


def test_packing_text_ids(spark):
    docs = spark.createDataFrame([("a", "one two"), (None, "three")], "doc_id string, text string")
    assert {r.doc_id for r in packing.pack(docs, WORDS).collect()} == {"a", None}
