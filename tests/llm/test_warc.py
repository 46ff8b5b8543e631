"""Archives, the capture index and range reads."""

import base64
import gzip
import hashlib
from collections import defaultdict

import pytest

from longrec.llm import warc
from longrec.llm.common import shared_dir

EDGE = [
    (1, "http://a.example.com/x?y=1#z", "<p>é</p>"), (2, "https://B.Example.com:8080/", "<p>é</p>"), (3, None, None), (4, "", ""),
    (5, "not a url\r\nX: y", "p" * 300_000), (6, "http://u:p@h.org", "<p>é</p>"), (None, "http://h.org/n", "lone"), (7, "http://h.org/n", None),
    (8, "http://h.org/same", "one"), (8, "http://h.org/same", "one"), (None, "http://h.org/n", "<p>é</p>"), (9, "http://h.org/crlf", "a\r\n\r\nb\r\n\r\n"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "k", 0) for i, u, h in rows], "page_id long, url string, html string, key string, offset int")


def wanted(rows, least=0):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[html or ""].append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        ids = [x for x in groups[html or ""] if x is not None]
        first = min(ids) if ids and len(groups[html or ""]) > 1 and len(data) >= least else None
        again = first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = warc.round_trip(frame(spark, EDGE), least_shared=least)
    # records without an id are found by their URL, and come back as often as they were written
    assert sorted((tuple(r) for r in got.collect()), key=repr) == wanted(EDGE, least)


def test_empty(spark):
    assert warc.round_trip(frame(spark, EDGE).limit(0)).count() == 0


def test_files_are_whole_archives(spark, tmp_path):
    folder = f"file://{tmp_path}/archive"
    captures = warc.write_archives(frame(spark, EDGE).coalesce(1), folder).collect()
    files = {r.file for r in captures}
    assert len(files) == 1
    body = open(files.pop().removeprefix("file://"), "rb").read()
    assert gzip.decompress(body).count(b"WARC/1.1\r\n") == len(EDGE)
    assert sum(r.length for r in captures) == len(body)
    for r in captures:
        assert warc.parse(body[r.offset : r.offset + r.length]).page_id == r.id


def test_damaged_payload():
    member = warc.record("1", "http://x.org/", b"payload", None, False, "1970-01-01T00:00:00Z")
    broken = gzip.compress(gzip.decompress(member).replace(b"payload", b"payl0ad"))
    with pytest.raises(ValueError):
        warc.parse(broken)


def test_index_with_small_blocks(spark):
    rows = [(k, f"http://h{k % 3}.org/{k // 9}", f"page {k}") for k in range(400)] + [(9999, "http://hot.org/", "hot")] * 30
    folder = shared_dir(spark, "warc-test")
    captures = warc.write_archives(frame(spark, rows), f"{folder}/archive")
    index = warc.build_index(captures, f"{folder}/index", block_rows=7)
    assert index.firsts == sorted(index.firsts)
    places = {(r.key, r.id): r for r in captures.collect()}
    found = warc.locate(captures.select("key", "id"), index).collect()
    assert len(found) == len(rows)
    assert {(r.key, r.id) for r in found} == set(places)
    absent = spark.createDataFrame([("org,h0)/0", "1"), ("zzz", "0"), ("", "0")], "key string, id string")
    assert warc.locate(absent, index).count() == 0
    one = spark.createDataFrame([("org,h1)/0", "1")], "key string, id string")
    assert [bytes(r.payload) for r in warc.fetch(warc.locate(one, index), payload=True).collect()] == [b"page 1"]
