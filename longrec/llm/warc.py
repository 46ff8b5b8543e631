"""WARC archives with a two-level capture index.

``write_archives`` writes one gzip member per record.  ``build_index`` sorts the captures by their URL key
(host labels reversed) and writes them as compressed blocks; each index file ends with a sparse directory that
has the first key of every block, and a manifest has the first key of every file.  ``locate`` finds a capture by
binary search in manifest, directory and block, reading one block; ``fetch`` reads only the bytes of the
records wanted.

All files lie in a folder that every executor reaches.  A task that runs again writes files of new names;
tables list the files of the attempts that counted, and readers see no others.

Defined results: a null or empty payload is a record of 0 bytes; of records with equal payloads of at least
``least_shared`` bytes those with the smallest id are responses (repeated rows of that id all are), the others
revisit it; a null id is revisited by none unless the group has no other, and comes back as null; a null URL
has the empty key and no target; control signs and blanks in URLs are percent-encoded; an empty table
gives empty archives; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longrec.llm.common import cut_lineage, possibly_in, shared_dir, ship

#: Captures of an index block, and bytes after which an archive is closed and the next begun.
BLOCK_ROWS = 1_000
ARCHIVE_BYTES = 1 << 28
#: Archives that a task holds open.
OPEN_FILES = 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:longrec:page:"


def url_key(url: Column) -> Column:
    """``com,example,www)/path?query`` of a URL; the empty text for null."""
    bare = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^([^/?#]*)", 1), r"^[^@]*@", "")
    rest = F.regexp_extract(bare, r"^[^/?#]*(.*)$", 1)
    key = F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), F.lit(")"), rest)
    return F.when(bare == "", F.lit("")).otherwise(F.regexp_replace(key, r"[\x00-\x20\x7F]", "_"))


# ---------------------------------------------------------------- records


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _target(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: str | None, url: str | None, payload: bytes, first_id: str | None, revisit: bool, date: str) -> bytes:
    """A WARC/1.1 response or revisit record as a gzip member of its own."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {date}"]
    lines.append(f"WARC-Record-ID: <{_ID}{page_id}>" if page_id is not None else f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>")
    if url:
        lines.append(f"WARC-Target-URI: {_target(url)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_ID}{first_id}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


@dataclass
class Record:
    page_id: str | None
    record_type: str
    refers_to: str | None
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


def parse(member: bytes) -> Record:
    """The record of a gzip member; a response's payload is checked against its digest."""
    data = gzip.decompress(member)
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    header = dict(line.split(": ", 1) for line in lines[1:])
    length = int(header["Content-Length"])
    block = data[end + 4 : end + 4 + length]
    if lines[0] != "WARC/1.1" or len(block) != length or data[end + 4 + length :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http_end = block.index(b"\r\n\r\n") + 4
    http = dict(line.split(": ", 1) for line in block[: http_end - 4].decode().split("\r\n")[1:])
    revisit = header["WARC-Type"] == "revisit"
    digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None if revisit else block[http_end:]
    if payload is not None and (digest_of(payload) != digest or len(payload) != int(http["Content-Length"])):
        raise ValueError("payload and digest differ")

    def page(name: str) -> str | None:
        value = header.get(name, "")[1:-1]
        return value.removeprefix(_ID) if value.startswith(_ID) else None

    return Record(page("WARC-Record-ID"), header["WARC-Type"], page("WARC-Refers-To"), int(http["Content-Length"]), digest, payload)


# ---------------------------------------------------------------- files


def _create(uri: str):
    """A new file of the shared folder, for writing."""
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


class _Files:
    """A few open files for range reads."""

    def __init__(self, most: int = OPEN_FILES):
        self.most, self.open = most, OrderedDict()

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri not in self.open:
            system, path = fs.FileSystem.from_uri(uri)
            self.open[uri] = system.open_input_file(path)
            if len(self.open) > self.most:
                self.open.popitem(last=False)[1].close()
        self.open.move_to_end(uri)
        return self.open[uri].read_at(length, offset)

    def close(self) -> None:
        for file in self.open.values():
            file.close()
        self.open.clear()


# ---------------------------------------------------------------- writing

CAPTURE = "key string, id string, file string, offset long, length long"


def _first_of_equal(pages: DataFrame, least_shared: int) -> DataFrame:
    """(digest, first): the smallest id of payloads that several rows have."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page", F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).alias("bytes"))
    groups = rows.where(F.col("bytes") >= least_shared).groupBy("digest")
    return cut_lineage(groups.agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"))


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    least_shared: int = 0, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record for each row into archives below ``folder``; the captures (key, id, file, offset, length)."""
    ship(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    digest = F.sha1(F.coalesce("html", F.lit("")).cast("binary"))
    shared = _first_of_equal(rows, least_shared)
    # payloads that surely occur once stay where they are
    rows = possibly_in(rows.withColumn("digest", digest), ["digest"], shared.select("digest"), "hit")
    alone = rows.where("not hit").withColumn("first", F.lit(None).cast(rows.schema["page"].dataType))
    rows = alone.drop("hit").unionByName(rows.where("hit").drop("hit").join(shared, "digest", "left"))
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    rows = rows.select(
        url_key(F.col("url")).alias("key"), F.col("page").cast("string").alias("id"), "url",
        F.coalesce("html", F.lit("")).alias("html"), F.col("first").cast("string").alias("first"), revisit.alias("revisit"),
    )

    def write(batches):
        task, out, uri = TaskContext.get().partitionId(), None, None
        for batch in batches:
            places = {"file": [], "offset": [], "length": []}
            columns = (batch.column(c).to_pylist() for c in ("id", "url", "html", "first", "revisit"))
            for page, url, html, first, again in zip(*columns, strict=True):
                if out is None or out.tell() >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    uri = f"{folder}/part-{task:06d}-{uuid.uuid4().hex}.warc.gz"
                    out = _create(uri)
                member = record(page, url, html.encode("utf-8", "surrogatepass"), first, again, date)
                for name, value in (("file", uri), ("offset", out.tell()), ("length", len(member))):
                    places[name].append(value)
                out.write(member)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("id"), pa.array(places["file"], pa.string()),
                 pa.array(places["offset"], pa.int64()), pa.array(places["length"], pa.int64())],
                ["key", "id", "file", "offset", "length"],
            )
        if out is not None:
            out.close()

    return cut_lineage(rows.mapInArrow(write, CAPTURE))


# ---------------------------------------------------------------- index


@dataclass
class CaptureIndex:
    """The manifest: first (key, id) of each index file, in order, and where the file has its directory."""

    firsts: list[tuple[str, str]]
    files: list[tuple[str, int, int]]


def build_index(captures: DataFrame, folder: str, block_rows: int = BLOCK_ROWS) -> CaptureIndex:
    """Sort the captures into blocks below ``folder``.

    The files are ranges of (key, id), so neither a busy host nor a busy URL makes one large.  The manifest
    has one row for each file, that is for each partition, and comes to the driver.
    """
    ship(captures.sparkSession)
    ordered = captures.withColumn("id", F.coalesce("id", F.lit(""))).repartitionByRange("key", "id").sortWithinPartitions("key", "id")

    def write(batches):
        out, uri, directory, block = None, None, [], []

        def close_block():
            body = zlib.compress("\n".join(json.dumps(row) for row in block).encode(), 6)
            directory.append([block[0][0], block[0][1], out.tell(), len(body)])
            out.write(body)
            block.clear()

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "file", "offset", "length")), strict=True):
                if out is None:
                    uri = f"{folder}/index-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.cdx"
                    out = _create(uri)
                block.append(row)
                if len(block) >= block_rows:
                    close_block()
        if out is None:
            return
        if block:
            close_block()
        place = out.tell()
        body = zlib.compress(json.dumps(directory).encode(), 6)
        out.write(body)
        out.close()
        yield pa.RecordBatch.from_pydict(
            {"key": [directory[0][0]], "id": [directory[0][1]], "file": [uri], "offset": [place], "length": [len(body)]}
        )

    manifest = cut_lineage(ordered.mapInArrow(write, CAPTURE)).collect()  # one row a partition
    manifest.sort(key=lambda row: (row["key"], row["id"]))
    return CaptureIndex([(r["key"], r["id"]) for r in manifest], [(r["file"], r["offset"], r["length"]) for r in manifest])


class _Searcher:
    """Binary search in one index, keeping the directory and the block read last."""

    def __init__(self, index: CaptureIndex):
        self.index, self.files = index, _Files()
        self._directory = self._block = (None, [])

    def directory(self, number: int) -> list:
        if self._directory[0] != number:
            self._directory = (number, json.loads(zlib.decompress(self.files.read(*self.index.files[number]))))
        return self._directory[1]

    def block(self, number: int, offset: int, length: int) -> list:
        if self._block[0] != (number, offset):
            body = zlib.decompress(self.files.read(self.index.files[number][0], offset, length))
            self._block = ((number, offset), [json.loads(line) for line in body.split(b"\n")])
        return self._block[1]

    def find(self, wanted: tuple[str, str]) -> Iterator[list]:
        """All captures with this (key, id); equal ones may lie in several blocks and files."""
        for number in range(max(bisect_left(self.index.firsts, wanted) - 1, 0), bisect_right(self.index.firsts, wanted)):
            directory = self.directory(number)
            firsts = [(key, page) for key, page, _, _ in directory]
            for at in range(max(bisect_left(firsts, wanted) - 1, 0), bisect_right(firsts, wanted)):
                rows = self.block(number, *directory[at][2:])
                first = bisect_left(rows, wanted, key=lambda row: (row[0], row[1]))
                while first < len(rows) and (rows[first][0], rows[first][1]) == wanted:
                    yield rows[first]
                    first += 1


def locate(wanted: DataFrame, index: CaptureIndex) -> DataFrame:
    """The captures of ``wanted`` (key, id), each wanted pair once, by the index."""
    ship(wanted.sparkSession)
    ordered = wanted.select("key", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id")).distinct()
    ordered = ordered.repartitionByRange("key", "id").sortWithinPartitions("key", "id")

    def search(batches):
        searcher = _Searcher(index)
        for batch in batches:
            found = [row for pair in zip(batch.column("key").to_pylist(), batch.column("id").to_pylist(), strict=True) for row in searcher.find(pair)]
            columns = list(zip(*found, strict=True)) or [[]] * 5
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "id", "file", "offset", "length"])
        searcher.files.close()

    return ordered.mapInArrow(search, CAPTURE)


def fetch(captures: DataFrame, payload: bool = False) -> DataFrame:
    """The records at ``captures``: id, record_type, refers_to, payload_bytes, payload_digest (and payload).

    Only the bytes of these records are read, in the order of the archives.
    """
    ship(captures.sparkSession)
    # a fixed number of parts: the places are few bytes, but the records behind them are not
    parts = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    places = captures.select("file", "offset", "length")
    ordered = places.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    names = ["id", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * payload
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * payload

    def read(batches):
        files = _Files()
        for batch in batches:
            rows = []
            for place in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True):
                r = parse(files.read(*place))
                rows.append((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.payload)[: len(names)])
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        files.close()

    schema = "id string, record_type string, refers_to string, payload_bytes long, payload_digest string"
    return ordered.mapInArrow(read, schema + ", payload binary" * payload)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_shared: int = 0) -> DataFrame:
    """Write ``pages`` to archives, index them, look every page up by its URL and id and read its record."""
    folder = shared_dir(pages.sparkSession, "warc")
    captures = write_archives(pages, f"{folder}/archive", id_col, url_col, html_col, least_shared)
    index = build_index(captures, f"{folder}/index")
    records = fetch(locate(pages.select(url_key(F.col(url_col)).alias("key"), F.col(id_col).alias("id")), index))
    kind = pages.schema[id_col].dataType
    return records.select(
        F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )
