"""Bounded-space online packing of documents into token sequences of one size.

Each task keeps at most ``open_windows`` windows open.  A document's rest goes to the window
it fits best; when it fits none, the fullest window is emitted: topped up with the head of the rest
where its gap is worth a cut, else as it is.  What stays open at the end of a task is merged
with that of neighbouring tasks, in rounds of ``MERGE`` tasks each, until one window is left;
that one is cut into powers of two, which need no padding.

The rows of a task depend on its part of the table only and are written out before the merge, so
a task that runs again replaces its own rows.

Defined results: a null text is empty and has the end id alone; rows with the same id are documents
of their own; a null id stays null; a long text fills whole windows first; of windows that fit equally well the oldest
is taken, and of equally full ones the oldest is emitted; an empty table gives an empty result; other columns are
ignored; an id column named like one of the result gets underscores.  Each id of a document lies in exactly one piece, and a sequence has no gaps.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from longrec.llm import tokens
from longrec.llm.common import apart_from, cut_lineage, ship, text_or_empty
from longrec.llm.words import passes, release

#: Tasks (later: merge groups) whose open windows one merge takes: MERGE * open_windows windows.
MERGE = 16
#: A gap of fewer tokens is padded; a larger one is filled by a cut.
MIN_CUT = 32

LONGS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "task"]
PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Open windows of one task.  A piece is [doc id, start, ids, tokens of its document]."""

    def __init__(self, capacity: int, open_windows: int, first_sequence: int):
        self.capacity, self.next_sequence = capacity, first_sequence
        self.windows: list[list[list]] = []
        self.free = np.zeros(0, np.int64)
        self.limit = open_windows
        self.done: list[tuple] = []

    def emit(self, pieces: list[list]) -> None:
        """A finished sequence: its pieces one after the other."""
        offset = 0
        for doc, start, ids, total in pieces:
            crc = zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
            self.done.append((doc, start, len(ids), crc, total, self.next_sequence, offset))
            offset += len(ids)
        self.next_sequence += 1

    def add_document(self, doc, ids: np.ndarray) -> None:
        """Full windows first, then the rest by best fit."""
        full = len(ids) // self.capacity * self.capacity
        for start in range(0, full, self.capacity):
            self.emit([[doc, start, ids[start : start + self.capacity], len(ids)]])
        if full < len(ids):
            self.place([doc, full, ids[full:], len(ids)])

    def place(self, piece: list) -> None:
        size = len(piece[2])
        fits = np.flatnonzero(self.free >= size)
        if len(fits):
            self._put(int(fits[np.argmin(self.free[fits])]), piece)
        elif len(self.windows) < self.limit:
            self.windows.append([piece])
            self.free = np.append(self.free, self.capacity - size)
        else:
            fullest = int(np.argmin(self.free))
            gap = int(self.free[fullest])
            if gap >= MIN_CUT:
                self.windows[fullest].append([*piece[:2], piece[2][:gap], piece[3]])
                piece = [piece[0], piece[1] + gap, piece[2][gap:], piece[3]]
            self.emit(self.windows[fullest])
            self.windows[fullest] = []
            self.free[fullest] = self.capacity
            self.place(piece)

    def _put(self, window: int, piece: list) -> None:
        self.windows[window].append(piece)
        self.free[window] -= len(piece[2])
        if not self.free[window]:
            self.emit(self.windows.pop(window))
            self.free = np.delete(self.free, window)

    def gather(self) -> list[list]:
        """Fill the open windows one after the other; the pieces of the one that stays open."""
        order = np.argsort(self.free, kind="stable")
        pieces, size = [], 0
        for piece in (p for w in order for p in self.windows[w]):
            while size + len(piece[2]) >= self.capacity:
                cut = self.capacity - size
                self.emit([*pieces, [*piece[:2], piece[2][:cut], piece[3]]])
                piece = [piece[0], piece[1] + cut, piece[2][cut:], piece[3]]
                pieces, size = [], 0
            if len(piece[2]):
                pieces.append(piece)
                size += len(piece[2])
        self.windows, self.free = [], np.zeros(0, np.int64)
        return pieces

    def emit_in_powers(self, pieces: list[list]) -> None:
        """The last open window as sequences whose lengths are powers of two."""
        left = sum(len(p[2]) for p in pieces)
        while left:
            room, some = 1 << (left.bit_length() - 1), []
            left -= room
            while room:
                doc, start, ids, total = pieces.pop(0)
                some.append([doc, start, ids[:room], total])
                if len(ids) > room:
                    pieces.insert(0, [doc, start + room, ids[room:], total])
                room -= min(room, len(ids))
            self.emit(some)


def _first_sequence(merge_round: int, group: int) -> int:
    return merge_round << 56 | group << 28


def _columns(packer: Packer, open_pieces: list[list], group: int) -> dict[str, list]:
    """Finished pieces, then open ones with their ids and the merge group that takes them."""
    rows = [(*done, None, None) for done in packer.done]
    rows += [
        (doc, start, len(ids), None, total, None, None, group, np.ascontiguousarray(ids, "<u4").tobytes())
        for doc, start, ids, total in open_pieces
    ]
    packer.done = []
    names = ["id", *LONGS, "ids"]
    return dict(zip(names, map(list, zip(*rows, strict=True)) if rows else [[] for _ in names], strict=True))


def pack(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096,
    end_id: int = 2, open_windows: int = 64,
) -> DataFrame:
    """Pieces: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``path`` is a ``tokenizers`` file that drops white space, readable on every executor.
    ``capacity`` must be a power of two for the last window to end without padding.
    """
    spark = docs.sparkSession
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["id"].dataType
    schema = f"id {id_type.simpleString()}, {PIECE}, task long, ids binary"
    kinds = pa.schema([("id", to_arrow_type(id_type)), *((c, pa.int64()) for c in LONGS), ("ids", pa.binary())])

    def pack_task(batches):
        task = TaskContext.get().partitionId()
        packer = Packer(capacity, open_windows, _first_sequence(0, task))
        encoder = tokens.word_ids(path)
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for first, end, data, offsets in passes(batch.column("text")):
                for doc, own in zip(ids[first:end], encoder.encode(data, offsets, end_id), strict=True):
                    packer.add_document(doc, own)
            yield pa.RecordBatch.from_pydict(_columns(packer, [], 0), kinds)
        left = [piece for window in packer.windows for piece in window]
        yield pa.RecordBatch.from_pydict(_columns(packer, left, task // MERGE), kinds)
        release()

    def merge(merge_round: int, last: bool):
        def run(key, table):
            group = key[0].as_py()
            packer = Packer(capacity, open_windows, _first_sequence(merge_round, group))
            table = table.sort_by([("length", "descending"), ("id", "ascending"), ("start", "ascending")])
            for row in table.select(["id", "start", "ids", "doc_tokens"]).to_pylist():
                packer.place([row["id"], row["start"], np.frombuffer(row["ids"], "<u4"), row["doc_tokens"]])
            left = packer.gather()
            if last:
                packer.emit_in_powers(left)
                left = []
            return pa.Table.from_pydict(_columns(packer, left, group // MERGE), kinds)

        return run

    written = [cut_lineage(rows.mapInArrow(pack_task, schema))]
    while True:
        still_open = written[-1].where("task is not null")
        groups = still_open.agg(F.max("task")).head()[0]
        if groups is None:
            break
        merged = still_open.groupBy("task").applyInArrow(merge(len(written), groups == 0), schema)
        written.append(cut_lineage(merged))
    pieces = written[0]
    for more in written[1:]:
        pieces = pieces.unionByName(more)
    pieces = pieces.where("task is null").drop("task", "ids")
    return pieces.withColumnRenamed("id", apart_from(id_col, pieces.columns[1:]))
