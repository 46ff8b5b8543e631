"""Words of Arrow text columns as numpy arrays: one pass over the UTF-8 bytes, no loop per row."""

from __future__ import annotations

import ctypes
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy pass takes at a time; a longer text is a pass of its own.
PASS_BYTES = 1 << 19

#: Random constants of the two hashes: start, factor for each eight bytes.
_FIRST, _SECOND = np.random.default_rng(20240601).integers(1 << 62, 1 << 63, (2, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Spans above this many bytes are hashed by BLAKE2, the others eight bytes at a time.
LONG_SPAN = 64
#: The first k bytes of eight.
_HEADS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

#: Words end at ASCII white space only.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: Words end at every ASCII byte that is no letter and no digit.
NON_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
#: Code points of scripts that are written without blanks between words: first and last.
UNSEGMENTED = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF),
    (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x323AF),
)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@cache
def _code_point_kinds() -> np.ndarray:
    """Of each code point: 1 for punctuation, blanks and symbols, 2 for a word of its own, else 0."""
    kinds = np.zeros(0x110000, np.uint8)
    for first, last in UNSEGMENTED:
        kinds[first : last + 1] = 2
    for point in range(128, UNSEGMENTED[-1][1] + 1):
        kind = unicodedata.category(chr(point))
        if kind[0] in "PZS" or kind == "Cc":
            kinds[point] = 1
    return kinds


def _wide_characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, length, kind) of the characters of valid UTF-8 that are not ASCII."""
    at = np.flatnonzero(data >= 0xC0)
    lead = data[at].astype(np.int64)
    length = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = lead & (0xFF >> (length + 1))
    for k in range(1, 4):
        after = data[np.minimum(at + k, len(data) - 1)].astype(np.int64) & 0x3F
        point = np.where(k < length, point << 6 | after, point)
    return at, length, _code_point_kinds()[np.minimum(point, 0x10FFFF)]


def fold_case(data: np.ndarray, latin: bool = True) -> np.ndarray:
    """ASCII letters in lower case; with ``latin`` also the two-byte letters U+00C0 to U+00DE."""
    folded = _LOWER[data]
    if latin and len(data) > 1:
        after = np.flatnonzero(data[:-1] == 0xC3) + 1
        wide = folded[after]
        up = (wide >= 0x80) & (wide <= 0x9E) & (wide != 0x97)
        folded[after[up]] += 0x20
    return folded


def passes(column: pa.Array, max_bytes: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of slices of a text column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    n = len(column)
    if not n:
        return
    try:
        yield from _slices(column, n, wide, max_bytes)
    finally:
        release()


def _slices(column: pa.Array, n: int, wide: bool, max_bytes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def release() -> None:
    """Give memory that is no longer used back to the system, at the end of a task.

    Workers are reused, so what the allocators keep for later would add up over the stages of a pipeline.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


class Words:
    """Word boundaries and hashes of the texts of one pass.

    Unless ``fold``, letters of both cases differ.  With ``scripts`` words also end at punctuation, blanks and symbols beyond ASCII, and each character of a script written without
    blanks is a word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray, latin: bool = True, scripts: bool = False, fold: bool = True):
        self.data, self.offsets = data, offsets
        inside = ~separators[data]
        n = len(data)
        own = np.zeros(0, np.int64)
        if scripts:
            at, length, kind = _wide_characters(data)
            signs = kind == 1
            for k in range(4):
                inside[at[signs & (k < length)] + k] = False
            own = np.concatenate([at[kind == 2], (at + length)[kind == 2]])
            own = own[own < n]
        start = inside.copy()
        start[1:] &= ~inside[:-1]
        begins = offsets[:-1][offsets[:-1] < n]
        start[begins] = inside[begins]
        start[own] = inside[own]
        self.starts = np.flatnonzero(start)
        last = inside.copy()
        last[:-1] &= ~inside[1:] | start[1:]
        self.ends = np.flatnonzero(last) + 1
        #: The row (within the pass) of each word, and where each row's words begin.
        self.first_word = np.searchsorted(self.starts, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first_word))
        self._folded = np.concatenate([fold_case(data, latin) if fold else data, np.zeros(8, np.uint8)])
        #: The eight bytes from each place on, without a copy.
        self._eights = np.ndarray(n + 1, "<u8", self._folded, strides=(1,))

    def _spans(self, starts: np.ndarray, ends: np.ndarray, constants: np.ndarray, half: int) -> np.ndarray:
        length = ends - starts
        result = mix(length.astype(np.uint64) * constants[1] ^ constants[0])
        rows = np.flatnonzero((length > 0) & (length <= LONG_SPAN))
        at, left = starts[rows], length[rows]
        while len(rows):
            eight = self._eights[at] & _HEADS[np.minimum(left, 8)]
            result[rows] = mix((result[rows] ^ eight) * constants[1])
            more = left > 8
            rows, at, left = rows[more], at[more] + 8, left[more] - 8
        for row in np.flatnonzero(length > LONG_SPAN).tolist():
            digest = hashlib.blake2b(self._folded[starts[row] : ends[row]], digest_size=16).digest()
            result[row] = int.from_bytes(digest[8 * half : 8 * half + 8], "little")
        return result

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans, equal for equal lower-cased bytes."""
        return self._spans(starts, ends, _FIRST, 0)

    def check_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A second hash with constants of its own; both together have 128 bits."""
        return self._spans(starts, ends, _SECOND, 1)

    @cached_property
    def hashes(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)
