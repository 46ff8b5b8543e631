"""Sets of word shingles of texts, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

from longrec.llm.words import SPACES, Words, mix

#: Words of a shingle.
WORDS = 5
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _combined(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    total = np.full(len(starts), size, np.uint64)
    for j in range(size):
        total += hashes[starts + j] * _FACTORS[j]
    return mix(total)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the shingles of each text of a pass in text order, with repeats.

    Words are runs without ASCII white space, A-Z in lower case.  A text with fewer words than a shingle has its
    whole sequence as one; a text without words has none.
    """
    words = Words(data, offsets, SPACES, latin=False)
    count = np.diff(words.first_word)
    hashes = words.hashes
    long = np.flatnonzero(np.repeat(count >= WORDS, count) & (np.arange(len(hashes)) <= np.repeat(words.first_word[1:] - WORDS, count)))
    starts, values = [long], [_combined(hashes, long, WORDS)]
    for size in range(1, WORDS):
        short = words.first_word[:-1][count == size]
        starts.append(short)
        values.append(_combined(hashes, short, size))
    starts, values = np.concatenate(starts), np.concatenate(values)
    order = np.argsort(starts, kind="stable")
    per_text = np.where(count >= WORDS, count - WORDS + 1, count > 0)
    return values[order], np.concatenate([[0], np.cumsum(per_text)])


def distinct_sorted(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted and without repeats, and where each text begins."""
    values = values.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        values[a:b].sort()
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[new], np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(first) - 1))]).astype(np.int64)
