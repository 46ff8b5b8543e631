"""Naive Bayes support vectors: n-gram indicators scaled by class log-count ratios, then a linear
hinge-loss model by dual coordinate descent.

N-grams of one to three are taken over two views of a text: its words, and the shapes of its
words (case, length, digits, signs, whether a word repeats its predecessor).  All are hashed; a text's
features are the buckets that occur in it anywhere.
"""

from __future__ import annotations

import numpy as np

from longrec.llm.calibration import logistic_curve
from longrec.llm.words import SPACES, Words, mix

_SIGNS = np.zeros(256, np.int64)
for _kind, _bytes in enumerate((b".", b",", b"!?", b"#$%&*@^~+=", b"|/\\<>_[]{}", b"'\"()-:;"), 1):
    _SIGNS[list(_bytes)] = _kind
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])
_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 0xC0 for b in range(256)])


def _counts(flags: np.ndarray, words: Words) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[words.ends] - sums[words.starts]


def shapes(words: Words) -> np.ndarray:
    """A small number for the look of each word."""
    data = words.data
    length = words.ends - words.starts
    letters, upper, digits = (_counts(f[data], words) for f in (_LETTER, _UPPER, _DIGIT))
    kind = np.where(letters == 0, 0, np.where(upper == 0, 1, np.where((upper >= 2) & (2 * upper >= letters), 3, 2)))
    last, before = data[words.ends - 1], data[np.maximum(words.ends - 2, words.starts)]
    sign = _SIGNS[last] * 2 + ((last == before) & (length > 1) & (_SIGNS[last] > 0))
    size = np.digitize(length, [2, 4, 8, 16, 40])
    same = np.zeros(len(length), np.int64)
    hashes = words.hashes
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (words.row[1:] == words.row[:-1])
    return (((kind * 14 + sign) * 6 + size) * 2 + same) * 2 + (digits > 0)


def features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) pairs of a pass, each once, sorted by text."""
    words = Words(data, offsets, SPACES)
    texts = len(offsets) - 1
    views = [words.hashes, mix(shapes(words).astype(np.uint64) + np.uint64(1 << 40))]
    row, n = words.row, len(words.row)
    keys = [np.arange(texts, dtype=np.uint64) * np.uint64(buckets)]  # bucket 0: every text
    for view in views:
        gram = view
        for size in range(1, 4):
            if size > 1:
                if n < size:
                    break
                gram = mix(gram[: n - size + 1] * np.uint64(0x9E3779B97F4A7C15) + view[size - 1 :])
            inside = row[: n - size + 1] == row[size - 1 :]
            hashed = gram % np.uint64(buckets - 1) + np.uint64(1)
            keys.append((row[: n - size + 1].astype(np.uint64) * np.uint64(buckets) + hashed)[inside])
    keys = np.unique(np.concatenate(keys))
    return (keys // np.uint64(buckets)).astype(np.int32), (keys % np.uint64(buckets)).astype(np.int32)


class NbSvm:
    """weights per bucket, already multiplied by the log-count ratios; a probability by a fitted slope."""

    def __init__(self, buckets: int = 1 << 18):
        self.buckets = buckets
        self.weights = np.zeros(buckets, np.float32)
        self.slope, self.shift = 1.0, 0.0

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, bucket = features(data, offsets, self.buckets)
        size = np.sqrt(np.maximum(np.bincount(row, minlength=len(offsets) - 1), 1))
        return np.bincount(row, self.weights[bucket], minlength=len(offsets) - 1) / size

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(data, offsets) + self.shift, -40, 40)))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, epochs: int = 20, smoothing: float = 1.0, seed: int = 5) -> NbSvm:
        """``texts``: the buckets of each text.  L1-loss dual coordinate descent with shuffled rows."""
        sign = np.where(labels > 0, 1.0, -1.0)
        counts = np.full((2, self.buckets), smoothing)
        for own, label in zip(texts, labels, strict=True):
            counts[int(label > 0), own] += 1
        counts /= (np.bincount(labels > 0, minlength=2) + 2 * smoothing)[:, None]
        ratio = np.log(counts[1] / counts[0])
        scaled = [ratio[own] / np.sqrt(len(own)) for own in texts]
        square = np.array([x @ x for x in scaled])
        upper = cost * np.where(sign > 0, len(sign) / (2 * (sign > 0).sum()), len(sign) / (2 * (sign < 0).sum()))
        alpha, weights, rng = np.zeros(len(sign)), np.zeros(self.buckets), np.random.default_rng(seed)
        for _ in range(epochs):
            worst = 0.0
            for i in rng.permutation(len(sign)):
                if square[i] <= 0:
                    continue
                own = texts[i]
                gradient = sign[i] * (weights[own] @ scaled[i]) - 1
                moved = min(max(alpha[i] - gradient / square[i], 0.0), upper[i]) - alpha[i]
                if moved:
                    alpha[i] += moved
                    weights[own] += moved * sign[i] * scaled[i]
                    worst = max(worst, abs(moved) * square[i])
            if worst < 1e-3:
                break
        self.weights = (weights * ratio).astype(np.float32)
        return self

    def calibrate(self, margins: np.ndarray, labels: np.ndarray) -> None:
        self.slope, self.shift = logistic_curve(margins, labels)
