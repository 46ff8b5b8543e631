"""A convolutional text classifier in numpy: hashed word embeddings, several filter widths, max pooling.

A word's vector is the sum of the vectors of its hashed form and its hashed prefixes, so that words unseen
in training share vectors with those they begin like.  Every filter looks at ``width``
neighbouring words, and the largest response anywhere in the text counts: the whole text is read.
"""

from __future__ import annotations

import numpy as np

from longrec.llm.words import NON_WORD, Words, mix

PREFIXES = (4, 5, 6)
#: Word positions that one matrix product takes at a time.
BLOCK = 1 << 15
#: What squared gradients begin with.
START = np.float32(1e-2)


def word_features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers (words x features) of a pass and the first word of each text.

    Bucket 0 stands for "no such prefix" and has the zero vector.
    """
    words = Words(data, offsets, NON_WORD)
    length = words.ends - words.starts
    columns = [words.hashes]
    for size in PREFIXES:
        hashed = words.span_hash(words.starts, np.minimum(words.starts + size, words.ends))
        columns.append(np.where(length > size, mix(hashed + np.uint64(size)), 0))
    numbers = np.stack(columns, axis=1)
    numbers = np.where(numbers > 0, numbers % np.uint64(buckets - 1) + np.uint64(1), 0).astype(np.int32)
    return numbers, words.first_word


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def bucket_counts(texts: list[np.ndarray], labels: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """In how many texts, and in how many with label 1, each bucket occurs."""
    seen, positive = np.zeros(buckets), np.zeros(buckets)
    for numbers, label in zip(texts, labels, strict=True):
        own = np.unique(numbers)
        seen[own] += 1
        positive[own] += label
    return seen, positive


class Adagrad:
    """Squared gradients so far, and the order of the texts."""

    def __init__(self, model: TextCnn, seed: int = 11):
        self.rng = np.random.default_rng(seed)
        self.dense = [np.full_like(p, START) for p in model.dense]
        self.table = np.full(model.table.shape, START, np.float32)

    def touched(self) -> np.ndarray:
        """The buckets whose vectors were moved."""
        return np.flatnonzero((self.table > START).any(axis=1))


class TextCnn:
    """Parameters and the forward pass; small enough to travel with a task (buckets x size floats)."""

    def __init__(self, buckets: int = 1 << 17, size: int = 12, widths: tuple[int, ...] = (1, 2, 3), filters: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.buckets, self.widths = buckets, widths
        self.table = rng.normal(0, 0.1, (buckets, size)).astype(np.float32)
        self.table[0] = 0
        self.kernels = [rng.normal(0, 0.3, (w, size, filters)).astype(np.float32) for w in widths]
        self.bias = [np.zeros(filters, np.float32) for _ in widths]
        self.out = rng.normal(0, 0.3, len(widths) * filters).astype(np.float32)
        self.shift = np.zeros(1, np.float32)

    def _vectors(self, numbers: np.ndarray) -> np.ndarray:
        vectors = self.table[numbers[:, 0]]
        for k in range(1, numbers.shape[1]):
            vectors += self.table[numbers[:, k]]
        return vectors

    def pooled(self, numbers: np.ndarray, first_word: np.ndarray) -> np.ndarray:
        """The largest response of each filter in each text (0 where no word responds).

        A filter's window may reach past the end of its text, where the vectors are zero.
        """
        texts, reach = len(first_word) - 1, max(self.widths)
        best = np.zeros((texts, len(self.out)), np.float32)
        flat = np.concatenate([part for kernel in self.kernels for part in kernel], axis=1)
        n, filters = len(numbers), self.kernels[0].shape[2]
        row = np.repeat(np.arange(texts), np.diff(first_word))
        for begin in range(0, n, BLOCK):
            end, upto = min(begin + BLOCK, n), min(begin + BLOCK + reach - 1, n)
            size, own = end - begin, row[begin:upto]
            parts = self._vectors(numbers[begin:upto]) @ flat
            cuts = np.flatnonzero(np.diff(own[:size], prepend=-1))
            first = 0
            for at, (width, bias) in enumerate(zip(self.widths, self.bias, strict=True)):
                response = parts[:size, first : first + filters] + bias
                for j in range(1, width):
                    some = min(size, upto - begin - j)
                    more = parts[j : j + some, first + j * filters : first + (j + 1) * filters]
                    same = own[j : j + some] == own[:some]
                    response[:some] += more if same.all() else np.where(same[:, None], more, 0)
                first += width * filters
                high = np.maximum.reduceat(response, cuts, axis=0)
                columns = slice(at * filters, (at + 1) * filters)
                best[own[cuts], columns] = np.maximum(best[own[cuts], columns], high)
        return best

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probabilities of the texts of one pass; texts without a word get that of no response."""
        numbers, first_word = word_features(data, offsets, self.buckets)
        return _sigmoid((self.pooled(numbers, first_word) @ self.out + self.shift[0]).astype(np.float64))

    def start_from_counts(self, texts: list[np.ndarray], labels: np.ndarray, prior: float = 10) -> None:
        """Let the first filter read how much likelier each bucket is in texts with label 1.

        Training moves on from there; from random vectors alone max pooling finds rare signs slowly.
        """
        self.start(*bucket_counts(texts, labels, self.buckets), len(labels), float(labels.sum()), prior)

    def start(self, seen: np.ndarray, positive: np.ndarray, texts: int, ones: float, prior: float = 10) -> None:
        """The same from the texts, and those with label 1, that each bucket occurs in."""
        share = (ones + 1) / (texts + 2)
        odds = np.log((positive + prior * share) / (seen - positive + prior * (1 - share)) * (1 - share) / share)
        self.table[1:, 0] = odds[1:]
        self.kernels[0][0, :, 0] = 0
        self.kernels[0][0, 0, 0] = 1
        self.out[0] = 1
        self.shift[0] = np.log(share / (1 - share))

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, steps: int = 2_500, batch: int = 32, rate: float = 0.05, seed: int = 11) -> TextCnn:
        """About ``steps`` steps of Adagrad on the log loss; ``texts`` are the bucket numbers of each text."""
        self.start_from_counts(texts, labels)
        return self.train(texts, labels, Adagrad(self, seed), -(-steps * batch // len(texts)), batch, rate)

    @property
    def dense(self) -> list[np.ndarray]:
        """All parameters but the table."""
        return [*self.kernels, *self.bias, self.out, self.shift]

    def train(self, texts: list[np.ndarray], labels: np.ndarray, state: Adagrad, rounds: int, batch: int = 32, rate: float = 0.05) -> TextCnn:
        """Some rounds over these texts; ``state`` goes on to the next ones."""
        rng, seen, seen_table, dense = state.rng, state.dense, state.table, self.dense
        reach = max(self.widths) - 1
        pad = np.zeros((reach, len(PREFIXES) + 1), np.int32)
        for _ in range(rounds):
            order = rng.permutation(len(texts))
            for first in range(0, len(order), batch):
                rows = order[first : first + batch]
                parts = [np.concatenate([texts[r], pad]) for r in rows]
                bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                numbers = np.concatenate(parts)
                vectors = np.concatenate([self._vectors(numbers), np.zeros((reach, self.table.shape[1]), np.float32)])
                tops, values = [], []
                for width, kernel, bias in zip(self.widths, self.kernels, self.bias, strict=True):
                    response = sum(vectors[j : j + len(numbers)] @ kernel[j] for j in range(width)) + bias
                    top = np.stack([a + response[a : max(b - reach, a + 1)].argmax(axis=0) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
                    tops.append(top)
                    values.append(np.take_along_axis(response, top, axis=0))
                hidden = np.maximum(np.concatenate(values, axis=1), 0)
                error = (_sigmoid(hidden @ self.out + self.shift[0]) - labels[rows]).astype(np.float32) / len(rows)
                back = error[:, None] * self.out * (hidden > 0)
                grads_kernel, grads_bias, at_rows, at_grads, column = [], [], [], [], 0
                for width, kernel, top in zip(self.widths, self.kernels, tops, strict=True):
                    own = back[:, column : column + kernel.shape[2]]
                    column += kernel.shape[2]
                    grads_kernel.append(np.stack([np.einsum("bfd,bf->df", vectors[top + j], own) for j in range(width)]))
                    grads_bias.append(own.sum(axis=0))
                    for j in range(width):
                        place = np.minimum(top + j, len(numbers) - 1)
                        at_rows.append(numbers[place].reshape(-1, numbers.shape[1]))
                        at_grads.append((own[:, :, None] * kernel[j].T[None]).reshape(-1, kernel.shape[1]))
                grads = [*grads_kernel, *grads_bias, hidden.T @ error, error.sum(keepdims=True)]
                for parameter, past, grad in zip(dense, seen, grads, strict=True):
                    past += grad * grad
                    parameter -= rate * grad / np.sqrt(past)
                buckets, inverse = np.unique(np.concatenate(at_rows), return_inverse=True)
                grad = np.zeros((len(buckets), self.table.shape[1]), np.float32)
                np.add.at(grad, inverse.ravel(), np.repeat(np.concatenate(at_grads), len(PREFIXES) + 1, axis=0))
                seen_table[buckets] += grad * grad
                self.table[buckets] -= rate * grad / np.sqrt(seen_table[buckets])
                self.table[0] = 0
        return self
