"""Token ids and counts of texts by a public tokenizer file, for use inside tasks."""

from __future__ import annotations

import json
import os
import re
import sys
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

from longrec.llm.words import SPACES, Words

#: Bytes of runs and their ids that a Python worker remembers; beyond that it keeps the half used most.
REMEMBERED_BYTES = 16 << 20
#: New runs in one call of the encoder.
RUNS_AT_ONCE = 500
_PLAIN = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
#: Bytes of runs and their lengths in each of the two generations that a Python worker remembers.
GENERATION_BYTES = 32 << 20
#: Characters of the longest run that is remembered.
LONGEST_RUN = 64
#: Letters after a blank or at the beginning, up to a blank or an ASCII sign other than the apostrophe; else all up to the next blank that
#: follows a non-blank.  Blanks of other kinds end no run, since libraries differ in what they take for one.
_SIGNS = r"!-&(-/:-@\[-`{-~"
_RUNS = re.compile(
    rf"[ \t\n\r]?[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[ \t\n\r{_SIGNS}])|\s*+\S++(?:(?![ \t\n\r])\s++\S*+)*+|\s++"
)


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a file; one per worker, single-threaded as Spark runs the tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def split_safely(text: str, max_chars: int) -> Iterator[str]:
    """``text`` in pieces of about ``max_chars``, cut only before a space that follows a non-space.

    A byte-level tokenizer starts a new word there whatever stands around it, so the pieces have
    the tokens of the whole.  A text without such a place stays whole.
    """
    start = 0
    while len(text) - start > max_chars:
        cut = text.find(" ", start + max_chars)
        while cut > 0 and text[cut - 1].isspace():
            cut = text.find(" ", cut + 1)
        if cut <= 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


class WordIds:
    """Ids of whole texts from the ids of their runs, for tokenizers that drop white space.

    Such a tokenizer works on each run between blanks alone, so a run that occurs again needs no
    second encoding.  Where it also lower-cases and takes letters and other signs apart, runs that differ in ASCII
    case only are the same, and a full stop or comma at the end of a run is a run of its own.  Runs are known by
    two hashes, so a known run costs a few numbers.  Use ``word_ids``: one object per Python worker.
    """

    def __init__(self, path: str):
        self._tokenizer = load(path)
        described = json.loads(self._tokenizer.to_str())
        split, normalizer = str(described["pre_tokenizer"]), str(described["normalizer"])
        if "'behavior': 'Removed', 'invert': True" not in split:
            raise ValueError("this tokenizer keeps white space; its words cannot be encoded alone")
        if "'Lowercase'" not in normalizer or "[\\\\p{L}]+|" not in split:
            raise ValueError("this tokenizer tells cases apart or joins letters and signs")
        # sorted hashes, their check hashes and the entry of each
        self._keys, self._checks, self._entries = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._ids, self._ends, self._uses = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int64)

    @property
    def nbytes(self) -> int:
        return sum(part.nbytes for part in (self._keys, self._checks, self._entries, self._ids, self._ends, self._uses))

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _forget(self) -> None:
        """Keep the runs used most, up to half of the bytes."""
        size = 40 + 4 * np.diff(self._ends)
        most = np.argsort(-self._uses, kind="stable")
        keep = np.sort(most[np.cumsum(size[most]) <= REMEMBERED_BYTES // 2])
        kept = np.zeros(len(self._uses), bool)
        kept[keep] = True
        moved = np.cumsum(kept) - 1
        own = kept[self._entries]
        self._keys, self._checks, self._entries = self._keys[own], self._checks[own], moved[self._entries[own]]
        lengths = np.diff(self._ends)
        self._ids = self._ids[np.repeat(kept, lengths)]
        self._ends = np.concatenate([[0], np.cumsum(lengths[kept])])
        self._uses = self._uses[kept] // 2

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The entry of each run, -1 where it is not known."""
        if not len(self._keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (self._checks[at] == checks), self._entries[at], -1)

    def _encoded(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all runs, number of ids of each).

        The runs are encoded as one text, and the places of its tokens tell whose they are; special tokens may hold blanks.
        """
        text = " ".join(runs)
        if "<|" in text:
            own = [e.ids for e in self._tokenizer.encode_batch_fast(runs, add_special_tokens=False)]
            return np.array(list(chain.from_iterable(own)), np.uint32), np.fromiter(map(len, own), np.int64, len(own))
        encoded = self._tokenizer.encode(text, add_special_tokens=False)
        ends = np.cumsum(np.fromiter(map(len, runs), np.int64, len(runs)) + 1)
        begins = np.fromiter((begin for begin, _ in encoded.offsets), np.int64, len(encoded))
        return np.array(encoded.ids, np.uint32), np.bincount(np.searchsorted(ends, begins, "right"), minlength=len(runs))

    def _learn(self, runs: list[str], keys: np.ndarray, checks: np.ndarray) -> None:
        """Encode new runs; ``keys`` are sorted and different."""
        parts, lengths = [self._ids], []
        for first in range(0, len(runs), RUNS_AT_ONCE):
            ids, counts = self._encoded(runs[first : first + RUNS_AT_ONCE])
            parts.append(ids)
            lengths.append(counts)
        entries = len(self._uses) + np.arange(len(runs))
        places = np.searchsorted(self._keys, keys)
        # two runs of one hash: the later takes the place, and the other is learnt again if it returns
        same = (places < len(self._keys)) & (self._keys[np.minimum(places, len(self._keys) - 1)] == keys) if len(self._keys) else np.zeros(len(keys), bool)
        self._checks[places[same]], self._entries[places[same]] = checks[same], entries[same]
        new = ~same
        self._keys = np.insert(self._keys, places[new], keys[new])
        self._checks = np.insert(self._checks, places[new], checks[new])
        self._entries = np.insert(self._entries, places[new], entries[new])
        self._ids = np.concatenate(parts)
        self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(np.concatenate(lengths))])
        self._uses = np.concatenate([self._uses, np.zeros(len(runs), np.int64)])

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> list[np.ndarray]:
        """The ids of each text of a pass (UTF-8 bytes and offsets), each followed by ``end_id``."""
        if self.nbytes > REMEMBERED_BYTES:
            self._forget()
        words = Words(data, offsets, SPACES, latin=False)
        n = len(words.starts)
        sign = np.zeros(n, bool)
        if n:
            last, before = data[words.ends - 1], data[np.maximum(words.ends - 2, words.starts)]
            sign = ((last == ord(".")) | (last == ord(","))) & (words.ends - words.starts > 1) & _PLAIN[before]
        # runs and split-off signs in text order
        place = np.arange(n) + np.cumsum(sign) - sign
        starts, ends = np.zeros(n + int(sign.sum()), np.int64), np.zeros(n + int(sign.sum()), np.int64)
        starts[place], ends[place] = words.starts, words.ends - sign
        starts[place[sign] + 1], ends[place[sign] + 1] = words.ends[sign] - 1, words.ends[sign]
        keys, checks = words.span_hash(starts, ends), words.check_hash(starts, ends)
        entries = self._find(keys, checks)
        while len(missing := np.flatnonzero(entries < 0)):
            new, first = np.unique(keys[missing], return_index=True)
            first = missing[first]
            body = data.tobytes()
            runs = [body[a:b].decode("utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            self._learn(runs, new, checks[first])
            entries[missing] = self._find(keys[missing], checks[missing])
        self._uses += np.bincount(entries, minlength=len(self._uses))
        lengths = np.diff(self._ends)[entries]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ids = self._ids[np.repeat(self._ends[entries] - upto[:-1], lengths) + np.arange(int(upto[-1]))]
        bounds = upto[np.append(place, len(starts))[words.first_word]]
        end = np.array([end_id], np.uint32)
        result = [np.concatenate([ids[a:b], end]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        # texts that may hold a special token, whose case matters, are encoded whole
        for text in np.unique(np.searchsorted(offsets, np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)), "right") - 1).tolist():
            whole = data[offsets[text] : offsets[text + 1]].tobytes().decode("utf-8", "replace")
            result[text] = np.concatenate([self._whole(whole), end])
        return result


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """The runs remembered in this Python worker, which later tasks find again."""
    return WordIds(path)


def _known_words(tokenizer) -> bool:
    """Whether a word of this tokenizer never goes on over the end of one of ``_RUNS``."""
    described = json.loads(tokenizer.to_str())
    splits = described["pre_tokenizer"] or {}
    if splits.get("type") != "ByteLevel" or not splits.get("use_regex") or splits.get("add_prefix_space"):
        return False
    if any(described[part] is not None for part in ("normalizer", "truncation", "padding")) or described["model"].get("dropout"):
        return False
    return all(
        re.fullmatch(rf"[{_SIGNS}]\S*", token["content"]) and not (token["lstrip"] or token["rstrip"] or token["single_word"])
        for token in described["added_tokens"]
    )


class RunLengths:
    """Numbers of tokens of texts from those of their runs, for byte-level tokenizers.

    Where a tokenizer splits words by the pattern of the library's byte level, a word ends before a blank that follows a non-blank, and
    letters end before a sign.  So the tokens of a run do not depend on what stands around it, and a run that occurs again
    needs no second encoding.  For other tokenizers a text is one run.  Runs are kept whole, so none is taken for
    another.  Use ``run_lengths``: one object per Python worker.
    """

    def __init__(self, path: str):
        self._tokenizer = load(path)
        self._runs = _RUNS.findall if _known_words(self._tokenizer) else lambda text: [text]
        # the runs met since the generation began, and those of the generation before
        self._recent: dict[str, int] = {}
        self._before: dict[str, int] = {}
        self.nbytes = 0

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text; the new runs of all texts go to the encoder in one call."""
        runs = [self._runs(text) for text in texts]
        absent = set().union(*runs).difference(self._recent)
        unknown = absent.difference(self._before)
        absent -= unknown
        new = list(unknown)
        self._recent.update((run, self._before[run]) for run in absent)
        self._recent.update(zip(new, map(len, self._tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        counts = [sum(map(self._recent.__getitem__, own)) for own in runs]
        for run in new:
            if len(run) > LONGEST_RUN:
                del self._recent[run]
            else:
                absent.add(run)
        # an entry of a dictionary takes some 100 bytes beside the run
        self.nbytes += sum(map(sys.getsizeof, absent)) + 100 * len(absent)
        if self.nbytes > GENERATION_BYTES:
            self._recent, self._before, self.nbytes = {}, self._recent, 0
        return counts


@lru_cache(maxsize=2)
def run_lengths(path: str) -> RunLengths:
    """The runs remembered in this Python worker, which later tasks find again."""
    return RunLengths(path)
