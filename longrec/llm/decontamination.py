"""Benchmark passages inside documents, allowing for edits.

A text is its sequence of words (ASCII letters and U+00C0 to U+00DE in lower case, without signs and blanks of any script);
in scripts without blanks between words, as Chinese, Japanese or Thai, each character is one.  Item and window are
compared by the edit distance of their words.  A CGK random walk maps a window to a longer sequence: at
step j it writes the word it stands on and moves on if the j-th random bit of that word says so, so sequences
a few edits apart fall into step again and agree in most places.  Locality-sensitive hashing samples
places of that embedding; several walks, as many as a simulation of edited items needs for the
target recall (planned on one half of it, measured on the other), give each window several chances to meet its item.  All meetings are verified by the
exact edit distance.

Windows are item-sized (items of similar length share a class) and begin at every word that some item has; a window
that has too few words of the items, or too few of their rare words, cannot be within the distance of any, and is
left out beforehand.

Items travel with the tasks in blocks of at most ``BLOCK_WORDS`` words, one pass over the documents each, whose result is written
before the next block is read; an index is as large as the words of its items.  The documents are not shuffled (with
several blocks, those that may hold an item are joined with the hashes of those that do).

Defined results: null and empty texts match nothing, also as items; items with fewer than ``min_words`` words match without
edits only; repeated items or documents give a match each; ids
may be null; empty tables give no match, and with no item every document stays; long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from longrec.llm.common import cut_lineage, possibly_in, ship, text_or_empty
from longrec.llm.words import NON_WORD, Words, mix, passes

#: Words of benchmark items that travel with a task.
BLOCK_WORDS = 500_000
#: Bytes of text that one numpy pass takes.
PASS_BYTES = 1 << 20
#: Largest and smallest item of a length class differ by this factor at most.
CLASS_RATIO = 1.25
#: Bits (as a power of two) of the table of words that items have.
VOCABULARY_BITS = 22
#: Words that at most this part of the items have count as rare.
RARE_SHARE = 0.05
#: (places sampled by a hash, most walks tried with that many).
PLANS = ((3, 24), (2, 48), (1, 96))


def word_lists(texts: pa.Array) -> list[np.ndarray]:
    """Hashes of the words of each text."""
    lists = []
    for _, _, data, offsets in passes(texts):
        words = Words(data, offsets, NON_WORD, scripts=True)
        lists += np.split(words.hashes, words.first_word[1:-1])
    return lists


@dataclass
class Walks:
    """Random bits of the walks of one class and the places its hashes sample."""

    factors: np.ndarray  # walks x steps
    places: np.ndarray  # walks x places, ascending

    @classmethod
    def draw(cls, size: int, walks: int, places: int, seed: int) -> Walks:
        rng = np.random.default_rng(seed)
        steps = max(2 * size - 1, 1)
        factors = rng.integers(0, 1 << 63, (walks, steps), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        sampled = np.stack([np.sort(rng.choice(steps, min(places, steps), replace=False)) for _ in range(walks)])
        return cls(factors, sampled)

    def keys(self, walk: int, words: np.ndarray, starts: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """The hash of each window words[start:limit] by one walk.  ``words`` ends with one spare word."""
        at, key = starts.copy(), np.full(len(starts), walk + 1, np.uint64)
        wanted = set(self.places[walk].tolist())
        for step in range(int(self.places[walk][-1]) + 1):
            inside = at < limits
            here = words[at]
            if step in wanted:
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, here, np.uint64(0)))
            at += ((here * self.factors[walk, step]) >> np.uint64(63)).astype(np.int64) & inside
        return key


def edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """``words`` after random substitutions, insertions and deletions by new words."""
    result = words.tolist()
    for _ in range(edits):
        at, kind, new = int(rng.integers(len(result))), rng.random(), int(rng.integers(1, 1 << 63))
        if kind < 0.5:
            result[at] = new
        elif kind < 0.75:
            result.insert(at, new)
        elif len(result) > 1:
            del result[at]
    return np.array(result, np.uint64)


def plan_walks(size: int, edits: int, target: float, seed: int, pairs: int = 600) -> Walks:
    """Fewest walks that find ``target`` of simulated windows with the most edits allowed.

    One half of the windows plans; the walks are taken only where they find as many of the other half, which is drawn
    apart.  Where no plan does, the target is refused.
    """
    rng = np.random.default_rng(seed)
    originals = [rng.integers(1, 1 << 63, size + edits, dtype=np.uint64) for _ in range(pairs)]
    copies = [np.concatenate([edited(o[:size], edits, rng), rng.integers(1, 1 << 63, size, dtype=np.uint64)]) for o in originals]
    both, starts = [], []
    for texts in (originals, copies):
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        both.append(np.append(np.concatenate(texts), np.uint64(0)))
        starts.append(first[:-1])
    for places, most in PLANS:
        walks = Walks.draw(size, most, places, seed)
        found = np.zeros(pairs, bool)
        for walk in range(most):
            a, b = (walks.keys(walk, w, s, s + size) for w, s in zip(both, starts, strict=True))
            found |= a == b
            if found[: pairs // 2].mean() >= target and found[pairs // 2 :].mean() >= target:
                return Walks(walks.factors[: walk + 1], walks.places[: walk + 1])
    raise ValueError(f"no plan of walks finds {target} of windows of {size} words with {edits} edits")


@dataclass
class LengthClass:
    least: int  # words of its shortest item
    span: int  # words that a window may reach
    needed: int  # words of the span that items must have
    needed_rare: int  # the same of words that few items have
    items: np.ndarray
    walks: Walks
    keys: list[tuple[np.ndarray, np.ndarray]]  # sorted hashes, items


class ItemIndex:
    """Benchmark items of one block, ready to look for in texts."""

    def __init__(self, items: list[np.ndarray], max_edit_share: float, target: float, min_words: int, seed: int):
        self.words = items
        sizes = np.array([len(w) for w in items], np.int64)
        self.edits = np.where(sizes >= min_words, np.floor(sizes * max_edit_share + 1e-9), 0).astype(np.int64)
        used = np.flatnonzero(sizes)
        known = np.zeros(1 << VOCABULARY_BITS, bool)
        everything = np.concatenate([items[i] for i in used]) if len(used) else np.zeros(0, np.uint64)
        known[(everything & np.uint64(len(known) - 1)).astype(np.int64)] = True
        self._known = np.packbits(known)
        #: Words of all items, sorted; word number v is at v - 1, and 0 stands for every other word.
        self._vocabulary = np.unique(everything)
        #: The words each item has, by number: item * (words + 1) + word number, sorted.
        own_words = [np.unique(np.searchsorted(self._vocabulary, items[i]) + 1) + i * (len(self._vocabulary) + 1) for i in used]
        self._has = np.concatenate([np.zeros(0, np.int64), *own_words])
        holders = np.bincount(self._has % (len(self._vocabulary) + 1), minlength=len(self._vocabulary) + 1)
        self._rare = holders <= max(RARE_SHARE * len(used), 1)
        chosen = set(used.tolist())
        rare_words = np.array([self._rare[np.searchsorted(self._vocabulary, w) + 1].sum() if i in chosen else 0 for i, w in enumerate(items)], np.int64)
        self.classes: list[LengthClass] = []
        left = used[np.argsort(sizes[used], kind="stable")]
        while len(left):
            least = int(sizes[left[0]])
            own = left[sizes[left] <= least * CLASS_RATIO]
            left = left[len(own) :]
            longest = int(own[np.argmax(self.edits[own])])
            walks = plan_walks(least, int(self.edits[longest]), target, seed + least)
            padded = np.append(np.concatenate([items[i] for i in own]), np.uint64(0))
            starts = np.concatenate([[0], np.cumsum(sizes[own])])[:-1]
            keys = []
            for walk in range(len(walks.places)):
                key = walks.keys(walk, padded, starts, starts + least)
                order = np.argsort(key, kind="stable")
                keys.append((key[order], own[order]))
            span = int((sizes + self.edits)[own].max())
            self.classes.append(LengthClass(least, span, int((sizes[own] - self.edits[own]).min()), int((rare_words - self.edits)[own].min()), own, walks, keys))

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, distance, first word) of the best match of each pair of a pass."""
        none = (np.zeros(0, np.int64),) * 4
        words = Words(data, offsets, NON_WORD, scripts=True)
        n = len(words.starts)
        if not n or not self.classes:
            return none
        hashes = np.append(words.hashes, np.uint64(0))
        numbers = self._word_numbers(hashes)
        ends = words.first_word[1:][words.row]
        found = []
        for group in self.classes:
            held = self._held(group.items)
            known = held[numbers]
            starts = np.flatnonzero(known)
            reach = np.minimum(starts + group.span, ends[starts])
            for flags, needed in ((held & self._rare, group.needed_rare), (held, group.needed)):
                sums = np.concatenate([[0], np.cumsum(flags[numbers], dtype=np.int32)])
                enough = sums[reach] - sums[starts] >= needed
                starts, reach = starts[enough], reach[enough]
            if not len(starts):
                continue
            limits = np.minimum(starts + group.least, ends[starts])
            hits = []
            for walk, (keys, items) in enumerate(group.keys):
                key = group.walks.keys(walk, hashes, starts, limits)
                low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                met = np.flatnonzero(high > low)
                for shift in range(int((high - low).max(initial=0))):
                    own = met[low[met] + shift < high[met]]
                    hits.append(starts[own] * len(self.words) + items[low[own] + shift])
            if not hits:
                continue
            for start, item, distance in self._verified(np.unique(np.concatenate(hits)), hashes, numbers, ends):
                found.append((words.row[start], item, distance, start - words.first_word[words.row[start]]))
        if not found:
            return none
        text, item, distance, first = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((first, distance, item, text))
        text, item, distance, first = text[order], item[order], distance[order], first[order]
        best = np.ones(len(text), bool)
        best[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
        return text[best], item[best], distance[best], first[best]

    def _word_numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word among those of the items, 0 for others and for the spare word at the end."""
        slots = (hashes & np.uint64((1 << VOCABULARY_BITS) - 1)).astype(np.int64)
        likely = np.flatnonzero(np.unpackbits(self._known).astype(bool)[slots])
        at = np.minimum(np.searchsorted(self._vocabulary, hashes[likely]), len(self._vocabulary) - 1)
        numbers = np.zeros(len(hashes), np.int32)
        numbers[likely] = np.where(self._vocabulary[at] == hashes[likely], at + 1, 0)
        numbers[-1] = 0
        return numbers

    def _held(self, items: np.ndarray) -> np.ndarray:
        """Of each word number, whether one of the items has it."""
        held = np.zeros(len(self._vocabulary) + 1, bool)
        held[np.searchsorted(self._vocabulary, np.concatenate([self.words[i] for i in items])) + 1] = True
        return held

    def _has_word(self, item: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Whether each item has the word of that number."""
        wanted = item * (len(self._vocabulary) + 1) + number
        return self._has[np.minimum(np.searchsorted(self._has, wanted), len(self._has) - 1)] == wanted

    def _enough_words(self, start: np.ndarray, item: np.ndarray, numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Meetings whose window has as many words of its own item as the distance asks for."""
        size = np.array([len(self.words[i]) for i in item])
        count = np.zeros(len(item), np.int32)
        for t in range(int((size + self.edits[item]).max(initial=0))):
            there = (start + t < ends[start]) & (t < size + self.edits[item])
            count += there & self._has_word(item, numbers[np.minimum(start + t, len(numbers) - 1)])
        return count >= size - self.edits[item]

    def _verified(
        self, hits: np.ndarray, hashes: np.ndarray, numbers: np.ndarray, ends: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The meetings within the distance: the edit distance to the best prefix of each window."""
        start, item = np.divmod(hits, len(self.words))
        hits = hits[self._enough_words(start, item, numbers, ends)]
        for first in range(0, len(hits), 4096):
            start, item = np.divmod(hits[first : first + 4096], len(self.words))
            sizes = np.array([len(self.words[i]) for i in item])
            width = int(sizes.max())
            wanted = np.zeros((len(item), width), np.uint64)
            for row, i in enumerate(item):
                wanted[row, : sizes[row]] = self.words[i]
            steps = np.arange(width + 1)
            before = np.broadcast_to(steps, (len(item), width + 1)).astype(np.int32)
            best = before[np.arange(len(item)), sizes]
            for t in range(width + int(self.edits[item].max())):
                at = np.minimum(start + t, len(hashes) - 1)
                there = (start + t < ends[start]) & (t < sizes + self.edits[item])
                now = before + 1
                np.minimum(now[:, 1:], before[:, :-1] + (wanted != hashes[at][:, None]), out=now[:, 1:])
                now = np.minimum.accumulate(now - steps, axis=1) + steps
                before = np.where(there[:, None], now, before)
                best = np.minimum(best, before[np.arange(len(item)), sizes])
            near = best <= self.edits[item]
            yield start[near], item[near], best[near]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[list, list[np.ndarray], bool]]:
    """Items in blocks of bounded size, read one partition at a time, and whether the block is the only one."""
    ids, items, total, alone = [], [], 0, True
    rows = benchmark.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    for row in rows.toLocalIterator():
        own = word_lists(pa.array([row["text"]], pa.string()))[0]
        if items and total + len(own) > BLOCK_WORDS:
            alone = False
            yield ids, items, alone
            ids, items, total = [], [], 0
        ids.append(row["id"])
        items.append(own)
        total += len(own)
    if items:
        yield ids, items, alone


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", max_edit_share: float = 0.2, target_recall: float = 0.95, min_words: int = 5, seed: int = 17,
) -> DataFrame:
    """(id, item id, distance, item_words, first_word): each item that occurs in each document.

    A match has at most ``max_edit_share`` word edits per word of the item.  Of several places the
    nearest, then the first, is given.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    id_type, item_type = rows.schema["id"].dataType, benchmark.schema[item_id_col].dataType
    schema = f"id {id_type.simpleString()}, item {item_type.simpleString()}, distance int, item_words int, first_word long"
    item_kind = to_arrow_type(item_type)
    result = docs.sparkSession.createDataFrame([], schema)
    for number, (ids, items, alone) in enumerate(_blocks(benchmark, item_id_col, item_text_col)):
        index = ItemIndex(items, max_edit_share, target_recall, min_words, seed + number)
        item_ids, sizes = pa.array(ids, item_kind), np.array([len(w) for w in items])

        def run(batches, index=index, item_ids=item_ids, sizes=sizes):
            for batch in batches:
                for first, _, data, offsets in passes(batch.column("text"), PASS_BYTES):
                    text, item, distance, word = index.find(data, offsets)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(text + first)), item_ids.take(pa.array(item)),
                         pa.array(distance.astype(np.int32)), pa.array(sizes[item].astype(np.int32)), pa.array(word)],
                        ["id", "item", "distance", "item_words", "first_word"],
                    )

        found = rows.mapInArrow(run, schema)
        # the plan keeps the index until it has run
        result = result.unionByName(found if alone else cut_lineage(found))
    names = {"id": id_col, "item": item_id_col if item_id_col != id_col else "item"}
    return result.select(*(F.col(c).alias(names.get(c, c)) for c in result.columns))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    max_edit_share: float = 0.2, target_recall: float = 0.95, min_words: int = 5, seed: int = 17,
) -> DataFrame:
    """The rows of ``docs`` in which no item occurs; all columns stay, nothing is shuffled.

    With more than one block, the hashes of the texts that go are written for each, and rows that may have one are joined.
    """
    ship(docs.sparkSession)
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows, text = docs.toDF(*names), names[docs.columns.index(text_col)]
    gone = []
    for number, (_, items, alone) in enumerate(_blocks(benchmark, item_id_col, item_text_col)):
        held = _contains(ItemIndex(items, max_edit_share, target_recall, min_words, seed + number))(text_or_empty(text))
        if alone:
            return rows.where(~held).toDF(*docs.columns)
        gone.append(cut_lineage(rows.where(held).select(F.xxhash64(text_or_empty(text)).alias("hash")).distinct()))
    if not gone:
        return rows.toDF(*docs.columns)
    found = cut_lineage(reduce(DataFrame.unionByName, gone).distinct())
    rows = possibly_in(rows.withColumn("hash", F.xxhash64(text_or_empty(text))), ["hash"], found, "hit")
    kept = rows.where("not hit").select(*names).unionByName(rows.where("hit").join(found, "hash", "left_anti").select(*names))
    return kept.toDF(*docs.columns)


def _contains(index: ItemIndex):
    def contains(texts):
        found = np.zeros(len(texts), bool)
        for first, _, data, offsets in passes(texts, PASS_BYTES):
            found[first + index.find(data, offsets)[0]] = True
        return pa.array(found)

    contains.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(contains, "boolean")
