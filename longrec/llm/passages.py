"""Deletion of repeated passages wherever they begin and end, also inside lines.

A text is its sequence of words (runs without blanks).  A passage is a run of at least ``min_words`` words; it repeats
if the same words stood earlier.  Words are grouped into short runs, and of each window of ``min_words`` words the run
with the least hash is the seed (winnowing): equal windows have equal seeds, so each repeat has a seed that
occurs at two places.  Windows around shared seeds are compared whole, by two hashes of their words, with the first equal
one; the windows of a match that is longer overlap, so it is extended word by word in both directions, past the ends of lines,
and the words of all windows that stood earlier are deleted.

"Earlier" is the order of (id, text hash, word), null ids first.  In the same text a window counts as repeated only if it
begins after the first one ends, so a run that overlaps itself keeps its first copy.  Equal texts with
several ids are compared once; the later ones lose everything.

A deleted run goes with the blanks inside it.  Of the blanks around it those before go if those after hold a line
break or the text ends there; else those after go.

Defined results: null texts count as empty and come back as empty; a text that loses every word keeps the blanks at its
ends; rows with the same id and text are one document: each of them gets its result; texts of fewer words
than ``min_words`` never change; long texts are read whole; an empty table gives an empty result; other columns stay as they are.

Hashes of words and their minima over windows are numpy arrays inside tasks: with DataFrame functions alone they took more than twice
the CPU time allowed (README).  All joins, groups and deletions are DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longrec.llm.common import cut_lineage, free_name, possibly_in, ship, text_or_empty
from longrec.llm.words import SPACES, Words, mix, passes

DOCUMENT = ("id", "text_hash")
#: Words of a seed; less if ``min_words`` is below twice that.
SEED_WORDS = 8
#: Low bits of a seed that hold its place: more words than a text can have.
PLACE_BITS = 30


def _sliding(values: np.ndarray, size: int, combine: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Each element combined with the ``size - 1`` after it; the last ``size - 1`` are left out.

    Spans are doubled, so it takes log2(size) passes.  The two halves of the last step overlap.
    """
    span = 1
    while span < size:
        step = min(span, size - span)
        values = combine(values[:-step], values[step:])
        span += step
    return values


def _spread(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(data, offsets, SPACES, fold=False)


def _own_seeds(words: Words, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, seed) of each window's seed, each once."""
    size, place_mask = min(SEED_WORDS, (min_words + 1) // 2), np.uint64((1 << PLACE_BITS) - 1)
    if len(words.starts) < min_words:
        return (np.zeros(0, np.int64),) * 3
    runs = _sliding(words.hashes, size, _spread)
    place = np.arange(len(words.starts)) - words.first_word[words.row]
    both = runs & ~place_mask | place[: len(runs)].astype(np.uint64)
    least = _sliding(both, min_words - size + 1, np.minimum)
    # a window lies in one text; neighbours mostly share their seed
    inside = words.row[: len(least)] == words.row[min_words - 1 :]
    row, least = words.row[: len(least)][inside], least[inside]
    new = np.ones(len(row), bool)
    new[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    row, least = row[new], least[new]
    return row, (least & place_mask).astype(np.int64), (least >> np.uint64(PLACE_BITS)).astype(np.int64)


def _seeds(rows: DataFrame, min_words: int) -> DataFrame:
    """(text_hash, place, seed) of each window's seed, each once."""
    ship(rows.sparkSession)

    def run(batches):
        for batch in batches:
            for first, _, data, offsets in passes(batch.column("text")):
                row, place, seed = _own_seeds(_words(data, offsets), min_words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("text_hash").take(pa.array(first + row)), pa.array(place.astype(np.int32)), pa.array(seed)], ["text_hash", "place", "seed"]
                )

    return rows.select("text_hash", "text").mapInArrow(run, "text_hash long, place int, seed long").distinct()


def _lowest_and_highest(rows: DataFrame, keys: list[str], place: Column) -> DataFrame:
    """The first and the last place of each key that occurs at two."""
    return rows.groupBy(*keys).agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low != high")


def _windows(rows: DataFrame, holders: DataFrame, min_words: int) -> DataFrame:
    """(id, text_hash, start, k, k2): the windows around shared seeds and two hashes of their words, 96 bits in all."""
    seeds = cut_lineage(_seeds(rows, min_words))
    shared = cut_lineage(_lowest_and_highest(seeds, ["seed"], F.struct("text_hash", "place")).select("seed"))
    near = cut_lineage(seeds.join(shared, "seed", "left_semi").groupBy("text_hash").agg(F.collect_list("place").alias("places")))
    near = cut_lineage(near.join(holders, "text_hash").select(*DOCUMENT, "places"))
    wanted = near.select(F.col("id").alias("near_id"), F.col("text_hash").alias("near_hash"), "places")
    texts = possibly_in(rows, [*DOCUMENT], near.select(*DOCUMENT), "hit").where("hit")
    same = F.col("id").eqNullSafe(F.col("near_id")) & (F.col("text_hash") == F.col("near_hash"))
    texts = texts.join(wanted, same).select(*DOCUMENT, "places", "text")
    before = min_words - min(SEED_WORDS, (min_words + 1) // 2)
    id_type = texts.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            places = batch.column("places")
            for first, end, data, offsets in passes(batch.column("text")):
                words = _words(data, offsets)
                if len(words.starts) < min_words:
                    continue
                own = places.slice(first, end - first)
                row = np.repeat(np.arange(end - first), pc.list_value_length(own).to_numpy())
                at = own.flatten().to_numpy().astype(np.int64)
                begin = words.first_word[row]
                low = begin + np.maximum(at - before, 0)
                high = np.minimum(begin + at, words.first_word[row + 1] - min_words)
                # the starts from low to high, each once
                many = np.maximum(high - low + 1, 0)
                shift = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                starts = np.unique(np.repeat(low, many) + shift)
                owner = words.row[starts]
                k, k2 = (_sliding(h, min_words, _spread)[starts].view(np.int64) for h in (words.hashes, words.check_hash(words.starts, words.ends)))
                took = pa.array(first + owner)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(took), batch.column("text_hash").take(took), pa.array((starts - words.first_word[owner]).astype(np.int32)), pa.array(k), pa.array((k2 >> 32).astype(np.int32))],
                    [*DOCUMENT, "start", "k", "k2"],
                )

    return cut_lineage(texts.mapInArrow(run, f"id {id_type}, text_hash long, start int, k long, k2 int"))


def _runs(repeated: DataFrame, min_words: int) -> DataFrame:
    """(id, text_hash, runs): overlapping or touching windows as one run, in order."""
    in_order = Window.partitionBy(*DOCUMENT).orderBy("start")
    begins = F.coalesce(F.col("start") > F.lag("start").over(in_order) + min_words, F.lit(True))
    rows = repeated.withColumn("run", F.sum(begins.cast("int")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.groupBy(*DOCUMENT, "run").agg(F.min("start").alias("first"), (F.max("start") + min_words).alias("end"))
    return rows.groupBy(*DOCUMENT).agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("runs"))


def deleted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """(id, text_hash, runs): the words (first, end; from 0) that go, of documents that lose any."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    documents = cut_lineage(rows.select(*DOCUMENT).distinct())
    own = F.struct("id")
    holders = cut_lineage(documents.groupBy("text_hash").agg(F.min(own).alias("low"), F.max(own).alias("high")))
    windows = _windows(rows, holders.select("text_hash", F.col("low.id").alias("id")), min_words)
    first = cut_lineage(_lowest_and_highest(windows, ["k", "k2"], F.struct(*DOCUMENT, "start")).select("k", "k2", "low"))
    elsewhere = ~(F.col("id").eqNullSafe(F.col("low.id")) & (F.col("text_hash") == F.col("low.text_hash")))
    later = F.struct(*DOCUMENT, "start") > F.col("low")
    repeated = windows.join(first, ["k", "k2"]).where(later & (elsewhere | (F.col("start") >= F.col("low.start") + min_words)))
    found = _runs(repeated.select(*DOCUMENT, "start").distinct(), min_words)
    copies = holders.where("low != high").select("text_hash", "low")
    whole = documents.join(copies, "text_hash").where(own != F.col("low"))
    whole = whole.select(*DOCUMENT, F.array(F.struct(F.lit(0).alias("first"), F.lit(None).cast("int").alias("end"))).alias("runs"))
    return cut_lineage(found.unionByName(whole))


def _without(text: Column, pieces: Column, runs: Column) -> Column:
    """The text without the words of its runs.  ``pieces`` are its words with the blanks before them."""
    tail = F.substring(text, F.length(F.array_join(pieces, "")) + 1, F.length(text))

    def part(run: Column, at: Column) -> Column:
        """What stays between a run and the next, or the end."""
        last = at + 1 == F.size(runs)
        until = F.when(last, F.size(pieces)).otherwise(F.get(runs, at + 1)["first"])
        kept = F.array_join(F.slice(pieces, run["end"] + 1, until - run["end"]), "")
        after, before = F.regexp_extract(kept, r"^(\s*)", 1), F.regexp_extract(F.get(pieces, run["first"]), r"^(\s*)", 1)
        keep_after = (run["first"] > 0) & F.contains(after, F.lit("\n"))
        moved = F.concat(before, F.substring(kept, F.length(after) + 1, F.length(kept)))
        nothing = F.when(run["first"] == 0, before).otherwise("")
        return F.when(kept == "", nothing).when(keep_after, kept).otherwise(moved)

    head = F.array_join(F.slice(pieces, 1, F.get(runs, F.lit(0))["first"]), "")
    return F.concat(head, F.array_join(F.transform(runs, part), ""), tail)


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """``docs`` with the repeated passages deleted from its texts, and ``n_deleted`` words that went.

    ``n_deleted`` gets underscores if ``docs`` has that name already.
    """
    counted = free_name(docs, "n_deleted")
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names)
    found = deleted_runs(rows, at[id_col], at[text_col], min_words)
    text = text_or_empty(at[text_col])
    rows = rows.withColumns({"key": F.col(at[id_col]), "hash": F.xxhash64(text)})
    rows = possibly_in(rows, ["key", "hash"], found.select(*DOCUMENT), "hit")
    same = F.col("key").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("text_hash"))
    changed = rows.where("hit").join(found, same, "left")
    size = F.regexp_count(text, F.lit(r"\S+"))
    ends = F.transform("runs", lambda r: F.struct(r["first"].alias("first"), F.coalesce(r["end"], F.col("size")).alias("end")))
    changed = changed.withColumn("size", size).withColumn("runs", F.when(F.col("size") >= min_words, ends))
    pieces = F.when(F.col("runs").isNotNull(), F.regexp_extract_all(text, F.lit(r"\s*\S+"), F.lit(0)))
    changed = changed.withColumn("pieces", pieces)
    cleaned = F.when(F.col("runs").isNull(), text).otherwise(_without(text, F.col("pieces"), F.col("runs")))
    gone = F.aggregate("runs", F.lit(0), lambda total, r: total + r["end"] - r["first"])

    def result(part: DataFrame, new_text: Column, count: Column) -> DataFrame:
        columns = [new_text.alias(text_col) if n == at[text_col] else F.col(n).alias(c) for c, n in at.items()]
        return part.select(*columns, count.alias(counted))

    same_text = result(rows.where("not hit"), text, F.lit(0))
    return same_text.union(result(changed, cleaned, F.coalesce(gone, F.lit(0))))
