"""N-gram Jaccard self-join with adaptive multi-match prefixes, down to connected components.

Two texts link when their sets of word shingles have a Jaccard similarity of at least 0.8.  All
shingles follow one global order, rare ones first.  If two sets overlap in at least t shingles, the first
|s| - t + l shingles of each share at least l, for every l <= t: longer prefixes allow
a stricter test.  Each set picks its own l by the estimated cost of its candidates.

1. One scan makes each text's set size and signature, and counts shingles in a sketch of fixed
   size, from which the global order is taken.  Texts with equal sets become one class.
2. A second scan emits prefixes; prefix shingles of one class alone are dropped at once.
3. Each class is verified against three classes of each of its shared prefix shingles; the
   links found so make components.  Large groups of near copies end here, at linear cost.
4. Classes of different components that share a prefix shingle are joined with the adaptive
   prefixes and verified.  Pairs inside one component can add nothing and are never made, nor
   are pairs at crowded shingles that an exact bound by parity bits rules out.  A sketch of fixed size cannot tell all common
   shingles from rare ones in a large input.  So where shingles of many components would make many pairs, those, now
   counted exactly, move to the end of the order and the prefixes are taken again (``_reordered``).

No pair is lost or capped: step 4 is complete for pairs between the components of step 3.  Sets are compared by
64-bit shingle hashes.

Defined results: null and empty texts, and texts of white space, have no shingles, link with nothing
and are their own component; a text of fewer than five words has its whole sequence as its one shingle;
repeated rows are copies of each other; a null id is never the smallest of a component unless
all its ids are null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longrec.llm.common import cut_lineage, possibly_in, ship, text_or_empty
from longrec.llm.components import components as connected
from longrec.llm.shingles import distinct_sorted, shingles
from longrec.llm.words import mix, passes

#: Buckets (as a power of two) of the sketch of shingle counts, whatever the input.
SKETCH_BITS = 17
#: Bits (as a power of two) of the filter that names the texts whose sets are needed: 4 MB.
FILTER_BITS = 25
#: Largest number of shared prefix shingles that a set may ask for.
MOST_MATCHES = 8
#: A pair enters step 3 if it shares this part of the smaller set's prefix; step 4 sees the others.
STAR_SHARE = 0.3
#: Rows of a prefix shingle from which its classes count as crowded.
CROWD = 64
#: Pairs at crowded shingles for each prefix row from which the order is mended, and how often it may be.
MANY_PAIRS, MOST_ORDERS = 100, 3
#: Rows of a prefix shingle from which it counts as common: shingles of more levels come later in the order.
LEVELS = (64, 1 << 10, 1 << 14)
#: Bits (as a power of two) of the filters that name common shingles: 2 MB a level.
LEVEL_BITS = 24
#: Columns of 64 parity bits of a set.
BITS = [f"b{i}" for i in range(8)]
#: Cost of verifying a candidate, in units of one shared prefix shingle, for each shingle of the set.
VERIFY_COST = 0.05


def _ceil(numerator: Column, denominator: int) -> Column:
    return F.floor((numerator + (denominator - 1)) / F.lit(denominator))


def _probe_prefix(n: Column, matches) -> Column:
    """Prefix length of the larger set of a pair: an overlap of 0.8 n is needed."""
    return n - _ceil(n * 4, 5) + matches


def _index_prefix(n: Column, matches) -> Column:
    """Prefix length of the smaller set of a pair: an overlap of 8/9 n is needed."""
    return n - _ceil(n * 8, 9) + matches


def _classes(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The size of each set and a 64-bit number that equal sets share."""
    n = np.diff(begin)
    totals = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values), out=totals[1:])
    return n, mix(totals[begin[1:]] - totals[begin[:-1]] + n.astype(np.uint64)).view(np.int64)


def _parity(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each set's parity bits (sets x len(BITS) numbers): bit i is odd where i has an odd number of shingles."""
    width = 64 * len(BITS)
    bits = np.zeros((len(n), len(BITS)), np.int64)
    rows = np.repeat(np.arange(len(n)), n)
    places = rows * width + (mix(values) % np.uint64(width)).astype(np.int64)
    for first in range(0, len(n), 1024):
        last = min(first + 1024, len(n))
        a, b = np.searchsorted(rows, [first, last])
        odd = np.bincount(places[a:b] - first * width, minlength=(last - first) * width) & 1
        bits[first:last] = np.packbits(odd.astype(bool).reshape(last - first, width), axis=1, bitorder="little").view(np.int64)
    return bits


def _signatures(rows: DataFrame, id_type: str) -> DataFrame:
    """(id, n, c, parity bits) of each text; after each task's texts its sketch as rows (bucket, seen)."""
    names = ["id", "n", "c", *BITS, "bucket", "seen"]

    def run(batches):
        seen = np.zeros(1 << SKETCH_BITS, np.int64)
        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            for first, end, data, offsets in passes(batch.column("text")):
                values, begin = distinct_sorted(*shingles(data, offsets))
                seen += np.bincount((values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(seen))
                n, signature = _classes(values, begin)
                bits = _parity(values, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, end - first), pa.array(n), pa.array(signature, mask=n == 0),
                     *(pa.array(bits[:, i]) for i in range(len(BITS))), pa.nulls(end - first, pa.int32()), pa.nulls(end - first, pa.int64())],
                    names,
                )
        if kind is not None:
            used = np.flatnonzero(seen)
            none = pa.nulls(len(used), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(used), kind), none, none, *[none] * len(BITS), pa.array(used.astype(np.int32)), pa.array(seen[used])],
                names,
            )

    longs = ", ".join(f"{name} long" for name in names[1:-2])
    return rows.mapInArrow(run, f"id {id_type}, {longs}, bucket int, seen long")


def _ranks(sketch: DataFrame) -> np.ndarray:
    """0 for the buckets of rare shingles; above that the larger, the further a bucket stands out.

    A shingle that many texts have lifts its bucket out of the spread of all buckets, at any size of the input.
    """
    counts = np.zeros(1 << SKETCH_BITS)
    for bucket, seen in sketch.groupBy("bucket").agg(F.sum("seen")).collect():  # at most 2 ** SKETCH_BITS rows
        counts[bucket] = seen
    middle = np.median(counts)
    spread = 1.5 * np.median(np.abs(counts - middle)) + 1
    above = np.maximum((counts - middle) / (6 * spread), 0.5)
    return np.clip(np.floor(2 * np.log2(above)) + 1, 0, 63).astype(np.uint64)


def _order(values: np.ndarray, ranks: np.ndarray, common: list[np.ndarray]) -> np.ndarray:
    """Numbers in the global order: six bits of rank, then the upper bits of the shingle.  Common ones come last, by level."""
    rank = np.minimum(ranks[(values >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], np.uint64(63 - len(LEVELS)))
    upper = values >> np.uint64(6)
    slot = (upper & np.uint64((1 << LEVEL_BITS) - 1)).astype(np.int64)
    for level, bits in enumerate(common, 1):
        in_level = bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1
        rank = np.where(in_level > 0, np.uint64(63 - len(LEVELS) + level), rank)
    return rank << np.uint64(58) | upper


def _prefixes(rows: DataFrame, ranks: np.ndarray, common: list[np.ndarray]) -> DataFrame:
    """(t, c, n, pos): the prefix shingles of each class, each class once a task."""

    def run(batches):
        known: set[int] = set()
        for batch in batches:
            for _, _, data, offsets in passes(batch.column("text")):
                values, begin = distinct_sorted(*shingles(data, offsets))
                n, signature = _classes(values, begin)
                ordered = _order(values, ranks, common)
                length = np.minimum(n, n - -(-4 * n // 5) + MOST_MATCHES)
                parts, owners = [], []
                for text, key in enumerate(signature.tolist()):
                    if n[text] and key not in known:
                        known.add(key)
                        own = np.sort(ordered[begin[text] : begin[text + 1]])
                        parts.append(own[: length[text]])
                        owners.append(text)
                if not parts:
                    continue
                sizes = length[owners]
                tokens = np.concatenate(parts)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array(np.repeat(signature[owners], sizes)),
                     pa.array(np.repeat(n[owners], sizes).astype(np.int32)),
                     pa.array((np.arange(len(tokens)) - np.repeat(ends - sizes, sizes)).astype(np.int32))],
                    ["t", "c", "n", "pos"],
                )

    return rows.select("text").mapInArrow(run, "t long, c long, n int, pos int")


def _shared_prefixes(prefixes: DataFrame) -> DataFrame:
    """Prefix rows whose shingle several classes have, with the number of its rows.

    Shingles of often seen buckets (the upper bits of t) skip the window, which would bring all
    rows of one shingle to one task, and are counted by an aggregate and a join.
    """
    prefixes = cut_lineage(prefixes)
    often = F.shiftrightunsigned("t", 58) > 0
    by_class = Window.partitionBy("t").orderBy("c")
    whole = by_class.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rare = prefixes.where(~often).withColumns(
        {"low": F.first("c").over(whole), "high": F.last("c").over(whole), "before": F.lag("c").over(by_class),
         "holders": F.count(F.lit(1)).over(whole)}
    )
    rare = rare.where("low != high and (before is null or before != c)").drop("low", "high", "before")
    often_rows = prefixes.where(often).distinct()
    counted = cut_lineage(often_rows.groupBy("t").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1"))
    return cut_lineage(rare.unionByName(often_rows.join(counted, "t")))


def _sets(rows: DataFrame, classes: DataFrame, needed: DataFrame) -> DataFrame:
    """(c, shingles) of the classes ``needed`` (c), from the text of one member each.

    A bitmap of fixed size names the members.  The few others that it lets through join with nothing, and a
    class that several tasks send gives the same link several times.
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS)) + 1
    members = needed.join(classes, "c").select(F.col("rep").alias("id")).select(slot.alias("slot"))
    parts = members.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    packed = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for part, own in parts.collect():  # at most 2 ** FILTER_BITS bits
        packed[(part - 1) * 4096 : part * 4096] = np.frombuffer(bytes(own), np.uint8)

    def run(batches):
        known: set[int] = set()
        for batch in batches:
            at = batch.column("slot").to_numpy() - 1
            chosen = np.flatnonzero(packed[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            if not len(chosen):
                continue
            for _, _, data, offsets in passes(batch.column("text").take(pa.array(chosen))):
                values, begin = distinct_sorted(*shingles(data, offsets))
                n, signature = _classes(values, begin)
                lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values.view(np.int64)))
                new = [i for i, c in enumerate(signature.tolist()) if n[i] and not (c in known or known.add(c))]
                yield pa.RecordBatch.from_arrays([pa.array(signature), lists], ["c", "shingles"]).take(pa.array(new, pa.int64()))

    return rows.select(slot.alias("slot"), "text").mapInArrow(run, "c long, shingles array<long>")


def _verified(rows: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (x, y) whose sets are similar enough, some several times.

    Nothing is aggregated above the joins, so Spark can split them at a class with very many pairs.
    """
    sets = _sets(rows, classes, pairs.select(F.explode(F.array("x", "y")).alias("c")).distinct())
    at_x = sets.select(F.col("c").alias("x"), F.col("shingles").alias("sx"))
    at_y = sets.select(F.col("c").alias("y"), F.col("shingles").alias("sy"))
    both = F.size(F.array_intersect("sx", "sy"))
    similar = both * 100 >= (F.size("sx") + F.size("sy") - both) * 80
    return cut_lineage(pairs.join(at_x, "x").join(at_y, "y").where(similar).select("x", "y"))


def _near_in_size(a: str, b: str) -> Column:
    return (F.least(a, b) * 10) >= (F.greatest(a, b) * 8)


def _star_pairs(shared: DataFrame) -> DataFrame:
    """Each class with three classes of each of its shared prefix shingles, where it shares much with them.

    These are the first, the last and the most central one: the class whose whole prefix is shared most.  In
    a group of near copies that is the text with the fewest edits, which most others link to.
    """
    central = cut_lineage(shared.groupBy("c").agg(F.sum("holders").alias("weight")))
    member = F.struct("c", "n")
    ends = shared.join(central, "c").groupBy("t").agg(
        F.min(member).alias("first"), F.max(member).alias("last"), F.max(F.struct("weight", "c", "n")).alias("central")
    )
    ends = cut_lineage(ends.select("t", F.array("first", "last", F.struct("central.c", "central.n")).alias("ends")))
    near = shared.join(ends, "t").select("c", "n", F.explode(F.array_distinct("ends")).alias("end"))
    near = near.where((F.col("c") != F.col("end.c")) & _near_in_size("n", "end.n")).select(
        F.least("c", "end.c").alias("x"), F.greatest("c", "end.c").alias("y"), F.least("n", "end.n").alias("n")
    )
    counted = near.groupBy("x", "y", "n").agg(F.count(F.lit(1)).alias("common"))
    return cut_lineage(counted.where(F.col("common") >= STAR_SHARE * _index_prefix(F.col("n"), 1)).select("x", "y"))


def _between(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Prefix rows of shingles that classes of several components have, with their component and the number of rows."""
    own = shared.select("t", "c", "n", "pos").join(roots.select(F.col("node").alias("c"), "root"), "c", "left")
    own = own.withColumn("root", F.coalesce("root", "c"))
    mixed = own.groupBy("t").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("holders")).where("low != high")
    return cut_lineage(own.join(cut_lineage(mixed.select("t", "holders")), "t"))


def _reordered(rows: DataFrame, ranks: np.ndarray, shared: DataFrame, roots: DataFrame) -> DataFrame:
    """``_between`` of prefixes in an order whose common shingles, where they would make many pairs, were counted exactly.

    Any order gives the same links.  A common shingle is named by filters of fixed size, which may name others too.
    """
    own, common = _between(shared, roots), [np.zeros(1 << (LEVEL_BITS - 3), np.uint8) for _ in LEVELS]
    for _ in range(MOST_ORDERS - 1):
        crowd = F.col("holders") >= LEVELS[0]
        # each row of a shingle meets all its rows
        row = own.agg(F.sum(F.when(crowd, F.col("holders"))).alias("pairs"), F.count(F.lit(1)).alias("rows")).first()
        if (row["pairs"] or 0) <= MANY_PAIRS * row["rows"]:
            break
        slot = F.col("t").bitwiseAND((1 << LEVEL_BITS) - 1) + 1
        for bits, least in zip(common, LEVELS, strict=True):
            slots = own.where(F.col("holders") >= least).select(slot.alias("slot"))
            parts = slots.groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
            for part, own_bits in parts.collect():  # at most 2 ** LEVEL_BITS bits
                bits[(part - 1) * 4096 : part * 4096] |= np.frombuffer(bytes(own_bits), np.uint8)
        own = _between(_shared_prefixes(_prefixes(rows, ranks, common)), roots)
    return own


def _adaptive_pairs(classes: DataFrame, own: DataFrame) -> DataFrame:
    """Pairs of classes of different components that pass the adaptive prefix test.

    At crowded shingles a pair must also pass an exact bound: the parity bits of two sets differ in no
    more places than the sets have shingles apart, which may be a ninth of their sizes at most.
    """
    n, costs = F.col("n"), []
    for matches in range(1, MOST_MATCHES + 1):
        inside = F.sum(F.when(F.col("pos") < _probe_prefix(n, matches), F.col("holders")).otherwise(0))
        costs.append(F.struct((inside * (1 + VERIFY_COST * n / matches)).alias("cost"), F.lit(matches).alias("matches")))
    picked = own.groupBy("c", "n").agg(F.array(*costs).alias("costs"))
    allowed = F.filter("costs", lambda x: x["matches"] <= F.greatest(_ceil(n * 4, 5), F.lit(1)))
    picked = cut_lineage(picked.select("c", F.array_min(allowed)["matches"].alias("matches")))
    calm = own.where(F.col("holders") < CROWD).withColumns({b: F.lit(None).cast("long") for b in BITS})
    own = calm.unionByName(own.where(F.col("holders") >= CROWD).join(classes.select("c", *BITS), "c"))
    probe = own.join(picked, "c").where(F.col("pos") < _probe_prefix(n, F.col("matches")))
    probe = probe.select(
        "t", F.col("c").alias("x"), F.col("n").alias("xn"), F.col("root").alias("xr"), "matches", *(F.col(b).alias(f"x{b}") for b in BITS)
    )
    index = own.where(F.col("pos") < _index_prefix(n, MOST_MATCHES))
    index = index.select(
        "t", F.col("c").alias("y"), F.col("n").alias("yn"), F.col("root").alias("yr"), F.col("pos").alias("yp"),
        *(F.col(b).alias(f"y{b}") for b in BITS),
    )
    apart = sum((F.bit_count(F.col(f"x{b}").bitwiseXOR(F.col(f"y{b}"))) for b in BITS), F.lit(0))
    # null, so possible, where the shingle is not crowded
    possible = F.coalesce(apart * 9 <= F.col("xn") + F.col("yn"), F.lit(True))
    smaller = (F.col("yn") < F.col("xn")) | ((F.col("yn") == F.col("xn")) & (F.col("y") < F.col("x")))
    pairs = probe.join(index, "t").where(
        possible & smaller & (F.col("yn") * 10 >= F.col("xn") * 8) & (F.col("xr") != F.col("yr"))
        & (F.col("yp") < _index_prefix(F.col("yn"), F.col("matches")))
    )
    counted = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("common"), F.first("matches").alias("matches"))
    return cut_lineage(counted.where("common >= matches").select("x", "y"))


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id of its component)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    scanned = cut_lineage(_signatures(rows, rows.schema["id"].dataType.simpleString()))
    own = scanned.where("bucket is null")
    classes = own.where("c is not null").groupBy("c").agg(F.min("id").alias("rep"), *(F.min(b).alias(b) for b in BITS))
    classes, own = cut_lineage(classes), own.select("id", "n", "c")
    ranks = _ranks(scanned.where("bucket is not null"))
    shared = _shared_prefixes(_prefixes(rows, ranks, []))
    near = _verified(rows, classes, _star_pairs(shared))
    first_roots = connected(near)
    more = _verified(rows, classes, _adaptive_pairs(classes, _reordered(rows, ranks, shared, first_roots)))
    roots = connected(near.unionByName(more)) if not more.isEmpty() else first_roots
    classes = classes.select("c", "rep")
    linked = roots.join(classes, F.col("node") == F.col("c"))
    least = cut_lineage(linked.groupBy("root").agg(F.min("rep").alias("least")))
    named = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").join(least, "root", "left")
    named = cut_lineage(named.select("c", F.coalesce("least", "rep").alias("component_id")))
    result = own.join(named, "c", "left")
    component = F.when(F.col("c").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return result.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; all columns stay.

    Rows with a null id, and several rows with the id that stays, all stay.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names, strict=True))
    rows = docs.toDF(*names)
    found = similar_components(rows, at[id_col], at[text_col])
    dropped = found.where(F.col(at[id_col]) != F.col("component_id")).select(at[id_col]).distinct()
    dropped = cut_lineage(dropped)
    rows = possibly_in(rows, [at[id_col]], dropped, "hit")
    kept = rows.where("hit").join(dropped, at[id_col], "left_anti").select(*names)
    return rows.where("not hit").select(*names).unionByName(kept).toDF(*docs.columns)
