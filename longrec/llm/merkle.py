"""A Merkle manifest of a dataset: a tree of hashes for each part, a tree over the parts' roots, and a proof for each row.

Rows of a part stand in the order of ``order_by``; every ``fanout`` consecutive nodes (the last run may be shorter) become the hash of
their digests as text, until one is left.  The roots of the parts, ordered by part, become the root in the same way.

The leaves are dealt into aligned blocks of ``fanout ** block_levels`` rows, whose subtrees are built locally.  Then the blocks run a butterfly
exchange: in round r, the ``fanout`` blocks whose numbers differ in digit r alone swap the roots they have reached, and each hashes
the common ancestor itself.  After the last round every block knows all its siblings on the way up and the root, so nothing has
to be passed down.  Where the last subtree of a round has fewer blocks than its neighbours, its blocks
answer for the missing ones too.  A round moves one row for each block.

Positions come from a range partitioning by part and order (a part may be as large as it likes), counted within tasks; one row for
each task goes through the driver, where a part that spans tasks is carried over.

Defined results: null parts are one part, before all others; null order values come first; rows that agree in the order stand by leaf,
and those that agree in that too are alike for the tree; a single leaf is its own root with an empty proof; an empty table gives an empty result;
long values enter the hashes whole; columns of
any name may stand in the table, those to carry must not be named like those of the result (an error).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longrec.llm.common import cut_lineage, ship

#: Children of a node, and levels of a block's own subtree.
FANOUT, BLOCK_LEVELS = 16, 2
#: One level of a proof: the digests left and right of the node, one after the other.
STEP = "struct<left:string,right:string>"


def record_hash(columns: list[str]) -> Column:
    """The hash of a row: each value as ``-`` if null, else its UTF-8 bytes' count, ``:`` and itself."""

    def field(name: str) -> Column:
        text = F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, columns)).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """The hash of all siblings, level by level, left to right."""
    siblings = F.transform(proof, lambda step: F.concat(step["left"], step["right"]))
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)


def _place(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``position``: the place within the part, from 0 on; written out."""
    keys = ["part", *order, "leaf", "salt"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    # the salt only spreads rows that are alike over tasks
    ranged = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("salt")

    def count(batches):
        last, reached, parts = None, 0, 0
        for batch in batches:
            n, part = len(batch), batch.column("part")
            if not n:
                continue
            new = np.ones(n, bool)
            new[1:] = pc.not_equal(part[1:], part[:-1]).to_numpy(zero_copy_only=False)
            new[0] = last is None or part[0].as_py() != last
            here = np.arange(n)
            begin = np.maximum.accumulate(np.where(new, here, -1))
            within = np.where(begin >= 0, here - begin, here + reached)
            number = parts + np.cumsum(new)
            last, reached, parts = part[n - 1].as_py(), int(within[-1]) + 1, int(number[-1])
            task = np.full(n, TaskContext.get().partitionId(), np.int64)
            more = [pa.array(task), pa.array(within.astype(np.int64)), pa.array(number == 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "task", "within", "leading"])

    counted = cut_lineage(ranged.mapInArrow(count, f"{schema}, task long, within long, leading boolean"))
    ends = counted.groupBy("task").agg(
        F.min("part").alias("first"), F.max("part").alias("last"), (F.max(F.when(F.col("leading"), F.col("within"))) + 1).alias("head"),
        F.max_by(F.col("within") + 1, F.struct("part", "within")).alias("tail"),
    )
    part, reached, offsets = None, 0, []
    for row in ends.orderBy("task").collect():
        before = reached if row["first"] == part else 0
        if before:
            offsets.append((row["task"], before))
        part, reached = row["last"], row["tail"] + (before if row["first"] == row["last"] else 0)
    position = F.col("within")
    if offsets:
        # at most a row for each task
        table = counted.sparkSession.createDataFrame(offsets, "task long, before long")
        counted = counted.join(F.broadcast(table), "task", "left")
        position += F.when(F.col("leading"), F.coalesce("before", F.lit(0))).otherwise(0)
    return counted.withColumn("position", position).select(*rows.columns, "position")


def _levels(leaves: list[str], block: int, fanout: int, block_levels: int) -> list[list[str]]:
    """All nodes of a block's subtree, level by level.  A part of one block ends where one node is left."""
    levels = [leaves]
    while len(levels) <= block_levels and (block or len(levels[-1]) > 1):
        below = levels[-1]
        levels.append([hashlib.sha256("".join(below[k : k + fanout]).encode()).hexdigest() for k in range(0, len(below), fanout)])
    return levels


def _block_roots(placed: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """(part, block, node): the root of each block's subtree."""

    def root(key, table):
        leaves = table.sort_by("position").column("leaf").to_pylist()
        part, block = (k.as_py() for k in key)
        node = _levels(leaves, block, fanout, block_levels)[-1][0]
        return pa.table({"part": [part], "block": pa.array([block], pa.int64()), "node": [node]})

    return placed.select("part", "block", "position", "leaf").groupBy("part", "block").applyInArrow(root, "part string, block long, node string")


def _butterfly(roots: DataFrame, fanout: int) -> DataFrame:
    """(part, block, node, path): the root of the part and the way up from each block; written out."""
    roots = cut_lineage(roots)
    sizes = roots.groupBy("part").agg(F.count("*").alias("blocks"))
    state = roots.join(sizes, "part").withColumn("path", F.array().cast(f"array<{STEP}>"))
    most = sizes.agg(F.max("blocks")).head()[0] or 0
    done, stride = [], 1
    while stride < most:
        done.append(state.where(F.col("blocks") <= stride))
        state = _exchange(state.where(F.col("blocks") > stride), stride, fanout)
        stride *= fanout
    for early in done:
        state = state.unionByName(early)
    return cut_lineage(state.select("part", "block", "node", "path"))


def _exchange(state: DataFrame, stride: int, fanout: int) -> DataFrame:
    """One round: blocks whose numbers differ in one digit swap their nodes, and each hashes the ancestor."""
    lane, digit = F.expr(f"block % {stride}L"), F.expr(f"block div {stride}L % {fanout}L")
    # the last subtree may have fewer blocks than lanes: its blocks answer in the lanes of missing ones too
    last = F.expr(f"(blocks - 1) div {stride}L * {stride}L")
    lanes = F.when((F.col("block") >= last) & (digit > 0), F.sequence(lane, F.lit(stride - 1).cast("long"), F.col("blocks") - last)).otherwise(F.array(lane))
    sent = state.withColumns({"group": F.expr(f"block div {stride * fanout}L"), "digit": digit, "own": lane, "lane": F.explode(lanes)})
    met = F.sort_array(F.collect_list(F.struct("digit", "node")).over(Window.partitionBy("part", "group", "lane")))
    sent = sent.withColumn("met", met).where("lane = own")

    def beside(keep) -> Column:
        return F.array_join(F.transform(F.filter("met", lambda x: keep(x["digit"])), lambda x: x["node"]), "")

    sent = sent.withColumns({"left": beside(lambda d: d < F.col("digit")), "right": beside(lambda d: d > F.col("digit"))})
    node = F.sha2(F.concat("left", "node", "right").cast("binary"), 256)
    path = F.concat("path", F.array(F.struct("left", "right")))
    return sent.select("part", "block", "blocks", path.alias("path"), node.alias("node"))


def _leaf_paths(placed: DataFrame, upper: DataFrame, more: list[str], fanout: int, block_levels: int) -> DataFrame:
    """Rows of ``placed`` with their whole proof and the columns ``more`` of their block in ``upper``."""
    carried = [c for c in placed.columns if c not in ("block", "position")]
    fields = [placed.schema[c] for c in carried] + [upper.schema[c] for c in more]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", proof array<{STEP}>"

    def prove(key, own, above):
        own, block = own.sort_by("position"), key[1].as_py()
        levels = _levels(own.column("leaf").to_pylist(), block, fanout, block_levels)
        path = above.column("path").to_pylist()[0]
        left, right, places, n = [], [], [], len(own)
        for k, nodes in enumerate(levels[:-1]):
            places.append(len(left) + np.arange(n) // fanout**k)
            for i in range(len(nodes)):
                first = i - i % fanout
                left.append("".join(nodes[first:i]))
                right.append("".join(nodes[i + 1 : first + fanout]))
        for step in path:
            places.append(np.full(n, len(left)))
            left.append(step["left"])
            right.append(step["right"])
        steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"])
        at = np.stack(places, axis=1).ravel() if places else np.zeros(0, np.int64)
        proof = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(places), pa.int32()), steps.take(pa.array(at, pa.int64())))
        columns = [own.column(c) for c in carried] + [pa.array(above.column(c).to_pylist() * n, above.schema.field(c).type) for c in more]
        return pa.Table.from_arrays([*columns, proof], [*carried, *more, "proof"])

    return placed.groupBy("part", "block").cogroup(upper.groupBy("part", "block")).applyInArrow(prove, schema)


def manifest(
    rows: DataFrame, part_col: str, order_by: list[str], leaf: Column, carry: list[str], fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS
) -> DataFrame:
    """The columns of ``carry`` and leaf, subroot, root and proof (from the leaf up to the root) of each row.

    ``leaf`` is a hash as lower-case hex text, as ``record_hash`` makes it of columns.  The hashes of rows are
    written out first, so wide rows are read once.
    """
    clash = {c.lower() for c in carry} & {"leaf", "subroot", "root", "proof"}
    if clash:
        raise ValueError(f"cannot carry {sorted(clash)}: the result has columns of these names")
    ship(rows.sparkSession)
    block = F.expr(f"position div {fanout**block_levels}L")
    names = [f"c{k}" for k in range(len(carry) + len(order_by))]
    # nulls before all others
    part = F.coalesce(F.concat(F.lit("="), F.col(part_col).cast("string")), F.lit(""))
    narrow = rows.select(part.alias("part"), *(F.col(c).alias(n) for c, n in zip([*carry, *order_by], names, strict=True)), leaf.alias("leaf"))
    placed = _place(cut_lineage(narrow), names[len(carry) :]).drop(*names[len(carry) :]).withColumn("block", block)
    upper = _butterfly(_block_roots(placed, fanout, block_levels), fanout)
    # the tree of the parts' roots
    tops = upper.where("block = 0").select(F.lit("").alias("part"), F.col("part").alias("own"), F.col("node").alias("leaf"))
    top_placed = _place(tops, ["own"]).withColumn("block", block)
    top_upper = _butterfly(_block_roots(top_placed, fanout, block_levels), fanout).withColumnRenamed("node", "root")
    top = _leaf_paths(top_placed, top_upper, ["root"], fanout, block_levels)
    top = top.select(F.col("own").alias("part"), "root", F.col("proof").alias("rest"))
    both = upper.join(top, "part").select("part", "block", F.col("node").alias("subroot"), "root", F.concat("path", "rest").alias("path"))
    proven = _leaf_paths(placed, both, ["subroot", "root"], fanout, block_levels)
    return proven.select(*(F.col(n).alias(c) for c, n in zip(carry, names, strict=False)), "leaf", "subroot", "root", "proof")

