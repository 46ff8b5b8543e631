"""Allow and block lists over URLs: a trie of reversed host labels and path segments, longest match first.

A rule is (host, path, verdict).  It fits a URL whose host is the rule's or a subdomain of it and whose path starts with
the rule's.  Of the rules that fit, the one with the most host labels counts, then the one with the longest path, that is
the deepest in the trie; of a rule given both ways, ``block`` counts.  URLs that no rule fits get the default verdict.

The trie is numpy arrays: distinct labels, and sorted (node, label) edges.  A batch of URLs walks it together, one level at
a time, with exact comparison of the labels.  It is broadcast, ``BLOCK_BYTES`` of rules at most; a longer list goes in blocks, one
pass over the URLs each, written before the next is read, and the deepest match over all blocks counts.

Defined results: a null URL, and one without ``://``, has an empty host and path, which only rules with an empty host and
path fit; hosts are compared with A-Z in lower case, paths as they are; ports and names of users belong to the host;
long URLs are read whole; repeated URLs and rows are judged each on its own; rules with a null verdict or host are left out, a null path
is empty; no rules leave every URL to the default; an empty table gives an empty result.  Columns of
``pages`` that are named like those of the result are replaced by them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longrec.llm.common import cut_lineage, ship

#: Bytes of the texts of the rules in one broadcast trie; its arrays take at most about ten times as much.
BLOCK_BYTES = 4 << 20
ALLOW, BLOCK = "allow", "block"
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Host up to the first of these signs; path from there to one of the last two.
_PARTS = r"://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), *LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


class _Edges:
    """Edges from a node by a label to a node (or rule), as sorted keys."""

    def __init__(self, edges: dict[tuple[int, str], int]):
        self.labels = pa.array(sorted({label for _, label in edges}), pa.string())
        number = {label: k for k, label in enumerate(self.labels.to_pylist())}
        keys = np.array([node * len(number) + number[label] for node, label in edges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ends = keys[order], np.array(list(edges.values()), np.int64)[order]

    def follow(self, nodes: np.ndarray, labels: pa.Array) -> np.ndarray:
        """Where each edge leads, -1 where there is none."""
        result = np.full(len(nodes), -1)
        if not len(self.keys):
            return result
        number = pc.fill_null(pc.index_in(labels, self.labels), -1).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero((number >= 0) & (nodes >= 0))
        wanted = nodes[rows] * len(self.labels) + number[rows]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        result[rows] = np.where(self.keys[at] == wanted, self.ends[at], -1)
        return result


class Trie:
    """Rules of one block.  Node 0 is the root; hosts lead from it, paths from the nodes of hosts.

    The part of a rule's path after its last slash may be the beginning of a segment; it leads from the node of the
    segments before it to the rule.
    """

    def __init__(self, rules: list[tuple[str, str, str]]):
        best: dict[tuple[str, str], str] = {}
        for host, path, verdict in rules:
            key = (host.translate(str.maketrans(*LOWER)), path)
            best[key] = BLOCK if BLOCK in (verdict, best.get(key)) else verdict
        hosts, paths, tails, nodes = {}, {}, {}, 1
        self.texts, self.verdicts = [], []
        for (host, path), verdict in sorted(best.items()):
            node = 0
            for label in reversed(host.split(".")) if host else ():
                nodes += (node, label) not in hosts
                node = hosts.setdefault((node, label), nodes - 1)
            *segments, tail = path.split("/")
            for segment in segments:
                nodes += (node, segment) not in paths
                node = paths.setdefault((node, segment), nodes - 1)
            tails[node, tail] = len(self.texts)
            self.texts.append(host + path)
            self.verdicts.append(verdict)
        self.sizes = np.array([len(p) for _, p in sorted(best)], np.int64)
        self.host_depth = max((len(h.split(".")) for h, _ in best), default=0)
        self.path_depth = max((p.count("/") for _, p in best), default=0)
        self.tail_sizes = sorted({len(tail) for _, tail in tails})
        self.hosts, self.paths, self.tails = _Edges(hosts), _Edges(paths), _Edges(tails)
        #: Nodes from which a path or the end of one leads on.
        self.open = np.zeros(nodes, bool)
        self.open[[node for node, _ in (*paths, *tails)]] = True

    def match(self, hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The deepest rule of each URL (-1: none) and the host labels of that rule."""
        n = len(hosts)
        labels = _Parts(pc.split_pattern(hosts, ".", max_splits=self.host_depth, reverse=True), backwards=True)
        segments = _Parts(pc.split_pattern(paths, "/", max_splits=self.path_depth + 1))
        rule, depth = np.full(n, -1), np.zeros(n, np.int64)
        # an empty host has no labels
        labels.count[pc.equal(hosts, "").to_numpy(zero_copy_only=False)] = 0
        nodes = np.zeros(n, np.int64)
        for level in range(self.host_depth + 1):
            found = self._match_path(nodes, segments)
            hit = found >= 0
            rule[hit], depth[hit] = found[hit], level
            if level < self.host_depth:
                nodes = np.where(labels.count > level, self.hosts.follow(nodes, labels.at(level)), -1)
        return rule, depth

    def _match_path(self, nodes: np.ndarray, segments: _Parts) -> np.ndarray:
        rows = np.flatnonzero((nodes >= 0) & self.open[nodes])
        rule = np.full(len(nodes), -1)
        at = nodes[rows]
        for level in range(self.path_depth + 1):
            if not len(rows):
                break
            here = segments.at(level, rows)
            for size in self.tail_sizes:
                tail = pc.utf8_slice_codeunits(here, 0, size) if size else pa.array([""] * len(rows))
                found = self.tails.follow(at, tail)
                rule[rows[found >= 0]] = found[found >= 0]
            # a segment is whole where another follows
            at = np.where(segments.count[rows] > level + 1, self.paths.follow(at, here), -1)
            rows, at = rows[at >= 0], at[at >= 0]
        return rule


class _Parts:
    """The k-th part of each text of a list column."""

    def __init__(self, parts: pa.ListArray, backwards: bool = False):
        offsets = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset : parts.offset + len(parts) + 1].astype(np.int64)
        self.values, self.first, self.end, self.backwards = parts.values, offsets[:-1], offsets[1:], backwards
        self.count = np.diff(offsets)

    def at(self, level: int, rows: np.ndarray | slice = slice(None)) -> pa.Array:
        first, end = self.first[rows], self.end[rows]
        place = end - 1 - level if self.backwards else first + level
        there = (place >= first) & (place < end)
        return self.values.take(pa.array(np.where(there, place, 0), mask=~there))


def _blocks(rules: DataFrame, block_bytes: int) -> Iterator[tuple[list[tuple[str, str, str]], bool]]:
    """Rules in blocks of bounded size, and whether the block is the only one."""
    block, size, alone = [], 0, True
    wanted = rules.select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host is not null and verdict is not null")
    for host, path, verdict in wanted.toLocalIterator():
        own = len(host.encode()) + len(path.encode())
        if block and size + own > block_bytes:
            alone = False
            yield block, alone
            block, size = [], 0
        block.append((host, path, verdict))
        size += own
    if block:
        yield block, alone


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``pages`` with host, path, rule (host and path of the rule that counts, else null) and verdict.

    ``rules`` has host, path and verdict (``allow`` or ``block``).
    """
    spark = pages.sparkSession
    ship(spark)
    names = [f"c{i}" for i in range(len(pages.columns))]
    url = F.col(names[pages.columns.index(url_col)])
    best_type = "struct<depth:long,size:long,rule:string,verdict:string>"
    result = pages.toDF(*names).withColumns({"host": url_host(url), "path": url_path(url), "best": F.lit(None).cast(best_type)})
    for block, alone in _blocks(rules, block_bytes):
        result = result.withColumn("fresh", _matcher(spark.sparkContext.broadcast(Trie(block)), best_type)(F.col("host"), F.col("path")))
        deeper = F.struct("fresh.depth", "fresh.size") > F.struct("best.depth", "best.size")
        # of one rule in two blocks, block counts
        deeper |= (F.col("fresh.rule") == F.col("best.rule")) & (F.col("fresh.verdict") == BLOCK)
        take = F.col("fresh").isNotNull() & (F.col("best").isNull() | deeper)
        result = result.withColumn("best", F.when(take, F.col("fresh")).otherwise(F.col("best"))).drop("fresh")
        # one trie at a time
        result = result if alone else cut_lineage(result)
    own = {"host": F.col("host"), "path": F.col("path"), "rule": F.col("best.rule"), "verdict": F.coalesce("best.verdict", F.lit(default))}
    kept = [F.col(n).alias(c) for n, c in zip(names, pages.columns, strict=True) if c.lower() not in own]
    return result.select(*kept, *(column.alias(name) for name, column in own.items()))


def _matcher(shared, kind: str):
    def match(host, path):
        trie = shared.value
        rule, depth = trie.match(host, path)
        none = pa.array(rule < 0)
        at = pa.array(np.maximum(rule, 0))
        columns = [
            pa.array(depth), pa.array(trie.sizes).take(at), pa.array(trie.texts, pa.string()).take(at), pa.array(trie.verdicts, pa.string()).take(at),
        ]
        return pa.StructArray.from_arrays(columns, ["depth", "size", "rule", "verdict"], mask=none)

    match.__annotations__ = {"host": pa.Array, "path": pa.Array, "return": pa.Array}
    return F.arrow_udf(match, kind)


def allowed(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = ALLOW) -> DataFrame:
    """The rows of ``pages`` whose verdict is ``allow``, with the same columns."""
    names = [f"c{i}" for i in range(len(pages.columns))]
    judged = judge(pages.toDF(*names), rules, names[pages.columns.index(url_col)], default)
    return judged.where(F.col("verdict") == ALLOW).select(*names).toDF(*pages.columns)
