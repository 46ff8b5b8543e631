"""Joins.  All equi joins; small sides are broadcast by Spark's own size check or a counted hint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longrec.names import col, quoted
from longrec.operators.common_types import common_types

ORIGINAL = "_original"


def enrich_left(
    df: DataFrame, other: DataFrame, left_on: Sequence[str], right_on: Sequence[str], fields: Sequence[str]
) -> DataFrame:
    """Bring in ``fields``; columns of the table that collide become ``<name>_original``."""
    kept = df.withColumnsRenamed({c: c + ORIGINAL for c in df.columns if c in fields and c not in left_on})
    keys = [f"__key{i}" for i in range(len(right_on))]
    # fields are copied before the keys are renamed, so that a key may be among them
    side = other.select(*[col(c).alias(k) for c, k in zip(right_on, keys)], *[col(c) for c in fields if c not in left_on])
    on = [kept[quoted(c)] == side[k] for c, k in zip(left_on, keys)]
    return kept.join(side, on, "left").drop(*keys)


def undo_enrich(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Drop the brought-in fields and give the original columns their names back."""
    dropped = df.drop(*fields)
    return dropped.withColumnsRenamed({f + ORIGINAL: f for f in fields if f + ORIGINAL in dropped.columns})


def merge_fill(base: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join; base values win, incoming ones fill their nulls.

    Both sides must be unique in ``keys`` for the result to be, and keys must not be null: plain
    equality lets sides that are already partitioned by the keys stay where they are.
    """
    shared = [c for c in base.columns if c in incoming.columns and c not in keys]
    added = [c for c in incoming.columns if c not in base.columns]
    joined = base.alias("b").join(incoming.alias("i"), list(keys), "full")
    return joined.select(
        *keys,
        *[
            F.coalesce(F.col(f"b.`{c}`"), F.col(f"i.`{c}`")).alias(c) if c in shared else F.col(f"b.`{c}`")
            for c in base.columns
            if c not in keys
        ],
        *[F.col(f"i.`{c}`") for c in added],
    )


def stable_left_long(stable: DataFrame, long: DataFrame, key: str) -> DataFrame:
    """Keep every stable subject, with or without longitudinal columns."""
    return stable.join(long, key, "left")


def densify(df: DataFrame, key: str, axis: str, values: Sequence) -> DataFrame:
    """Exactly one row per subject and listed value; others vanish, missing ones are null.

    The list is exploded per subject: the grid is never the product of two tables.
    """
    kind = df.schema[axis].dataType
    grid = df.select(key).distinct().withColumn(axis, F.explode(F.array(*[F.lit(v).cast(kind) for v in values])))
    rest = [c for c in df.columns if c not in (key, axis)]
    return (
        grid.alias("g").join(df.alias("d"), [key, axis], "left").select(key, axis, *[F.col(f"d.`{c}`") for c in rest])
    )


def join_mappings(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of two mapping tables."""
    return left.join(right, list(on), "inner")


def subject_lookup(df: DataFrame, per_subject: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join of one row per subject."""
    return df.join(per_subject.select(key, *columns), key, "left")


def union_missing(*tables: DataFrame) -> DataFrame:
    """Union by name; columns a table lacks are null in its rows.

    Columns of different types get the least type that loses no value (``common_types``): longs beside doubles stay
    numbers only where a double holds all of them, and become text else.
    """
    columns: dict[str, list[tuple[int, str]]] = {}
    for i, table in enumerate(tables):
        for c in table.columns:
            columns.setdefault(c, []).append((i, c))
    kinds = common_types(tables, {c: own for c, own in columns.items() if len(own) > 1})
    result = None
    for table in tables:
        odd = {c: col(c).cast(kinds[c]) for c in table.columns if c in kinds and table.schema[c].dataType != kinds[c]}
        table = table.withColumns(odd) if odd else table
        result = table if result is None else result.unionByName(table, allowMissingColumns=True)
    return result
