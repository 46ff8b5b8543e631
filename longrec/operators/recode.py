"""Metadata-driven transforms: change maps, dictionaries, recodes, merges and typing."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longrec.names import col
from longrec.functions.values import any_of, exact_number, graded, parse_choices, recode, to_long, to_number
from longrec.operators.columns import rename_with_families, with_families
from longrec.session import collect_small


@dataclass(frozen=True)
class Dictionary:
    """Field names in order with type, form, label and choices."""

    fields: tuple = ()

    def names(self, kind: str | None = None, forms: Sequence[str] | None = None) -> list[str]:
        """Field names of a type and of some forms."""
        return [
            f["name"]
            for f in self.fields
            if (kind is None or f["type"] == kind) and (forms is None or f["form"] in forms)
        ]

    def forms(self) -> dict[str, list[str]]:
        found: dict[str, list[str]] = {}
        for f in self.fields:
            found.setdefault(f["form"], []).append(f["name"])
        return found

    def choices(self, name: str) -> dict[str, str]:
        return parse_choices(next(f["choices"] for f in self.fields if f["name"] == name))

    def labelled(self, text: str, kind: str = "radio") -> list[str]:
        """Fields of a type whose label contains a text, in dictionary order."""
        return [f["name"] for f in self.fields if f["type"] == kind and f["label"] and text in f["label"]]

    def between(self, first: str, last: str, kind: str | None = None) -> list[str]:
        """Fields from ``first`` to ``last`` in dictionary order."""
        names = [f["name"] for f in self.fields]
        inside = self.fields[names.index(first) : names.index(last) + 1]
        return [f["name"] for f in inside if kind is None or f["type"] == kind]


#: Header of the dictionary export, in the order name, form, type, label, choices.
DICTIONARY_HEADER = (
    "Variable / Field Name", "Form Name", "Field Type", "Field Label", "Choices, Calculations, OR Slider Labels",
)


def read_dictionary(df: DataFrame, order_by: str | None = None, header: Sequence[str] = DICTIONARY_HEADER) -> Dictionary:
    """Bring a dictionary table to the driver; its size is checked."""
    short = ("name", "form", "type", "label", "choices")
    picked = df.select(
        *[(col(h) if h in df.columns else F.lit(None)).alias(s) for h, s in zip(header, short)],
        *([F.col(order_by).alias("__order")] if order_by else []),
    )
    rows = collect_small(picked)
    if order_by:
        rows = sorted(rows, key=lambda r: r["__order"])
    return Dictionary(tuple({s: r[s] for s in short} for r in rows))


@dataclass(frozen=True)
class Change:
    old: str
    new: str | None = None
    merge: str | None = None
    drop: bool = False
    replacements: str | None = None


@dataclass(frozen=True)
class ChangeMap:
    """What happens to each old variable."""

    changes: tuple = field(default=())

    @classmethod
    def from_table(cls, df: DataFrame) -> "ChangeMap":
        rows = collect_small(df)
        return cls(
            tuple(
                Change(
                    r["old_var"], r["new_var"] or r["old_var"], r["merge_var"],
                    str(r["drop"]) in ("1", "1.0"), r["opt_replacements"],
                )
                for r in rows
            )
        )

    def merges(self) -> dict[str, list[str]]:
        """Result variable -> the old variables merged into it."""
        found: dict[str, list[str]] = {}
        for c in self.changes:
            if c.merge:
                found.setdefault(c.merge, []).append(c.old)
        return found

    def renames(self) -> dict[str, str]:
        merged = self.merges()
        return {c.old: c.new or c.old for c in self.changes if (c.new or c.old) not in merged}

    def dropped(self) -> list[str]:
        return [c.new or c.old for c in self.changes if c.drop]

    def recodes(self) -> dict[str, dict[str, str]]:
        return {c.new or c.old: parse_choices(c.replacements) for c in self.changes if c.replacements}


def merge_sources(changes: DataFrame) -> DataFrame:
    """(merge_var, list of old variables): a metadata table, one row per changed variable."""
    return (
        changes.where(F.col("merge_var").isNotNull())
        .groupBy("merge_var")
        .agg(F.sort_array(F.collect_list("old_var")).alias("old_vars"))
    )


def rename_changed(df: DataFrame, changes: ChangeMap, dictionary: Dictionary) -> DataFrame:
    """Rename by change map; checkbox families follow, merge sources keep their names."""
    sources = {v for vs in changes.merges().values() for v in vs}
    renames = {old: new for old, new in changes.renames().items() if old not in sources}
    return rename_with_families(df, renames, dictionary.names("checkbox"))


def dropped_columns(columns: Sequence[str], changes: ChangeMap, dictionary: Dictionary, keys: Sequence[str]) -> list[str]:
    """Columns to drop: flagged ones, calculated fields, and names the dictionary does not know.

    A checkbox column or completion flag belongs to the dictionary with its field or form;
    merge sources and keys are always kept.
    """
    sources = {v for vs in changes.merges().values() for v in vs}
    known = set(dictionary.names())
    forms = set(dictionary.forms())
    flagged = set(with_families(columns, changes.dropped())) | set(dictionary.names("calc"))

    def unknown(c: str) -> bool:
        base = c.split("___", 1)[0]
        return base not in known and not (c.endswith("_complete") and c.removesuffix("_complete") in forms)

    return [c for c in columns if c not in keys and c not in sources and (c in flagged or unknown(c))]


def recode_values(df: DataFrame, recodes: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Replace whole values of several variables in one projection."""
    return df.withColumns({c: recode(col(c), dict(m)) for c, m in recodes.items() if c in df.columns})


def graded_merge(columns: Sequence[str]) -> Column:
    """Limb columns are those named ``_l`` or ``_r``; the other one is axial."""
    limbs = [c for c in columns if re.search("_(l|r)", c)]
    axial = [c for c in columns if c not in limbs]
    return graded(limbs, axial[0])


def merge_columns(
    df: DataFrame, merges: Mapping[str, Sequence[str]], rules: Mapping[str, Callable[[Sequence[str]], Column]] | None = None
) -> DataFrame:
    """Merge source columns into one each: "any" unless a rule is given; sources are dropped."""
    rules = rules or {}
    merged = {name: rules.get(name, any_of)([c for c in cs if c in df.columns]) for name, cs in merges.items()}
    sources = [c for cs in merges.values() for c in cs if c not in merges]
    return df.withColumns(merged).drop(*sources)


@dataclass(frozen=True)
class ColumnTyping:
    """Chosen type of a text column and the number of values that do not parse or lose digits."""

    column: str
    kind: str
    lost: int


def _typed_names(columns: Sequence[str], excluded: Sequence[str]) -> list[str]:
    return [c for c in columns if not any(c.startswith(p) for p in excluded)]


def typing_counts(columns: Sequence[str], excluded: Sequence[str] = ()) -> dict[str, Column]:
    """The aggregates that ``typing_plan`` needs, for a caller who gathers them while writing the table."""
    aggregates: dict[str, Column] = {}
    for i, c in enumerate(_typed_names(columns, excluded)):
        number = to_number(col(c))
        aggregates |= {
            f"v{i}": F.count(col(c)),
            f"n{i}": F.count(number),
            f"l{i}": F.count(to_long(col(c))),
            f"e{i}": F.count(exact_number(col(c))),
            f"w{i}": F.coalesce(F.bool_and(number == F.floor(number)), F.lit(False)),
        }
    return aggregates


def typing_plan(columns: Sequence[str], excluded: Sequence[str], row: Mapping) -> list[ColumnTyping]:
    """What the values of ``typing_counts`` say."""
    return [
        ColumnTyping(c, "long" if row[f"w{i}"] else "double", row[f"v{i}"] - row[f"l{i}" if row[f"w{i}"] else f"e{i}"])
        for i, c in enumerate(_typed_names(columns, excluded))
        if row[f"n{i}"]
    ]


def plan_numeric_types(df: DataFrame, columns: Sequence[str], excluded: Sequence[str] = ()) -> list[ColumnTyping]:
    """Which text columns become numbers: one aggregate over all of them.

    A column stays text if nothing parses or its name starts with an excluded prefix; it
    becomes an integer if all parsed values are whole.
    """
    aggregates = typing_counts(columns, excluded)
    row = df.agg(*[column.alias(name) for name, column in aggregates.items()]).first().asDict() if aggregates else {}
    return typing_plan(columns, excluded, row)


def apply_numeric_types(df: DataFrame, plan: Sequence[ColumnTyping]) -> DataFrame:
    """Cast the planned columns; values that do not parse become null."""
    return df.withColumns({t.column: (to_long if t.kind == "long" else to_number)(col(t.column)) for t in plan})
