"""Long <-> wide reshaping of session records.

The set of output columns depends on the data.  ``profile_sessions`` finds it with one
aggregate (session labels and which variables hold values in each) and every reshaping
function accepts that profile, so that a caller who knows it pays no extra job.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longrec.names import col, quoted, renamed_columns
from longrec.operators.common_types import common_types

#: More sessions than this belong in long form.
MAX_SESSIONS = 5_000

#: With more labels than this a pivot gathers cells instead of testing every label per row.
MANY_LABELS = 200

SESSION_PREFIX = re.compile(r"s\d+_")


@dataclass(frozen=True)
class SessionProfile:
    """Session labels in ascending order, and the variables with any value in each."""

    filled: dict

    @property
    def sessions(self) -> list:
        return list(self.filled)

    def variables(self, sessions: Sequence, order: Sequence[str]) -> list[str]:
        """Variables with a value in any of ``sessions``, in the given order."""
        present = set().union(*[self.filled[s] for s in sessions]) if sessions else set()
        return [v for v in order if v in present]


def profile_sessions(
    df: DataFrame, session: str, variables: Sequence[str], max_sessions: int = MAX_SESSIONS
) -> SessionProfile:
    """One pass over the rows; the result has one row per session label."""
    counts = (
        df.where(F.col(session).isNotNull())
        .groupBy(session)
        .agg(*[F.count(col(v)).alias(f"n{i}") for i, v in enumerate(variables)], F.count(F.lit(1)).alias("rows"))
        .limit(max_sessions + 1)
        .collect()
    )
    if len(counts) > max_sessions:
        raise ValueError(f"more than {max_sessions} values of {session}: keep the table in long form")
    by_label = {row[0]: {v for i, v in enumerate(variables) if row[f"n{i}"]} for row in counts}
    return SessionProfile({label: by_label[label] for label in sorted(by_label)})


def _single(value: Column, label: str) -> Column:
    """The one value of a cell; a second row for the same cell is an error, never a choice."""
    return F.when(
        F.count(col(label)) > 1, F.raise_error(F.lit("more than one row for the same subject and session"))
    ).otherwise(value)


def _cell_value(df: DataFrame, variables: Sequence[str], labels: int) -> Column:
    """The variables of a cell's only row, as one struct.

    Few cells of fixed-width types are aggregated one by one, which keeps Spark on a hash
    aggregate; anything else is carried as a struct, with one buffer per label.
    """
    narrow = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if len(variables) * labels <= MANY_LABELS and all(isinstance(df.schema[v].dataType, narrow) for v in variables):
        return F.struct(*[F.max(col(v)).alias(v) for v in variables])
    return F.first(F.struct(*[col(v) for v in variables]))


def _pivot(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    values: Sequence,
    variables: Sequence[str],
    agg: Callable[[str], Column] | None,
) -> DataFrame:
    """One struct column per label holding the variables: a single shuffle by ``keys``.

    The buffers have a fixed size per key and are combined before the shuffle.  They cost one
    test per label and row, so beyond ``MANY_LABELS`` the cells are built per key and label
    first and then gathered: at most one entry per label, whatever the number of rows.
    """
    if agg is None:
        cell = _single(_cell_value(df, variables, len(values)), label)
    else:
        cell = F.struct(*[agg(quoted(v)).alias(v) for v in variables])
    if len(values) > MANY_LABELS:
        cells = df.groupBy(*keys, label).agg(cell.alias("cell"))
        # a key whose labels are all null keeps its row, with no entry
        entry = F.when(col(label).isNotNull(), F.struct(label, "cell"))
        gathered = cells.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))
        return gathered.select(
            *keys, *[F.try_element_at("cells", F.lit(v)).alias(f"__{i}") for i, v in enumerate(values)]
        )
    wide = df.groupBy(*keys).pivot(label, list(values)).agg(cell.alias("cell"))
    return wide.toDF(*keys, *[f"__{i}" for i in range(len(values))])


def wide_columns(names: list[tuple], sort: bool) -> list[tuple]:
    """Order (session position, variable) pairs by session, or by variable as given."""
    return sorted(names, key=lambda p: (p[0], p[1])) if sort else names


def flatten(
    df: DataFrame,
    key: str,
    session: str,
    prefix: str = "",
    sort: bool = True,
    profile: SessionProfile | None = None,
    bookkeeping: Sequence[str] = ("clinic_year", "session_number"),
    agg: Callable[[str], Column] | None = None,
    max_sessions: int = MAX_SESSIONS,
) -> DataFrame:
    """One row per subject: ``<prefix><session>_<variable>``.

    Session 0 (or ``'0'``) is the stable arm.  Subjects without a stable row are left out,
    subjects with nothing else are kept.  Variables without any value in an arm get no column
    there, and the ``bookkeeping`` variables get none for session 0.  Two rows for the same
    subject and session are an error unless ``agg`` says how to combine them.  More than
    ``max_sessions`` sessions are refused.
    """
    variables = [c for c in df.columns if c not in (key, session)]
    numeric = isinstance(df.schema[session].dataType, T.NumericType)
    zero = 0 if numeric else "0"
    known = profile or profile_sessions(df, session, variables, max_sessions)
    long_sessions = [s for s in known.sessions if (s > 0 if numeric else s != zero)]
    stable = known.variables([zero], variables) if zero in known.filled else []
    longitudinal = known.variables(long_sessions, variables)

    # the stable cell must exist even where all of its variables are null
    present = df.withColumn("__present", F.lit(1))
    arms = [zero, *long_sessions]
    wide = _pivot(
        present.where(F.col(session).isin(arms)) if len(arms) <= 100 else present,
        [key],
        session,
        arms,
        ["__present", *dict.fromkeys([*stable, *longitudinal])],
        agg if agg is None else (lambda v: F.max(v) if v == quoted("__present") else agg(v)),
    ).where(F.col("__0.__present").isNotNull())

    def block(names: list[str], sessions: list) -> list[tuple]:
        return wide_columns([(s, v) for v in names for s in sessions], sort)

    chosen = block(stable, [zero]) + block(longitudinal, long_sessions)
    chosen = [(s, v) for s, v in chosen if not (s == zero and v in bookkeeping)]
    position = {s: i for i, s in enumerate(arms)}
    return wide.select(
        key, *[F.col(f"__{position[s]}").getField(v).alias(f"{prefix}{s}_{v}") for s, v in chosen]
    )


def simple_flatten(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    prefix: str = "",
    sort: bool = True,
    profile: SessionProfile | None = None,
    agg: Callable[[str], Column] | None = None,
    max_sessions: int = MAX_SESSIONS,
) -> DataFrame:
    """One row per ``keys``: ``<prefix><label>_<variable>``, without columns that are all null."""
    variables = [c for c in df.columns if c not in (*keys, label)]
    known = profile or profile_sessions(df, label, variables, max_sessions)
    wide = _pivot(df, keys, label, known.sessions, variables, agg)
    names = wide_columns([(s, v) for v in variables for s in known.sessions], sort)
    position = {s: i for i, s in enumerate(known.sessions)}
    return wide.select(
        *keys,
        *[
            F.col(f"__{position[s]}").getField(v).alias(f"{prefix}{s}_{v}")
            for s, v in names
            if v in known.filled[s]
        ],
    )


def double_flatten(
    df: DataFrame,
    key: str,
    session: str,
    instrument: str,
    prefix: str = "s",
    agg: Callable[[str], Column] | None = None,
    max_sessions: int = MAX_SESSIONS,
) -> DataFrame:
    """``<prefix><session>_<instrument>_<score>``: both levels in one pivot.

    A subject's sessions that lack an instrument stay null.  Columns follow the session, then
    instrument and score.
    """
    scores = [c for c in df.columns if c not in (key, session, instrument)]
    cell = "__cell"
    labelled = df.where(F.col(instrument).isNotNull()).withColumn(
        cell, F.concat_ws("\u0001", F.col(session).cast("string"), F.col(instrument))
    )
    known = profile_sessions(labelled.drop(session, instrument), cell, scores, max_sessions)
    wide = _pivot(labelled, [key], cell, known.sessions, scores, agg)
    position = {s: i for i, s in enumerate(known.sessions)}
    columns = []
    for label in known.sessions:
        visit, test = label.split("\u0001", 1)
        columns += [(visit, f"{test}_{score}", label, score) for score in scores if score in known.filled[label]]
    columns.sort(key=lambda c: (c[0], c[1]))
    return wide.select(
        key,
        *[F.col(f"__{position[label]}").getField(score).alias(f"{prefix}{v}_{name}") for v, name, label, score in columns],
    )


def without_session(name: str) -> str:
    """A column name without its session."""
    return SESSION_PREFIX.sub("", name, count=1) if SESSION_PREFIX.match(name) else name


def prefix_default_session(columns: Sequence[str], default: str = "s1") -> dict[str, str]:
    """``{name: s1_name}`` for the names that carry no session."""
    return {c: f"{default}_{c}" for c in columns if not SESSION_PREFIX.match(c)}


def drop_default_session(df: DataFrame, renamed: dict[str, str]) -> DataFrame:
    """Undo ``prefix_default_session`` after the table was reshaped back."""
    return renamed_columns(df, {new: old for old, new in renamed.items()})


def expand(
    df: DataFrame, key: str, session: str = "session_number", default: str = "s1"
) -> tuple[DataFrame, dict[str, str]]:
    """One row per subject and session from ``s<k>_<variable>`` columns.

    Unprefixed columns count as session ``default``.  Sessions without any value vanish.  Also
    returns the names that were given the default prefix.  Narrow: no shuffle.  A variable whose columns have different
    types gets the least type that loses no value.
    """
    renamed = prefix_default_session([c for c in df.columns if c != key], default)
    cells: dict[str, dict[str, str]] = {}
    for column in df.columns:
        if column == key:
            continue
        visit, variable = renamed.get(column, column).split("_", 1)
        if variable in cells.setdefault(visit, {}):
            raise ValueError(f"{column} and {cells[visit][variable]} are the same variable of session {visit}")
        cells[visit][variable] = column
    variables = list(dict.fromkeys(v for visit in cells.values() for v in visit))
    types = common_types([df], {v: [(0, visit[v]) for visit in cells.values() if v in visit] for v in variables})

    def row(visit: str) -> Column:
        own = cells[visit]
        fields = [
            (col(own[v]) if v in own else F.lit(None)).cast(types[v]).alias(v) for v in variables
        ]
        return F.struct(F.lit(visit).alias(session), *fields)

    visits = sorted(cells, key=lambda s: (int(s[1:]) if s[1:].isdigit() else 0, s))
    # a session is emitted only if one of its own variables holds a value
    slots = F.array(*[F.when(_any_value(list(cells[s].values())), row(s)) for s in visits])
    long = df.select(key, F.explode(slots).alias("__row")).where(F.col("__row").isNotNull())
    return long.select(key, "__row.*"), renamed


def _any_value(columns: Sequence[str]) -> Column:
    found = col(columns[0]).isNotNull()
    for c in columns[1:]:
        found = found | col(c).isNotNull()
    return found


def suffix_to_prefix(columns: Sequence[str]) -> dict[str, str]:
    """``x_s2`` -> ``s2_x``."""
    found = {c: re.search(r"^(.*)_(s\d+)$", c) for c in columns}
    return {c: f"{m.group(2)}_{m.group(1)}" for c, m in found.items() if m}


def reshape_direction(df: DataFrame, key: str) -> str:
    """``'expand'`` where every subject has one row, else ``'flatten'``."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("ids"), F.max(F.col(key).isNull()).alias("null")).first()
    return "expand" if row["rows"] == row["ids"] + bool(row["null"]) else "flatten"


def reshape(df: DataFrame, direction: str | None = None, sort: bool = True, bookkeeping: Sequence[str] = ()) -> DataFrame:
    """Convert between one row per session and one row per subject.

    The first column is the subject, and the second the session in the long form.
    """
    key = df.columns[0]
    chosen = direction or reshape_direction(df, key)
    if chosen == "expand":
        return expand(renamed_columns(df, suffix_to_prefix(df.columns)), key)[0]
    session = df.columns[1]
    prefix = "s" if isinstance(df.schema[session].dataType, T.IntegralType) else ""
    return flatten(df, key, session, prefix=prefix, sort=sort, bookkeeping=bookkeeping)


def long_transpose(df: DataFrame, key: str) -> DataFrame:
    """(variable, subject, value) as text: the transpose that stays distributed."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("variable"), col(c).cast("string").alias("value"))
            for c in df.columns
            if c != key
        ]
    )
    return df.select(F.explode(cells).alias("cell"), F.col(key)).select("cell.variable", key, "cell.value")


def transpose_small(df: DataFrame, key: str, max_rows: int = 1_000) -> DataFrame:
    """Subjects as columns, for a result that fits a screen; larger ones use ``long_transpose``."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"more than {max_rows} rows: use long_transpose")
    texts = [col(c).cast("string").alias(c) for c in df.columns if c != key]
    return df.select(key, *texts).transpose().withColumnRenamed("key", "variable")


def slopes_wide(slopes: DataFrame, keys: Sequence[str], variable: str = "variable", variables: Sequence[str] | None = None) -> DataFrame:
    """``<variable>_<statistic>`` per subject, ordered by variable, then statistic."""
    stats = sorted(c for c in slopes.columns if c not in (*keys, variable))
    names = sorted(variables) if variables else profile_sessions(slopes, variable, stats).sessions
    wide = _pivot(slopes, keys, variable, names, stats, None)
    return wide.select(
        *keys, *[F.col(f"__{i}").getField(s).alias(f"{v}_{s}") for i, v in enumerate(names) for s in stats]
    )


def blocks_wide(
    df: DataFrame, key: str, block: str, measure: str, sides: Sequence[str], max_sessions: int = MAX_SESSIONS
) -> DataFrame:
    """``<block>_<measure>_<side>`` in lower case, all blocks of a subject side by side."""
    cell = "__cell"
    labelled = df.where(F.col(measure).isNotNull()).select(
        key, F.lower(F.concat_ws("_", F.col(block), F.col(measure))).alias(cell), *sides
    )
    known = profile_sessions(labelled, cell, list(sides), max_sessions)
    wide = _pivot(labelled, [key], cell, known.sessions, list(sides), None)
    kept = {s for s in sides if any(s in filled for filled in known.filled.values())}
    return wide.select(
        key,
        *[
            F.col(f"__{i}").getField(side).alias(f"{label}_{side.lower()}")
            for i, label in enumerate(known.sessions)
            for side in sides
            if side in kept
        ],
    )
