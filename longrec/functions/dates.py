"""Date and age expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longrec.names import col

DAYS_PER_YEAR = 365.25

#: Years of two digits from here on belong to the last century.
CENTURY_PIVOT = 69
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

_MONTH = "(" + "|".join("sep(?:t(?:ember)?)?" if m == "september" else f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + ")"
_WEEKDAY = "^(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*[,.]? )?"
_TIME = r"(?:[ t,]+(\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d{1,6})?)\d*)?(?: ?([ap])\.?m\.?)?)?$"
_YEAR, _DAY = r"(\d{4}|\d{2})", r"(\d{1,2})(?:st|nd|rd|th)?"


def _shape(pattern: str, kind: str, year: int, month: int, day: int) -> tuple[str, str]:
    """(pattern of a way to write a date, its parts in one order); the groups of year, month and day are given, 0 for the first day."""
    time = max(year, month, day) + 1
    groups = [f"${year}", f"${month}", f"${day}" if day else "1", *(f"${time + k}" for k in range(4))]
    return _WEEKDAY + pattern + _TIME, "|".join([kind, *groups])


#: Dates whose pattern does not tell the order of day and month, then all others.
EITHER, KNOWN = "e", "k"
SHAPES = (
    _shape(rf"(\d{{1,2}})[-/.](\d{{1,2}})[-/.]{_YEAR}", EITHER, 3, 1, 2),
    _shape(r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})", KNOWN, 1, 2, 3),
    _shape(r"(\d{4})(\d{2})(\d{2})", KNOWN, 1, 2, 3),
    _shape(rf"{_DAY}[- ]?{_MONTH}[.,]?[- ]*{_YEAR}", KNOWN, 3, 2, 1),
    _shape(rf"{_MONTH}\.?[- ]{_DAY},?[- ]+{_YEAR}", KNOWN, 3, 1, 2),
    _shape(rf"(\d{{4}})[- ]{_MONTH}[- ](\d{{1,2}})", KNOWN, 1, 2, 3),
    _shape(r"(\d{4})[-/.](\d{1,2})", KNOWN, 1, 2, 0),
    _shape(rf"{_MONTH}[.,]?[- ]+(\d{{4}})", KNOWN, 2, 1, 0),
)


def _with_parts(value: Column, function: Callable[[Column], Column]) -> Column:
    """``function`` of the parts of a text date (kind, year, month, day, hour, minute, second, a or p), found once."""
    text = F.translate(F.lower(F.regexp_replace(F.trim(value), r"\s+", " ")), "|", "!")
    for pattern, parts in SHAPES:
        # what one pattern has rewritten, no other matches
        text = F.regexp_replace(text, pattern, parts)
    return F.get(F.transform(F.array(F.split(text, r"\|", -1)), function), F.lit(0))


def _moment(parts: Column, swapped: bool) -> Column:
    year, month, day, hour, minute, second, half = (F.get(parts, F.lit(k)) for k in (1, *((3, 2) if swapped else (2, 3)), 4, 5, 6, 7))
    full = year.try_cast("int")
    full = F.when(F.length(year) == 2, full + F.when(full >= CENTURY_PIVOT, 1900).otherwise(2000)).otherwise(full)
    named = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.substring(month, 1, 3)).cast("int")
    clock = F.coalesce(hour.try_cast("int"), F.lit(0))
    clock = F.when(half == "", clock).when(clock.between(1, 12), clock % 12 + F.when(half == "p", 12).otherwise(0))
    seconds = F.coalesce(second.try_cast("decimal(16,6)"), F.lit(0).cast("decimal(16,6)"))
    return F.try_make_timestamp_ntz(
        full, F.coalesce(month.try_cast("int"), named), day.try_cast("int"), clock, F.coalesce(minute.try_cast("int"), F.lit(0)), seconds
    )


def _either_way(parts: Column) -> tuple[Column, Column]:
    """The moment with the month first and with the day first, of dates that the pattern leaves open."""
    either = F.get(parts, F.lit(0)) == EITHER
    return F.when(either, _moment(parts, False)), F.when(either, _moment(parts, True))


def parse_date(value: Column, day_first: bool = False) -> Column:
    """Timestamp of a text date; text that is none becomes null.

    ``day_first`` settles dates such as 1/2/2019; where only one order is a date, that one counts.
    """

    def read(parts: Column) -> Column:
        ways = _moment(parts, False), F.when(F.get(parts, F.lit(0)) == EITHER, _moment(parts, True))
        return F.coalesce(*(ways[::-1] if day_first else ways))

    iso = F.trim(value)
    # other ISO forms, as with a time zone
    return F.coalesce(_with_parts(value, read), F.when(iso.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), iso.try_cast("timestamp_ntz")))


@dataclass(frozen=True)
class DatePlan:
    """How the dates of a text column are read, and what spoke for it.

    ``values`` are all texts, ``unread`` those that are no date.  ``day_proofs`` and ``month_proofs`` can be read in one order only;
    ``open`` could be either.
    """

    column: str
    day_first: bool
    values: int
    unread: int
    day_proofs: int
    month_proofs: int
    open: int

    @property
    def ambiguous(self) -> bool:
        """Whether the order of some dates is a guess: no value proves one, or some prove each."""
        return self.open > 0 and (self.day_proofs > 0) == (self.month_proofs > 0)


def plan_dates(df: DataFrame, columns: Sequence[str], day_first: bool = False) -> list[DatePlan]:
    """One aggregate over all columns; ``day_first`` counts where a column's values prove neither order or as many each."""
    read, counts = [], []
    for i, c in enumerate(columns):
        ways = _with_parts(col(c), lambda p: F.struct(*(m.alias(n) for m, n in zip(_either_way(p), ("month", "day"), strict=True))))
        read += [col(c).isNotNull().alias(f"there{i}"), parse_date(col(c)).isNotNull().alias(f"read{i}"), ways.alias(f"ways{i}")]
        month, day = F.col(f"ways{i}.month"), F.col(f"ways{i}.day")
        tests = {
            "values": F.col(f"there{i}"), "unread": F.col(f"there{i}") & ~F.col(f"read{i}"), "day": month.isNull() & day.isNotNull(),
            "month": month.isNotNull() & day.isNull(), "open": month != day,
        }
        counts += [F.count(F.when(test, 1)).alias(f"{name}{i}") for name, test in tests.items()]
    if not counts:
        return []
    row, plans = df.select(*read).agg(*counts).first(), []
    for i, c in enumerate(columns):
        day, month = row[f"day{i}"], row[f"month{i}"]
        plans.append(DatePlan(c, day > month if day != month else day_first, row[f"values{i}"], row[f"unread{i}"], day, month, row[f"open{i}"]))
    return plans


def apply_dates(df: DataFrame, plans: Sequence[DatePlan]) -> DataFrame:
    """The planned columns as timestamps; texts that are no dates become null."""
    return df.withColumns({p.column: parse_date(col(p.column), p.day_first) for p in plans})


def read_dates(df: DataFrame, columns: Sequence[str], day_first: bool = False) -> DataFrame:
    """The text columns among ``columns`` as timestamps, each in the order that its own values show."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    return apply_dates(df, plan_dates(df, texts, day_first)) if texts else df


def _clock(moment: Column) -> Column:
    exact = moment.cast("timestamp_ntz")
    return exact - exact.cast("date").cast("timestamp_ntz")


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole days between two moments, rounded down: independent of the session time zone."""
    days = F.datediff(end.cast("date"), start.cast("date"))
    return days - (_clock(end) < _clock(start)).cast("int")


def age(birth: Column, at: Column) -> Column:
    """Age in years: elapsed whole days over 365.25."""
    return elapsed_days(birth, at) / F.lit(DAYS_PER_YEAR)


def best_age(imaging: Column, session: Column) -> Column:
    """The imaging age where it is above 0, else the session age."""
    return F.when(imaging > 0, imaging).otherwise(session)


def duration(session_age: Column, onset_age: Column) -> Column:
    """Years since onset; an onset age of 0 is an age like any other."""
    return session_age - onset_age


def session_number(start_year: Column, clinic_year: Column) -> Column:
    """Number of the clinic counted from the start year; 0 is no session."""
    return F.nullif(clinic_year.cast("int") - start_year.cast("int") + 1, F.lit(0))
