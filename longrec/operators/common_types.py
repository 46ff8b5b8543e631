"""The type that holds the values of several columns without losing any."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longrec.names import col

#: Digits that every value of a whole-number type fits into.
WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
#: Whole numbers up to here are exact in a double.
EXACT_IN_DOUBLE = 1 << 53
MOST_DIGITS = 38


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """(digits before the point, digits after it) of an exact number type."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    name = kind.simpleString()
    return (WHOLE_DIGITS[name], 0) if name in WHOLE_DIGITS else None


def wider(one: T.DataType, other: T.DataType, exact: bool = False) -> T.DataType:
    """The least type that holds both without loss; text where no other does.

    Whole numbers and decimals grow as they need.  With a double, they become double if all values of
    the type fit, or where the caller found that those of the columns do (``exact``).
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if isinstance(one, T.NumericType) and isinstance(other, T.NumericType):
        exactly = [_digits(t) for t in (one, other)]
        if all(exactly):
            whole, after = (max(d[k] for d in exactly) for k in (0, 1))
            if after == 0 and not any(isinstance(t, T.DecimalType) for t in (one, other)):
                return max((one, other), key=lambda t: WHOLE_DIGITS[t.simpleString()])
            return T.DecimalType(whole + after, after) if whole + after <= MOST_DIGITS else T.StringType()
        known = [d for d in exactly if d]
        # a double has 15 decimal digits for certain
        return T.DoubleType() if exact or all(w + a <= 15 and a == 0 for w, a in known) else T.StringType()
    dates = (T.DateType, T.TimestampNTZType)
    if isinstance(one, dates) and isinstance(other, dates):
        return T.TimestampNTZType()
    return T.StringType()


def undecided(types: Sequence[T.DataType]) -> bool:
    """Whether the values decide if the columns have a common number type: long or decimal with a double."""
    numeric = all(isinstance(t, (T.NumericType, T.NullType)) for t in types)
    return numeric and isinstance(common(types), T.StringType) and any(_digits(t) is None for t in types)


def common(types: Sequence[T.DataType], exact: bool = False) -> T.DataType:
    """``wider`` of all types."""
    # the exact ones first, so that the result does not depend on the order
    ordered = sorted(types, key=lambda t: isinstance(t, (T.DoubleType, T.FloatType)))
    result = ordered[0]
    for t in ordered[1:]:
        result = wider(result, t, exact)
    return result


def exact_in_double(df: DataFrame, columns: Sequence[str]) -> dict[str, bool]:
    """Whether a double holds every value of the number columns as it is: one aggregate, none for types that always fit."""
    open_columns, result = [], dict.fromkeys(columns, True)
    for c in columns:
        digits = _digits(df.schema[c].dataType)
        if digits and (sum(digits) > 15 or digits[1]):
            open_columns.append(c)
    if open_columns:
        # the longest decimal text of a double that is read back has 17 digits
        kept = [F.coalesce(F.bool_and(col(c).cast("double").try_cast(df.schema[c].dataType).eqNullSafe(col(c))), F.lit(True)).alias(str(i))
                for i, c in enumerate(open_columns)]
        row = df.agg(*kept).first()
        result.update({c: row[i] for i, c in enumerate(open_columns)})
    return result


def common_types(tables: Sequence[DataFrame], columns: Mapping[str, Sequence[tuple[int, str]]]) -> dict[str, T.DataType]:
    """The type of each result column, from its sources: (table, column) pairs.

    Only where a long or decimal meets a double are values looked at, with one aggregate for each table.
    """
    types = {name: [tables[i].schema[c].dataType for i, c in own] for name, own in columns.items()}
    asked = [name for name in columns if undecided(types[name])]
    exact = {name: True for name in asked}
    for i, table in enumerate(tables):
        wanted = {name: [c for j, c in columns[name] if j == i] for name in asked}
        own = sorted({c for cs in wanted.values() for c in cs})
        found = exact_in_double(table, own) if own else {}
        for name, cs in wanted.items():
            exact[name] = exact[name] and all(found[c] for c in cs)
    return {name: common(types[name], exact.get(name, False)) for name in columns}
