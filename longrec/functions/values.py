"""Typing, recoding and score expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from longrec.names import col
from longrec.fixed_values import BORDERLINE_T, CLINICAL_T, PERCENTILES


#: What counts as a number in a text.  A cast alone would also take ``12d``, ``3F`` and ``0x1p3``.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


def to_number(value: Column) -> Column:
    """Number of a text; anything else, NaN and infinity are missing."""
    text = value.cast("string")
    number = text.try_cast("double")
    # numbers beyond the range of doubles are infinite there
    return F.when(text.rlike(NUMBER) & (F.abs(number) < float("inf")), number)


def exact_number(value: Column) -> Column:
    """The same, where the double holds the number as written: long integers that lose digits are missing."""
    text, number = value.cast("string"), to_number(value)
    changed = text.rlike(WHOLE_NUMBER) & ~text.try_cast("decimal(38,0)").eqNullSafe(number.try_cast("decimal(38,0)"))
    return F.when(~changed, number)


def to_long(value: Column) -> Column:
    """Whole number of a text, digit by digit where it is written as one; other numbers are cut."""
    text = value.cast("string")
    whole = F.when(text.rlike(WHOLE_NUMBER), F.trim(text).try_cast("long"))
    return F.when(text.rlike(WHOLE_NUMBER), whole).otherwise(to_number(value).try_cast("long"))


def to_integer(value: Column) -> Column:
    """Integer of a text; null where it is none."""
    return value.try_cast("int")


def typed_option(value: Column) -> Column:
    """A number written plainly where the text is one, else the trimmed text."""
    text = F.trim(value)
    return F.coalesce(to_number(text).cast("string"), text)


def plain_answer(value: Column) -> Column:
    """Numeric text cut to its integer part, any other text as it is."""
    return F.coalesce(to_long(value).cast("string"), value)


def parse_choices(text: str | None) -> dict[str, str]:
    """``1, a | 2, b`` as a dict: choices stand between bars, code and label around the first comma.

    An empty piece, as after a trailing bar, is no choice; a piece without a comma is its own label.
    """
    choices = {}
    for piece in filter(None, (text or "").split("|")):
        code, comma, label = piece.partition(",")
        choices[code.strip()] = (label if comma else code).strip()
    return choices


def choices_map(text: Column) -> Column:
    """The same parse for a column of choice texts, as a map."""
    parts = F.filter(F.split(text, r"\|"), lambda p: p != "")
    return F.map_from_entries(
        F.transform(
            parts,
            lambda p: F.struct(
                F.trim(F.substring_index(p, ",", 1)).alias("key"),
                F.trim(F.when(F.contains(p, F.lit(",")), F.substr(p, F.instr(p, ",") + 1)).otherwise(p)).alias("value"),
            ),
        )
    )


def recode(value: Column, mapping: dict) -> Column:
    """Replace whole values, all at once; values outside the map stay."""
    if not mapping:
        return value
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, value), value)


def any_of(columns: Sequence[str]) -> Column:
    """1 if any value is not 0, 0 if none is, null if all are missing."""
    values = [col(c).cast("double") for c in columns]
    present = reduce(lambda a, b: a | b, [v.isNotNull() for v in values])
    hit = reduce(lambda a, b: a | b, [F.coalesce(v != 0, F.lit(False)) for v in values])
    return F.when(present, hit.cast("long"))


def graded(limbs: Sequence[str], axial: str) -> Column:
    """2 if the limb values add up to more than 0, plus the axial value (null stays null)."""
    total = reduce(lambda a, b: a + b, [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in limbs])
    return (F.when(total > 0, 2).otherwise(0) + col(axial).cast("double")).cast("long")


def range_flag(value: Column, low: float, high: float) -> Column:
    """1 inside the inclusive range, else 0; a missing value gives 0."""
    return F.coalesce(value.between(low, high), F.lit(False)).cast("int")


def percentile_band(tscore: Column, percentiles: Sequence[int] = PERCENTILES) -> Column:
    """Percentile text of a T-score: ``<= 50`` at 50, ``> 98`` beyond the list, null below 50."""
    position = (tscore - 50).cast("int")
    listed = F.array(*[F.lit(str(p)) for p in percentiles])
    return (
        F.when(tscore == 50, F.lit("<= 50"))
        .when(position >= len(percentiles), F.lit(f"> {percentiles[-1]}"))
        .otherwise(F.get(listed, position))
    )


def clinical_flag(tscore: Column) -> Column:
    return F.coalesce(tscore >= CLINICAL_T, F.lit(False)).cast("int")


def borderline_flag(tscore: Column) -> Column:
    """At or above the borderline limit and not clinical."""
    return F.coalesce((tscore >= BORDERLINE_T) & (tscore < CLINICAL_T), F.lit(False)).cast("int")


def tscore_parts(text: Column) -> tuple[Column, Column, Column]:
    """(score, clinical, borderline) of a printed T-score such as ``71-C``; ``nc`` is missing."""
    score = F.nullif(F.substring_index(text, "-", 1), F.lit("nc"))
    return score, F.contains(text, F.lit("-C")).cast("int"), F.contains(text, F.lit("-B")).cast("int")


def fixed_text(value: Column, places: int, ties: str = "up") -> Column:
    """Number with up to three decimals, rounded on its exact binary value (magnitudes below 10**15).

    Exact ties (such as 0.125 at two places) go away from zero with ``ties="up"`` and to the even digit with
    ``ties="even"``.

    ``format_string`` rounds the shortest decimal form instead: 40.595 would become 40.60 although
    the number itself lies below the tie.
    """
    size = F.abs(value)
    whole = F.floor(size).cast("long")
    # both steps are exact: the fraction of a double, and its scaling by a power of two
    fraction = ((size - F.floor(size)) * float(2**52)).cast("long")
    scaled = fraction * 10**places
    digits = F.shiftright(scaled + 2**51, 52)
    if ties == "even":
        tied = scaled.bitwiseAND(F.lit(2**52 - 1)) == 2**51
        odd = digits.bitwiseAND(F.lit(1)) == 1
        # at no places the digit before the point decides
        odd = odd if places else (whole + digits) % 2 == 1
        digits = digits - F.when(tied & odd, 1).otherwise(0)
    elif ties != "up":
        raise ValueError("ties are 'up' or 'even'")
    carried = whole + F.when(digits == 10**places, 1).otherwise(0)
    tail = F.lpad((digits % 10**places).cast("string"), places, "0")
    sign = F.when((value < 0) & ((whole > 0) | (digits > 0)), "-").otherwise("")
    return F.concat(sign, carried.cast("string"), F.lit("."), tail)


def regression_label(group: Column, r: Column, p: Column) -> Column:
    """``g (R^2 = 0.00, p = 0.00)``"""
    return F.concat(
        group, F.lit(" (R^2 = "), fixed_text(r * r, 2, "even"), F.lit(", p = "), fixed_text(p, 2, "even"), F.lit(")")
    )


def row_minimum(columns: Sequence[str]) -> Column:
    """Smallest value of a row, nulls left out."""
    cells = [col(c) for c in columns]
    return F.least(*cells) if len(cells) > 1 else cells[0]
