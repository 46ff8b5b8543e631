"""Fixed-width questionnaire records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from longrec.names import col
from longrec.fixed_values import CARD_ENDINGS, MISSING_FIRST_CARD
from longrec.functions.values import row_minimum


def _digits(cells: Sequence[Column]) -> Column:
    """Answers as one digit each, 9 for a missing one."""
    return F.concat(*[F.coalesce(c.cast("int"), F.lit(9)).cast("string") for c in cells])


def symptom_card(columns: Sequence[str]) -> Column:
    """Answers as digits; answers counted from 1 (smallest not 0) are moved down by 1."""
    shift = F.when(row_minimum(columns) == 0, 0).otherwise(1)
    return _digits([col(c) - shift for c in columns])


def competence_card(
    columns: Sequence[str],
    count_prefix: str,
    friends: str,
    other_prefix: str,
    last_rating: str,
    yes_no: Sequence[str],
    siblings: str,
) -> Column:
    """First card: 18 blanks, then the competence answers recoded field by field.

    Counts (and the friends item) are numbered from 1 on the form.  Subjects without the
    competence part of a rating gave 4 or 5, which becomes 9.  Yes/no items are swapped.
    """
    rated = columns[: columns.index(last_rating) + 1] if last_rating in columns else []

    def answer(name: str) -> Column:
        value = col(name)
        if name.startswith(count_prefix) or name == friends:
            value = value - 1
        if name.startswith(other_prefix):
            value = F.when(value == 5, 9).otherwise(value)
        if name in rated and not name.startswith(count_prefix):
            value = F.when(value.isin(4, 5), 9).otherwise(value)
        if name in yes_no:
            value = F.when(value == 2, 1).otherwise(2)
        if name == siblings:
            value = F.when(value == 4, 0).otherwise(value)
        if name == friends:
            value = F.when(value == 0, 1).otherwise(value)
        return value

    return F.concat(F.lit(" " * 18), _digits([answer(c) for c in columns]))


def record_head(subject: Column, gender: Column, age: Column, card: str) -> Column:
    """Id in 10 columns, card number, gender digit and age in two digits."""
    short = F.concat(F.substring(subject, 1, 9), F.right(subject, F.lit(1)))
    return F.concat(
        F.lpad(short, 10, " "),
        F.lit(card),
        gender.cast("int").cast("string"),
        F.format_string("%02d", age.cast("int")),
    )


def record_text(subject: Column, gender: Column, age: Column, cards: dict[str, Column | None]) -> Column:
    """All cards of one record, a line each; a missing first card is blanks and nines."""
    lines = []
    for number, body in cards.items():
        content = F.lit(MISSING_FIRST_CARD) if body is None else body
        lines.append(F.concat(record_head(subject, gender, age, number), content, F.lit(CARD_ENDINGS.get(number, ""))))
    return F.concat_ws("\n", *lines)
