"""Job: metadata-driven migration of an all-text export."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longrec import fixed_values as fixed
from longrec.functions import labels
from longrec.operators import columns, ordered, predicates, recode
from longrec.session import cut_lineage


def migrate(
    df: DataFrame,
    changes: recode.ChangeMap,
    dictionary: recode.Dictionary,
    order_by: Sequence[str],
    key: str = "study_id",
    event: str = "event_name",
    key_pattern: str | None = None,
    event_prefix: str | None = None,
    stable_event: str = "stable_patient_cha_arm_1",
    merge_rules: Mapping[str, Callable[[Sequence[str]], Column]] | None = None,
    text_prefixes: Sequence[str] = ("compass31",),
    drop: Sequence[str] = (),
) -> tuple[DataFrame, list[recode.ColumnTyping]]:
    """(migrated rows, chosen numeric types with the number of lost values).

    One projection up to the backward fill, one window, and one table, whose numeric types are
    counted while it is written.
    ``order_by`` columns that are not exported must survive the drop list as keys do.
    """
    keys = [key, event]
    rows = df.where(predicates.key_matches(key, key_pattern)) if key_pattern else df
    if event_prefix:
        rows = rows.withColumn(event, labels.strip_prefix_text(F.col(event), event_prefix))
    kept = list(dict.fromkeys([*keys, *order_by]))
    rows = predicates.drop_all_null(rows, [c for c in rows.columns if c not in kept])
    rows = recode.rename_changed(rows, changes, dictionary)
    rows = rows.drop(*recode.dropped_columns(rows.columns, changes, dictionary, kept), *drop)
    rows = recode.recode_values(rows, changes.recodes())
    merges = {name: cs for name, cs in changes.merges().items() if any(c in rows.columns for c in cs)}
    rows = recode.merge_columns(rows, merges, merge_rules)

    demographics = columns.with_families(rows.columns, dictionary.names(forms=[fixed.DEMOGRAPHIC_FORM]))
    demographics = [c for c in demographics if c not in kept]
    if demographics:
        rows = ordered.backward_fill(rows, [key], demographics, order_by)
    stable = [c for c in columns.family_union(rows.columns, dictionary.forms(), fixed.STABLE_FORMS) if c not in kept]
    rows = columns.only_where(rows, F.col(event) == stable_event, stable)

    # the rows are written once, and what their types depend on is counted meanwhile
    texts = [c for c in columns.with_families(rows.columns, dictionary.names("text")) if c not in kept]
    rows, counts = cut_lineage(rows, recode.typing_counts(texts, text_prefixes))
    plan = recode.typing_plan(texts, text_prefixes, counts)
    typed = recode.apply_numeric_types(rows, plan)
    return predicates.drop_all_null(typed, [c for c in typed.columns if c not in kept]), plan
