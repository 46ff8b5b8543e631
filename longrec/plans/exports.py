"""Jobs that write answers out: nested documents and fixed-width records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from longrec import fixed_values as fixed
from longrec.functions import records, values
from longrec.operators import columns, joins, ordered, predicates, reshape
from longrec.operators.recode import Dictionary, recode_values
from longrec.session import collect_small
from longrec.sources.sinks import answer_document


def export_answers(
    df: DataFrame,
    mapping: DataFrame,
    answer_ids: DataFrame,
    order_by: Sequence[str],
    form_id: str,
    society_id: str,
    wide: bool = False,
    form_tokens: Sequence[str] = ("cbcl", "ysr"),
) -> DataFrame:
    """(id, document) per answered session, from an all-text export.

    ``mapping`` has ``source_var``, ``target_var`` and ``opt_replacements``; ``answer_ids`` gives
    the ``json_id`` of each ``source_var``.  The first column is the subject, and the second the
    session unless the export is ``wide``.  Stable columns are filled forward per subject.
    """
    rows = collect_small(joins.join_mappings(mapping, answer_ids, ["source_var"]))
    subject, session = "study_id", "session_number"
    data = df.withColumnRenamed(df.columns[0], subject)
    if wide:
        data, prefixed = reshape.expand(data, subject, session)
        stable = [c for c in prefixed if c in data.columns]
    else:
        data = data.withColumnRenamed(data.columns[1], session)
        sex = next(r["target_var"] for r in rows if r["source_var"].endswith("_sex"))
        stable = [sex] if sex in data.columns else []
    if stable:
        data = ordered.forward_fill(data, [subject], stable, order_by)
    mapped = [r["target_var"] for r in rows]
    data = data.select(subject, session, *[c for c in data.columns if c in mapped])
    data = predicates.drop_all_null(data, [c for c in data.columns if any(t in c for t in form_tokens)])
    data = recode_values(
        data, {r["target_var"]: values.parse_choices(r["opt_replacements"]) for r in rows if r["opt_replacements"]}
    )
    ids = {r["target_var"]: int(r["json_id"]) for r in rows if r["json_id"] is not None}
    return answer_document(data, [subject, session], ids, form_id, society_id)


def session_variables(names: Sequence[str], dictionary: Dictionary, age: str) -> list[dict[str, str]]:
    """Bounding questions, gender and age of every session, found by label text."""
    found = {
        place: [n for n in dictionary.labelled(text) if n in names] for text, place in fixed.CARD_LABELS.items()
    }
    found = {place: cs for place, cs in found.items() if cs}
    genders = [c for c in names if "gender" in c]
    age_columns = columns.searching(names, [age])
    if not genders or not age_columns:
        raise ValueError("age and gender columns must be included in the export")
    return [
        {place: cs[i] for place, cs in found.items()} | {"gender": genders[0], "age": age_columns[i]}
        for i in range(len(found["q1"]))
    ]


def export_records(
    df: DataFrame,
    dictionary: Dictionary,
    age: str,
    event: str = "event_name",
    count_prefix: str = "cbcl_number",
    friends: str = "cbcl_times_a_week_friends",
    other_prefix: str = "cbcl_other_sub",
    last_rating: str = "cbcl_chores_well3",
    yes_no: Sequence[str] = ("cbcl_special_edu", "cbcl_repeat_grade", "cbcl_acad_prob"),
    siblings: str = "cbcl_along_w_sibs",
) -> tuple[DataFrame, DataFrame]:
    """((id, record), rejected rows): a three-line record per subject and session.

    Empty forms are left out session by session; rows without gender or age are rejected.
    """
    key = df.columns[0]
    records_out = rejected = None
    for names in session_variables(df.columns, dictionary, age):
        start = names.get("num_sports", names["q1"])
        asked = [c for c in dictionary.between(start, names["q113"], "radio") if c in df.columns]
        gender = names["gender"]
        codes = {k: 1 if v.lower() in ("male", "boy") else 2 for k, v in dictionary.choices(gender).items()}
        coded = df.withColumn(gender, values.recode(F.col(gender).cast("int"), {int(k): v for k, v in codes.items()}))
        filled = coded.where(predicates.non_empty_form(asked))
        usable, unusable = predicates.complete_demographics(filled, [gender, names["age"]])

        visit = F.replace(F.col(event), F.lit("_"), F.lit("")) if event in df.columns else F.lit(names["q1"].split("_")[0])
        subject = F.concat(F.col(key).cast("string"), F.lit("_"), visit)
        cards: dict = {}
        for number, (first, last) in fixed.CARD_BOUNDS.items():
            if first not in names or last not in names:
                cards[number] = None
                continue
            inside = asked[asked.index(names[first]) : asked.index(names[last]) + 1]
            cards[number] = (
                records.competence_card(inside, count_prefix, friends, other_prefix, last_rating, yes_no, siblings)
                if number == "01"
                else records.symptom_card(inside)
            )
        part = usable.select(
            subject.alias("id"), records.record_text(subject, F.col(gender), F.col(names["age"]), cards).alias("record")
        )
        bad = unusable.select(subject.alias("id"), F.lit("missing age or gender").alias("reason"))
        records_out = part if records_out is None else records_out.unionByName(part)
        rejected = bad if rejected is None else rejected.unionByName(bad)
    return records_out, rejected
