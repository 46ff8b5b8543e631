"""Jobs on scores: test batteries, score exports, questionnaires and score reports."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from longrec.names import col, renamed_columns
from longrec import fixed_values as fixed
from longrec.functions import labels, values
from longrec.operators import columns, ordered, predicates, reshape, scoring
from longrec.session import collect_small, cut_lineage
from longrec.sources import folders, reports

BATTERY_SCORES, UNADJUSTED = fixed.BATTERY_SCORES, fixed.UNADJUSTED


def _battery_rules() -> list[columns.Rule]:
    """Parents' scores lose their session and have short names; two irregular names are put right."""

    def short(name: str) -> str:
        for text, new in fixed.PARENT_SCORES.items():
            name = name.replace(text, new)
        return name

    crystal, old, new = fixed.CRYSTAL_AGE
    own_raw, raw = fixed.SELF_RAW
    return [
        (lambda c: fixed.PARENT in c, short),
        (lambda c: crystal in c, lambda c: c.replace(old, new)),
        (lambda c: fixed.PARENT in c and fixed.OTHER_MEASURE not in c, reshape.without_session),
        (lambda c: own_raw in c, lambda c: c.removesuffix(raw)),
    ]


def battery_rows(
    df: DataFrame, file: str = "file", pin: str = "PIN", instrument: str = "Inst", parent_limit: int = 4
) -> DataFrame:
    """(subject, session_number, instrument, scores) with instruments named by who answered.

    Rows whose PIN says parent are parent rows.  Other PINs with up to ``parent_limit`` rows in
    their file are read by the parent names too.
    """
    sized = ordered.group_size(df, [file, pin], "__rows")
    parent = F.lower(F.col(pin)).contains("parent") | (F.col("__rows") <= parent_limit)
    label = F.col(instrument)
    named = F.when(parent, labels.map_instrument(label, fixed.PARENT_INSTRUMENTS)).otherwise(
        labels.map_instrument(label, fixed.SUBJECT_INSTRUMENTS)
    )
    return sized.withColumns(
        {
            instrument: named,
            "subject": labels.pin_subject(F.col(pin)),
            "session_number": labels.pin_session(F.col(pin)),
        }
    ).drop("__rows", pin).transform(renamed_columns, BATTERY_SCORES)


def import_battery(
    df: DataFrame,
    order_by: Sequence[str],
    file: str = "file",
    pin: str = "PIN",
    instrument: str = "Inst",
    subjects: Sequence[str] | None = None,
    dedupe: Sequence[str] = ("subject", "session_number", "Inst", "unadj"),
) -> DataFrame:
    """One row per subject: ``s<session>_<instrument>_<score>``, with the finished names."""
    rows = battery_rows(df, file, pin, instrument).where(F.col("subject").isNotNull())
    if subjects:
        rows = predicates.subjects_in(rows, "subject", subjects)
    scores = list(BATTERY_SCORES.values())
    rows = ordered.keep_last(rows, dedupe, order_by)
    rows = predicates.drop_all_null(rows.select("subject", "session_number", instrument, *scores), scores)
    wide = reshape.double_flatten(cut_lineage(rows), "subject", "session_number", instrument, "s")
    named = columns.rename_by_rules(wide, _battery_rules())
    return columns.drop_matching(named, r"\w*_(raw|tscore)$", unless="neuroqol")


def import_battery_folder(
    spark: SparkSession, folder: str, subjects: Sequence[str] | None = None
) -> tuple[DataFrame | None, DataFrame, DataFrame | None]:
    """(one row per subject, skipped files, files whose PINs lack the session in their name).

    Of equal scores the last one in file order is kept.
    """
    rows, skipped = folders.scan_folder(spark, folder, UNADJUSTED)
    if rows is None:
        return None, skipped, None
    lacking = {c: F.lit(None).cast("double") for c in BATTERY_SCORES if c not in rows.columns}
    rows = rows.withColumns(lacking)
    mismatches = predicates.file_mismatches(rows, "file", "PIN")
    return import_battery(rows, folders.FILE_ORDER, subjects=subjects), skipped, mismatches


def import_scores(
    df: DataFrame,
    mapping: DataFrame,
    id_column: str = "AssessedPersonId",
    longitudinal: bool = False,
    wide: bool = False,
    event: str = "event_name",
    flags: Mapping[str, tuple[float, float]] = fixed.SCORE_FLAGS,
    integer_columns: Sequence[str] = ("cbcl_age_6_18_yn",),
) -> DataFrame:
    """Scores with range flags under the mapped names.

    ``mapping`` has ``source_var``, ``target_var`` and ``fill_value``.  A longitudinal id is
    split at its first underscore into subject and event.
    """
    rows = collect_small(mapping)
    sources = [r["source_var"] for r in rows if r["source_var"]]
    scored = columns.keep_mapped(df, sources)
    available = {name: limits for name, limits in flags.items() if name.split(".")[0] in scored.columns}
    scored = scoring.with_range_flags(scored, available, sources)
    renames = {r["source_var"]: r["target_var"] for r in rows if r["source_var"] and r["target_var"]}
    scored = columns.rename_by_table(scored, renames)
    scored = columns.with_constants(
        scored, {r["target_var"]: r["fill_value"] for r in rows if r["fill_value"] is not None and r["target_var"]}
    )
    key = renames.get(id_column, id_column)
    if longitudinal:
        subject, visit = labels.split_key(F.col(key))
        rest = [col(c) for c in scored.columns if c != key]
        scored = scored.select(subject.alias(key), visit.alias(event), *rest)
    scored = scored.withColumns({c: values.to_integer(F.col(c)) for c in integer_columns if c in scored.columns})
    return reshape.simple_flatten(scored, [key], event) if wide and longitudinal else scored


# Names of the score columns; a session prefix goes in front.
RAW_NAME, T_NAME, BAND_NAME = "{}ycbcl_raw_{}", "{}ycbcl_t_{}", "{}ycbcl_per_{}"
BORDERLINE_NAME, CLINICAL_NAME = "{}cbcl_borderline___{}", "{}cbcl_clinical___{}"
QUESTION_NAME = "{}ycbcl_q{}"


def score_questionnaire(
    df: DataFrame,
    questions: DataFrame,
    norms: DataFrame,
    keys: Sequence[str],
    prefix: str = "",
    flag: str = "ycbcl_age_5_complete",
    unscored: Sequence[str] = ("otherprob",),
    composites: Mapping[str, Sequence[str]] = fixed.COMPOSITE_SCALES,
    constants: Mapping[str, int] | None = None,
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw scores, T-scores, percentile bands and flags of every scale.

    ``questions`` is (scale, question) and ``norms`` (scale, raw, tscore); both are metadata and
    their size is checked.  Scores are looked up inside one projection: no shuffle.
    """
    asked: dict[str, list[str]] = {}
    for row in collect_small(questions.orderBy("scale", "question")):
        asked.setdefault(row["scale"], []).append(QUESTION_NAME.format(prefix, row["question"]))
    tables: dict[str, dict[int, int]] = {}
    for row in collect_small(norms):
        tables.setdefault(row["scale"], {})[row["raw"]] = row["tscore"]

    answered = [c for c in df.columns if "ycbcl_q" in c]
    rows = predicates.drop_all_null(predicates.completed(df, flag), answered)
    raw = {s: RAW_NAME.format(prefix, s) for s in (*asked, *composites)}
    rows = scoring.raw_score_columns(rows, asked, RAW_NAME.format(prefix, "{}"))
    rows = scoring.raw_score_columns(rows, {c: [raw[s] for s in parts] for c, parts in composites.items()}, RAW_NAME.format(prefix, "{}"))
    scored = [s for s in raw if s not in unscored]
    rows = rows.withColumns({T_NAME.format(prefix, s): _norm(raw[s], tables.get(s, {})) for s in scored})
    boxes = fixed.SESSION_CHECKBOXES if prefix else fixed.PLAIN_CHECKBOXES
    added = {}
    for scale in scored:
        t = F.col(T_NAME.format(prefix, scale))
        if scale not in composites:
            added[BAND_NAME.format(prefix, scale)] = values.percentile_band(t)
        if scale in boxes:
            place = boxes.index(scale) + 1
            added[CLINICAL_NAME.format(prefix or "y", place)] = values.clinical_flag(t)
            added[BORDERLINE_NAME.format(prefix or "y", place)] = values.borderline_flag(t)
    rows = rows.withColumns(added)
    kept = [
        c
        for c in rows.columns
        if re.search("cbcl_(raw|t|per|borderline|clinical)", c) and not any(u in c for u in unscored)
    ]
    finished = columns.rename_by_table(rows.select(*keys, *kept), dict(renames or {}))
    return columns.with_constants(
        finished, dict(constants or {"ycbcl_age_5_yn": 1, "ycbcl_age_5_scores_complete": 2})
    )


def _norm(raw: str, table: Mapping[int, int]) -> Column:
    if not table:
        return F.lit(None).cast("int")
    listed = F.array(*[F.lit(table.get(i)).cast("int") for i in range(max(table) + 1)])
    return F.get(listed, col(raw).cast("int"))


def collect_score_reports(
    cells: DataFrame,
    key: str,
    event: str,
    scales: Sequence[str] = fixed.REPORT_SCALES,
    prefix: str = "cbcl_",
    longitudinal: bool = True,
) -> DataFrame:
    """One row per subject and event: ``cbcl_<type>_<scale>`` and ``cbcl_<flag>___<k>``.

    Unless ``longitudinal``, one row per subject with the event before each name.

    ``cells`` is (key, event, score_type, scale, cell).  T-scores are split into number and
    flags; the k of a flag is the place of its scale.  Columns without a value are left out.
    """
    score, clinical, borderline = values.tscore_parts(F.col("cell"))
    is_t = F.col("score_type") == "t"
    position = F.array_position(F.lit(list(scales)), F.col("scale")).cast("string")
    entries = F.array(
        F.struct(
            F.concat_ws("_", "score_type", "scale").alias("name"),
            F.nullif(F.when(is_t, score).otherwise(F.col("cell")), F.lit("nc")).alias("value"),
        ),
        F.when(is_t, F.struct(F.concat(F.lit("clinical___"), position).alias("name"), clinical.cast("string").alias("value"))),
        F.when(is_t, F.struct(F.concat(F.lit("borderline___"), position).alias("name"), borderline.cast("string").alias("value"))),
    )
    named = cells.select(key, event, F.explode(entries).alias("e")).where(F.col("e").isNotNull())
    long = named.select(key, event, F.col("e.name").alias("name"), F.col("e.value").alias("value"))
    wide = reshape.simple_flatten(cut_lineage(long), [key, event], "name", prefix, sort=False)
    wide = wide.toDF(*[c.removesuffix("_value") for c in wide.columns])
    return wide if longitudinal else reshape.simple_flatten(cut_lineage(wide), [key], event, sort=False)


def collect_score_report_folder(
    spark: SparkSession, folder: str, prefix: str, subjects: Sequence[str] = (), modified_after: str | None = None,
    longitudinal: bool = True,
) -> DataFrame | None:
    """The same from the ``<prefix><digits>_<visit>.csv`` reports below a folder; ``None`` where no file is chosen.

    Only files of the chosen subjects and times are opened.
    """
    files = cut_lineage(folders.discover_files(spark, folder, prefix, "csv", subjects, modified_after))
    paths = folders.chosen_paths(files)
    if not paths:
        return None
    cells = reports.read_labelled_reports(spark, paths)
    named = cells.join(
        files.select(F.col("path").alias("file"), "subject", F.col("visit").alias("event_name")), "file"
    ).drop("file")
    scored = reports.report_scores(named, ["subject", "event_name"])
    return collect_score_reports(scored, "subject", "event_name", longitudinal=longitudinal)
