"""Whole jobs on session tables derived from the driver tables."""

from pyspark.sql import functions as F

from longrec import fixed_values as fixed
from longrec.operators import recode
from longrec.operators.recode import Change, ChangeMap, Dictionary
from longrec.plans import exports, measures, migration, scores, sessions
from longrec.queries import query, table
from longrec.session import shared_dir
from longrec.sources import reports, sinks, tables
from longrec.streaming.log import Files

# A run of three years starts by 1999, and its first two are kept.
YEARS = range(1995, 2001)


def _yearly(spark, d, *aggregates):
    """One row per customer and order year."""
    return (
        table(spark, d, "orders")
        .withColumn("year", F.year("o_orderdate"))
        .groupBy("o_custkey", "year")
        .agg(*aggregates)
    )


# -- longitudinal export ------------------------------------------------------------------

_EXPORT = """
y as (select o_custkey, cast(year(o_orderdate) as integer) as year, min(o_orderdate) clinic, max(o_orderdate) filter (o_orderstatus = 'F') mri,
  count(*) visits, min(o_orderstatus) = 'P' and max(o_orderstatus) = 'P' missed from orders group by 1, 2),
a as (select c_custkey, c_mktsegment, date '1950-01-01' + cast(c_custkey as integer) dob from customer),
t as (select *, case when year - lag(year) over (partition by o_custkey order by year) = 1 then 0 else 1 end brk from y where not missed),
r as (select *, sum(brk) over (partition by o_custkey order by year rows unbounded preceding) run from t),
s as (select *, count(*) over (partition by o_custkey, run) size, count(*) over (partition by o_custkey) dated from r),
k as (select *, row_number() over (partition by o_custkey order by year) rn from s where size >= 3),
g as (select k.*, floor(datediff('day', dob, clinic)) / 365.25 clinic_age, floor(datediff('day', dob, mri)) / 365.25 mri_age
  from k join a on c_custkey = o_custkey where rn <= 2),
w as (select * from g where mri_age > 0)"""


def _export(spark, d):
    """A stable row per customer, a row per order year."""
    stable = table(spark, d, "customer").select(
        F.concat(F.lit("SUBJ_"), F.col("c_custkey").cast("string")).alias("study_id"),
        F.lit("stable_arm_1").alias("event_name"),
        F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_custkey").cast("int")).cast("timestamp_ntz").alias("dob"),
        F.col("c_mktsegment").alias("segment"),
    )
    status = F.col("o_orderstatus")
    yearly = _yearly(
        spark, d,
        F.min("o_orderdate").alias("clinic_date"),
        F.max(F.when(status == "F", F.col("o_orderdate"))).alias("mri_date"),
        F.count(F.lit(1)).alias("visits"),
        F.when((F.min(status) == "P") & (F.max(status) == "P"), 1).alias("missed_session"),
    ).select(
        F.concat(F.lit("SUBJ_"), F.col("o_custkey").cast("string")).alias("study_id"),
        F.concat(F.col("year").cast("string"), F.lit("_arm_1")).alias("event_name"),
        (F.col("year") - 1994).cast("double").alias("session_number"),
        F.col("year").alias("session_year"),
        "clinic_date", "mri_date", "visits", "missed_session",
    )
    return stable.unionByName(yearly, allowMissingColumns=True)


_VARIABLES = {"session_year": "year", "visits": "visits", "clinic_age": "clinic_age", "mri_age": "mri_age"}


def _wide_export(label, names):
    cells = ", ".join(
        f"max(case when year = {y} then {e} end) {label(y)}_{n}" for n, e in names.items() for y in YEARS
    )
    return (
        f"with {_EXPORT} select 'SUBJ_' || c_custkey study_id, any_value(c_mktsegment) {label(1994)}_segment, {cells} "
        "from a left join w on o_custkey = c_custkey where c_custkey in (select o_custkey from s where dated >= 3) group by c_custkey"
    )


@query("job_format_sessions", _wide_export(lambda y: f"s{y - 1994}", {**_VARIABLES, "clinic_year": "cast(year as varchar)"}))
def job_format_sessions(spark, d):
    """Three consecutive years (with the stable row), imaging sessions only, one row per subject."""
    return sessions.format_sessions(
        _export(spark, d), ["session_year"], key_pattern="^SUBJ_", consecutive=3, imaging_only=True, flatten_by="session"
    )


@query(
    "job_format_sessions_by_clinic",
    _wide_export(lambda y: "c0" if y == 1994 else f"c{y}", {**_VARIABLES, "session_number": "year - 1994"}),
)
def job_format_sessions_by_clinic(spark, d):
    """The same by clinic year, ordered by session."""
    return sessions.format_sessions(
        _export(spark, d), ["session_year"], consecutive=3, imaging_only=True, flatten_by="clinic", sort_by="session/clinic"
    )


# -- tracked cohort -----------------------------------------------------------------------


_EXAMS = range(1995, 2002)


def _cohort(spark, d):
    """One row per customer with the first exam of every year."""
    years = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    wide = years.groupBy("o_custkey").pivot("year", list(_EXAMS)).agg(F.min("o_orderdate").alias("physicalexam_date"), F.count("o_orderkey").alias("score"))
    exams = wide.select(
        "o_custkey",
        *[F.col(f"{y}_{v}").alias(f"s{y - 1994}_{v}") for y in _EXAMS for v in ("physicalexam_date", "score")],
    )
    people = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"), (F.col("c_acctbal") / 1000).alias("db_onset_age")
    )
    return people.join(exams, "o_custkey", "left").withColumn(
        "study_id", F.concat(F.lit("TRIAL"), F.col("o_custkey").cast("string"))
    ).select("study_id", "segment", "db_onset_age", *exams.columns[1:])


@query(
    "job_format_cohort",
    """with x as (select c_custkey, 'TRIAL' || c_custkey study_id, c_mktsegment segment, c_acctbal / 1000 db_onset_age,
  date '1950-01-01' + cast(c_custkey as integer) dob from customer),
y as (select o_custkey, cast(year(o_orderdate) as integer) as year, min(o_orderdate) exam, count(*) score from orders group by 1, 2),
b as (select *, case when year - lag(year) over (partition by o_custkey order by exam) = 1 then 0 else 1 end brk from y),
r as (select *, sum(brk) over (partition by o_custkey order by exam rows unbounded preceding) run from b),
s as (select *, count(*) over (partition by o_custkey, run) size from r),
k as (select *, row_number() over (partition by o_custkey order by exam) rn from s where size >= 2),
f as (select o_custkey from y where year = 1995)
select study_id, 's' || (year - 1994) session_number, case when year = 1995 then segment end segment,
  case when year = 1995 then db_onset_age end db_onset_age, exam physicalexam_date, score,
  case when k.o_custkey in (select o_custkey from f) then floor(datediff('day', dob, exam)) / 365.25 - db_onset_age end dx_db_duration
from k join x on c_custkey = o_custkey where rn <= 2""",
)
def job_format_cohort(spark, d):
    """Two consecutive years with exams, and the time since diagnosis."""
    cohort = _cohort(spark, d).withColumns(
        {f"s{y - 1994}_score": F.nullif(F.col(f"s{y - 1994}_score"), F.lit(0)) for y in _EXAMS}
    )
    birthdays = table(spark, d, "customer").select(
        F.concat(F.lit("TRIAL"), F.col("c_custkey").cast("string")).alias("study_id"),
        F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_custkey").cast("int")).cast("timestamp_ntz").alias("dob"),
    )
    enrichment = birthdays.join(cohort.select("study_id", *[f"s{y - 1994}_physicalexam_date" for y in _EXAMS]), "study_id")
    return sessions.format_cohort(
        cohort, key_pattern=r"TRIAL\d+", require_any=["segment", "s1_"], enrichment=enrichment, duration=True, consecutive=2, long=True
    )


# -- extraction ---------------------------------------------------------------------------


@query(
    "job_extract_and_merge",
    """with b as (select user_id, cast(ts as date) as day, max(value) filter (event_type = 'click') top_value, count(*) n from events group by 1, 2),
i as (select user_id, cast(ts as date) as day, max(value) top_value, max(event_id) last_event from events group by 1, 2)
select user_id, day, coalesce(b.top_value, i.top_value) top_value, n, last_event from b full join i using (user_id, day)""",
)
def job_extract_and_merge(spark, d):
    """Fields of one table fill the gaps of another."""
    days = table(spark, d, "events").withColumn("day", F.col("ts").cast("date")).groupBy("user_id", "day")
    base = days.agg(F.max(F.when(F.col("event_type") == "click", F.col("value"))).alias("top_value"), F.count(F.lit(1)).alias("n"))
    other = days.agg(F.max("value").alias("top_value"), F.max("event_id").alias("last_event"), F.min("ts").alias("first_seen"))
    return sessions.extract_and_merge(other, ["top_value$", "last_"], base)


# -- test battery -------------------------------------------------------------------------

_SUBJECT_NAMES = ("vocab", "oral_reading", "flanker", "listsort", "pattern", "crystal_cog", "self_neuroqol")
_LABEL_OF = {name: text for text, name in fixed.SUBJECT_INSTRUMENTS.items()}
#: Labels as they stand in exports: the known text and some more.
_INSTRUMENTS = tuple(f"{_LABEL_OF[name]} {k}" for k, name in enumerate(_SUBJECT_NAMES))


def _battery_sql():
    subject = _SUBJECT_NAMES
    parent = [fixed.PARENT_INSTRUMENTS.get(_LABEL_OF[name]) for name in subject]
    cells = []
    for i, label in enumerate(_INSTRUMENTS):
        for who, names in (("n > 4", subject), ("n <= 4", parent)):
            name = names[i] or label
            for score in ("unadj", "ageadj", "raw"):
                column = f"s1_{name}_{score}"
                if "parent" in name:
                    column = column.replace("unadj", "unc").replace("ageadj", "ac")
                    column = column if "neuroqol" in name else column[3:]
                if score == "raw":
                    if "neuroqol" not in name and " " not in name:
                        continue
                    column = column.removesuffix("_raw") if "self" in name else column
                column = column.replace("crystal_cog_ageadj", "cog_crystal_ageadj")
                cells.append(f"max(case when day = {i} and {who} then {score} end) \"{column}\"")
    return (
        "with e as (select user_id % 400 * 20 + hour(ts) % 20 as pin, dayofweek(ts) as day, max(value) raw, min(value) unadj, cast(count(*) as double) ageadj "
        "from events group by 1, 2), g as (select *, count(*) over (partition by pin) n from e) "
        "select 'CUST' || pin subject, " + ", ".join(cells) + " from g group by pin"
    )


def _battery_rows(spark, d):
    """Weekdays as instruments of a user and hour; those with up to four of them are read as parents."""
    pin = (F.col("user_id") % 400 * 20 + F.hour("ts") % 20).alias("pin")
    return (
        table(spark, d, "events").groupBy(pin, (F.dayofweek("ts") - 1).alias("day"))
        .agg(
            F.max("value").alias("RawScore"), F.min("value").alias("Uncorrected Standard Score"),
            F.count(F.lit(1)).cast("double").alias("Age-Corrected Standard Score"), F.max("event_id").alias("row"),
        )
        .select(
            F.concat(F.lit("cust "), F.col("pin").cast("string")).alias("PIN"),
            F.get(F.array(*[F.lit(i) for i in _INSTRUMENTS]), F.col("day")).alias("Inst"),
            "RawScore", F.lit(None).cast("double").alias("TScore"), "Uncorrected Standard Score",
            "Age-Corrected Standard Score", "row", F.lit("export.csv").alias("file"),
        )
    )


@query("job_import_battery", _battery_sql())
def job_import_battery(spark, d):
    return scores.import_battery(_battery_rows(spark, d), ["row"])


# -- score import -------------------------------------------------------------------------


def _score_mapping(spark):
    return spark.createDataFrame(
        [
            ("AssessedPersonId", "study_id", None),
            ("Activities_TScore", "act_t", None),
            ("Activities_TScore.clinical", "act___1", None),
            ("Activities_TScore.borderline", "act___2", None),
            ("Total_Problems_TScore", None, None),
            ("Total_Problems_TScore.clinical", "total_flag", None),
            (None, "scores_complete", "2"),
            (None, "cbcl_age_6_18_yn", "1"),
        ],
        "source_var string, target_var string, fill_value string",
    )


_SCORES = """with y as (select o_custkey, year(o_orderdate) as year, cast(count(*) * 7 + 15 as integer) act, cast(max(o_totalprice) / 7000 as integer) total
  from orders group by 1, 2)
select cast(o_custkey as varchar) study_id, year || '_arm_1' event_name, act act_t, case when act between 20 and 30 then 1 else 0 end act___1,
  case when act between 31 and 35 then 1 else 0 end act___2, total "Total_Problems_TScore",
  case when total between 64 and 100 then 1 else 0 end total_flag, '2' scores_complete, 1 cbcl_age_6_18_yn from y"""


def _scores(spark, d):
    return _yearly(
        spark, d, (F.count(F.lit(1)) * 7 + 15).cast("int").alias("Activities_TScore"),
        F.round(F.max("o_totalprice") / 7000).cast("int").alias("Total_Problems_TScore"), F.max("o_orderkey").alias("Unmapped"),
    ).select(
        F.concat(F.col("o_custkey").cast("string"), F.lit("_"), F.col("year").cast("string"), F.lit("_arm_1")).alias("AssessedPersonId"),
        "Activities_TScore", "Total_Problems_TScore", "Unmapped",
    )


@query("job_import_scores", _SCORES.replace("cast(max(o_totalprice) / 7000 as integer)", "cast(round(max(o_totalprice) / 7000) as integer)"))
def job_import_scores(spark, d):
    """Scores with range flags under mapped names, subject and event split."""
    return scores.import_scores(_scores(spark, d), _score_mapping(spark), longitudinal=True)


# -- documents and records ----------------------------------------------------------------


@query(
    "job_export_answers",
    """with y as (select o_custkey, cast(year(o_orderdate) as integer) as year, count(*) n, min(o_orderstatus) worst from orders group by 1, 2),
s as (select *, case when year = min(year) over (partition by o_custkey) then c_mktsegment end seg from y join customer on c_custkey = o_custkey),
f as (select *, last_value(seg ignore nulls) over (partition by o_custkey order by year rows unbounded preceding) sex from s)
select o_custkey || '_' || year as id, '{"PersonInformation":{"IdentificationCode":"' || o_custkey || '_' || year
  || '"},"Forms":[{"FormInstrument":{"Id":"form","Answers":[{"QuestionId":11,"Value":"' || case when sex = 'BUILDING' then '1' else sex end
  || '","Comments":[]},{"QuestionId":12,"Value":"' || n || '","Comments":[]}' || case when worst = 'F' then ',{"QuestionId":13,"Value":"0","Comments":[]}'
  when worst = 'O' then ',{"QuestionId":13,"Value":"2","Comments":[]}' else '' end || ']},"Society":{"Id":"society"}}]}' as document from f""",
)
def job_export_answers(spark, d):
    """Documents per customer and year; the segment is known in the first year only and filled forward."""
    mapping = spark.createDataFrame(
        [("A_sex", "demo_sex", "BUILDING, 1 |"), ("A_n", "cbcl_n", None), ("A_worst", "cbcl_worst", "F, 0 | O, 2"), ("A_other", "other", None)],
        "source_var string, target_var string, opt_replacements string",
    )
    ids = spark.createDataFrame([("A_sex", 11), ("A_n", 12), ("A_worst", 13)], "source_var string, json_id int")
    first = table(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("first_year"))
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = (
        _yearly(spark, d, F.count(F.lit(1)).alias("n"), F.min("o_orderstatus").alias("worst"))
        .join(first, "o_custkey")
        .join(people, "o_custkey")
        .select(
            F.col("o_custkey").cast("string").alias("subject"), F.col("year").cast("string").alias("visit"),
            F.when(F.col("year") == F.col("first_year"), F.col("c_mktsegment")).alias("demo_sex"),
            F.concat(F.col("n").cast("string"), F.lit(".0")).alias("cbcl_n"),
            F.when(F.col("worst") != "P", F.col("worst")).alias("cbcl_worst"), F.lit("x").alias("unmapped"),
        )
    )
    return exports.export_answers(rows, mapping, ids, ["session_number"], "form", "society")


_RADIO = [f"cbcl_q{k}" for k in range(1, 8)]
_CARD_TEXT = {name: text for text, name in fixed.CARD_LABELS.items()}
_RECORD_FIELDS = Dictionary(
    tuple(
        {"name": n, "form": "cbcl", "type": t, "label": label, "choices": c}
        for n, t, label, c in (
            ("gender", "radio", "Gender", "1, Female | 2, Male"),
            ("age", "text", "Age", None),
            ("cbcl_q1", "radio", _CARD_TEXT["q1"], None),
            ("cbcl_q2", "radio", "2.", None),
            ("cbcl_q3", "radio", _CARD_TEXT["q58"], None),
            ("cbcl_note", "text", "Describe", None),
            ("cbcl_q4", "radio", _CARD_TEXT["q59"], None),
            ("cbcl_q5", "radio", "60.", None),
            ("cbcl_q6", "radio", "61.", None),
            ("cbcl_q7", "radio", _CARD_TEXT["q113"] + ". Other", None),
        )
    )
)


def _record_rows(spark, d):
    """Line counts of an order as answers; orders without a first line lack an age."""
    counted = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        *[F.nullif(F.count(F.when(F.col("l_linenumber") == k, 1)), F.lit(0)).cast("int").alias(f"cbcl_q{k}") for k in range(1, 8)],
        F.max(F.when(F.col("l_linenumber") == 1, F.col("l_quantity"))).alias("age"),
        F.lit("none").alias("cbcl_note"),
    )
    return counted.select("l_orderkey", (F.col("l_orderkey") % 2 + 1).cast("int").alias("gender"), "age", *_RADIO, "cbcl_note")


def _digit(k, shift):
    return f"coalesce(cast(q{k} - {shift} as varchar), '9')"


_RECORDS = f"""with o as (select l_orderkey, {", ".join(f"nullif(count(*) filter (l_linenumber = {k}), 0) q{k}" for k in range(1, 8))},
  max(l_quantity) filter (l_linenumber = 1) age from lineitem group by 1),
h as (select *, l_orderkey || '_cbcl' as id, (case when l_orderkey % 2 = 1 then 1 else 2 end) || printf('%02d', cast(age as integer)) tail,
  lpad(left(l_orderkey || '_cbcl', 9) || 'l', 10, ' ') head from o)"""


@query(
    "job_export_records",
    _RECORDS
    + f""" select id, head || '01' || tail || repeat(' ', 18) || repeat('9', 38) || 'CBC' || chr(10)
  || head || '02' || tail || {_digit(1, 1)} || {_digit(2, 1)} || {_digit(3, 1)} || chr(10)
  || head || '03' || tail || {_digit(4, 1)} || {_digit(5, 1)} || {_digit(6, 1)} || {_digit(7, 1)} || 'END' as record
from h where age is not null""",
)
def job_export_records(spark, d):
    """Three-line records; the first card was not asked."""
    return exports.export_records(_record_rows(spark, d), _RECORD_FIELDS, "^age$")[0]


@query("job_export_records_rejected", _RECORDS + " select id, 'missing age or gender' reason from h where age is null")
def job_export_records_rejected(spark, d):
    return exports.export_records(_record_rows(spark, d), _RECORD_FIELDS, "^age$")[1]


# -- migration ----------------------------------------------------------------------------

_FIELDS = Dictionary(
    tuple(
        {"name": n, "form": f, "type": t, "label": n, "choices": None}
        for n, f, t in (
            ("segment", "patient_demographics", "text"), ("status", "visit", "radio"), ("visits", "visit", "text"),
            ("price", "visit", "text"), ("paid", "visit", "radio"), ("kinds", "visit", "checkbox"), ("total", "visit", "calc"),
        )
    )
)
_CHANGES = ChangeMap(
    (
        Change("seg", "segment"),
        Change("state", "status", replacements="F, 1 | O, 2 | P, 3 |"),
        Change("paid_left", "paid_left", merge="paid"),
        Change("paid_right", "paid_right", merge="paid"),
        Change("kind", "kinds"),
    )
)


_MIGRATE_SQL = """with y as (select o_custkey, year(o_orderdate) as year, count(*) n, max(o_orderstatus) state, max(o_totalprice) price,
  max(case when o_orderpriority = '1-URGENT' then 1 end) l, max(case when o_orderpriority = '5-LOW' then 0 end) r,
  cast(max(case when o_orderstatus = 'F' then 1 else 0 end) as integer) k1 from orders group by 1, 2)
select 'CUST_' || c_custkey || '_x' study_id, 'stable_patient_cha_arm_1' event_name, 0::bigint as year, c_mktsegment segment, null status,
  null::bigint visits, null::double price, null::bigint paid, null kinds___1 from customer where c_custkey in (select o_custkey from y)
union all select 'CUST_' || o_custkey || '_x', year || '_arm_1', year, null, case state when 'F' then '1' when 'O' then '2' else '3' end,
  n, case when n > 1 then price end, case when l is null and r is null then null when l = 1 then 1 else 0 end, cast(k1 as varchar) from y"""


def _migration_rows(spark, d):
    priority = F.col("o_orderpriority")
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    last = table(spark, d, "orders").groupBy("o_custkey").agg(F.max(F.year("o_orderdate")).alias("last_year"))
    yearly = _yearly(
        spark, d, F.count(F.lit(1)).alias("n"), F.max("o_orderstatus").alias("state"), F.max("o_totalprice").alias("top"),
        F.max(F.when(priority == "1-URGENT", 1)).alias("paid_left"), F.max(F.when(priority == "5-LOW", 0)).alias("paid_right"),
        F.max((F.col("o_orderstatus") == "F").cast("int")).alias("kind___1"),
    ).join(last, "o_custkey").join(people, "o_custkey")
    key = F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string"), F.lit("_x")).alias("study_id")
    visits = yearly.select(
        key, F.concat(F.lit("clinic_"), F.col("year").cast("string"), F.lit("_arm_1")).alias("event_name"), F.col("year").cast("long").alias("year"),
        F.when(F.col("year") == F.col("last_year"), F.col("c_mktsegment")).alias("seg"), "state",
        F.col("n").cast("string").alias("visits"), F.when(F.col("n") > 1, F.col("top").cast("string")).otherwise("one").alias("price"),
        *[F.col(c).cast("string").alias(c) for c in ("paid_left", "paid_right", "kind___1")],
        F.lit("1").alias("total"), F.lit("2").alias("stray"),
    )
    stable = last.select(
        key, F.lit("stable_patient_cha_arm_1").alias("event_name"), F.lit(0).cast("long").alias("year"), F.lit("5").alias("stray")
    )
    return stable.unionByName(visits, allowMissingColumns=True)


def migrated(spark, d):
    return migration.migrate(_migration_rows(spark, d), _CHANGES, _FIELDS, ["year"], key_pattern="^CUST", event_prefix="clinic_")


@query("job_migrate", _MIGRATE_SQL)
def job_migrate(spark, d):
    """Renames, drops, recodes, merges, a backward fill, stable columns and types from metadata."""
    return migrated(spark, d)[0]


@query("job_migrate_from_tables", _MIGRATE_SQL)
def job_migrate_from_tables(spark, d):
    """The same with the dictionary and the change map read from CSV tables."""
    path = shared_dir(spark, "metadata")
    changes = [(c.old, c.new, c.merge, "1" if c.drop else None, c.replacements) for c in _CHANGES.changes]
    changes = spark.createDataFrame(changes, "old_var string, new_var string, merge_var string, `drop` string, opt_replacements string")
    fields = [tuple(f[k] for k in ("name", "form", "type", "label", "choices")) for f in _FIELDS.fields]
    fields = spark.createDataFrame(fields, ", ".join(f"`{h}` string" for h in recode.DICTIONARY_HEADER))
    for name, metadata in (("changes", changes), ("dictionary", fields)):
        sinks.write_csv(metadata.coalesce(1), f"{path}/{name}")
    dictionary = recode.read_dictionary(tables.read_text_table(spark, f"{path}/dictionary"))
    listed = ChangeMap.from_table(tables.read_text_table(spark, f"{path}/changes"))
    rows = _migration_rows(spark, d)
    return migration.migrate(rows, listed, dictionary, ["year"], key_pattern="^CUST", event_prefix="clinic_")[0]


# -- measures -----------------------------------------------------------------------------


def _blocks_sql():
    cells = [
        f"max(case when l_returnflag = '{flag}' and l_linestatus = '{status}' then {column} end) block{i}_{code}_{side}"
        for i, flag in ((1, "A"), (2, "N"), (3, "R"))
        for status, code in (("F", "ft_mpv"), ("O", "ft_pvcv"))
        for column, side in (("l_quantity", "left"), ("l_tax", "left_right" if code == "ft_mpv" else "right"))
    ]
    done = ", ".join(f"1 block_{i}_kinematics_complete" for i in (1, 2, 3))
    return f"select l_suppkey record_id, {', '.join(cells)}, {done} from lineitem group by 1"


@query("job_import_blocks", _blocks_sql())
def job_import_blocks(spark, d):
    """Three blocks of two measures per supplier."""
    lines = table(spark, d, "lineitem")
    rows = lines.groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(
        F.max("l_quantity").alias("Left Avg"), F.max("l_tax").alias("Right Avg"), F.count(F.lit(1)).alias("Trials")
    ).select(
        F.col("l_suppkey").alias("record_id"),
        F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(3).alias("block"),
        F.when(F.col("l_linestatus") == "F", "Finger Tap Mean Peak Velocity").otherwise("Finger Tap Peak Velocity Coefficient Of Variation").alias("measure"),
        "Left Avg", "Right Avg", "Trials",
    )
    return measures.import_blocks(rows)


@query(
    "job_slopes",
    """with y as (select o_custkey, year(o_orderdate) x, count(*) n, count(*) filter (o_orderstatus = 'F') f from orders group by 1, 2),
l as (select o_custkey, x, 'finished' v, f y from y union all select o_custkey, x, 'orders', n from y),
s as (select o_custkey, v, count(*) c, sum(x) sx, sum(y) sy, sum(x * x) sxx, sum(y * y) syy, sum(x * y) sxy, max(y) - min(y) spread, min(x) fx from l group by 1, 2),
r as (select *, c * sxy - sx * sy num, c * sxx - sx * sx dx, c * syy - sy * sy dy from s),
t as (select *, case when c > 1 then cast(num as double) / cast(dx as double) end slope,
  case when c > 1 then sqrt((cast(dy as double) * cast(dx as double) - cast(num as double) * cast(num as double)) / cast(dx as double) / c / c) end rmse from r)
select o_custkey, """
    + ", ".join(
        f"max(case when v = '{v}' and c > 1 then c end) {v}_count, round(max(case when v = '{v}' then slope end), 5) {v}_slope, "
        f"round(max(case when v = '{v}' then rmse end), 5) {v}_rmse, cast(max(case when v = '{v}' and c > 1 then fx end) as integer) {v}_year_s1, "
        f"round(max(case when v = '{v}' and spread > 0 then rmse / spread end), 5) {v}_nrmse"
        for v in ("finished", "orders")
    )
    + " from t group by o_custkey",
)
def job_slopes(spark, d):
    """Order counts over the years, one row per customer."""
    rows = _yearly(
        spark, d, F.count(F.lit(1)).alias("orders"), F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("finished")
    )
    wide = measures.slopes(rows.select("o_custkey", F.col("year").alias("session"), "year", "orders", "finished"), "year", ["session"])
    return wide.select(
        "o_custkey", *[F.round(c, 5).alias(c) if c.endswith(("slope", "rmse")) else F.col(c) for c in wide.columns[1:]]
    )


@query(
    "job_group_tables",
    """select l_returnflag, 'discount' variable, count(*) n, round(regr_slope(l_discount, l_quantity), 7) slope from lineitem group by 1
union all select l_returnflag, 'tax', count(*), round(regr_slope(l_tax, l_quantity), 7) from lineitem group by 1""",
)
def job_group_tables(spark, d):
    """Variables chosen by pattern, regressed on quantity per return flag."""
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        F.col("l_extendedprice").alias("price"),
    )
    fitted, _ = measures.group_tables(rows, "l_quantity", "l_returnflag", ["disc", "^tax"])
    return fitted.select("l_returnflag", "variable", "n", F.round("slope", 7).alias("slope"))


@query(
    "job_collect_reports",
    """with o as (select o_orderkey, 'p' || o_custkey || '_s1' pid, o_orderstatus sex, o_orderpriority header, o_orderdate, o_totalprice from orders),
n as (select *, case when header like '%LOW%' then 'subcortical' when header like '%HIGH%' then 'ceres'
  else 'hips_kulaga_' || case when sex = 'F' then 'multicontrast' else 'monocontrast' end end as type from o),
u as (select pid, 'old' as type, sex, o_totalprice volume, o_orderkey, o_orderdate, 0 batch from o where o_orderdate < date '1996-01-01'
  union all select pid, type, sex, o_totalprice, o_orderkey, o_orderdate, 1 from n where o_orderdate >= date '1996-01-01')
select pid "Patient ID", split_part(pid, '_', 1) "Subject", '40' "Age", sex "Sex", type, cast(o_orderkey as varchar) job_id, volume from (
  select *, row_number() over (partition by pid, sex, type order by batch desc, o_orderkey desc) rn from u) where rn = 1""",
)
def job_collect_reports(spark, d):
    """Orders as reports: the oldest are in the ledger, the others are typed and merged in."""
    orders = table(spark, d, "orders")
    patient = F.concat(F.lit("p"), F.col("o_custkey").cast("string"), F.lit("_s1"))
    every = orders.select(
        F.substring_index(patient, "_", 1).alias("Subject"), patient.alias("Patient ID"), F.lit("40").alias("Age"),
        F.col("o_orderstatus").alias("Sex"), F.col("o_orderkey").cast("string").alias("job_id"), F.col("o_totalprice").alias("volume"),
        F.col("o_orderkey").alias("number"), "o_orderdate",
    )
    old = every.where(F.col("o_orderdate") < F.lit("1996-01-01")).withColumn("type", F.lit("old")).drop("o_orderdate")
    headers = orders.select(F.col("o_orderkey").cast("string").alias("job_id"), F.concat(
        F.when(F.col("o_orderpriority").contains("LOW"), "Brainstem").when(F.col("o_orderpriority").contains("HIGH"), "Crus I").otherwise("CA1"), F.lit(";Age")
    ).alias("header"))
    files = orders.select(
        F.col("o_orderkey").cast("string").alias("job_id"),
        F.when(F.col("o_orderstatus") == "F", "scan_t2.nii").otherwise("scan_t1.nii").alias("file"),
    )
    return measures.collect_reports(every.drop("o_orderdate"), headers, files, old, ["number"]).drop("number")


# -- questionnaire ------------------------------------------------------------------------


def _questionnaire(spark, d):
    """Answers 0 to 2 per order from its line counts."""
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        *[F.least(F.count(F.when(F.col("l_linenumber") == k, 1)), F.lit(2)).cast("int").alias(f"ycbcl_q{k}") for k in range(1, 8)]
    )


_T = ", ".join(["50", "53", "58", "64", "66", "71", "75"])


@query(
    "job_score_questionnaire",
    f"""with q as (select l_orderkey, {", ".join(f"least(count(*) filter (l_linenumber = {k}), 2) q{k}" for k in range(1, 8))} from lineitem group by 1),
r as (select l_orderkey, q1 + q2 + q3 emoreact, q4 + q5 attprob, q6 + q7 otherprob, q1 + q2 + q3 intprob, q4 + q5 extprob,
  q1 + q2 + q3 + q4 + q5 + q6 + q7 totprob from q),
t as (select *, [{_T}][emoreact + 1] te, [{_T}][attprob + 1] ta, [{_T}][totprob + 1] tt from r)
select l_orderkey, cast(emoreact as integer) ycbcl_raw_emoreact, cast(attprob as integer) ycbcl_raw_attprob, cast(intprob as integer) ycbcl_raw_intprob,
  cast(extprob as integer) ycbcl_raw_extprob, cast(totprob as integer) ycbcl_raw_totprob, te ycbcl_t_emoreact, ta ycbcl_t_attprob, te ycbcl_t_intprob,
  ta ycbcl_t_extprob, tt ycbcl_t_totprob, {", ".join(f'''case when {t} = 50 then '<= 50' when {t} >= 71 then '> 98'
  else cast([50, 54, 58, 62, 66, 69, 72, 75, 78, 81, 84, 86, 88, 90, 92, 93, 94, 95, 96, 97, 98][{t} - 49] as varchar) end ycbcl_per_{s}''' for t, s in (("te", "emoreact"), ("ta", "attprob")))},
  {", ".join(f'''case when coalesce({t}, 0) >= 70 then 1 else 0 end ycbcl_clinical___{k}, case when coalesce({t}, 0) between 65 and 69 then 1 else 0 end ycbcl_borderline___{k}'''
             for t, k in (("te", 1), ("ta", 6), ("te", 8), ("ta", 9), ("tt", 10)))},
  1 ycbcl_age_5_yn, 2 ycbcl_age_5_scores_complete from t""",
)
def job_score_questionnaire(spark, d):
    """Two scales and their composites, looked up in one projection."""
    rows = _questionnaire(spark, d)
    questions = spark.createDataFrame(
        [("emoreact", k) for k in (1, 2, 3)] + [("attprob", k) for k in (4, 5)] + [("otherprob", k) for k in (6, 7)],
        "scale string, question int",
    )
    norms = spark.createDataFrame(
        [(s, raw, int(t)) for s in ("emoreact", "attprob", "intprob", "extprob", "totprob") for raw, t in enumerate(_T.split(", "))],
        "scale string, raw int, tscore int",
    )
    return scores.score_questionnaire(
        rows, questions, norms, ["l_orderkey"],
        composites={"intprob": ["emoreact"], "extprob": ["attprob"], "totprob": ["emoreact", "attprob", "otherprob"]},
    )


# -- score reports ------------------------------------------------------------------------

_SHORT = ["a", "b", "c", "d", "e", "f"]


def _report_sql():
    scales = ["x", *_SHORT]
    cells = []
    for s in scales:
        cells.append(f"max(case when scale = '{s}' then raw end) cbcl_raw_{s}")
        cells.append(f"max(case when scale = '{s}' then t end) cbcl_t_{s}")
    for i, s in enumerate(scales):
        for flag, low, high in (("clinical", 70, 999), ("borderline", 65, 69)):
            cells.append(
                f"max(case when scale = '{s}' then case when tn between {low} and {high} then '1' else '0' end end) cbcl_{flag}___{i + 1}"
            )
    return (
        "with o as (select l_orderkey, l_linenumber, cast(max(l_quantity) as integer) q from lineitem group by 1, 2), "
        "p as (select *, row_number() over (partition by l_orderkey order by l_linenumber) place, count(*) over (partition by l_orderkey) width from o), "
        f"s as (select *, case when width = {len(_SHORT)} then {_SHORT}[place] else {scales}[place] end scale, "
        "cast(q as varchar) raw, q + 30 tn, cast(q + 30 as varchar) t from p where width in (6, 7)) "
        "select l_orderkey, 'visit' as event, " + ", ".join(cells) + " from s group by l_orderkey"
    )


@query("job_collect_score_reports", _report_sql())
def job_collect_score_reports(spark, d):
    """Lines of an order as cells of a report; six of them mean that the first scale is lacking.

    Orders of any other width are no reports.
    """
    scored = reports.report_scores(_report_cells(spark, d), ["l_orderkey"], ["x", *_SHORT], ["x"])
    return scores.collect_score_reports(scored.withColumn("event", F.lit("visit")), "l_orderkey", "event", ["x", *_SHORT])


def _report_cells(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("int").alias("q"))
    q = F.col("q")
    t = (q + 30).cast("string")
    printed = F.when(q >= 40, F.concat(t, F.lit("-C"))).when(q >= 35, F.concat(t, F.lit("-B"))).otherwise(t)
    rows = lines.select(
        "l_orderkey", "l_linenumber",
        F.explode(F.array(F.array(F.lit("Total Score"), q.cast("string")), F.array(F.lit("T Score"), printed))).alias("cells"),
    )
    return reports.labelled_cells(rows, ["l_orderkey"], ["l_linenumber"], F.col("cells"), ["Total Score", "T Score"])


@query(
    "rejected_reports",
    """with o as (select distinct l_orderkey, l_linenumber from lineitem), n as (select l_orderkey, count(*) width from o group by 1)
select l_orderkey, label, cast(width as integer) width from n cross join (values ('Total Score'), ('T Score')) x(label) where width not in (6, 7)""",
)
def rejected_reports(spark, d):
    """Reports that are neither of all scales nor of all but the first."""
    return reports.rejected_reports(_report_cells(spark, d), ["l_orderkey"], ["x", *_SHORT], ["x"])


@query(
    "job_score_reports_by_subject",
    """with o as (select l_orderkey, l_linenumber, cast(max(l_quantity) as integer) q from lineitem group by 1, 2),
p as (select *, row_number() over (partition by l_orderkey order by l_linenumber) place, count(*) over (partition by l_orderkey) width from o),
s as (select l_suppkey subject, l_orderkey, place, q from p join (select l_orderkey k, min(l_suppkey) l_suppkey from lineitem group by 1) on k = l_orderkey
  where width = 7 and l_orderkey in (select min(l_orderkey) from (select l_orderkey, min(l_suppkey) s, count(distinct l_linenumber) w from lineitem group by 1) where w = 7 group by s))
select subject, """
    + ", ".join(f"max(case when place = {i + 1} then cast(q as varchar) end) first_cbcl_raw_{s}" for i, s in enumerate(["x", *_SHORT]))
    + " from s group by subject",
)
def job_score_reports_by_subject(spark, d):
    """The first whole report of each supplier, in one row with the event in the names."""
    cells = _report_cells(spark, d).where("label = 'Total Score' and width = 7")
    suppliers = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("subject"))
    chosen = cells.select("l_orderkey").distinct().join(suppliers, "l_orderkey").groupBy("subject").agg(F.min("l_orderkey").alias("l_orderkey"))
    scored = reports.report_scores(cells.join(chosen, "l_orderkey"), ["subject", "l_orderkey"], ["x", *_SHORT], ["x"]).drop("l_orderkey")
    return scores.collect_score_reports(scored.withColumn("event", F.lit("first")), "subject", "event", ["x", *_SHORT], longitudinal=False)


def _report_folder_sql():
    short = [s for s in fixed.REPORT_SCALES if s not in fixed.COMPETENCE_SCALES]
    columns = []
    for k, scale in enumerate(fixed.REPORT_SCALES):
        # subjects of region 0 have the short reports
        value = f"n_nationkey + {k} - case when n_regionkey = 0 then {len(fixed.REPORT_SCALES) - len(short)} else 0 end"
        there = "" if scale in short else "n_regionkey <> 0 and "
        columns.append(f"case when {there}true then cast({value} as varchar) || chr(10) end as cbcl_raw_{scale}")
        columns.append(f"case when {there}true then cast({value} + 40 as varchar) end as cbcl_t_{scale}")
        columns.append(f"case when {there}true then cast(case when ({value}) % 3 = 0 then 1 else 0 end as varchar) end as cbcl_clinical___{k + 1}")
        columns.append(f"case when {there}true then cast(case when ({value}) % 3 = 1 then 1 else 0 end as varchar) end as cbcl_borderline___{k + 1}")
    return f"select 'NT' || n_nationkey as subject, 'year' || n_regionkey as event_name, {', '.join(columns)} from nation where n_regionkey < 2"


@query("job_score_report_folder", _report_folder_sql())
def job_score_report_folder(spark, d):
    """A file for each nation, in a folder for each region; only the chosen subjects' files are opened.

    Cells hold line breaks inside quotes, and of another nation's file the quote never closes.
    """
    path, chosen = shared_dir(spark, "scores"), []
    files = Files(spark, path)
    for nation, region in table(spark, d, "nation").select("n_nationkey", "n_regionkey").orderBy("n_nationkey").collect():
        count = len(fixed.REPORT_SCALES) - (len(fixed.COMPETENCE_SCALES) if region == 0 else 0)
        raw = [f'"{nation + k}\n"' for k in range(count)]
        t = [f"{nation + k + 40}" + ("-C", "-B", "")[(nation + k) % 3] for k in range(count)]
        text = f"a,b\nTotal Score,{','.join(raw)}\nT Score,{','.join(t)},\n" + ('"never' if region == 4 else "")
        files.create(f"region{region}/NT{nation}_year{region}.csv", text)
        if region < 2:
            chosen.append(f"NT{nation}")
    return scores.collect_score_report_folder(spark, path, "nt", chosen)


@query("job_import_battery_folder", _battery_sql())
def job_import_battery_folder(spark, d):
    """The same rows from a folder with a file that is none of the battery."""
    path = shared_dir(spark, "battery")
    rows = _battery_rows(spark, d)
    rows.drop("file").repartition(1).sortWithinPartitions("row").write.csv(f"{path}/battery", header=True)
    rows.select("PIN", "Inst").limit(5).write.csv(f"{path}/other", header=True)
    return scores.import_battery_folder(spark, path)[0]
