"""Scalar functions on the driver tables."""

from pyspark.sql import functions as F

from longrec import fixed_values as fixed
from longrec.functions import dates, labels, records, sentences, values
from longrec.operators import ordered
from longrec.queries import query, table


@query(
    "fractional_age",
    """select l_orderkey, l_linenumber, l_partkey,
  floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0) / 365.25 age
from lineitem join orders on o_orderkey = l_orderkey""",
)
def fractional_age(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return lines.join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", dates.age(F.col("o_orderdate"), F.col("l_shipdate")).alias("age")
    )


@query(
    "elapsed_days",
    """select event_id, cast(floor((epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by event_id)))
  / 86400000000.0) as bigint) forward,
  cast(floor((epoch_us(lag(ts) over (partition by user_id order by event_id)) - epoch_us(ts)) / 86400000000.0) as bigint) backward
from events""",
)
def elapsed_days(spark, d):
    """Whole days to the user's previous event, in both directions: rounded down, also below 0."""
    events = table(spark, d, "events").select("event_id", "user_id", "ts")
    return ordered.previous_values(events, ["user_id"], {"ts": "before"}, ["event_id"]).select(
        "event_id",
        dates.elapsed_days(F.col("before"), F.col("ts")).cast("long").alias("forward"),
        dates.elapsed_days(F.col("ts"), F.col("before")).cast("long").alias("backward"),
    )


@query(
    "event_label",
    """with e as (select o_orderkey, case o_orderstatus when 'P' then 'stable_arm_1' when 'F' then 'mini_clinic_' || left(o_orderpriority, 1) || '_arm_2'
  else year(o_orderdate) || '_arm_1' end event from orders)
select o_orderkey, regexp_replace(event, '_arm_.', '', 'g') event, case left(event, 4) when 'stab' then '0'
  when 'mini' then 'mc' || substr(event, 13, 1) else left(event, 4) end as label from e""",
)
def event_label(spark, d):
    event = (
        F.when(F.col("o_orderstatus") == "P", "stable_arm_1")
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("mini_clinic_"), F.substring("o_orderpriority", 1, 1), F.lit("_arm_2")))
        .otherwise(F.concat(F.year("o_orderdate").cast("string"), F.lit("_arm_1")))
    )
    rows = table(spark, d, "orders").select("o_orderkey", labels.strip_event_tail(event).alias("event"))
    return rows.withColumn("label", labels.clinic_label(F.col("event")))


@query("strip_prefix_text", "select c_custkey, replace(c_name, 'Customer#', '') as number from customer")
def strip_prefix_text(spark, d):
    return table(spark, d, "customer").select("c_custkey", labels.strip_prefix_text(F.col("c_name"), "Customer#").alias("number"))


_PIN_SQL = """select c_custkey, case when c_mktsegment = 'BUILDING' then 'cust' || c_custkey || '_S2'
  when c_mktsegment = 'MACHINERY' then 'CUST ' || c_custkey || 's3 parent'
  when c_mktsegment = 'HOUSEHOLD' then 'walk-in' else 'CUST' || c_custkey end pin from customer"""


def _pins(spark, d):
    number, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    pin = (
        F.when(segment == "BUILDING", F.concat(F.lit("cust"), number, F.lit("_S2")))
        .when(segment == "MACHINERY", F.concat(F.lit("CUST "), number, F.lit("s3 parent")))
        .when(segment == "HOUSEHOLD", F.lit("walk-in"))
        .otherwise(F.concat(F.lit("CUST"), number))
    )
    return table(spark, d, "customer").select("c_custkey", pin.alias("pin"))


_PIN = fixed.PIN_PATTERN


@query(
    "id_extract",
    f"""with p as ({_PIN_SQL}) select c_custkey, nullif(upper(replace(regexp_extract(pin, '{_PIN}', 1), ' ', '')), '') subject,
  coalesce(nullif(regexp_extract(pin, '{_PIN}', 2), ''), '1') session,
  coalesce(nullif(lower(regexp_extract(pin, '(?i)(s\\d?)', 1)), ''), '1') token from p""",
)
def id_extract(spark, d):
    pin = F.col("pin")
    return _pins(spark, d).select(
        "c_custkey", labels.pin_subject(pin).alias("subject"), labels.pin_session(pin).alias("session"),
        labels.session_token(pin).alias("token"),
    )


@query(
    "composite_key",
    "select o_orderkey, cast(o_custkey as varchar) subject, year(o_orderdate) || '_arm_1' as event from orders",
)
def composite_key(spark, d):
    key = F.concat_ws("_", F.col("o_custkey").cast("string"), F.year("o_orderdate").cast("string"), F.lit("arm_1"))
    subject, event = labels.split_key(F.col("key"))
    return table(spark, d, "orders").select("o_orderkey", key.alias("key")).select(
        "o_orderkey", subject.alias("subject"), event.alias("event")
    )


@query(
    "instrument_map",
    """select p_partkey, case when p_name like '%small%' then 'size_s' when p_name like '%ring%' then 'kind_r'
  when p_name like '%bolt%' then 'kind_b' else p_name end variable from part""",
)
def instrument_map(spark, d):
    """By substring; of several matches the last entry wins."""
    mapping = {"bolt": "kind_b", "ring": "kind_r", "small": "size_s"}
    return table(spark, d, "part").select("p_partkey", labels.map_instrument(F.col("p_name"), mapping).alias("variable"))


@query(
    "measure_code",
    """with w as (select p_partkey, list_filter(string_split_regex(trim(regexp_replace(regexp_replace(p_name || ' ' || p_brand,
  '[_.-]', ' ', 'g'), '([A-Z])', ' \\1', 'g')), '\\s+'), lambda x: x <> '') words from part),
i as (select p_partkey, array_to_string(list_transform(words, lambda x: lower(left(x, 1))), '') initials from w)
select p_partkey, replace(left(initials, 2) || '_' || substr(initials, 3), 'rb', 'ab') code from i""",
)
def measure_code(spark, d):
    label = F.concat_ws(" ", "p_name", "p_brand")
    return table(spark, d, "part").select("p_partkey", labels.measure_code(label, [("rb", "ab")]).alias("code"))


@query(
    "path_patient",
    """select page_id, nullif(regexp_extract(url, '(?i)((en|fr|de|es)/\\d+)', 1), '') patient,
  nullif(split_part(regexp_extract(url, '(?i)((en|fr|de|es)/\\d+)', 1), '_', 1), '') subject from pages""",
)
def path_patient(spark, d):
    patient = labels.path_patient(F.col("url"), r"(?:en|fr|de|es)/\d+")
    return table(spark, d, "pages").select("page_id", patient.alias("patient")).withColumn(
        "subject", labels.patient_subject(F.col("patient"))
    )


_ANSWER_SQL = "select event_id, case event_type when 'error' then 'n/a' when 'signup' then ' late ' else cast(value as varchar) end as answer from events"


def _answers(spark, d):
    kind = F.col("event_type")
    answer = F.when(kind == "error", "n/a").when(kind == "signup", " late ").otherwise(F.col("value").cast("string"))
    return table(spark, d, "events").select("event_id", answer.alias("answer"))


@query(
    "text_values",
    f"""with a as ({_ANSWER_SQL}) select event_id, try_cast(answer as double) as number,
  try_cast(case when answer like '%.%' then null else answer end as integer) whole,
  coalesce(cast(try_cast(answer as double) as varchar), trim(answer)) typed,
  coalesce(cast(cast(trunc(try_cast(answer as double)) as bigint) as varchar), answer) plain from a""",
)
def text_values(spark, d):
    """Number, integer, typed option and plain answer of the same texts."""
    text = F.col("answer")
    return _answers(spark, d).select(
        "event_id",
        values.to_number(text).alias("number"),
        F.when(~text.contains("."), values.to_integer(text)).alias("whole"),
        values.typed_option(text).alias("typed"),
        values.plain_answer(text).alias("plain"),
    )


_CHOICES = "1-URGENT, now | 2-HIGH, soon, or so | now, never |"


@query(
    "recode_map",
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 'now' when '2-HIGH' then 'soon, or so' else o_orderpriority end
  as priority, case o_orderstatus when 'F' then 'O' when 'O' then 'P' when 'P' then 'F' end status from orders""",
)
def recode_map(spark, d):
    """Whole values, all at once: F becomes O although O becomes P."""
    return table(spark, d, "orders").select(
        "o_orderkey",
        values.recode(F.col("o_orderpriority"), values.parse_choices(_CHOICES)).alias("priority"),
        values.recode(F.col("o_orderstatus"), {"F": "O", "O": "P", "P": "F"}).alias("status"),
    )


@query(
    "choice_map",
    "select p_partkey, p_name first_choice, p_brand || ', ' || p_type second_choice, 2 choices from part",
)
def choice_map(spark, d):
    """Choice texts parsed as a column."""
    text = F.concat(F.lit("1, "), F.col("p_name"), F.lit(" | 2, "), F.col("p_brand"), F.lit(", "), F.col("p_type"), F.lit(" |"))
    return table(spark, d, "part").select("p_partkey", values.choices_map(F.rtrim(text)).alias("m")).select(
        "p_partkey", F.col("m")["1"].alias("first_choice"), F.col("m")["2"].alias("second_choice"), F.size("m").alias("choices")
    )


@query("gender_recode", "select c_custkey, case when lower(c_mktsegment) in ('machinery', 'building') then 1 else 2 end code from customer")
def gender_recode(spark, d):
    """Two of the labels are 1, all others 2."""
    found = values.parse_choices("MACHINERY, Machinery | BUILDING, Building | HOUSEHOLD, House | FURNITURE, F | AUTOMOBILE, A |")
    codes = {k: "1" if v.lower() in ("machinery", "building") else "2" for k, v in found.items()}
    return table(spark, d, "customer").select("c_custkey", values.recode(F.col("c_mktsegment"), codes).cast("int").alias("code"))


@query(
    "range_flags",
    "select p_partkey, case when p_size between 31 and 35 then 1 else 0 end borderline, "
    "case when p_size between 20 and 30 then 1 else 0 end clinical from part",
)
def range_flags(spark, d):
    limits = fixed.SCORE_FLAGS
    return table(spark, d, "part").select(
        "p_partkey",
        *[values.range_flag(F.col("p_size"), *limits[f"Activities_TScore.{flag}"]).alias(flag) for flag in ("borderline", "clinical")],
    )


@query(
    "percentile_band",
    f"""select p_partkey, case when p_size + 40 = 50 then '<= 50' when p_size + 40 < 50 then null
  when p_size - 10 >= {len(fixed.PERCENTILES)} then '> 98' else cast({fixed.PERCENTILES}[p_size - 9] as varchar) end band,
  case when p_size + 40 >= 70 then 1 else 0 end clinical,
  case when p_size + 40 between 65 and 69 then 1 else 0 end borderline from part""",
)
def percentile_band(spark, d):
    t = F.col("p_size") + 40
    return table(spark, d, "part").select(
        "p_partkey", values.percentile_band(t).alias("band"), values.clinical_flag(t).alias("clinical"), values.borderline_flag(t).alias("borderline")
    )


@query(
    "tscore_text",
    """select p_partkey, case when p_size < 5 then null else cast(p_size + 40 as varchar) end score,
  case when p_size >= 30 then 1 else 0 end clinical, case when p_size between 25 and 29 then 1 else 0 end borderline from part""",
)
def tscore_text(spark, d):
    """Printed scores such as 71-C, 66-B, 50 or nc."""
    size = F.col("p_size")
    number = (size + 40).cast("string")
    text = F.when(size < 5, "nc").when(size >= 30, F.concat(number, F.lit("-C"))).when(size >= 25, F.concat(number, F.lit("-B"))).otherwise(number)
    score, clinical, borderline = values.tscore_parts(text)
    return table(spark, d, "part").select("p_partkey", score.alias("score"), clinical.alias("clinical"), borderline.alias("borderline"))


_RULES = {"1-URGENT": "Date", "2-HIGH": "Age", "3-MEDIUM": "Month", "4-NOT SPECIFIED": "Year", "5-LOW": "Clinic dx"}


@query(
    "dx_text",
    """with r as (select o_orderkey, o_orderpriority, o_orderdate as day, o_totalprice / 10000 age, o_orderstatus from orders)
select o_orderkey, '<span style="color:#0e1f8a;">Diagnosis:</span> ' || case o_orderpriority
  when '1-URGENT' then 'The <i>actual dx date</i> is ' || strftime(day, '%B ') || day(day) || strftime(day, ', %Y') || '; age = ' || printf('%.2f', age) || '.'
  when '2-HIGH' then '<i>Estimated age</i> at dx = ' || printf('%.1f', age)
  when '3-MEDIUM' then '<i>Estimated</i> dx at <i>' || strftime(day, '%B %Y') || '</i>; age = ' || printf('%.2f', age)
  when '4-NOT SPECIFIED' then '<i>Estimated</i> dx in <i>year ' || year(day) || '</i> (used ' || strftime(day, '%B ') || day(day)
    || strftime(day, ', %Y') || '); age = ' || printf('%.2f', age)
  else '<i>Clinic dx</i> at the ' || year(day) || ' clinic (' || strftime(day, '%B %Y') || '); age = ' || printf('%.2f', age) end
  || '<br /><br /><span style="color:#0e1f8a;">Notes:</span> ' || o_orderstatus as sentence from r""",
)
def dx_text(spark, d):
    """One sentence per order; finished orders carry an estimate, the others the date itself."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rule = values.recode(F.col("o_orderpriority"), _RULES)
    finished = F.col("o_orderstatus") == "F"
    text = sentences.diagnosis_text(
        rule, F.col("o_totalprice") / 10000, F.col("o_orderstatus"),
        F.when(finished, "").otherwise(day), F.when(finished, day).otherwise(""),
    )
    return table(spark, d, "orders").select("o_orderkey", text.alias("sentence"))


@query(
    "dx_text_unknown",
    """select c_custkey, '<span style="color:#0e1f8a;">Diagnosis:</span> ' || case c_mktsegment when 'BUILDING' then 'No diagnosis'
  when 'MACHINERY' then 'Diagnosis present, but age unknown' else '' end
  || '<br /><br /><span style="color:#0e1f8a;">Notes:</span> ' || c_name as sentence from customer""",
)
def dx_text_unknown(spark, d):
    """Rules without a date; an unknown rule has no sentence, the notes always follow."""
    rule = values.recode(F.col("c_mktsegment"), {"BUILDING": "No dx", "MACHINERY": "Dx age unknown"})
    none = F.lit("")
    return table(spark, d, "customer").select(
        "c_custkey", sentences.diagnosis_text(rule, F.lit(None).cast("double"), F.col("c_name"), none, none).alias("sentence")
    )


@query(
    "dx_texts",
    """select p_partkey, '<span style="color:#0e1f8a;">Diagnosis:</span> <i>Estimated age</i> at dx = ' || p_size || '.0'
  || '<br /><br /><span style="color:#0e1f8a;">Notes:</span> ' || p_name dm_dx_label,
  '<span style="color:#0e1f8a;">Diagnosis:</span> ' || case when p_size > 20 then 'No diagnosis' else 'Diagnosis present, but age unknown' end
  || '<br /><br /><span style="color:#0e1f8a;">Notes:</span> ' || p_type oa_dx_label from part""",
)
def dx_texts(spark, d):
    """Two diagnoses of a row at once."""
    none = F.lit("")
    rows = table(spark, d, "part").select(
        "p_partkey",
        *[c.alias(n) for n, c in {
            "dm_dx_date_rule": F.lit("Age"), "dm_dx_age": F.col("p_size").cast("double"), "dm_dx_date_notes": F.col("p_name"),
            "dm_dx_date": none, "dm_dx_date_est": none,
            "oa_dx_date_rule": F.when(F.col("p_size") > 20, "No dx").otherwise("Dx age unknown"), "oa_dx_age": F.lit(None).cast("double"),
            "oa_dx_date_notes": F.col("p_type"), "oa_dx_date": none, "oa_dx_date_est": none,
        }.items()],
    )
    return sentences.with_diagnosis_texts(rows, ["dm", "oa"]).select("p_partkey", "dm_dx_label", "oa_dx_label")


_CARD = [f"q{k}" for k in range(1, 8)]
_COUNTS = ", ".join(f"nullif(count(*) filter (l_linenumber = {k}), 0) q{k}" for k in range(1, 8))
_DIGITS = " || ".join(f"coalesce(cast(q{k} - shift as varchar), '9')" for k in range(1, 8))


@query(
    "fixed_width",
    f"""with o as (select l_orderkey, {_COUNTS} from lineitem group by 1),
s as (select *, case when least(q1, q2, q3, q4, q5, q6, q7) = 0 then 0 else 1 end shift from o)
select l_orderkey, lpad(left('order_' || l_orderkey, 9) || right('order_' || l_orderkey, 1), 10, ' ') || '02' || '1'
  || printf('%02d', l_orderkey % 100) || {_DIGITS} || chr(10) || lpad(left('order_' || l_orderkey, 9) || right('order_' || l_orderkey, 1), 10, ' ')
  || '03' || '1' || printf('%02d', l_orderkey % 100) || {_DIGITS} || 'END' as record from s""",
)
def fixed_width(spark, d):
    """Line counts of an order as answers: digits less 1, 9 where there is none."""
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        *[F.nullif(F.count(F.when(F.col("l_linenumber") == k, 1)), F.lit(0)).alias(f"q{k}") for k in range(1, 8)]
    )
    card = records.symptom_card(_CARD)
    subject = F.concat(F.lit("order_"), F.col("l_orderkey").cast("string"))
    record = records.record_text(subject, F.lit(1), F.col("l_orderkey") % 100, {"02": card, "03": card})
    return rows.select("l_orderkey", record.alias("record"))


@query(
    "competence_card",
    """with p as (select p_partkey, p_size % 6 a, case when p_size > 40 then null else p_size % 6 end b, p_size % 3 c, p_size % 5 d from part)
select p_partkey, repeat(' ', 18) || (a - 1) || coalesce(cast(case when b in (4, 5) then 9 else b end as varchar), '9')
  || (case when c = 2 then 1 else 2 end) || (case when d = 4 then 0 else d end) || '9' as card from p""",
)
def competence_card(spark, d):
    """Counts less 1, 4 and 5 as 9, yes/no swapped, no siblings as 0, missing as 9."""
    size = F.col("p_size")
    rows = table(spark, d, "part").select(
        "p_partkey", (size % 6).alias("number_a"), F.when(size <= 40, size % 6).alias("rating_b"),
        (size % 3).alias("yes_c"), (size % 5).alias("sibs"), F.lit(None).cast("int").alias("other"),
    )
    card = records.competence_card(
        ["number_a", "rating_b", "yes_c", "sibs", "other"], "number", "friends", "other", "rating_b", ["yes_c"], "sibs"
    )
    return rows.select("p_partkey", card.alias("card"))
