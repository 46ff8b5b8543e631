import os
import time

import pytest
from conftest import dicts, rows
from pyspark.sql import functions as F

from longrec import fixed_values as fixed
from longrec.operators.recode import ChangeMap, Dictionary, graded_merge, read_dictionary
from longrec.plans import exports, measures, migration, scores, sessions
from longrec.sources import folders, reports


@pytest.fixture
def export(spark):
    data = [
        ("SUB_1", "stable_arm_1", None, None, None, "2000-01-01", None, None, "F", None),
        ("SUB_1", "2015_arm_1", 1.0, None, 2015, None, "2015-01-01", "2015-01-02", None, 10),
        ("SUB_1", "2016_arm_1", 2.0, None, 2016, None, "2016-01-01", None, None, 11),
        ("SUB_1", "2017_arm_1", 3.0, 1, 2017, None, "2017-01-01", "2017-01-02", None, 12),
        ("SUB_2", "stable_arm_1", None, None, None, None, None, None, "M", None),
        ("SUB_2", "2015_arm_1", 1.0, None, 2015, None, "2015-06-01", "2015-06-02", None, 20),
        ("SUB_2", "2017_arm_1", None, None, 2017, None, "2017-06-01", "2017-06-02", None, 21),
        ("test", "2015_arm_1", 1.0, None, 2015, None, None, None, None, 99),
    ]
    return spark.createDataFrame(
        data,
        "study_id string, event_name string, session_number double, missed_session int, session_year int, dob string, "
        "clinic_date string, mri_date string, sex string, v int",
    ).withColumn("repeat_instrument", F.lit("x"))


def test_format_sessions_long(export):
    out = sessions.format_sessions(export, ["session_year"], key_pattern="^(SUB|SIB)")
    got = sorted((r["study_id"], r["session_number"], r["clinic_year"], r["clinic_age"], r["v"]) for r in out.collect())
    assert got == sorted([
        ("SUB_1", 0, "0", None, None), ("SUB_1", 1, "2015", 5479 / 365.25, 10), ("SUB_1", 2, "2016", 5844 / 365.25, 11),
        ("SUB_2", 0, "0", None, None), ("SUB_2", 1, "2015", None, 20),
    ])
    assert not {"dob", "clinic_date", "mri_date", "event_name", "repeat_instrument"} & set(out.columns)


def test_format_sessions_wide(export):
    out = sessions.format_sessions(
        export, ["session_year"], key_pattern="^SUB", consecutive=2, imaging_only=True, flatten_by="session"
    )
    # two places, one of them taken by the stable row; the stable row survives the imaging filter
    got = dicts(out, "study_id")
    assert set(got) == {"SUB_1"}
    assert got["SUB_1"]["s0_sex"] == "F" and got["SUB_1"]["s1_v"] == 10 and "s2_v" not in out.columns
    by_clinic = sessions.format_sessions(export, ["session_year"], key_pattern="^SUB", flatten_by="clinic", sort_by="session/clinic")
    assert by_clinic.columns[:2] == ["study_id", "c0_sex"] and "c0_session_number" not in by_clinic.columns
    assert dicts(by_clinic, "study_id")["SUB_2"]["c2015_session_number"] == 1


def test_format_sessions_checks(export):
    with pytest.raises(ValueError):
        sessions.format_sessions(export, ["session_year"], consecutive=4)
    with pytest.raises(ValueError, match="no data"):
        sessions.format_sessions(export, ["session_year"], key_pattern="^none")
    long = sessions.format_sessions(export, ["session_year"], key_pattern="^SUB", flatten_by="session", transpose=True)
    assert long.columns == ["variable", "study_id", "value"]


@pytest.fixture
def cohort(spark):
    return spark.createDataFrame(
        [("TRK1", "F", 8.0, "2015-03-01", "2016-03-01", None, 1, 2, None), ("TRK2", "M", 0.0, "2015-03-01", None, "2017-03-01", 3, None, 4),
         ("other", "M", 1.0, "2015-03-01", None, None, 9, None, None)],
        "study_id string, sex string, db_onset_age double, s1_physicalexam_date string, s2_physicalexam_date string, "
        "s3_physicalexam_date string, s1_v int, s2_v int, s3_v int",
    )


def test_format_cohort(spark, cohort):
    births = spark.createDataFrame([("TRK1", "2005-03-01"), ("TRK2", "2005-03-01")], "study_id string, dob string")
    out = sessions.format_cohort(cohort, key_pattern=r"TRK\d+", enrichment=births, duration=True, long=True)
    got = {(r["study_id"], r["session_number"]): r["dx_db_duration"] for r in out.collect()}
    assert got == {
        ("TRK1", "s1"): 3652 / 365.25 - 8, ("TRK1", "s2"): 4018 / 365.25 - 8,
        ("TRK2", "s1"): 3652 / 365.25, ("TRK2", "s3"): 4383 / 365.25,
    }
    assert "dob" not in out.columns and "session_age" not in out.columns


def test_format_cohort_wide_again(cohort):
    out = sessions.format_cohort(cohort, key_pattern=r"TRK\d+", consecutive=2)
    got = dicts(out, "study_id")
    assert set(got) == {"TRK1"}
    assert got["TRK1"]["sex"] == "F" and got["TRK1"]["s1_v"] == 1 and got["TRK1"]["s2_v"] == 2
    assert set(dicts(sessions.format_cohort(cohort, require_all=["s2_v"]), "study_id")) == {"TRK1"}


def test_number_sessions(spark):
    df = spark.createDataFrame([("SUB_2015_a", "2018_arm_1", 1), ("SUB_2020_b", "2019_arm_1", 2)], "study_id string, event_name string, v int")
    out = sessions.number_sessions(df, ["2018_arm_1", "2019_arm_1"])
    got = {(r["study_id"], r["event_name"]): (r["session_number"], r["v"]) for r in out.collect()}
    assert got == {
        ("SUB_2015_a", "2018_arm_1"): (4, 1), ("SUB_2015_a", "2019_arm_1"): (5, None),
        ("SUB_2020_b", "2018_arm_1"): (-1, None), ("SUB_2020_b", "2019_arm_1"): (None, 2),
    }


def battery(spark):
    labels = ["Picture Vocabulary Test", "Flanker Inhibitory Control", "List Sorting", "Crystallized Composite", "Self Neuro-QoL"]
    data = [("f1.csv", "sub 01_s1", inst, 10 * i, 20 * i, 30 * i, 40 * i, i) for i, inst in enumerate(labels, 1)]
    data += [("f1.csv", "sub01 parent", "Oral Reading", 1, 2, 3, 4, 6), ("f1.csv", "sub01 parent", "Neuro-QoL", 5, 6, 7, 8, 7)]
    data += [("f2.csv", "SUB02", "Picture Vocabulary Test", 1, 1, 1, 1, 8), ("f2.csv", "SUB02", "Picture Vocabulary Test", 2, 2, 1, 2, 9)]
    return spark.createDataFrame(
        data, 'file string, PIN string, Inst string, RawScore int, TScore int, `Uncorrected Standard Score` int, '
        '`Age-Corrected Standard Score` int, row int'
    )


def test_battery(spark):
    got = dicts(scores.import_battery(battery(spark), ["row"]), "subject")
    first = got["SUB01"]
    assert first["s1_vocab_unadj"] == 30 and first["s1_vocab_ageadj"] == 40
    assert first["s1_crystal_cog_unadj"] == 120 and first["s1_cog_crystal_ageadj"] == 160
    assert first["s1_self_neuroqol"] == 50 and first["s1_self_neuroqol_tscore"] == 100
    assert first["parent_oral_reading_unc"] == 3 and first["parent_oral_reading_ac"] == 4
    assert first["s1_parent_neuroqol_raw"] == 5 and first["s1_parent_neuroqol_unc"] == 7
    assert not any(c.endswith("_raw") for c in first if "neuroqol" not in c)
    # few rows: read as a parent; equal scores collapse to the last row
    assert got["SUB02"]["parent_pic_vocab_unc"] == 1 and got["SUB02"]["parent_pic_vocab_ac"] == 2
    only = scores.import_battery(battery(spark), ["row"], subjects=["SUB02"])
    assert rows(only.select("subject")) == [("SUB02",)]


def test_battery_sessions_stay_apart(spark):
    df = battery(spark).where("PIN = 'SUB02'")
    twice = df.unionByName(df.withColumn("PIN", F.lit("SUB02_S2")))
    with pytest.raises(ValueError, match="duplicate"):
        # the parent names carry no session: two sessions clash
        scores.import_battery(twice, ["row"])


def test_import_scores(spark):
    mapping = spark.createDataFrame(
        [("AssessedPersonId", "id", None), ("Social_TScore", "soc", None), ("Social_TScore.clinical", "soc___1", None),
         ("Social_TScore.borderline", None, None), (None, "cbcl_age_6_18_yn", "1")],
        "source_var string, target_var string, fill_value string",
    )
    df = spark.createDataFrame([("a_2015_arm_1", 30, 1), ("b", 33, 2)], "AssessedPersonId string, Social_TScore int, drop int")
    out = scores.import_scores(df, mapping, longitudinal=True)
    assert out.columns == ["id", "event_name", "soc", "Social_TScore.borderline", "soc___1", "cbcl_age_6_18_yn"]
    assert rows(out) == [("a", "2015_arm_1", 30, 0, 1, 1), ("b", None, 33, 1, 0, 1)]
    assert "drop" not in scores.import_scores(df, mapping).columns
    wide = scores.import_scores(df.limit(1), mapping, longitudinal=True, wide=True)
    assert "2015_arm_1_soc" in wide.columns


def questionnaire(spark, prefix=""):
    scales = {"emoreact": [1, 2], "otherprob": [3], "attprob": [4]}
    df = spark.createDataFrame(
        [("a", 1, 2, 0, None, 2), ("b", 9, 9, 1, 1, 2), ("c", None, None, None, None, 2), ("d", 1, 1, 1, 1, 0)],
        f"id string, {prefix}ycbcl_q1 int, {prefix}ycbcl_q2 int, {prefix}ycbcl_q3 int, {prefix}ycbcl_q4 int, ycbcl_age_5_complete int",
    )
    questions = spark.createDataFrame([(s, q) for s, qs in scales.items() for q in qs], "scale string, question int")
    norms = spark.createDataFrame(
        [(s, r, 50 + 7 * r) for s in ("emoreact", "attprob", "totprob") for r in range(5)], "scale string, raw int, tscore int"
    )
    return scores.score_questionnaire(
        df, questions, norms, ["id"], prefix, composites={"totprob": ["emoreact", "attprob", "otherprob"]}
    )


def test_questionnaire(spark):
    got = dicts(questionnaire(spark), "id")
    assert set(got) == {"a", "b"}  # empty and incomplete forms are left out
    a, b = got["a"], got["b"]
    assert (a["ycbcl_raw_emoreact"], a["ycbcl_t_emoreact"], a["ycbcl_per_emoreact"]) == (3, 71, "> 98")
    assert (a["ycbcl_raw_attprob"], a["ycbcl_t_attprob"], a["ycbcl_per_attprob"]) == (0, 50, "<= 50")
    assert (a["ycbcl_clinical___1"], a["ycbcl_borderline___1"]) == (1, 0)
    assert a["ycbcl_raw_totprob"] == 3 and "ycbcl_per_totprob" not in a
    assert (b["ycbcl_raw_emoreact"], b["ycbcl_t_emoreact"], b["ycbcl_clinical___1"]) == (18, None, 0)
    assert not any("otherprob" in c for c in a) and a["ycbcl_age_5_yn"] == 1 and a["ycbcl_age_5_scores_complete"] == 2


def test_questionnaire_with_session(spark):
    a = dicts(questionnaire(spark, "s1_"), "id")["a"]
    assert a["s1_ycbcl_t_emoreact"] == 71 and a["s1_cbcl_clinical___1"] == 1 and a["s1_cbcl_clinical___9"] == 0


def test_score_reports(spark):
    lines = spark.createDataFrame(
        [("A1", "base", 1, ["Total Score", "1", "2"]), ("A1", "base", 2, ["T Score", "71-C", "nc"]), ("A1", "base", 3, ["Percentile", "98", "nc"])],
        "subject string, visit string, line int, cells array<string>",
    )
    cells = reports.labelled_cells(lines, ["subject", "visit"], ["line"], F.col("cells"), list(fixed.REPORT_ROWS))
    scored = reports.report_scores(cells, ["subject", "visit"], ["x", "y"], [])
    out = scores.collect_score_reports(scored, "subject", "visit", ["x", "y"])
    assert out.first().asDict() == {
        "subject": "A1", "visit": "base", "cbcl_raw_x": "1", "cbcl_raw_y": "2", "cbcl_t_x": "71", "cbcl_per_x": "98",
        "cbcl_clinical___1": "1", "cbcl_clinical___2": "0", "cbcl_borderline___1": "0", "cbcl_borderline___2": "0",
    }


def test_answers(spark):
    mapping = spark.createDataFrame(
        [("Q_sex", "sex", None), ("Q1", "cbcl_1", "0, 5 | 1, 6"), ("Q2", "cbcl_2", None), ("Q3", "gone", None)],
        "source_var string, target_var string, opt_replacements string",
    )
    ids = spark.createDataFrame([("Q_sex", 1), ("Q1", 2), ("Q2", None)], "source_var string, json_id int")
    df = spark.createDataFrame(
        [("a", "1", "F", "0", "7"), ("a", "2", None, "1", None), ("a", "3", None, None, None), ("b", "1", None, "2", None)],
        "who string, visit string, sex string, cbcl_1 string, cbcl_2 string",
    )
    out = exports.export_answers(df, mapping, ids, ["session_number"], "form", "soc")
    answers = {r["id"]: r["document"] for r in out.collect()}
    assert set(answers) == {"a_1", "a_2", "b_1"}
    assert '"Answers":[{"QuestionId":1,"Value":"F","Comments":[]},{"QuestionId":2,"Value":"6","Comments":[]}]' in answers["a_2"]
    assert '"Answers":[{"QuestionId":2,"Value":"2","Comments":[]}]' in answers["b_1"]


def test_answers_from_wide_export(spark):
    mapping = spark.createDataFrame([("Q_sex", "sex", None), ("Q1", "cbcl_1", None)], "source_var string, target_var string, opt_replacements string")
    ids = spark.createDataFrame([("Q_sex", 1), ("Q1", 2)], "source_var string, json_id int")
    df = spark.createDataFrame([("a", "F", "1", "2")], "who string, sex string, s1_cbcl_1 string, s2_cbcl_1 string")
    out = exports.export_answers(df, mapping, ids, ["session_number"], "form", "soc", wide=True)
    assert {r["id"] for r in out.collect()} == {"a_s1", "a_s2"}
    assert all('"Value":"F"' in r["document"] for r in out.collect())


def fields(*names):
    return Dictionary(tuple({"name": n, "form": f, "type": t, "label": label, "choices": c} for n, f, t, label, c in names))


def test_records_per_session(spark):
    dictionary = fields(
        ("gender", "demo", "radio", "Gender", "0, Girl | 1, Boy"),
        *[(f"s{s}_q{q}", "cbcl", "radio", label, None) for s in (1, 2)
          for q, label in ((1, "1. Acts too young for his/her age"), (58, "58. Picks nose, skin, or other parts of body"),
                           (59, "59. Plays with own sex parts in public"), (113, "113. Other"))],
    )
    df = spark.createDataFrame(
        [("sub1", 1, 7.5, 8.5, 1, 2, 3, None, 0, 0, 0, 0), ("sub2", 0, 6.0, None, 0, 1, 0, 1, 0, 2, 0, 2)],
        "id string, gender int, s1_age double, s2_age double, s1_q1 int, s1_q58 int, s1_q59 int, s1_q113 int, "
        "s2_q1 int, s2_q58 int, s2_q59 int, s2_q113 int",
    )
    records, rejected = exports.export_records(df, dictionary, "age")
    got = {r["id"]: r["record"].split("\n") for r in records.collect()}
    # an empty second session drops that record only
    assert set(got) == {"sub1_s1", "sub2_s1"}
    head = "sub1_s11".rjust(10)
    assert got["sub1_s1"] == [head + "01107" + " " * 18 + "9" * 38 + "CBC", head + "02107" + "01", head + "03107" + "29END"]
    assert got["sub2_s1"][1:] == ["sub2_s11".rjust(10) + "02206" + "01", "sub2_s11".rjust(10) + "03206" + "01END"]
    assert rows(rejected) == [("sub2_s2", "missing age or gender")]


def test_migration(spark):
    changes = ChangeMap.from_table(
        spark.createDataFrame(
            [("old", "new", None, None, "1, 2 | 2, 3"), ("box", "boxes", None, None, None), ("bad", None, None, 1, None),
             ("leg_l", "leg_l", "leg", None, None), ("leg_r", "leg_r", "leg", None, None), ("tng", "tng", "leg", None, None)],
            "old_var string, new_var string, merge_var string, drop int, opt_replacements string",
        )
    )
    dictionary = read_dictionary(
        spark.createDataFrame(
            [("sex", "patient_demographics", "text", "Sex", None), ("new", "visit", "radio", "New", None), ("boxes", "visit", "checkbox", "", None),
             ("sum", "visit", "calc", "", None), ("count", "visit", "text", "", None), ("bad", "visit", "text", "", None), ("leg", "visit", "radio", "", None)],
            "`Variable / Field Name` string, `Form Name` string, `Field Type` string, `Field Label` string, `Choices, Calculations, OR Slider Labels` string",
        )
    )
    df = spark.createDataFrame(
        [("SUB_1", "pre_stable_patient_cha_arm_1", 0, None, "1", None, "9", None, None, None, None, None, None, "2"),
         ("SUB_1", "pre_2015", 1, "F", "2", "1", "9", "x", "1", "0", "1", "3", "y", None),
         ("SUB_1", "pre_2016", 2, "M", "9", "0", "9", None, None, None, "0", "4.0", "y", None),
         ("test", "pre_2016", 3, "M", "9", "0", "9", None, None, None, "0", "4.5", "y", None)],
        "study_id string, event_name string, i int, sex string, old string, box___1 string, sum string, bad string, leg_l string, "
        "leg_r string, tng string, count string, stray string, patient_demographics_complete string",
    )
    out, plan = migration.migrate(
        df, changes, dictionary, ["i"], key_pattern="^SUB", event_prefix="pre_", merge_rules={"leg": graded_merge}
    )
    assert [(p.column, p.kind) for p in plan] == [("count", "long")]
    got = dicts(out, "i")
    assert set(got[0]) == {"study_id", "event_name", "sex", "new", "boxes___1", "count", "leg", "patient_demographics_complete"}
    assert (got[0]["sex"], got[0]["new"], got[0]["patient_demographics_complete"]) == ("F", "2", "2")
    assert (got[1]["sex"], got[1]["new"], got[1]["leg"], got[1]["count"], got[1]["boxes___1"]) == (None, "3", 3, 3, "1")
    assert (got[2]["new"], got[2]["leg"], got[2]["count"]) == ("9", 0, 4)


def test_blocks(spark):
    df = spark.createDataFrame(
        [("D1", 1, "Finger Tap Mean Peak Velocity", 1.0, 2.0, 9), ("D1", 2, "Finger Tap Mean Peak Velocity", 3.0, None, 9), ("D1", 3, None, 5.0, 6.0, 9)],
        "record_id string, block int, measure string, `Left Avg` double, `Right Avg` double, n int",
    )
    got = dicts(measures.import_blocks(df), "record_id")["D1"]
    assert got == {
        "block1_ft_mpv_left": 1.0, "block1_ft_mpv_left_right": 2.0, "block2_ft_mpv_left": 3.0, "block2_ft_mpv_left_right": None,
        "block_1_kinematics_complete": 1, "block_2_kinematics_complete": 1, "block_3_kinematics_complete": 1,
    }


def test_slopes_wide(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0, 2.0, None, "g"), ("a", 2, 2.0, 4.0, 1.0, "g"), ("b", 1, 1.0, None, None, "h")],
        "id string, session int, age double, v double, w double, grp string",
    )
    out = measures.slopes(df, "age", ["session"], group="grp")
    # as in the long table, a subject without a slope has no group in that row
    assert out.columns == ["id", "grp", "v_age_s1", "v_count", "v_nrmse", "v_rmse", "v_slope", "w_age_s1", "w_count", "w_nrmse", "w_rmse", "w_slope"]
    assert {r["id"] for r in out.collect()} == {"a"}
    assert measures.slopes(df, "age", ["session"], variables=["v"], wide=False).count() == 1


def test_group_tables(spark):
    df = spark.createDataFrame([(str(i), 1, float(i), 2.0 * i, -1.0 * i, "g") for i in range(1, 6)], "id string, s int, x double, up_v double, down double, g string")
    fitted, points = measures.group_tables(df, "x", "g", ["^up"])
    assert [r["variable"] for r in fitted.collect()] == ["up_v"] and points.count() == 5


def test_collect_reports(spark):
    schema = "Subject string, `Patient ID` string, Age string, Sex string, job_id string, v int, i int"
    new = spark.createDataFrame([("A", "A_s1", "4", "F", "j1", 1, 1), ("A", "A_s1", "4", "F", "j2", 2, 2), ("A", "A_s1", "4", "F", "j3", 3, 3)], schema)
    old = spark.createDataFrame([("A", "A_s1", "4", "F", "j1", 9, 1)], schema).withColumn("type", F.lit("ceres"))
    headers = spark.createDataFrame([("j2", "Crus"), ("j3", "Brainstem")], "job_id string, header string")
    files = spark.createDataFrame([("j2", "f")], "job_id string, file string")
    out = measures.collect_reports(new, headers, files, old, ["i"])
    assert sorted((r["type"], r["v"]) for r in out.collect()) == [("ceres", 2), ("subcortical", 3)]


def test_extract_and_merge(spark):
    df = spark.createDataFrame([("a", "1", 1, 2), ("b", "1", 3, 4)], "id string, s string, v_x int, w int")
    base = spark.createDataFrame([("a", "1", None, 7)], "id string, s string, v_x int, z int")
    assert sessions.extract_and_merge(df, ["v"]).columns == ["id", "s", "v_x"]
    assert rows(sessions.extract_and_merge(df, ["v"], base)) == [("a", "1", 1, 7), ("b", "1", 3, None)]


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_report_folder(spark, tmp_path):
    put(tmp_path / "A1_s1_job000001" / "report.csv", "Age;Sex;Brainstem\n40;F;1\n")
    put(tmp_path / "A2_s1_job000002" / "report.csv", "Age;Sex;CA1\n41;M;2\n")
    put(tmp_path / "A2_s1_job000002" / "native_t2.nii", "x")
    first = measures.collect_report_folder(spark, str(tmp_path))
    got = {(r["Subject"], r["Patient ID"], r["type"], r["job_id"]) for r in first.collect()}
    assert got == {("A1", "A1_s1", "subcortical", "job000001"), ("A2", "A2_s1", "hips_kulaga_multicontrast", "job000002")}
    old = spark.createDataFrame(first.collect(), first.schema)
    put(tmp_path / "A1_s1_job000003" / "report.csv", "Age;Sex;Brainstem\n40;F;9\n")
    put(tmp_path / "A1_s1_job000001" / "report.csv", "Age;Sex;Brainstem\n40;F;5\n")
    again = measures.collect_report_folder(spark, str(tmp_path), old)
    assert {(r["job_id"], r["Brainstem"]) for r in again.collect()} == {("job000003", 9), ("job000002", None)}


def test_battery_folder(spark, tmp_path):
    head = "PIN,Inst,RawScore,TScore,Uncorrected Standard Score,Age-Corrected Standard Score\n"
    labels = ["Picture Vocabulary Test", "Flanker Inhibitory Control", "List Sorting", "Oral Reading", "Total Composite"]
    put(tmp_path / "e1.csv", head + "".join(f"SUB1,{t},1,2,{i},4\n" for i, t in enumerate(labels)) + "SUB1,List Sorting,1,2,2,5\n")
    put(tmp_path / "e2_S2.csv", head + "".join(f"SUB1,{t},1,2,{i},4\n" for i, t in enumerate(labels)).replace("SUB1", "SUB2"))
    put(tmp_path / "notes.csv", "PIN,Inst\nSUB9,x\n")
    wide, skipped, mismatches = scores.import_battery_folder(spark, str(tmp_path))
    got = dicts(wide, "subject")
    assert got["SUB1"]["s1_listsort_unadj"] == 2 and got["SUB1"]["s1_listsort_ageadj"] == 5
    assert set(got) == {"SUB1", "SUB2"} and skipped.count() == 1
    assert [r["file"].rsplit("/", 1)[1] for r in mismatches.collect()] == ["e2_S2.csv"]


def test_score_report_folder(spark, tmp_path):
    cells = ",".join(str(i) for i in range(21))
    put(tmp_path / "NT01_base.csv", f"x,y\nTotal Score,{cells}\nT Score,{cells},\n")
    short = ",".join(["70-C"] + [str(i) for i in range(16)])
    put(tmp_path / "NT02_year1.csv", f"Total Score,{short}\nT Score,{short}\n")
    got = dicts(scores.collect_score_report_folder(spark, str(tmp_path), "NT"), "subject")
    assert got["NT01"]["event_name"] == "base" and got["NT01"]["cbcl_raw_activities"] == "0"
    assert got["NT02"]["cbcl_raw_activities"] is None and got["NT02"]["cbcl_t_anxdepr"] == "70"
    assert got["NT02"]["cbcl_clinical___5"] == "1" and got["NT02"]["cbcl_clinical___1"] is None


def test_only_chosen_reports_are_opened(spark, tmp_path):
    cells = ",".join(str(i) for i in range(21))
    for name in ("a/NT01_base.csv", "b/c/NT02_base.csv", "NT03_base.csv", "NT 04_base.csv", "other.csv"):
        put(tmp_path / name, f"Total Score,{cells}\n")
    os.utime(tmp_path / "NT03_base.csv", (time.time() - 86400 * 40,) * 2)
    recent = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(time.time() - 86400))
    found = folders.discover_files(spark, str(tmp_path), "NT", "csv", ["NT01", "NT03"], recent)
    paths = folders.chosen_paths(found)
    assert [os.path.basename(p) for p in paths] == ["NT01_base.csv"]
    assert [os.path.basename(p) for p in folders.text_lines(spark, paths).inputFiles()] == ["NT01_base.csv"]
    got = scores.collect_score_report_folder(spark, str(tmp_path), "NT")
    assert {r["subject"] for r in got.collect()} == {"NT01", "NT02", "NT03"}
    assert scores.collect_score_report_folder(spark, str(tmp_path), "XX") is None
    with pytest.raises(ValueError):
        folders.chosen_paths(folders.discover_files(spark, str(tmp_path), "NT", "csv"), 2)
