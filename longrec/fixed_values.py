"""Names, limits and codes that results must agree on."""

# Instrument label text -> variable, for rows answered by a parent.
PARENT_INSTRUMENTS = {
    "Picture Vocabulary": "parent_pic_vocab",
    "Oral Reading": "parent_oral_reading",
    "Crystallized Composite": "parent_verbal_iq",
    "Neuro-QoL": "parent_neuroqol",
}

# Instrument label text -> variable, for rows answered by the subject.
SUBJECT_INSTRUMENTS = {
    "Picture Vocabulary": "vocab",
    "Flanker Inhibitory Control": "flanker",
    "List Sorting": "listsort",
    "Dimensional Change": "dccs",
    "Pattern Comparison": "pattern",
    "Picture Sequence": "picseq",
    "Oral Reading": "oral_reading",
    "Fluid Composite": "fluid_cog",
    "Crystallized Composite": "crystal_cog",
    "Total Composite": "cog_composite",
    "Early Childhood": "cog_earlychild",
    "Neuro-QoL": "self_neuroqol",
}

# Flag -> inclusive T-score range.
SCORE_FLAGS = {
    "Activities_TScore.borderline": (31, 35),
    "Activities_TScore.clinical": (20, 30),
    "Aggressive_Behavior_TScore.borderline": (65, 69),
    "Aggressive_Behavior_TScore.clinical": (70, 100),
    "Anxiety_Problems_TScore.borderline": (65, 69),
    "Anxiety_Problems_TScore.clinical": (70, 100),
    "Anxious__Depressed_TScore.borderline": (65, 69),
    "Anxious__Depressed_TScore.clinical": (70, 100),
    "Attention_Deficit__Hyperactivity_Problems_TScore.borderline": (65, 69),
    "Attention_Deficit__Hyperactivity_Problems_TScore.clinical": (70, 100),
    "Attention_Problems_TScore.borderline": (65, 69),
    "Attention_Problems_TScore.clinical": (70, 100),
    "Conduct_Problems_TScore.borderline": (65, 69),
    "Conduct_Problems_TScore.clinical": (70, 100),
    "Depressive_Problems_TScore.borderline": (65, 69),
    "Depressive_Problems_TScore.clinical": (70, 100),
    "Emotionally_Reactive_TScore.borderline": (70, 100),
    "Externalizing_Problems_TScore.borderline": (60, 63),
    "Externalizing_Problems_TScore.clinical": (64, 100),
    "Internalizing_Problems_TScore.borderline": (60, 63),
    "Internalizing_Problems_TScore.clinical": (64, 100),
    "Obsessive_Compulsive_Problems_TScore.borderline": (65, 69),
    "Obsessive_Compulsive_Problems_TScore.clinical": (70, 100),
    "Oppositionally_Defiant_Problems_TScore.borderline": (65, 69),
    "Oppositionally_Defiant_Problems_TScore.clinical": (70, 100),
    "Rule_Breaking_Behavior_TScore.borderline": (65, 69),
    "Rule_Breaking_Behavior_TScore.clinical": (70, 100),
    "School_TScore.borderline": (31, 35),
    "School_TScore.clinical": (20, 30),
    "Sleep_Problems_Tscore.borderline": (70, 100),
    "Sluggish_Cognitive_Tempo_TScore.borderline": (65, 69),
    "Sluggish_Cognitive_Tempo_TScore.clinical": (70, 100),
    "Social_Problems_TScore.borderline": (65, 69),
    "Social_Problems_TScore.clinical": (70, 100),
    "Social_TScore.borderline": (31, 35),
    "Social_TScore.clinical": (20, 30),
    "Somatic_Complaints_TScore.borderline": (65, 69),
    "Somatic_Complaints_TScore.clinical": (70, 100),
    "Somatic_Problems_TScore.borderline": (65, 69),
    "Somatic_Problems_TScore.clinical": (70, 100),
    "Stress_Problems_TScore.borderline": (65, 69),
    "Stress_Problems_TScore.clinical": (70, 100),
    "Thought_Problems_TScore.borderline": (65, 69),
    "Thought_Problems_TScore.clinical": (70, 100),
    "Total_Competence_TScore.borderline": (37, 40),
    "Total_Competence_TScore.clinical": (10, 36),
    "Total_Problems_TScore.borderline": (60, 63),
    "Total_Problems_TScore.clinical": (64, 100),
    "Withdrawn__Depressed_TScore.borderline": (65, 69),
    "Withdrawn__Depressed_TScore.clinical": (70, 100),
}

# Percentile of T-scores from 50 upwards, and the flag limits.
PERCENTILES = [50, 54, 58, 62, 66, 69, 72, 75, 78, 81, 84, 86, 88, 90, 92, 93, 94, 95, 96, 97, 98]
BORDERLINE_T = 65
CLINICAL_T = 70

# The questionnaire scales that each composite adds up.
COMPOSITE_SCALES = {
    "intprob": ["emoreact", "anxdep", "somcomp", "withdrawn"],
    "extprob": ["attprob", "aggbehav"],
    "totprob": ["emoreact", "anxdep", "somcomp", "withdrawn", "attprob", "aggbehav", "sleepprob", "otherprob"],
}

# Scale order of the flag checkboxes, with and without a session prefix.
SESSION_CHECKBOXES = [
    "emoreact", "sleepprob", "pervdevprob", "anxdep", "withdrawn", "somcomp", None, None, "attprob", None,
    "aggbehav", "intprob", "extprob", "totprob", "affprob", "anxprob", None, "adhd", "oppdef", None,
]
PLAIN_CHECKBOXES = [
    "emoreact", "anxdep", "somcomp", "withdrawn", "sleepprob", "attprob", "aggbehav", "intprob", "extprob",
    "totprob", "affprob", "anxprob", "pervdevprob", "adhd", "oppdef",
]

# Scales of a score report in printed order; reports may lack the competence scales.
COMPETENCE_SCALES = ["activities", "social", "school", "totalcomp"]
REPORT_SCALES = [
    "activities", "social", "school", "totalcomp",
    "anxdepr", "withdepr", "somcomp", "socprob", "thoprob", "attenprob", "rulebreak", "aggbeh",
    "intprob", "extprob", "totalprob",
    "affecprob", "anxprob", "somprob", "adhdprob", "opdefprob", "condprob",
]
REPORT_ROWS = {"Total Score": "raw", "T Score": "t", "Percentile": "per"}

# Label text that marks the questions bounding the cards of the fixed-width record.
CARD_LABELS = {
    "Number of favorite sports listed": "num_sports",
    "any academic or other problems in school": "acad_prob",
    "1. Acts too young for his/her age": "q1",
    "58. Picks nose, skin, or other parts of body": "q58",
    "59. Plays with own sex parts in public": "q59",
    "113": "q113",
}
CARD_BOUNDS = {"01": ("num_sports", "acad_prob"), "02": ("q1", "q58"), "03": ("q59", "q113")}
CARD_ENDINGS = {"01": "CBC", "02": "", "03": "END"}
MISSING_FIRST_CARD = " " * 18 + "9" * 38

# Text fixes on measure codes, and the irregular block column.
MEASURE_FIXES = [("rt", "at"), ("ft_pvcov", "ft_pvcv"), ("b11h", "")]
IRREGULAR_BLOCK_SUFFIX = ("ft_mpv_right", "right", "left_right")

# Forms whose fields belong to the stable rows.
DEMOGRAPHIC_FORM = "patient_demographics"
STABLE_FORMS = [
    "patient_demographics", "ses_related_variables", "clinical_mutations", "clinical_dx_summary",
    "parent_wtar", "medical_history",
]

# Text taken as missing in CSV files.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "n/a", "nan", "null",
]

# Diagnoses whose labels carry a date sentence.
DIAGNOSES = ["wfs", "dm", "di", "hearloss", "oa", "bladder"]

# Fixed value: the form of a test PIN (key, optional separator, optional session letter and number).
PIN_PATTERN = r"(?i)(\w{0,4} ?\d{1,4})?(?:_| |-)?(?:s?)?(\d?)"

# Battery columns -> score names.
BATTERY_SCORES = {
    "RawScore": "raw",
    "TScore": "tscore",
    "Uncorrected Standard Score": "unadj",
    "Age-Corrected Standard Score": "ageadj",
}
UNADJUSTED = "Uncorrected Standard Score"

# Texts in the names of finished battery columns.
PARENT, OTHER_MEASURE = "parent", "neuroqol"
PARENT_SCORES = {"unadj": "unc", "ageadj": "ac"}
CRYSTAL_AGE = ("crystal_cog_ageadj", "crystal_cog", "cog_crystal")
SELF_RAW = ("self_neuroqol_raw", "_raw")

# Fixed value: the heading of a part of a diagnosis label.
LABEL_HEADING = '<span style="color:#0e1f8a;">{}:</span> '
