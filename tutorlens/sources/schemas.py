"""Fixed schema of each source table (column order as in the published files)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STUDENT_INFO = _schema(
    ("code_module", S), ("code_presentation", S), ("id_student", L), ("gender", S),
    ("region", S), ("highest_education", S), ("imd_band", S), ("age_band", S),
    ("num_of_prev_attempts", I), ("studied_credits", I), ("disability", S),
    ("final_result", S),
)
COURSES = _schema(("code_module", S), ("code_presentation", S), ("module_presentation_length", I))
ASSESSMENTS = _schema(
    ("code_module", S), ("code_presentation", S), ("id_assessment", L),
    ("assessment_type", S), ("date", D), ("weight", D),
)
STUDENT_ASSESSMENT = _schema(
    ("id_assessment", L), ("id_student", L), ("date_submitted", I), ("is_banked", I), ("score", D),
)
STUDENT_REGISTRATION = _schema(
    ("code_module", S), ("code_presentation", S), ("id_student", L),
    ("date_registration", D), ("date_unregistration", D),
)
STUDENT_VLE = _schema(
    ("code_module", S), ("code_presentation", S), ("id_student", L), ("id_site", L),
    ("date", I), ("sum_click", L),
)
VLE = _schema(
    ("id_site", L), ("code_module", S), ("code_presentation", S), ("activity_type", S),
    ("week_from", I), ("week_to", I),
)
STUDENT_VLE_SMALL = _schema(("id_student", L), ("sum_click", L))

# Table name -> (file stem, schema).
TABLES = {
    "student_info": ("studentInfo", STUDENT_INFO),
    "courses": ("courses", COURSES),
    "assessments": ("assessments", ASSESSMENTS),
    "student_assessment": ("studentAssessment", STUDENT_ASSESSMENT),
    "student_registration": ("studentRegistration", STUDENT_REGISTRATION),
    "student_vle": ("studentVle", STUDENT_VLE),
    "vle": ("vle", VLE),
}
