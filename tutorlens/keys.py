"""Grain keys shared by every module."""

# A course run (module + presentation).
K2 = ["code_module", "code_presentation"]
# An enrolment: one student on one course run.
K3 = ["code_module", "code_presentation", "id_student"]
