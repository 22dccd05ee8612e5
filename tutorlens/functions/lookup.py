"""Literal lookups that stay native expressions (no UDF)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The class code of each final result, and the report names of
# the codes.  They must equal the values the feature table is defined with.
TARGET_CODES = {"Pass": 0, "Distinction": 1, "Fail": 2, "Withdrawn": 3}
CLASS_NAMES = {0: "Pass (0)", 1: "Distinction (1)", 2: "Fail (2)", 3: "Withdrawn (3)"}
CLASS_LABELS = {0: "Pass", 1: "Distinction", 2: "Fail", 3: "Withdrawn"}


def map_lookup(c: str | Column, mapping: Mapping) -> Column:
    """``mapping[c]`` as a literal map; unknown or missing keys give null."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    col = F.col(c) if isinstance(c, str) else c
    return F.create_map(*pairs)[col]
