from tutorlens.functions.lookup import CLASS_LABELS, CLASS_NAMES, TARGET_CODES, map_lookup
from tutorlens.functions.nulls import (
    count_missing,
    drop_null_keys,
    nan_to_null,
    safe_divide,
    sum_or_zero,
)
from tutorlens.functions.rounding import percent_of, round_half_even

__all__ = [
    "CLASS_LABELS",
    "CLASS_NAMES",
    "TARGET_CODES",
    "count_missing",
    "drop_null_keys",
    "map_lookup",
    "nan_to_null",
    "percent_of",
    "round_half_even",
    "safe_divide",
    "sum_or_zero",
]
