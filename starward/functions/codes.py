"""Code maps.  The pairs are fixed values of the source systems."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operational clinic number -> clinic ID of the schedule system.
CLINIC_IDS = {100: 1, 200: 2, 300: 3}

# 12-hour shift texts -> 24-hour texts.
SHIFT_STARTS = {"09:00:00": "09:00:00", "01:00:00": "13:00:00", "21:00:00": "21:00:00"}
SHIFT_ENDS = {"05:00:00": "17:00:00", "21:00:00": "21:00:00", "09:00:00": "09:00:00"}


def decoded(code: Column, pairs: dict, keep_unmapped: bool = False) -> Column:
    """Map a code; an unmapped one becomes NULL, or stays as it is."""
    (first, value), *rest = pairs.items()
    out = F.when(code == F.lit(first), F.lit(value))
    for key, value in rest:
        out = out.when(code == F.lit(key), F.lit(value))
    return out.otherwise(code) if keep_unmapped else out


def clinic_id(clinic: Column) -> Column:
    return decoded(clinic, CLINIC_IDS)


def clinic_number(file_clinic: Column) -> Column:
    """Clinic text of a daily file (1, 2, 3) -> operational number (100, 200, 300)."""
    return file_clinic.cast("int") * 100


def shift_start(start: Column) -> Column:
    return decoded(start, SHIFT_STARTS, keep_unmapped=True)


def shift_end(end: Column) -> Column:
    """There is no fallback here: an unknown end is NULL and shows up in the not-null check."""
    return decoded(end, SHIFT_ENDS)
