"""Holiday name rules (H2, H3) as pure expressions: no Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Must equal the reference's rules for identical results.
# Case-insensitive substring tests, checked in this order; first hit wins,
# anything else (including a missing name) is STATE.
# ---------------------------------------------------------------------------
BANK_PATTERNS = ["2nd sat", "4th sat", "annual closing", "financial year end", "closing day"]
FESTIVAL_PATTERNS = ["holi", "eid", "ramzan", "bakri", "moharram", "pongal", "bihu", "navami",
                     "mahashivratri", "good friday", "christmas", "diwali", "dussehra", "durga",
                     "ganesh", "onam"]
NATIONAL_PATTERNS = ["republic day", "independence day", "gandhi jayanti"]
MAJOR_FESTIVAL_REGEX = "holi|diwali|eid|durga|dussehra|christmas|onam"

HOLIDAY_RULES = (("BANK", BANK_PATTERNS), ("FESTIVAL", FESTIVAL_PATTERNS), ("NATIONAL", NATIONAL_PATTERNS))

REGULAR_DAY = "Regular Day"
NO_HOLIDAY_TYPE = "NONE"


def _any_substring(lowered: Column, patterns: list[str]) -> Column:
    pred = None
    for p in patterns:
        hit = lowered.contains(p)
        pred = hit if pred is None else (pred | hit)
    return pred


def holiday_type(name: Column) -> Column:
    """H2: BANK / FESTIVAL / NATIONAL / STATE by ordered substring rules."""
    lowered = F.lower(name)
    expr = None
    for label, patterns in HOLIDAY_RULES:
        cond = _any_substring(lowered, patterns)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit("STATE"))


def is_major_festival(name: Column) -> Column:
    """H3: 1 when the lower-cased name matches the major-festival regex; missing -> 0."""
    return F.coalesce(F.lower(name).rlike(MAJOR_FESTIVAL_REGEX), F.lit(False)).cast("int")
