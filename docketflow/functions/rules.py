"""Business rules as native column expressions (no Python UDFs).

Matching is case-sensitive and a NULL input is never valid.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
VALID_EVENT_TYPES = ("opened", "status_change", "note_added", "closed")
VALID_DOC_ACTIONS = ("view", "edit", "share", "download", "delete")
KNOWN_PRACTICE_AREAS = ("M&A", "Litigation", "IP", "Real Estate", "Employment", "Tax", "Regulatory")
# Rate tiers: [..300) junior, [300,600) associate, [600,900) senior, [900..] partner, NULL unknown.
RATE_TIER_BOUNDS = ((300, "junior"), (600, "associate"), (900, "senior"))
RATE_TIER_TOP = "partner"
RATE_TIER_NULL = "unknown"


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def rate_tier(rate: Column | str) -> Column:
    """Seniority tier of an hourly rate; boundaries are half-open, NaN falls through to the top tier."""
    rate = F.col(rate) if isinstance(rate, str) else rate
    expr = F.when(rate.isNull(), F.lit(RATE_TIER_NULL))
    for bound, label in RATE_TIER_BOUNDS:
        expr = expr.when(rate < bound, F.lit(label))
    return expr.otherwise(F.lit(RATE_TIER_TOP))


def is_valid_doc_action(action: Column | str) -> Column:
    action = F.col(action) if isinstance(action, str) else action
    return F.coalesce(action.isin(*VALID_DOC_ACTIONS), F.lit(False))


def is_valid_event_type(event_type: Column | str) -> Column:
    event_type = F.col(event_type) if isinstance(event_type, str) else event_type
    return F.coalesce(event_type.isin(*VALID_EVENT_TYPES), F.lit(False))


def in_list_sql(column: str, values) -> str:
    """SQL predicate text `column IN (...)`, used for named expectations."""
    return f"{column} IN ({_sql_list(values)})"
