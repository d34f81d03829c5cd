"""Business labels derived from columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermill.functions.numeric import as_column

# Label texts and thresholds of the reports.
UNTRANSLATED_PREFIX = "untranslated__"
UNKNOWN = "unknown"
TIER_HIGH_ABOVE = 10_000
TIER_MEDIUM_FROM = 1_000
SEGMENT_FLOORS = (("Champion", 13), ("Loyal", 10), ("Potential", 7), ("At Risk", 4))
LOWEST_SEGMENT = "Lost"


def category_label(source: Column | str, english: Column | str) -> Column:
    """English name, else the marked source name, else ``unknown``."""
    marked = F.concat(F.lit(UNTRANSLATED_PREFIX), as_column(source))
    return F.coalesce(as_column(english), marked, F.lit(UNKNOWN))


def revenue_tier(
    revenue: Column | str,
    high_above: float = TIER_HIGH_ABOVE,
    medium_from: float = TIER_MEDIUM_FROM,
) -> Column:
    revenue = as_column(revenue)
    return (
        F.when(revenue > high_above, "high").when(revenue >= medium_from, "medium").otherwise("low")
    )


def segment_from_total(total: Column | str) -> Column:
    """Segment name of a summed 3..15 score."""
    total = as_column(total)
    name, floor = SEGMENT_FLOORS[0]
    label = F.when(total >= floor, name)
    for name, floor in SEGMENT_FLOORS[1:]:
        label = label.when(total >= floor, name)
    return label.otherwise(LOWEST_SEGMENT)


def segment_from_scores(recency: str, frequency: str, monetary: str) -> Column:
    """Segment name of a recency/frequency/monetary score triple."""
    r, f, m = F.col(recency), F.col(frequency), F.col(monetary)
    recent, valuable = r >= 3, m >= 3
    return (
        F.when(F.least(r, f, m) >= 4, "Champion")
        .when(recent & valuable, "Loyal")
        .when(recent, "Potential")
        .when(valuable, "At Risk")
        .otherwise(LOWEST_SEGMENT)
    )


def mask_identifier(identifier: Column | str, longest_plain: int = 12) -> Column:
    """Ids longer than ``longest_plain`` keep their first 8 and last 4 characters."""
    text = as_column(identifier).cast("string")
    short = F.concat(F.substring(text, 1, 8), F.lit("..."), F.right(text, F.lit(4)))
    return F.when(F.length(text) <= longest_plain, text).otherwise(short)
