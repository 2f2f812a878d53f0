"""Date and time column expressions.  The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_ms(ts: Column) -> Column:
    """Timestamp cut to milliseconds."""
    return F.date_trunc("MILLISECOND", ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Floor of the elapsed time in days, also below zero (not calendar days)."""
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(86_400_000_000)).cast("int")


def anchor_date(stage: Column, won_at: Column, lost_at: Column, start: Column) -> Column:
    """The moment a deal is judged at: won date, lost date, or start day 13:00."""
    opening = start.try_cast("timestamp") + F.expr("INTERVAL 13 HOURS")
    return (
        F.when(stage == "Closed Won", won_at)
        .when(stage == "Closed Lost", lost_at)
        .otherwise(opening)
    )


# Upper day bound (inclusive) and the points it earns.
RECENCY_BANDS = [(0, 0), (6, 5), (29, 4), (89, 3), (179, 2)]
RECENCY_OLDEST = 1


def recency_points(days: Column) -> Column:
    """Points for an age in days; not yet happened (or today) is 0, null stays null."""
    chain = F.when(days.isNull(), F.lit(None).cast("double"))
    for bound, points in RECENCY_BANDS:
        chain = chain.when(days <= bound, float(points))
    return chain.otherwise(float(RECENCY_OLDEST))
