"""Exchange calendar (weekdays, New York hours; no holidays) and freshness grades."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickhouse.functions.times import minutes_between

NEW_YORK = "America/New_York"
OPEN_MINUTE = 9 * 60 + 30
CLOSE_MINUTE = 16 * 60
SETTLED_MINUTE = 17 * 60


def _local(ts: Column) -> Column:
    return F.from_utc_timestamp(ts, NEW_YORK)


def market_state(ts: Column) -> Column:
    local = _local(ts)
    minute = F.hour(local) * 60 + F.minute(local)
    return (
        F.when(F.weekday(local) >= 5, "weekend")
        .when(minute < OPEN_MINUTE, "pre_open")
        .when(minute < CLOSE_MINUTE, "market_open")
        .when(minute < SETTLED_MINUTE, "settling")
        .otherwise("closed")
    )


def next_open(ts: Column) -> Column:
    """Next weekday 09:30 in New York, as UTC; before today's opening it is today's."""
    local = _local(ts)
    day = F.weekday(local)
    minute = F.hour(local) * 60 + F.minute(local)
    ahead = (
        F.when(day >= 5, 7 - day)
        .when(minute < OPEN_MINUTE, F.lit(0))
        .when(day == 4, F.lit(3))
        .otherwise(F.lit(1))
    )
    opening = F.date_add(F.to_date(local), ahead).cast("timestamp") + F.expr(
        f"INTERVAL {OPEN_MINUTE} MINUTE"
    )
    return F.to_utc_timestamp(opening, NEW_YORK)


def freshness(
    name: str, status: Column, seen: Column, now: Column, warning: int, unhealthy: int
) -> tuple[Column, Column]:
    """New status and the reason to add (or null) after grading how old ``seen`` is."""
    age = minutes_between(now, seen)
    ageing = (age > warning) & (status != "unhealthy")
    graded = (
        F.when(seen.isNull() | (age > unhealthy), "unhealthy")
        .when(ageing, "warning")
        .otherwise(status)
    )
    reason = (
        F.when(seen.isNull(), f"missing_{name}")
        .when(age > unhealthy, f"stale_{name}")
        .when(ageing, f"aging_{name}")
    )
    return graded, reason
