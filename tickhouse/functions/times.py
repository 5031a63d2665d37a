"""Timestamp text in and out. The session time zone is UTC throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp texts.
RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"
ISO_LENIENT = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?)?$"
EPOCH_SECONDS = r"^-?\d+(\.\d+)?$"
DIGITS = r"^[0-9]+$"

# Seconds of the years 1 to 9999.
FIRST_SECOND = -62_135_596_800
LAST_SECOND = 253_402_300_799

SECONDS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
MICROS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def seconds_text(ts: Column) -> Column:
    """UTC text truncated to seconds."""
    return F.date_format(ts, SECONDS_FORMAT)


def micros_text(ts: Column) -> Column:
    """UTC text with six fraction digits."""
    return F.date_format(ts, MICROS_FORMAT)


def strict_instant(text: Column) -> Column:
    """RFC 3339 with a zone, else null."""
    upper = F.upper(text)
    return F.when(upper.rlike(RFC3339), upper.try_cast("timestamp"))


def lenient_instant(text: Column) -> Column:
    """ISO date or date-time; a missing zone means UTC; anything else is null."""
    return F.when(text.rlike(ISO_LENIENT), text.try_cast("timestamp"))


def lenient_text(text: Column, fallback: Column | None = None) -> Column:
    """Normalised second text, or the fallback timestamp's text."""
    parsed = seconds_text(lenient_instant(text))
    return parsed if fallback is None else F.coalesce(parsed, seconds_text(fallback))


def epoch_or_iso_text(text: Column) -> Column:
    """Second text from Unix seconds or ISO text."""
    seconds = F.floor(text.try_cast("decimal(38,6)"))
    in_range = seconds.between(FIRST_SECOND, LAST_SECOND)
    from_epoch = F.timestamp_seconds(F.when(in_range, seconds).try_cast("long"))
    return seconds_text(
        F.when(text.rlike(EPOCH_SECONDS), from_epoch).otherwise(lenient_instant(text))
    )


def millis_text(value: Column) -> Column:
    """Second text from non-negative epoch milliseconds given as digits, else null."""
    text = value.cast("string")
    return seconds_text(F.timestamp_millis(F.when(text.rlike(DIGITS), text.try_cast("long"))))


def millis_or_never(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp, where zero means the event never happened."""
    return F.timestamp_millis(F.nullif(ms, F.lit(0)))


def zone_text(ts: Column, zone: str, suffix: str) -> Column:
    """Medium date and short time as read in ``zone``, e.g. ``2 Jan 2026, 14:30 UTC``."""
    local = F.from_utc_timestamp(ts, zone)
    return F.concat(F.date_format(local, "d MMM yyyy, HH:mm"), F.lit(f" {suffix}"))


def two_zone_text(ts: Column) -> Column:
    return F.concat_ws(
        " · ", zone_text(ts, "UTC", "UTC"), zone_text(ts, "Asia/Kolkata", "IST")
    )


def minutes_between(later: Column, earlier: Column) -> Column:
    """Exact age in microseconds, expressed in minutes as a double."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(60_000_000.0)
