"""Small classifications that keep private text out of reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickhouse.settings import COMMIT_FAILED, FAILURE_EVENTS

SAFE_OPERATIONS = ("append", "overwrite", "replace", "delete")


def alert_code(component: str, message: Column) -> Column:
    text = F.lower(F.coalesce(message, F.lit("")))
    suffix = (
        F.when(text.contains("delivery"), "delivery_failure")
        .when(text.contains("authentication") | text.contains("authenticated"), "authentication")
        .when(text.contains("commit"), "commit_failure")
        .otherwise("warning")
    )
    return F.concat(F.lit(f"{component}_"), suffix)


def failure_code(event: Column) -> Column:
    return F.when(event.startswith("loader_"), event).otherwise(F.concat(F.lit("loader_"), event))


def is_failure(event: Column) -> Column:
    return event.isin(*FAILURE_EVENTS)


def normal_event(event: Column, failure_type: Column, strict: bool = False) -> Column:
    """``commit_failed`` carries its class in ``failure_type``; ``strict`` leaves it unrecognised."""
    if strict:
        return event
    return F.when(event == COMMIT_FAILED, F.coalesce(failure_type, event)).otherwise(event)


def safe_operation(operation: Column) -> Column:
    name = F.lower(operation)
    return F.when(name.isin(*SAFE_OPERATIONS), name).otherwise("other")


def cost_read_failure(detail: Column) -> Column:
    text = F.lower(F.coalesce(detail, F.lit("")))
    return (
        F.when(text.contains("permission") | text.contains("access denied"), "permission_denied")
        .when(text.contains("not found"), "not_found")
        .otherwise("command_failed")
    )


def redacted(secret: Column) -> Column:
    """Show at most the first four characters of a longer secret."""
    return F.when(F.length(secret) <= 4, F.lit("<redacted>")).otherwise(
        F.concat(F.substring(secret, 1, 4), F.lit("…<redacted>"))
    )
