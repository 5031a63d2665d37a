"""Evaluate a costly expression once although the result is used several times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` bound to a lambda variable, so it is computed one time."""
    return F.transform(F.array(value), body)[0]
