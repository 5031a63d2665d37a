"""All registered queries; importing the modules registers them."""

from tickhouse.queries import bars, health, reports  # noqa: F401
from tickhouse.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
