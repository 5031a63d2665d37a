"""Plain argument objects shared by the jobs. Nothing here reads the environment."""

from __future__ import annotations

from dataclasses import dataclass

# Names that appear in log entries and must match to be recognised.
METRICS = "metrics"
FINAL_METRICS = "final metrics"
IDLE_SHUTDOWN = "no bar data within idle window; shutting down producer"
HEALTH_TARGET = "iceberg_loader::health"
HEALTH_PREFIX = "LOADER_HEALTH "
HEARTBEAT = "heartbeat"
COMMIT_STARTED = "commit_started"
COMMIT_SUCCEEDED = "commit_succeeded"
COMMIT_FAILED = "commit_failed"
FAILURE_EVENTS = (
    "data_file_write_failed",
    "iceberg_commit_failed",
    "iceberg_commit_state_unknown",
    "offset_commit_failed",
    "loader_failed",
)
# How many of the newest entries of each class a bounded live read asks for. Nothing
# applies them by itself; a caller that wants such a read passes them.
LIVE_READ_LIMITS = {
    "extractor": 500,
    "loader_heartbeats": 4,
    "loader_commits": 100,
    "loader_failures": 20,
}


@dataclass(frozen=True)
class LogNames:
    """Which units write the logs. ``topics=None`` accepts every topic."""

    extractor_unit: str = "bar-extractor.service"
    loader_unit: str = "bar-loader.service"
    health_target: str = HEALTH_TARGET
    topics: tuple[str, ...] | None = None


@dataclass(frozen=True)
class JournalNames:
    """Units and identifiers used to route host journal lines."""

    pipeline_units: tuple[str, ...] = (
        "bar-broker.service",
        "bar-topic.service",
        "bar-loader.service",
        "bar-extractor.service",
        "bar-extractor.timer",
        "bar-replayer.service",
    )
    extractor_units: tuple[str, ...] = ("bar-extractor.service", "bar-replayer.service")
    loader_unit: str = "bar-loader.service"
    lifecycle_pattern: str = "(bar-extractor|bar-loader|bar-broker)"
    telemetry_pattern: str = "ClientTelemetryReporter - Client telemetry registered"


@dataclass(frozen=True)
class Thresholds:
    """Ageing limits of the health roll-up, in minutes, and the commit history length."""

    bar_warning: int = 5
    bar_unhealthy: int = 10
    commit_warning: int = 10
    commit_unhealthy: int = 15
    heartbeat_warning: int = 5
    heartbeat_unhealthy: int = 10
    history_limit: int = 48
    alert_limit: int = 20
