"""Status lookups, written as CASE so they stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Run state -> normalised status.
JOB_RUN_STATUS = {
    "STARTING": "UNKNOWN",
    "RUNNING": "UNKNOWN",
    "STOPPING": "UNKNOWN",
    "STOPPED": "ABORTED",
    "SUCCEEDED": "SUCCESS",
    "FAILED": "FAILED",
    "ERROR": "FAILED",
    "TIMEOUT": "FAILED",
}

# Replication task state -> normalised status.
TASK_STATUS = {
    "creating": "UNKNOWN",
    "running": "RUNNING",
    "stopped": "ABORTED",
    "stopping": "UNKNOWN",
    "deleting": "UNKNOWN",
    "failed": "FAILED",
    "starting": "UNKNOWN",
    "ready": "UNKNOWN",
    "modifying": "UNKNOWN",
    "moving": "UNKNOWN",
    "failed-move": "BROKEN",
}

# Catalog table type -> entity type.
TABLE_KIND = {"EXTERNAL_TABLE": "TABLE", "VIRTUAL_VIEW": "VIEW"}


def lookup(key: Column, table: dict[str, str], default: str | None = None) -> Column:
    """Constant-size lookup; ``default`` is used for unseen and null keys."""
    expr = None
    for native, value in table.items():
        expr = (F if expr is None else expr).when(key == native, F.lit(value))
    return expr.otherwise(F.lit(default))


def job_run_status(state: Column) -> Column:
    return lookup(state, JOB_RUN_STATUS, "UNKNOWN")


def task_status(state: Column) -> Column:
    return lookup(state, TASK_STATUS, "UNKNOWN")


def status_reason(status: Column, message: Column) -> Column:
    """The error message, kept only for failures."""
    return F.when(status == "FAILED", message)


def table_kind(table_type: Column) -> Column:
    return lookup(table_type, TABLE_KIND, "UNKNOWN")
