"""Jobs joined with their runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.status import job_run_status, status_reason
from .joins import by_key


def job_runs(jobs: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs with job, owner and normalised status.

    ``jobs``: job_name, job_rn, owner_rn.  ``runs``: job_name, run_id, state, started_at,
    completed_at (null while unfinished), message.  N:1 on the job name; a job with most
    of the runs is split by Spark's skew join.
    """
    joined = runs.join(by_key(jobs.select("job_name", "job_rn", "owner_rn")), "job_name")
    status = job_run_status(F.col("state"))
    return joined.select(
        F.concat_ws("/", "job_rn", F.lit("runs"), "run_id").alias("run_rn"),
        "run_id",
        "job_rn",
        "owner_rn",
        status.alias("status"),
        status_reason(status, F.col("message")).alias("status_reason"),
        F.col("started_at").alias("start_time"),
        F.col("completed_at").alias("end_time"),
    )
