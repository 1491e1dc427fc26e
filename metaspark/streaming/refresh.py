"""Incremental catalog refresh: new dumps in, current state out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import latest_per_key


def refresh(
    changes: DataFrame,
    target: str,
    checkpoint: str,
    keys: list[str],
    order: list[Column],
    interval: str | None = None,
) -> StreamingQuery:
    """Write the newest row per key of every micro-batch under ``target/batch_id=N``.

    A retried batch overwrites its own folder, so each change is applied once without a
    transactional table format.  Rows are reduced per key inside the batch before they
    are written.  ``interval`` re-collects on a schedule; without it the job takes what is
    there and stops.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        newest = latest_per_key(batch, keys, order)
        newest.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch_id={batch_id}")

    writer = changes.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def current_state(spark: SparkSession, target: str, keys: list[str], order: list[Column]) -> DataFrame:
    """Newest row per key over all batches; a later batch wins a tie."""
    batches = spark.read.option("basePath", target).parquet(target)
    return latest_per_key(batches, keys, [*order, F.col("batch_id")]).drop("batch_id")


def compact(spark: SparkSession, target: str, compacted: str, keys: list[str], order: list[Column]) -> None:
    """Rewrite the current state as one batch in a new folder, to keep reads short."""
    current_state(spark, target, keys, order).write.mode("overwrite").parquet(f"{compacted.rstrip('/')}/batch_id=0")
