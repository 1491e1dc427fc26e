"""The current row of every key as the state of a stream.

Changes are reduced into Spark's keyed state, which lives in its on-disk store and is
committed with the stream's offsets.  The state itself is the table: it is read as the last
committed version, whatever the number of batches before, and a restart goes on from there.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "latest"


class LatestRow(StatefulProcessor):
    """Keeps the row with the greatest ``order`` of each key; a newer deletion clears it.

    A deletion leaves its order behind, so that older rows that come late do not bring the key
    back, until an expiry that is as new clears that too.
    """

    def __init__(self, keys: list[str], order: str, deleted: str | None, expired: str | None, row: StructType):
        self.keys, self.order, self.deleted, self.expired = keys, order, deleted, expired
        self.row = row
        self.columns = row.fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState(STATE, self.row)
        self.gone = handle.getValueState("gone", StructType([self.row[self.order]]))

    def _rank(self, row: tuple) -> tuple:
        """Order, and the whole row where orders tie."""
        return row[self.columns.index(self.order)], json.dumps([str(v) for v in row])

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        best = tuple(self.latest.get()) if self.latest.exists() else None
        buried = self.gone.get()[0] if self.gone.exists() else None
        changed = forget = False
        for r in rows:
            new = tuple(r[c] for c in self.columns)
            at = r[self.order]
            if self.expired is not None and r[self.expired]:
                if at is not None and all(at >= known for known in (buried, best and best[self.columns.index(self.order)]) if known is not None):
                    best, buried, changed, forget = None, None, True, True
                continue
            if at is None or (buried is not None and at <= buried) or (best is not None and self._rank(new) <= self._rank(best)):
                continue
            changed = True
            if self.deleted is not None and r[self.deleted]:
                best, buried = None, at
            else:
                best = new
        if not changed:
            return
        if buried is not None:
            self.gone.update((buried,))
        elif forget:
            self.gone.clear()
        if best is None:
            self.latest.clear()
        else:
            self.latest.update(best)
        shown = best if best is not None else tuple(buried if c == self.order else None for c in self.columns)
        yield Row(**dict(zip(self.keys, key)), **dict(zip(self.columns, shown)), is_deleted=best is None)

    def close(self) -> None:
        pass


def keyed_refresh(
    changes: DataFrame,
    checkpoint: str,
    keys: list[str],
    order: str,
    deleted: str | None = None,
    expired: str | None = None,
    feed: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Keep the newest row per key of a stream of changes; rows without an ``order`` are ignored.

    ``deleted`` and ``expired`` name boolean columns that mark deletions and expiries (which make
    the state forget a key), ``order`` a column that decides what is newer (equal ones: the
    greater row as text).  ``feed`` is a folder that gets the keys changed by
    each batch.  Without ``interval`` the job takes what is there and stops.
    """
    spark = changes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    row = StructType([f for f in changes.schema if f.name not in (*keys, deleted, expired)])
    out = StructType([*(changes.schema[k] for k in keys), *row.fields]).add("is_deleted", "boolean")
    kept = changes.groupBy(*keys).transformWithState(LatestRow(keys, order, deleted, expired, row), out, "Update", "None")
    writer = kept.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    if feed is None:
        writer = writer.format("noop")
    else:
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{feed.rstrip('/')}/batch_id={batch_id}")

        writer = writer.foreachBatch(write)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def keyed_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The current rows, from the last committed version of the state (or that of a batch)."""
    reader = spark.read.format("statestore").option("stateVarName", STATE)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint).select("key.*", "value.*")
