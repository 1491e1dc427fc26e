"""How large sides of joins meet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_key(rows: DataFrame) -> DataFrame:
    """A side of a join that meets the other by key and is never copied to every task.

    Spark judges a side by the bytes of the files below it.  Documents made of them, parsed
    JSON and exploded arrays hold many times as much, so sides that grow with the input
    would be broadcast through the driver until they no longer fit it.
    """
    return rows.hint("merge")


def met_by_key(rows: DataFrame, others: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``others`` by a key of text, neither of them copied to every task.

    Both sides are sorted; the hash of the key goes first, because names and ARNs begin alike
    and would be compared to their ends.
    """
    hashed = [side.withColumn("_hash", F.hash(key)) for side in (rows, others)]
    return hashed[0].join(by_key(hashed[1]), ["_hash", key], how).drop("_hash")
