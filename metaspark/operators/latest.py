"""Latest row per key without a window.

The extreme of a struct combines on the map side, so a key that holds a large share of
the rows costs one small buffer per task instead of one task sorting them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row with the greatest ``order`` tuple per key.

    Equal tuples are decided by the other columns, except maps and variants, which have
    no order: with those, ``order`` must not tie.
    """
    return _one_per_key(df, keys, order, F.max, F.max_by)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return _one_per_key(df, keys, order, F.min, F.min_by)


def _has_order(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_has_order(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _has_order(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column], extreme, extreme_by) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    position = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    row = F.struct(*rest)
    if all(_has_order(df.schema[c].dataType) for c in rest):
        chosen = extreme(F.struct(position.alias("position"), row.alias("row")))["row"]
    else:
        chosen = extreme_by(row, position)
    return df.groupBy(*keys).agg(chosen.alias("row")).select(*keys, "row.*").select(*df.columns)
