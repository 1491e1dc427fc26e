"""Sharding by a hierarchical weighted hash tree: regions hold racks, racks hold shards.

Every shard draws an exponential clock from the key's hash with its weight as the rate.  A
rack's clock is the least of its shards', a region's the least of its racks', so a subtree
draws with the sum of its weights.  A key descends: the region with the least clock, in it
the rack, in it the shard.  Changing weights in one subtree changes that subtree's clock
alone: keys only move into a subtree that grew or out of one that shrank, and a new shard
only takes keys into itself.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

REGIONS, RACKS = 3, 4
ROWS_PER_PIECE = 4096
SEED = 7


class Leaf(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def even_tree(shards: int, regions: int = REGIONS, racks: int = RACKS) -> list[Leaf]:
    """Shards dealt in turn to regions and, in each, to racks; another shard joins the tree as the next leaf."""
    return [Leaf(s % regions, s // regions % racks, s) for s in range(shards)]


def _clock(key: list[Column], leaf: Leaf, seed: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(leaf.shard), *key), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53))) / F.lit(float(leaf.weight))


def _least(items: list[Column]) -> Column:
    return items[0] if len(items) == 1 else F.least(*items)


def descend(key: list[Column], tree: list[Leaf], seed: int = SEED) -> Column:
    """Struct of ``clock``, ``region``, ``rack``, ``shard`` for a key; a null key column is a value too."""
    regions: dict[int, dict[int, list[Column]]] = {}
    for leaf in tree:
        if leaf.weight > 0:
            place = F.struct(
                _clock(key, leaf, seed).alias("clock"),
                F.lit(leaf.region).alias("region"),
                F.lit(leaf.rack).alias("rack"),
                F.lit(leaf.shard).alias("shard"),
            )
            regions.setdefault(leaf.region, {}).setdefault(leaf.rack, []).append(place)
    return _least([_least([_least(leaves) for leaves in racks.values()]) for racks in regions.values()])


def shard(docs: DataFrame, tree: list[Leaf], grown: list[Leaf] | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with ``_place`` (region, rack, shard) and, for a ``grown`` tree, ``_grown`` (the same there).

    The place depends on ``doc_id`` and the tree alone: rows with one id, null included,
    share a shard.
    """
    key = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))]
    out = docs.withColumn("_place", descend(key, tree, seed))
    return out if grown is None else out.withColumn("_grown", descend(key, grown, seed))


def slotted(placed: DataFrame, shard_col: str, order: list[str], rows: int, pieces_of: int = ROWS_PER_PIECE) -> DataFrame:
    """``placed`` with ``slot``: gapless from 0 in every shard, the same in every run.

    A shard is cut into pieces by a hash of the order columns; pieces number their rows on
    their own, after the counts of the pieces before them, so no task gets a whole shard.
    ``rows`` (about the rows of the table) decides the number of pieces.  Rows equal in all
    order columns take neighbouring slots in any order.  Columns named as the work columns are left out.
    """
    pieces = max(1, rows // pieces_of)
    piece = F.pmod(F.xxhash64(*order), F.lit(pieces)).alias("_piece")
    placed = placed.drop("_piece", "_n", "_start", "_place_in_piece", "slot")
    cut = placed.select("*", piece)
    before = W.partitionBy(shard_col).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    counts = cut.groupBy(shard_col, "_piece").agg(F.count("*").alias("_n"))
    starts = counts.select(shard_col, "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(W.partitionBy(shard_col, "_piece").orderBy(*order))
    return (
        cut.withColumn("_place_in_piece", place)
        .join(starts, [shard_col, "_piece"])
        .withColumn("slot", (F.col("_start") + F.col("_place_in_piece") - 1).cast("long"))
        .drop("_piece", "_start", "_place_in_piece")
    )
