"""Every table below a group, at any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import by_key


def descend(
    members: DataFrame, roots: DataFrame | None = None, group_types: tuple[str, ...] = ("DATABASE_SERVICE",)
) -> tuple[DataFrame, DataFrame]:
    """(tables, rejects) below each root; ``reach`` gives what an update needs as well."""
    tables, rejects, _ = reach(members, roots, group_types)
    return tables, rejects


def reach(
    members: DataFrame, roots: DataFrame | None = None, group_types: tuple[str, ...] = ("DATABASE_SERVICE",)
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tables, rejects, groups) below each root, where groups are (root_rn, group_rn) with the root itself.

    ``members``: group_rn, member_rn, member_type.  ``roots``: group_rn (default: every
    group).  Tables are (root_rn, table_rn, depth) with the smallest depth; members that
    are neither a table nor a group are rejected.

    A breadth-first join per level: groups already reached from a root are not visited
    again, so cycles end.  Each level and its new groups are checkpointed to the shared
    folder, which keeps the plan short and survives lost executors.
    """
    start = members.select("group_rn").distinct() if roots is None else roots.select("group_rn").distinct()
    frontier = start.select(F.col("group_rn").alias("root_rn"), "group_rn")
    visited = frontier
    levels = []
    depth = 0
    while True:
        depth += 1
        level = cut_lineage(
            frontier.join(by_key(members), "group_rn")
            .select("root_rn", "member_rn", "member_type", F.lit(depth).alias("depth"))
            .distinct()
        )
        levels.append(level)
        groups = level.filter(F.col("member_type").isin(*group_types)).select(
            "root_rn", F.col("member_rn").alias("group_rn")
        )
        # cut as well: otherwise the plan of ``visited`` would double with every level
        frontier = cut_lineage(groups.join(by_key(visited), ["root_rn", "group_rn"], "left_anti"))
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    reached = levels[0]
    for level in levels[1:]:
        reached = reached.unionByName(level)
    tables = (
        reached.filter(F.col("member_type") == "TABLE")
        .groupBy("root_rn", F.col("member_rn").alias("table_rn"))
        .agg(F.min("depth").alias("depth"))
    )
    rejects = (
        reached.filter(~F.col("member_type").isin("TABLE", *group_types))
        .select(
            F.lit("descent").alias("job"),
            F.col("member_rn").alias("key"),
            F.concat(F.lit("not a table or group: "), "member_type").alias("reason"),
        )
        .distinct()
    )
    return tables, rejects, visited


def update(
    tables: DataFrame, groups: DataFrame, before: DataFrame, after: DataFrame, group_types: tuple[str, ...] = ("DATABASE_SERVICE",)
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tables, groups, roots that were descended again) after members came, went or changed their type.

    ``tables`` and ``groups`` are those of ``reach`` on ``before``, from every group.  What is below a root can
    only differ if a group it reached has different members, so only such roots, and groups
    that are new, are descended again; all else is kept.  Cycles make no difference.
    """
    members = ["group_rn", "member_rn", "member_type"]
    old, new = before.select(*members).distinct(), after.select(*members).distinct()
    changed = cut_lineage(old.exceptAll(new).unionByName(new.exceptAll(old)).select("group_rn").distinct())
    starts = new.select("group_rn").distinct()
    touched = groups.join(changed, "group_rn", "left_semi").select("root_rn").union(starts.join(changed, "group_rn", "left_semi")).distinct()
    touched = cut_lineage(touched)
    again = touched.withColumnRenamed("root_rn", "group_rn").join(starts, "group_rn", "left_semi")
    fresh_tables, _, fresh_groups = reach(after, again, group_types)
    kept_tables = tables.join(touched, "root_rn", "left_anti").unionByName(fresh_tables)
    kept_groups = groups.join(touched, "root_rn", "left_anti").unionByName(fresh_groups)
    return kept_tables, kept_groups, again.withColumnRenamed("group_rn", "root_rn")
