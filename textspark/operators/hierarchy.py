"""Walks over parent-child tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.functions.labels import PATH_SEPARATOR
from textspark.plans.lineage import durable
from textspark.plans.skew import heavy_keys, lookup_join
from textspark.plans.union import union_rows


def tree_paths(nodes: DataFrame, allowed: Column | None = None) -> DataFrame:
    """(node_id, path, depth) for every node reachable from a root through allowed names.

    `nodes` has (node_id, parent_id, name); roots have a null parent. A node whose name is not allowed is
    dropped with its whole subtree. One equi-join per level, each level written once, so there is neither
    a recursion row limit nor a plan that grows with depth. A node found among its own ancestors is an error.
    """
    if allowed is not None:
        nodes = nodes.filter(allowed)
    level = nodes.filter(F.col("parent_id").isNull()).select(
        "node_id", F.col("name").alias("path"), F.lit(1).cast("bigint").alias("depth"), F.array("node_id").alias("_line")
    )
    found = level.drop("_line")
    depth = 1
    while True:
        depth += 1
        above = level.select(F.col("node_id").alias("parent_id"), "path", "_line")
        level = durable(
            nodes.join(above, "parent_id").select(
                "node_id",
                F.concat_ws(PATH_SEPARATOR, "path", "name").alias("path"),
                F.lit(depth).cast("bigint").alias("depth"),
                F.concat("_line", F.array("node_id")).alias("_line"),
                F.array_contains("_line", F.col("node_id")).alias("_ring"),
            )
        )
        state = level.agg(F.count("*").alias("n"), F.bool_or("_ring").alias("ring")).first()
        if not state.n:
            return found
        if state.ring:
            raise ValueError(f"a node at depth {depth} is its own ancestor")
        level = level.drop("_ring")
        found = union_rows(found, level.drop("_line"))


def _doubled(rows: DataFrame, joint: Column | None = None) -> DataFrame:
    """Every stretch of ancestors put before the one of the node it points to; stretches whose pointer leads nowhere go.

    Late rounds point at few nodes near the roots, so the pointers that own most rows meet a broadcast slice.
    """
    carried = [c for c in ("top", "depth", "path") if c in rows.columns]
    open_rows = rows.filter("up IS NOT NULL")
    above = rows.filter("node_id IS NOT NULL").select(F.col("node_id").alias("up"), F.col("up").alias("_up"), *(F.col(c).alias(f"_{c}") for c in carried))
    width = 64
    if joint is not None:
        width += int(rows.agg(F.avg(F.octet_length("path"))).first()[0] or 0)
    heavy = heavy_keys(durable(open_rows.groupBy("up").agg(F.count("*").alias("_n"))), ["up"], "_n")
    met = lookup_join(open_rows, above, ["up"], heavy, row_bytes=width)
    longer = {"top": F.col("_top"), "depth": F.col("depth") + F.col("_depth")}
    if joint is not None:
        longer["path"] = F.concat(F.col("_path"), joint, F.col("path"))
    moved = met.select("node_id", F.col("_up").alias("up"), *(longer[c].alias(c) for c in carried))
    # The union has the partitions of its parts, which would double with every round.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return durable(union_rows(rows.filter("up IS NULL"), moved).coalesce(parts))


def tree_depths(nodes: DataFrame, allowed: Column | None = None) -> DataFrame:
    """(node_id, root_id, depth) of every node that leads to a root through allowed names; a root has depth 1.

    For trees of any depth: pointers double their reach, so a chain of n levels takes about log2(n) rounds. `nodes` has
    (node_id, parent_id, name) as in `tree_paths`, but one row a node: a repeated node_id is an error. Nodes in or
    below a ring or a missing parent lead to no root and have no row.
    """
    if allowed is not None:
        nodes = nodes.filter(allowed)
    rows = durable(nodes.select("node_id", F.col("parent_id").alias("up"), F.col("node_id").alias("top"), F.lit(1).cast("bigint").alias("depth")))
    if not rows.filter("node_id IS NOT NULL").groupBy("node_id").count().filter("count > 1").isEmpty():
        raise ValueError("a node_id has more than one row")
    # A path without a ring is no longer than the table, so what is open after these rounds is in a ring or below one.
    for _ in range(rows.count().bit_length()):
        if rows.filter("up IS NOT NULL").isEmpty():
            break
        rows = _doubled(rows)
    return rows.filter("up IS NULL").select("node_id", F.col("top").alias("root_id"), "depth")


def deep_tree_paths(nodes: DataFrame, allowed: Column | None = None) -> DataFrame:
    """(node_id, path, depth): the rows of `tree_paths` for one row a node, in as many rounds as `tree_depths` takes.

    Paths are joined only for nodes that lead to a root; a path is as long as the names on it. A null name adds nothing
    between its separators.
    """
    if allowed is not None:
        nodes = nodes.filter(allowed)
    rooted = tree_depths(nodes).select("node_id")
    start = nodes.join(rooted, "node_id", "left_semi")
    rows = durable(
        start.select("node_id", F.col("parent_id").alias("up"), F.lit(1).cast("bigint").alias("depth"), F.coalesce("name", F.lit("")).alias("path"))
    )
    while not rows.filter("up IS NOT NULL").isEmpty():
        rows = _doubled(rows, F.lit(PATH_SEPARATOR))
    return rows.select("node_id", "path", "depth")
