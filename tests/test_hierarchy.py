import random

import pytest
from pyspark.sql import functions as F

from textspark.operators import hierarchy
from textspark.plans import skew

SCHEMA = "node_id long, parent_id long, name string"


def slow(nodes):
    """{node: (root, depth, path)} by walking up from every node."""
    up, names, out = {n: p for n, p, _ in nodes}, {n: m for n, _, m in nodes}, {}
    for n in up:
        line = [n]
        while up[line[-1]] is not None and up[line[-1]] in up and up[line[-1]] not in line:
            line.append(up[line[-1]])
        if up[line[-1]] is None:
            out[n] = (line[-1], len(line), " > ".join(names[x] for x in reversed(line)))
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_equals_walking_up(spark, monkeypatch, broadcast):
    """Trees, a hot root, rings with branches, and nodes below a missing parent; also with every lookup split by heat."""
    if not broadcast:
        monkeypatch.setattr(skew, "fits_broadcast", lambda *args: False)
    pick = random.Random(1)
    nodes = [(0, None, "r"), (1, None, "s")] + [(i, pick.randrange(i), f"n{i}") for i in range(2, 40)]
    nodes += [(i, 0, f"h{i}") for i in range(40, 90)]
    nodes += [(100, 102, "a"), (101, 100, "b"), (102, 101, "c"), (103, 102, "d"), (104, 104, "e"), (105, 999, "f"), (106, 105, "g")]
    df, want = spark.createDataFrame(nodes, SCHEMA), slow(nodes)
    assert {r.node_id: (r.root_id, r.depth) for r in hierarchy.tree_depths(df).collect()} == {n: w[:2] for n, w in want.items()}
    assert {r.node_id: (r.depth, r.path) for r in hierarchy.deep_tree_paths(df).collect()} == {n: w[1:] for n, w in want.items()}


def test_ten_thousand_levels_in_fourteen_rounds(spark, monkeypatch):
    rounds, once = [], hierarchy._doubled
    monkeypatch.setattr(hierarchy, "_doubled", lambda *args: rounds.append(1) or once(*args))
    n = F.col("id")
    chain = spark.range(10_000).select(n.alias("node_id"), F.when(n > 0, n - 1).alias("parent_id"), F.lit("x").alias("name"))
    got = hierarchy.tree_depths(chain)
    assert got.filter("root_id = 0 AND depth = node_id + 1").count() == 10_000
    assert len(rounds) == 14


def test_names_cut_subtrees_and_a_repeated_node_fails(spark):
    nodes = spark.createDataFrame([(1, None, "A"), (2, 1, "B"), (3, 2, None), (4, 1, "skip"), (5, 4, "D")], SCHEMA)
    rows = hierarchy.deep_tree_paths(nodes, F.coalesce("name", F.lit("")) != "skip").collect()
    assert {(r.path, r.depth) for r in rows} == {("A", 1), ("A > B", 2), ("A > B > ", 3)}
    with pytest.raises(ValueError):
        hierarchy.tree_depths(nodes.union(nodes))
    assert hierarchy.deep_tree_paths(nodes.limit(0)).count() == 0
