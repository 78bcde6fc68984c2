"""Density clustering of points in the plane, exact, without comparing all points of a crowded place.

The plane is cut into cells so small that two points of one cell are always within `eps`:

* copies of a location are merged with a weight first;
* a cell holding `min_samples` points needs no comparison at all, its points are all core points;
* points of other cells are few per cell, and only they are compared with their surroundings;
* two cells are tested for contact through bounding boxes, which are split further only while they leave
  the answer open; single points are compared for small boxes only.

Clusters are then components of the graph of cells, whose nodes have at most 24 neighbours.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textspark.operators.components import components
from textspark.plans.lineage import durable
from textspark.plans.skew import heavy_keys, lookup_join
from textspark.plans.union import union_rows

_CELL = ["cx", "cy"]
_REACH = range(-2, 3)
_SLICES = 64
_HOT_CELL = 10_000
_DIRECT_PAIRS = 4096
_SPLIT = 4
_MAX_LEVEL = 24


def _offsets(pairs) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in pairs]))


def _square_distance(ax: str, ay: str, bx: str, by: str) -> Column:
    dx, dy = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return dx * dx + dy * dy


def _around(probes: DataFrame, others: DataFrame, hot: DataFrame, eps: float) -> DataFrame:
    """Pairs (probe columns, other columns as o_*) within eps, others looked up in the 25 cells around.

    Crowded cells (a bounded list) are dealt out over slices, each of which meets every probe.
    """
    marked = F.broadcast(hot.select(*_CELL, F.lit(True).alias("_hot")))
    sliced = others.join(marked, _CELL, "left").withColumn(
        "_slice", F.when(F.col("_hot"), F.pmod(F.xxhash64("loc"), F.lit(_SLICES))).otherwise(F.lit(0).cast("bigint"))
    )
    right = sliced.select(*_CELL, "_slice", *[F.col(c).alias(f"o_{c}") for c in others.columns if c not in _CELL])
    left = (
        probes.withColumnsRenamed({"cx": "_px", "cy": "_py"})
        .withColumn("_o", _offsets([(i, j) for i in _REACH for j in _REACH]))
        .withColumns({"cx": F.col("_px") + F.col("_o.i"), "cy": F.col("_py") + F.col("_o.j")})
        .join(marked, _CELL, "left")
        .withColumn(
            "_slice",
            F.explode(
                F.when(F.col("_hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(_SLICES - 1).cast("bigint")))
                .otherwise(F.array(F.lit(0).cast("bigint")))
            ),
        )
        .drop("_o", "_hot")
    )
    near = _square_distance("x", "y", "o_x", "o_y") <= eps * eps
    return left.join(right, [*_CELL, "_slice"]).filter(near)


def _sub(level: int, side: float) -> dict[str, Column]:
    """Sub-cell numbers of a point; a power-of-two scale keeps the levels nested exactly."""
    place = {c: (F.col(v) - F.col(f"c{v}") * F.lit(side)) / F.lit(side) for c, v in (("sx", "x"), ("sy", "y"))}
    return {c: F.floor(p * F.lit(float(_SPLIT**level))) for c, p in place.items()}


def _boxes(core: DataFrame, level: int, side: float, prefix: str) -> DataFrame:
    boxes = core.withColumns(_sub(level, side)).groupBy(*_CELL, "sx", "sy").agg(
        F.count("*").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"),
        F.min("y").alias("y0"), F.max("y").alias("y1"),
    )
    return boxes.toDF(*[f"{prefix}{c}" for c in boxes.columns])


_BOX = ["cx", "cy", "sx", "sy"]


def _touching(pairs: DataFrame, core: DataFrame, eps: float, side: float) -> DataFrame:
    """Those cell pairs (a, b) of `pairs(a, b, acx, acy, bcx, bcy)` with core points within eps of each other."""
    e2 = eps * eps
    keys = [f"{p}{c}" for p in "ab" for c in _BOX]
    zero = F.lit(0).cast("bigint")
    still_open = pairs.withColumns({k: zero for k in keys if k[1:] in ("sx", "sy")})
    found = None
    for level in range(_MAX_LEVEL + 1):
        judged = still_open
        for p in "ab":
            judged = judged.join(_boxes(core, level, side, p), [f"{p}{c}" for c in _BOX])
        wide = [F.greatest(F.col(f"a{v}1") - F.col(f"b{v}0"), F.col(f"b{v}1") - F.col(f"a{v}0")) for v in "xy"]
        gap = [
            F.greatest(F.col(f"a{v}0") - F.col(f"b{v}1"), F.col(f"b{v}0") - F.col(f"a{v}1"), F.lit(0.0)) for v in "xy"
        ]
        far, near = (sum((d * d for d in ds[1:]), ds[0] * ds[0]) for ds in (wide, gap))
        judged = durable(
            judged.select("a", "b", *keys, far.alias("far"), near.alias("near"), (F.col("an") * F.col("bn")).alias("n"))
            .filter(F.col("near") <= e2)
        )
        sure = judged.filter(F.col("far") <= e2).select("a", "b")
        unsure = judged.filter(F.col("far") > e2)
        small = F.col("n") <= _DIRECT_PAIRS if level < _MAX_LEVEL else F.lit(True)
        direct = unsure.filter(small)
        placed = core.withColumns(_sub(level, side)).select(*_BOX, "x", "y")
        for p in "ab":
            direct = direct.join(placed.toDF(*[f"{p}{c}" for c in placed.columns]), [f"{p}{c}" for c in _BOX])
        checked = direct.filter(_square_distance("ax", "ay", "bx", "by") <= e2).select("a", "b")
        hits = durable(union_rows(sure, checked).distinct())
        found = hits if found is None else union_rows(found, hits)
        left = unsure.filter(~small).join(hits, ["a", "b"], "left_anti")
        if level == _MAX_LEVEL or left.isEmpty():
            return found.distinct()
        children = [(i, j) for i in range(_SPLIT) for j in range(_SPLIT)]
        still_open = left.select("a", "b", *keys)
        for p in "ab":
            still_open = still_open.withColumn("_o", _offsets(children)).withColumns(
                {
                    f"{p}sx": F.col(f"{p}sx") * _SPLIT + F.col("_o.i"),
                    f"{p}sy": F.col(f"{p}sy") * _SPLIT + F.col("_o.j"),
                }
            ).drop("_o")
    return found


def density_clusters(points: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """(id, cluster, is_core) of points(id, x, y); noise is dropped.

    A core point has at least min_samples points within eps, itself included. A cluster is named after its
    smallest core id; a border point goes to the smallest cluster among its core neighbours.
    """
    side = eps / math.sqrt(2) * (1 - 1e-9)
    placed = points.select("id", "x", "y", *[F.floor(F.col(v) / side).alias(c) for c, v in zip(_CELL, "xy")])
    locations = durable(
        placed.groupBy(*_CELL, "x", "y").agg(F.min("id").alias("loc"), F.count("*").alias("w"))
    )
    cells = durable(locations.groupBy(*_CELL).agg(F.sum("w").alias("weight"), F.count("*").alias("n_locs")))
    hot = heavy_keys(cells.filter(F.col("n_locs") >= _HOT_CELL), _CELL, "n_locs")

    weighed = lookup_join(locations, cells.select(*_CELL, "weight"), _CELL, hot)
    crowded = weighed.filter(F.col("weight") >= min_samples).select(*locations.columns)
    lonely = weighed.filter(F.col("weight") < min_samples).select(*locations.columns)
    counted = _around(lonely, locations, hot, eps).groupBy("loc").agg(F.sum("o_w").alias("_n"))
    lonely_core = lonely.join(counted.filter(F.col("_n") >= min_samples), "loc", "left_semi")
    core = durable(union_rows(crowded, lonely_core.select(*crowded.columns)))

    nodes = durable(core.groupBy(*_CELL).agg(F.min("loc").alias("node")))
    ahead = [(i, j) for i in _REACH for j in _REACH if (i, j) > (0, 0)]
    pairs = (
        nodes.select(F.col("node").alias("a"), F.col("cx").alias("acx"), F.col("cy").alias("acy"))
        .withColumn("_o", _offsets(ahead))
        .withColumns({"bcx": F.col("acx") + F.col("_o.i"), "bcy": F.col("acy") + F.col("_o.j")})
        .join(nodes.select(F.col("node").alias("b"), F.col("cx").alias("bcx"), F.col("cy").alias("bcy")), ["bcx", "bcy"])
        .drop("_o")
    )
    edges = _touching(pairs, core, eps, side)
    clusters = nodes.join(components(nodes.select("node"), edges), "node").select(
        *_CELL, F.col("component").alias("cluster")
    )

    core_clusters = durable(lookup_join(core, clusters, _CELL, hot))
    fringe = lonely.join(core.select("loc"), "loc", "left_anti")
    border = _around(fringe, core_clusters, hot, eps).groupBy("x", "y").agg(F.min("o_cluster").alias("cluster"))

    full = cells.filter(F.col("weight") >= min_samples).select(*_CELL).join(clusters, _CELL)
    inside = lookup_join(placed, full, _CELL, hot).select("id", "cluster", F.lit(True).alias("is_core"))
    # What is left lies in cells with fewer than min_samples points, so these joins cannot be skewed.
    rest = placed.join(cells.filter(F.col("weight") < min_samples).select(*_CELL), _CELL, "left_semi")
    alone = rest.join(
        lonely_core.select("x", "y", *_CELL).join(clusters, _CELL).select("x", "y", "cluster"), ["x", "y"]
    ).select("id", "cluster", F.lit(True).alias("is_core"))
    edge = rest.join(border, ["x", "y"]).select("id", "cluster", F.lit(False).alias("is_core"))
    return union_rows(inside, alone, edge)
