"""Density clusters (DBSCAN) of coordinates on a decimal lattice.

Rows are first reduced to distinct lattice points with a weight, so a place with many reports is one
point. Points are grouped into square cells so small that any two points of a cell are neighbours: its core
points always belong together, and clusters are the connected components of the cells rather than of the
points. A cell of up to MAX_CELL_SIDE lattice steps is a list of points; where eps makes cells wider, quadtrees
tell which cells and points are within reach of each other, whatever the number of points in a cell.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import round_even
from ..session import write_stage
from .components import tiled_components
from .indexing import add_dense_index
from .skew import salted_join

NOISE = -1
MAX_CELL_SIDE = 64  # wider cells are searched by quadtrees
LEAF_SIDE = 8
CELL_SPAN = 1 << 31
# Width of a tile in cells. Inside a large tile only the edges across small tiles are left.
TILES = {"tile": 1 << 6, "block": 1 << 11}


def round_coordinates(df: DataFrame, decimals: int = 4) -> DataFrame:
    return df.withColumns({c: round_even(c, decimals) for c in ("latitude", "longitude")})


def _cell_id(cx: Column, cy: Column) -> Column:
    return cx.cast("bigint") * F.lit(CELL_SPAN) + cy.cast("bigint") + F.lit(CELL_SPAN // 2)


def _tile_id(cell: str, width: int) -> Column:
    """Tile of a cell, from the two numbers packed in its id."""
    cx = F.shiftright(cell, 31)
    cy = F.col(cell).bitwiseAND(F.lit(CELL_SPAN - 1)) - F.lit(CELL_SPAN // 2)
    return _cell_id(F.floor(cx / width), F.floor(cy / width))


def _reach(side: int, limit: float) -> list[tuple[int, int]]:
    """Cell offsets, without (0, 0), that can hold a point within sqrt(limit) lattice steps."""

    def gap(k: int) -> int:
        return max(0, (abs(k) - 1) * side + 1) if k else 0

    far = math.isqrt(int(limit)) // side + 1
    span = range(-far, far + 1)
    return [(a, b) for a in span for b in span if (a or b) and gap(a) ** 2 + gap(b) ** 2 <= limit]


def _near(p: Column, q: Column, limit: float) -> Column:
    dx, dy = p["x"] - q["x"], p["y"] - q["y"]
    return dx * dx + dy * dy <= F.lit(limit)


def _neighbour_ids(cx: Column, cy: Column, offsets: list[tuple[int, int]]) -> Column:
    return F.array(*[_cell_id(cx + a, cy + b) for a, b in offsets])


def dbscan(df: DataFrame, id_column: str, eps: float = 0.0008, min_samples: int = 1, decimals: int = 4, dense: bool = True, **salting) -> DataFrame:
    """Add cluster: numbered 0, 1, .. by the smallest row id at a core point of the cluster, -1 for noise.

    latitude and longitude are rounded to `decimals`; two points are neighbours when their distance in
    degrees is at most eps. A border point goes to the first of the clusters that it touches. With
    dense=False the label is that smallest row id itself. Row ids must be numeric.
    """
    scale = 10**decimals
    limit = math.floor((eps * scale) ** 2 + 1e-6)
    side = math.isqrt(limit // 2) + 1
    while 2 * (side - 1) ** 2 > limit:
        side -= 1
    offsets = _reach(side, limit)
    wide = side > MAX_CELL_SIDE  # cells that may hold too many points for a list get a quadtree

    rows = round_coordinates(df, decimals).withColumns(
        {"_x": F.rint(F.col("longitude") * scale).cast("int"), "_y": F.rint(F.col("latitude") * scale).cast("int")}
    )
    cx, cy = F.floor(F.col("x") / side).cast("int"), F.floor(F.col("y") / side).cast("int")
    points = (
        rows.filter("_x is not null and _y is not null")
        .groupBy(F.col("_x").alias("x"), F.col("_y").alias("y"))
        .agg(F.count(F.lit(1)).alias("w"), F.min(id_column).alias("first_id"))
        .withColumns({"cx": cx, "cy": cy})
        .withColumn("cell", _cell_id(F.col("cx"), F.col("cy")))
    )
    marked = _mark_core_by_quads(points, offsets, limit, min_samples, side) if wide else _mark_core(points, offsets, limit, min_samples)
    points = write_stage(marked, "points")
    salting["rows"] = points.agg(F.sum("w")).first()[0] or 0

    listed = F.lit(None) if wide else F.collect_list(F.struct("x", "y"))
    cells = points.filter("core").groupBy("cell", "cx", "cy").agg(listed.alias("pts"), F.min("first_id").alias("first_id"))
    cells = write_stage(cells.drop("pts") if wide else cells, "cells")
    forward = [o for o in offsets if o > (0, 0)]
    quads = Quads(points.filter("core"), side) if wide else None
    neighbours = F.explode(_neighbour_ids(F.col("cx"), F.col("cy"), forward)).alias("v")
    if wide:
        met = cells.select(F.col("cell").alias("u"), neighbours).join(cells.select(F.col("cell").alias("v")), "v")
        pairs, touching = quads.touching(met, limit), F.lit(True)
    else:
        pairs = cells.select(F.col("cell").alias("u"), F.col("pts").alias("a"), neighbours)
        pairs = pairs.join(cells.select(F.col("cell").alias("v"), F.col("pts").alias("b")), "v")
        touching = F.exists("a", lambda p: F.exists(F.col("b"), lambda q: _near(p, q, limit)))
    places = [_tile_id(end, width).alias(f"{level}_{end}") for level, width in TILES.items() for end in ("u", "v")]
    linked = tiled_components(pairs.filter(touching).select("u", "v", *places), list(TILES), **salting)
    linked = linked.withColumnRenamed("node", "cell")
    roots = write_stage(cells.join(linked, "cell", "left").withColumn("root", F.coalesce("root", "cell")), "roots")
    names = roots.groupBy("root").agg(F.min("first_id").alias("cluster"))
    if dense:
        names = add_dense_index(write_stage(names, "names"), "cluster", "number").select("root", F.col("number").alias("cluster"))
    named = salted_join(roots, names, ["root"], "inner", **salting).drop("cx", "cy", "first_id", "root")
    named = write_stage(named, "named")

    core = points.filter("core").join(named.select("cell", "cluster"), "cell").select("x", "y", "cluster")
    borders = points.filter("not core").select(
        "x", "y", F.explode(_neighbour_ids(F.col("cx"), F.col("cy"), [(0, 0), *offsets])).alias("cell")
    )
    if wide:
        touched = quads.weight_near(borders, limit).filter("weight > 0").join(named, "cell")
    else:
        touched = borders.join(named, "cell").filter(F.exists("pts", lambda q: _near(F.struct("x", "y"), q, limit)))
    labels = core.unionAll(touched.groupBy("x", "y").agg(F.min("cluster").alias("cluster")))
    labels = write_stage(labels.withColumnsRenamed({"x": "_x", "y": "_y"}), "labels")
    # Rows without coordinates are noise and meet no join, where they would all share one key.
    placed = rows.filter("_x is not null and _y is not null")
    found = salted_join(placed, labels, ["_x", "_y"], "left", **salting)
    lost = rows.filter("_x is null or _y is null").withColumn("cluster", F.lit(None).cast("bigint"))
    found = found.select(lost.columns).unionAll(lost).drop("_x", "_y")
    return found.withColumn("cluster", F.coalesce("cluster", F.lit(NOISE)).cast("bigint"))


class Quads:
    """Quadtrees over the points of large cells: squares that halve down to LEAF_SIDE lattice steps.

    Squares whose boxes lie wholly within reach, or wholly beyond it, are settled as they are; only the
    others are opened, one level a round. No row ever holds more points than a leaf has room for.
    """

    def __init__(self, points: DataFrame, side: int):
        self.depth = max(0, math.ceil(math.log2(side / LEAF_SIDE)))
        width = LEAF_SIDE << self.depth
        inner = points.withColumns({"ix": F.col("x") - F.col("cx") * side, "iy": F.col("y") - F.col("cy") * side})

        def square(level: Column) -> Column:
            step = F.lit(width) / F.pow(F.lit(2), level)
            return F.floor(F.col("ix") / step) * F.lit(CELL_SPAN) + F.floor(F.col("iy") / step)

        levels = inner.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(self.depth))))
        levels = levels.withColumns({"q": square(F.col("level")), "up": square(F.greatest(F.col("level") - 1, F.lit(0)))})
        boxes = levels.groupBy("cell", "level", "q", "up").agg(
            F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.sum("w").alias("w")
        )
        self.nodes = write_stage(boxes, "quads")
        leaves = inner.withColumn("q", square(F.lit(self.depth)))
        self.leaves = write_stage(leaves.groupBy("cell", "q").agg(F.collect_list(F.struct("x", "y", "w")).alias("pts")), "leaves")

    def _level(self, level: int, **names: str) -> DataFrame:
        """The squares of a level under other names."""
        return self.nodes.filter(F.col("level") == level).drop("level").withColumnsRenamed(names)

    def weight_near(self, asked: DataFrame, limit: float) -> DataFrame:
        """(x, y, cell, weight): for points (x, y) and cells, the weight of the cell's points within reach."""
        settled = []
        state = asked.select("x", "y", "cell", F.lit(None).cast("bigint").alias("q"))
        for level in range(self.depth + 1):
            below = self._level(level)
            met = state.drop("q").join(below, "cell") if level == 0 else state.join(below.withColumnRenamed("q", "_q").withColumnRenamed("up", "q"), ["cell", "q"]).drop("q").withColumnRenamed("_q", "q")
            gap, far = _box_distances(F.col("x"), F.col("x"), F.col("y"), F.col("y"), F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1"))
            met = met.withColumns({"gap": gap, "far": far}).filter(F.col("gap") <= limit)
            settled.append(met.filter(F.col("far") <= limit).select("x", "y", "cell", F.col("w").alias("weight")))
            state = write_stage(met.filter(F.col("far") > limit).select("x", "y", "cell", "q"), "opened")
        near = F.filter("pts", lambda q: _near(F.struct("x", "y"), q, limit))
        weight = F.aggregate(near, F.lit(0).cast("bigint"), lambda total, q: total + q["w"])
        settled.append(state.join(self.leaves, ["cell", "q"]).select("x", "y", "cell", weight.alias("weight")))
        return reduce(DataFrame.unionAll, settled).groupBy("x", "y", "cell").agg(F.sum("weight").alias("weight"))

    def touching(self, pairs: DataFrame, limit: float) -> DataFrame:
        """Those pairs (u, v) of cells of which two points are within reach of each other."""
        a = {c: f"a_{c}" for c in ("q", "up", "x0", "x1", "y0", "y1", "w")}
        b = {c: f"b_{c}" for c in a}
        found, state = [], pairs.select("u", "v")
        for level in range(self.depth + 1):
            left, right = self._level(level, cell="u", **a), self._level(level, cell="v", **b)
            if level == 0:
                met = state.join(left, "u").join(right, "v")
            else:
                left, right = (side.withColumnRenamed(f"{n}_q", f"{n}_new").withColumnRenamed(f"{n}_up", f"{n}_q") for side, n in ((left, "a"), (right, "b")))
                met = state.join(left, ["u", "a_q"]).join(right, ["v", "b_q"]).drop("a_q", "b_q").withColumnsRenamed({"a_new": "a_q", "b_new": "b_q"})
            box = [F.col(f"{n}_{c}") for n in "ab" for c in ("x0", "x1", "y0", "y1")]
            gap, far = _box_distances(*box)
            met = write_stage(met.withColumns({"gap": gap, "far": far}).filter(F.col("gap") <= limit).select("u", "v", "a_q", "b_q", "far"), "opened")
            found.append(met.filter(F.col("far") <= limit).select("u", "v").distinct())
            state = met.join(found[-1], ["u", "v"], "left_anti").select("u", "v", "a_q", "b_q")
        left = self.leaves.select(F.col("cell").alias("u"), F.col("q").alias("a_q"), F.col("pts").alias("a"))
        right = self.leaves.select(F.col("cell").alias("v"), F.col("q").alias("b_q"), F.col("pts").alias("b"))
        close = F.exists("a", lambda p: F.exists(F.col("b"), lambda q: _near(p, q, limit)))
        found.append(state.join(left, ["u", "a_q"]).join(right, ["v", "b_q"]).filter(close).select("u", "v"))
        return reduce(DataFrame.unionAll, found).distinct()


def _box_distances(ax0: Column, ax1: Column, ay0: Column, ay1: Column, bx0: Column, bx1: Column, by0: Column, by1: Column) -> tuple[Column, Column]:
    """Squares of the least and the greatest distance between two boxes."""

    def gap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
        return F.greatest(a0 - b1, b0 - a1, F.lit(0)).cast("bigint")

    def far(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
        return F.greatest(a1 - b0, b1 - a0).cast("bigint")

    x, y = (ax0, ax1, bx0, bx1), (ay0, ay1, by0, by1)
    return gap(*x) * gap(*x) + gap(*y) * gap(*y), far(*x) * far(*x) + far(*y) * far(*y)


def _mark_core_by_quads(points: DataFrame, offsets: list[tuple[int, int]], limit: float, min_samples: int, side: int) -> DataFrame:
    """_mark_core for cells that may hold many points."""
    if min_samples <= 1:
        return points.withColumn("core", F.lit(True))
    points = write_stage(points, "points")
    own = points.groupBy("cell").agg(F.sum("w").alias("own"))
    counted = write_stage(points.join(own, "cell"), "points")
    asked = counted.filter(F.col("own") < min_samples).select("x", "y", F.explode(_neighbour_ids(F.col("cx"), F.col("cy"), offsets)).alias("cell"))
    extra = Quads(points, side).weight_near(asked, limit).groupBy("x", "y").agg(F.sum("weight").alias("more"))
    total = F.col("own") + F.coalesce("more", F.lit(0))
    return counted.join(extra, ["x", "y"], "left").withColumn("core", total >= min_samples).drop("own", "more")


def _mark_core(points: DataFrame, offsets: list[tuple[int, int]], limit: float, min_samples: int) -> DataFrame:
    """Add core: at least min_samples rows within reach, the point's own rows included."""
    if min_samples <= 1:
        return points.withColumn("core", F.lit(True))
    points = write_stage(points, "points")
    cells = points.groupBy("cell").agg(F.sum("w").alias("own"), F.collect_list(F.struct("x", "y", "w")).alias("pts"))
    cells = write_stage(cells, "cells")
    # Points of one cell are all neighbours, so a full cell needs no further look.
    counted = points.join(cells.select("cell", "own"), "cell")
    open_points = counted.filter(F.col("own") < min_samples)
    around = open_points.select(
        "x", "y", F.explode(_neighbour_ids(F.col("cx"), F.col("cy"), offsets)).alias("cell")
    ).join(cells, "cell")
    near = F.filter("pts", lambda q: _near(F.struct("x", "y"), q, limit))
    weight = F.aggregate(near, F.lit(0).cast("bigint"), lambda total, q: total + q["w"])
    extra = around.select("x", "y", weight.alias("more")).groupBy("x", "y").agg(F.sum("more").alias("more"))
    total = F.col("own") + F.coalesce("more", F.lit(0))
    return counted.join(extra, ["x", "y"], "left").withColumn("core", total >= min_samples).drop("own", "more")
