"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_stage, write_stage
from .skew import salted_join

# Tasks get the functions of this module with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _min_neighbour(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours; combined before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame, **salting) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = salted_join(both, _min_neighbour(both), ["u"], "inner", **salting)
    return linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, **salting) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _min_neighbour(down)
    linked = salted_join(down, least, ["u"], "inner", **salting)
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("u") != F.col("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60, **salting) -> DataFrame:
    """(node, root) for every node of the edge table (u, v), root being the smallest node of its component.

    Ends when a round leaves the edges as they were; by then they are stars around the roots. Each
    round is written out, so the plan stays short and a lost executor costs one round at most.
    """
    now = write_stage(_tidy(edges.select("u", "v")), "edges")
    state = _state(now)
    if not state[0]:
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(max_rounds):
        # A large-star step sees each edge from both ends, a small-star step at most those edges.
        salting["rows"] = 2 * state[0]
        starred = _tidy(_large_star(now, **salting))
        following = write_stage(_tidy(_small_star(starred, **salting)), "edges")
        drop_stage(now)
        now, before, state = following, state, _state(following)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)


def _roots_in_tile(edges: pd.DataFrame) -> pd.DataFrame:
    nodes, ends = np.unique(edges[["u", "v"]].to_numpy(), return_inverse=True)
    u, v = ends.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if np.array_equal(new, root):
            return pd.DataFrame({"node": nodes, "root": nodes[root]})
        root = new


def _relabel(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Replace both ends of the edges by their roots; the tiles stay those of the first ends."""
    for end in ("u", "v"):
        edges = edges.join(roots.withColumnRenamed("node", end), end, "left")
        edges = edges.withColumn(end, F.coalesce("root", end)).drop("root")
    return edges.filter("u <> v").distinct()


def _compose(inner: DataFrame, outer: DataFrame, **salting) -> DataFrame:
    """Roots of roots: nodes of both tables, each with the last root known for it."""
    onward = outer.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = salted_join(inner, onward, ["root"], "left", **salting)
    moved = moved.select("node", F.coalesce("top", "root").alias("root"))
    return moved.unionByName(outer.join(inner.select("node"), "node", "left_anti"))


def tiled_components(edges: DataFrame, tiles: list[str], **salting) -> DataFrame:
    """(node, root) for edges between places on a map, solved tile by tile.

    Every edge (u, v) carries for each level of tiles, small ones first, the columns <level>_u and
    <level>_v. Edges inside a tile are solved in that tile, and only edges across tiles, between the
    roots found so far, go on to the next level and at last to the rounds above. A tile must hold a
    bounded number of nodes.
    """
    known = None
    for level in tiles:
        here = write_stage(edges, "edges")
        same = F.col(f"{level}_u") == F.col(f"{level}_v")
        inside = here.filter(same).groupBy(f"{level}_u").applyInPandas(_roots_in_tile, "node bigint, root bigint")
        roots = write_stage(inside, "roots")
        edges = _relabel(here.filter(~same), roots)
        known = roots if known is None else _compose(known, roots, **salting)
    return _compose(known, connected_components(edges.select("u", "v"), **salting), **salting)
