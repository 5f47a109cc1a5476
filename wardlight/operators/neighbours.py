"""Exact k nearest neighbours among vectors, as a pivot-partitioned join (after Lu et al., VLDB 2012).

Every point belongs to the cell of its nearest pivot. From the cell radii, the distances between pivots
and the k + 1 points nearest to each pivot follows how far a point's neighbours can be at most, so a cell
needs only the points within its reach. Cells and reaches are cut into blocks of bounded size; a task
compares one block of queries with one block of candidates and passes on k rows per query.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_stage
from .sampling import sample_data

BLOCK_BYTES = 16 << 20
POINTS_PER_PIVOT = 4_000
MAX_PIVOTS = 2_048
PIVOT_VALUES = 2_000_000
SLICE = 256
#: Numbers that a task holds at a time while it deals points to cells: distances to pivots, and values of copies.
HELD_VALUES = 4_000_000
SLACK = 1e-7  # relative allowance for rounding, always on the side of keeping more candidates

# Tasks get the functions of this module with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a @ b.T
    out *= -2.0
    out += (a * a).sum(1)[:, None]
    out += (b * b).sum(1)[None, :]
    return np.maximum(out, 0.0, out=out)


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(float)


def _slices(batches: Iterator[pd.DataFrame], cells: int, width: int) -> Iterator[pd.DataFrame]:
    """Rows in slices so small that a distance to every cell, and a copy for every cell, stay within HELD_VALUES."""
    step = max(1, HELD_VALUES // (cells * (width + 1)))
    for b in batches:
        for start in range(0, len(b), step):
            yield b.iloc[start : start + step]


def _nearest(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """k nearest candidates of each query, by (distance, id), the query itself left out."""
    columns = ["id", "nid", "dist"]
    if queries.empty or candidates.empty:
        return pd.DataFrame(columns=columns).astype({"id": str, "nid": str, "dist": float})
    a, b = _matrix(queries["features"]), _matrix(candidates["features"])
    qid, cid = queries["id"].to_numpy(), candidates["id"].to_numpy()
    norm = float((b * b).sum(1).max())
    place = np.unique(cid, return_inverse=True)[1]
    out = []
    for start in range(0, len(a), SLICE):
        part = a[start : start + SLICE]
        rough = _squared(part, b)
        kept = min(k + 1, len(b))
        bound = np.partition(rough, kept - 1, axis=1)[:, kept - 1]
        bound = bound + SLACK * (norm + (part * part).sum(1))
        row, near = np.nonzero(rough <= bound[:, None])
        other = cid[near] != qid[start + row]
        row, near = row[other], near[other]
        exact = np.sqrt(((b[near] - part[row]) ** 2).sum(1))
        best = np.lexsort((place[near], exact, row))
        row = row[best]
        first = np.arange(len(row)) - np.searchsorted(row, row) < k
        row, best = row[first], best[first]
        out.append(pd.DataFrame({"id": qid[start + row], "nid": cid[near[best]], "dist": exact[best]}))
    return pd.concat(out, ignore_index=True)


def _cell_bounds(near: dict[int, list[float]], radius: np.ndarray, gaps: np.ndarray, k: int) -> np.ndarray:
    """Greatest distance from each pivot at which a neighbour of a point of its cell can lie."""
    reach = np.full(len(radius), np.inf)
    owner = np.array([j for j, ds in near.items() for _ in ds])
    close = np.array([d for ds in near.values() for d in ds])
    if len(close) > k:
        for i in range(len(radius)):
            within = radius[i] + np.partition(gaps[i, owner] + close, k)[k]
            reach[i] = radius[i] + within
    return reach * (1 + SLACK) + SLACK


def nearest_neighbours(
    points: DataFrame, k: int, block_rows: int | None = None, pivots: int | None = None, queries: DataFrame | None = None
) -> DataFrame:
    """(id, nid, dist, rank) with rank 1..k.

    points: id STRING, features ARRAY<DOUBLE>, no two equal vectors; a table, since it is read often. With
    queries (id) only those points ask for their neighbours, among all points, and cells reach no further
    than the asking points need.
    """
    n = points.count()
    width = len(points.select("features").first()[0])
    block = block_rows or max(1_000, BLOCK_BYTES // (8 * width))
    wanted = pivots or min(MAX_PIVOTS, math.ceil(n / POINTS_PER_PIVOT), max(1, PIVOT_VALUES // width))
    picked = sample_data(points, "id", wanted, "pivot").orderBy("id").select("features").collect()
    centres = np.array([r["features"] for r in picked], dtype=float)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _slices(batches, len(centres), 1):
            d = np.sqrt(_squared(_matrix(b["features"]), centres))
            cell = d.argmin(axis=1)
            yield b.assign(cell=cell.astype("int32"), dist=d[np.arange(len(b)), cell])

    assigned = points.select("id", "features").mapInPandas(assign, "id string, features array<double>, cell int, dist double")
    assigned = write_stage(assigned, "cells")  # read three times below
    # Spark prunes this ranking before the shuffle, so a large cell sends k + 1 rows per task.
    ranked = assigned.select("cell", "dist").withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy("dist")))
    near: dict[int, list[float]] = {}
    for r in ranked.filter(F.col("r") <= k + 1).select("cell", "dist").collect():
        near.setdefault(r["cell"], []).append(r["dist"])
    asking = assigned if queries is None else write_stage(assigned.join(queries.select("id").distinct(), "id", "left_semi"), "queries")
    sizes = asking.groupBy("cell").agg(F.max("dist").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    radius, queries_in = np.zeros(len(centres)), np.zeros(len(centres), dtype=int)
    for r in sizes:
        radius[r["cell"]], queries_in[r["cell"]] = r["radius"], r["n"]
    reach = _cell_bounds(near, radius, np.sqrt(_squared(centres, centres)), k)
    reach[queries_in == 0] = -1.0

    def within(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(np.sqrt(_squared(_matrix(b["features"]), centres)) <= reach[None, :])

    def count_copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(centres), dtype="int64")
        for b in _slices(batches, len(centres), 1):
            total += np.bincount(within(b)[1], minlength=len(centres))
        yield pd.DataFrame({"cell": np.arange(len(centres), dtype="int32"), "n": total})

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _slices(batches, len(centres), width):
            row, cell = within(b)
            yield b.iloc[row].assign(cell=cell.astype("int32"))

    counted = points.select("features").mapInPandas(count_copies, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    candidates_in = {r["cell"]: r["n"] for r in counted.collect()}

    def blocks(of: dict[int, int]) -> Column:
        numbers = [max(1, math.ceil(of.get(i, 0) / block)) for i in range(len(centres))]
        return F.get(F.array(*[F.lit(x) for x in numbers]), F.col("cell"))

    query_blocks, candidate_blocks = blocks(dict(enumerate(queries_in.tolist()))), blocks(candidates_in)
    place = F.xxhash64("id")

    def every(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    left = asking.select("id", "features", "cell", F.pmod(place, query_blocks).cast("int").alias("qb"), every(candidate_blocks).alias("cb"))
    copies = points.select("id", "features").mapInPandas(copy, "id string, features array<double>, cell int")
    right = copies.select("id", "features", "cell", F.pmod(place, candidate_blocks).cast("int").alias("cb"), every(query_blocks).alias("qb"))
    keys = ["cell", "qb", "cb"]

    def compare(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        return _nearest(queries, candidates, k)

    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "id string, nid string, dist double")
    order = Window.partitionBy("id").orderBy("dist", "nid")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
