import random

import numpy as np
import pytest

from wardlight.operators import clusters
from wardlight.operators.clusters import dbscan
from wardlight.operators.components import connected_components


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, a):
        self.parent.setdefault(a, a)
        while self.parent[a] != a:
            a = self.parent[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def brute_force(rows, limit, min_samples):
    at = {i: (round(lon * 1e4), round(lat * 1e4)) for i, lat, lon in rows}
    near = {i: [j for j in at if (at[i][0] - at[j][0]) ** 2 + (at[i][1] - at[j][1]) ** 2 <= limit] for i in at}
    core = {i for i in at if len(near[i]) >= min_samples}
    sets = Union()
    for i in core:
        for j in near[i]:
            if j in core:
                sets.join(i, j)
    raw = {i: sets.find(i) if i in core else min((sets.find(j) for j in near[i] if j in core), default=-1) for i in at}
    number = {r: k for k, r in enumerate(sorted({sets.find(i) for i in core}))}
    return {i: number.get(r, -1) for i, r in raw.items()}


@pytest.mark.parametrize(
    "min_samples, salting", [(1, {}), (4, {}), (6, {"share": 0.01, "min_rows": 1, "salts": 4})]
)
def test_matches_brute_force(spark, min_samples, salting):
    rng = random.Random(min_samples)
    rows = [(i, 13.5 + rng.randint(0, 900) / 1e4, 100.4 + rng.randint(0, 120) / 1e4) for i in range(900)]
    rows += [(900 + i, 13.51, 100.401) for i in range(300)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id long, latitude double, longitude double")
    got = {r["id"]: r["cluster"] for r in dbscan(df, "id", min_samples=min_samples, **salting).collect()}
    assert got == brute_force(rows, 64, min_samples)


def chains():
    rows = [(i, 13.7, round(100.5 + 0.0007 * i, 4)) for i in range(5)]
    rows += [(10 + i, 13.8, round(100.5 + 0.0007 * i, 4)) for i in range(5)]
    return [*rows, (20, 14.0, 101.0), (30, 13.7, round(100.5 + 0.0014, 4))]


def test_chains_and_isolated_point(spark):
    df = spark.createDataFrame(chains(), "id long, latitude double, longitude double")
    one = {r["id"]: r["cluster"] for r in dbscan(df, "id").collect()}
    assert [one[i] for i in (0, 4, 30, 10, 14, 20)] == [0, 0, 0, 1, 1, 2]
    three = {r["id"]: r["cluster"] for r in dbscan(df, "id", min_samples=3).collect()}
    assert three[20] == -1 and {three[i] for i in range(5)} == {0} and {three[10 + i] for i in range(5)} == {1}


def test_rows_without_coordinates_are_noise(spark):
    df = spark.createDataFrame([(1, None, 100.0), (2, 13.0, 100.0)], "id long, latitude double, longitude double")
    assert {r["id"]: r["cluster"] for r in dbscan(df, "id").collect()} == {1: -1, 2: 0}


def test_many_rows_without_coordinates_share_no_task(spark):
    rows = [(i, None, None) for i in range(3000)] + [(5000 + i, 13.0, 100.0 + i) for i in range(4)]
    out = dbscan(spark.createDataFrame(rows, "id long, latitude double, longitude double").repartition(6), "id", min_rows=100)
    assert out.filter("cluster = -1").count() == 3000 and out.filter("cluster >= 0").count() == 4
    sizes = [n for n in out.rdd.glom().map(len).collect() if n]
    assert max(sizes) < 1500


@pytest.mark.parametrize("min_samples", [1, 12])
def test_wide_eps(spark, min_samples):
    """Cells of 141 lattice steps, some of them with many points, searched by quadtrees."""
    rng = random.Random(min_samples)
    rows = [(i, -0.05 + rng.randint(0, 1500) / 1e4, 100.4 + rng.randint(0, 12000) / 1e4) for i in range(350)]
    rows += [(400 + i, 0.05 + rng.gauss(0, 0.004), 100.9 + rng.gauss(0, 0.004)) for i in range(250)]
    rows = [(i, round(a, 4), round(b, 4)) for i, a, b in rows] + [(900, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, latitude double, longitude double")
    got = {r["id"]: r["cluster"] for r in dbscan(df, "id", eps=0.02, min_samples=min_samples).collect()}
    assert got.pop(900) == -1 and got == brute_force(rows[:-1], 200**2, min_samples)


def test_quadtrees_give_what_lists_give(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, 13.5 + rng.randint(0, 300) / 1e4, 100.4 + rng.randint(0, 100) / 1e4) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, latitude double, longitude double")
    want = {r["id"]: r["cluster"] for r in dbscan(df, "id", eps=0.002, min_samples=5).collect()}
    monkeypatch.setattr(clusters, "MAX_CELL_SIDE", 1)
    assert {r["id"]: r["cluster"] for r in dbscan(df, "id", eps=0.002, min_samples=5).collect()} == want
    assert {r["cluster"] for r in dbscan(df, "id", eps=5.0).collect()} == {0}
    assert dbscan(df.limit(0), "id", eps=5.0).count() == 0


@pytest.mark.parametrize("salting", [{}, {"share": 0.01, "min_rows": 1, "salts": 4}])
def test_components(spark, salting):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 150, (110, 2))]
    edges += [(500, i) for i in range(501, 560)] + [(i, i + 1) for i in range(700, 730)]
    sets = Union()
    for a, b in edges:
        sets.join(a, b)
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["root"] for r in connected_components(df, **salting).collect()}
    want = {n: sets.find(n) for e in edges if e[0] != e[1] for n in e}
    assert got == want
