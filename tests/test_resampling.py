from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wardlight.operators import neighbours
from wardlight.operators.neighbours import nearest_neighbours
from wardlight.operators.resampling import determine_resampling_strategy, non_adaptive_strategy, resample, smote


def labelled(spark, n, positives, width=10, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, width))
    rows = [(f"r{i}", [float(v) for v in x[i]], float(i < positives)) for i in range(n)]
    return spark.createDataFrame(rows, "row_id string, f array<double>, label double").select(
        "row_id", array_to_vector("f").alias("features"), "label"
    )


def test_strategy_rules():
    assert [determine_resampling_strategy(r) for r in (0.049, 0.05, 0.149, 0.15)] == [
        "smote_under", "undersampling", "undersampling", "class_weight",
    ]
    assert [non_adaptive_strategy(r) for r in (0.049, 0.05)] == ["smote_under", "class_weight"]


@pytest.mark.parametrize(
    "positives, strategy, want",
    [(220, "class_weight", (220, 780)), (80, "undersampling", (80, 160)), (30, "smote_under", (194, 646))],
)
def test_resampled_sizes(spark, positives, strategy, want):
    got, stats = resample(labelled(spark, 1000, positives), minority_ratio=positives / 1000)
    counts = Counter(r["label"] for r in got.collect())
    assert stats.strategy == strategy and stats.error is None
    assert (counts[1.0], counts[0.0]) == want == (stats.resampled_positive, stats.resampled_negative)
    row = stats.to_df(spark).first()
    assert row["original_total"] == 1000 and row["change_percent"] == pytest.approx((sum(want) - 1000) / 10)


@pytest.mark.parametrize(
    "positives, strategy", [(5, "smote_under"), (400, "undersampling"), (400, "smote_under"), (10, "unknown"), (0, "undersampling")]
)
def test_inapplicable_strategies_return_the_input(spark, positives, strategy):
    got, stats = resample(labelled(spark, 1000, positives), strategy=strategy)
    assert got.count() == 1000 and stats.error and stats.resampled_total == 1000


def test_auto_takes_the_share_of_positives(spark):
    assert resample(labelled(spark, 20, 3))[1].strategy == "class_weight"
    assert resample(labelled(spark, 1000, 80))[1].strategy == "undersampling"


@pytest.mark.parametrize("options", [{}, {"block_rows": 40, "pivots": 12}])
def test_neighbours_are_exact(spark, options):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(0, 1, (150, 4)), rng.normal(6, 0.1, (150, 4)), rng.normal(-9, 3, (60, 4))])
    df = spark.createDataFrame([(f"p{i:03d}", [float(v) for v in r]) for i, r in enumerate(x)], "id string, features array<double>")
    got = {}
    for r in nearest_neighbours(df, 5, **options).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["nid"])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    assert got == {f"p{i:03d}": [f"p{j:03d}" for j in np.argsort(d[i])[:5]] for i in range(len(x))}


def test_copies_for_cells_are_dealt_in_bounded_slices(spark, monkeypatch):
    """A task holds a bounded number of values while it copies points to cells, however many cells there are."""
    batch = pd.DataFrame({"id": [str(i) for i in range(1000)], "features": [[0.0] * 8] * 1000})
    parts = list(neighbours._slices(iter([batch, batch[:0], batch[:7]]), 2_000, 8))
    assert max(map(len, parts)) * 2_000 * 8 <= neighbours.HELD_VALUES and sum(map(len, parts)) == 1007
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(f"p{i:03d}", [float(v) for v in r]) for i, r in enumerate(rng.normal(0, 1, (200, 3)))], "id string, features array<double>")
    want = {tuple(r) for r in nearest_neighbours(df, 4, pivots=9).collect()}
    monkeypatch.setattr(neighbours, "HELD_VALUES", 100)
    assert {tuple(r) for r in nearest_neighbours(df, 4, pivots=9).collect()} == want


@pytest.mark.parametrize("options", [{}, {"block_rows": 20, "pivots": 9}])
def test_only_asking_points_get_neighbours(spark, options):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(0, 1, (120, 3)), rng.normal(50, 1, (120, 3))])
    df = spark.createDataFrame([(f"p{i:03d}", [float(v) for v in r]) for i, r in enumerate(x)], "id string, features array<double>")
    some = df.filter("id in ('p003', 'p077', 'p200')")
    want = {tuple(r) for r in nearest_neighbours(df, 4, **options).filter("id in ('p003', 'p077', 'p200')").select("id", "nid", "rank").collect()}
    got = [tuple(r) for r in nearest_neighbours(df, 4, queries=some, **options).select("id", "nid", "rank").collect()]
    assert len(got) == 12 and set(got) == want
    assert nearest_neighbours(df, 4, queries=some.limit(0), **options).count() == 0


def test_smote_searches_for_drawn_vectors_only(spark, monkeypatch):
    from wardlight.operators import resampling

    asked = []

    def watched(points, k, queries=None, **search):
        asked.append(queries.count())
        return nearest_neighbours(points, k, queries=queries, **search)

    monkeypatch.setattr(resampling, "nearest_neighbours", watched)
    made = smote(labelled(spark, 300, 300).select("row_id", "features"), 20).collect()
    assert len(made) == 20 and asked == [len({r["row_id"].split(":")[1] for r in made})]


def test_fewer_points_than_neighbours(spark):
    df = spark.createDataFrame([("a", [0.0]), ("b", [1.0])], "id string, features array<double>")
    assert nearest_neighbours(df, 5).count() == 2


def test_smote_rows_lie_between_neighbours(spark, monkeypatch):
    from wardlight.operators import resampling

    monkeypatch.setattr(resampling, "DRAWS_PER_TASK_ROW", 16)
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(0, 1, (30, 3)), np.zeros((15, 3)), np.ones((3, 3))])
    names = [f"r{i:02d}" for i in range(len(x))]
    rare = spark.createDataFrame([(n, [float(v) for v in r]) for n, r in zip(names, x)], "row_id string, f array<double>")
    rare = rare.select("row_id", array_to_vector("f").alias("features"))
    made = smote(rare, 400).collect()
    assert len(made) == len({r["row_id"] for r in made}) == 400
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)

    def between(v, a, b):
        t = 0.0 if (a == b).all() else ((v - a) @ (b - a)) / ((b - a) @ (b - a))
        return -1e-9 <= t <= 1 + 1e-9 and np.allclose(a + t * (b - a), v)

    bases = Counter()
    for r in made:
        i = names.index(r["row_id"].split(":")[1])
        bases[i] += 1
        near = np.flatnonzero(d[i] <= np.sort(d[i])[4] + 1e-12)
        assert any(between(np.array(r["features"]), x[i], x[j]) for j in near)
    assert 70 < bases[30] < 180  # 15 of 48 rows share this vector
    again = {(r["row_id"], tuple(r["features"])) for r in smote(rare.repartition(5), 400).collect()}
    assert again == {(r["row_id"], tuple(r["features"])) for r in made}


def test_smote_counts(spark):
    rare = labelled(spark, 40, 40)
    assert smote(rare, 0).count() == 0
    assert smote(rare, 33).agg(F.count_distinct("row_id")).first()[0] == 33
