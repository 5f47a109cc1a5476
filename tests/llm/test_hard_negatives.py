"""Hard negatives against brute force, and the bounds of the segment summaries."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from wardlight.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, block int"


def scored(rows, step):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], c) for i, v, c, *_ in rows
            if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, c in good:
        if i % step:
            continue
        met = [(sum(a * b for a, b in zip(v, w)), j, d) for j, w, d in good if j != i]
        met.sort(key=lambda m: (-m[0], m[1]))
        for ps, p, _ in [m for m in met if m[2] == c][:5]:
            fits = [m for m in met if m[2] != c and 80 * ps <= 100 * m[0] <= 100 * ps][:5]
            out += [(i, p, rank, n, ps, ns) for rank, (ns, n, _) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, step):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % step == 0).collect())


def made(n, width, labels, seed, grid=4):
    rnd = random.Random(seed)
    return [(i, [rnd.randint(-grid, 2 * grid) / grid for _ in range(width)], rnd.choice(labels), "x", 0) for i in range(n)]


def test_ties_odd_rows_and_one_label_that_most_rows_share(spark):
    rows = made(120, 5, [0, 0, 0, 0, 1, 2], 1, 2)
    rows += [(None, [1.0] * 5, 0, "", 0), (200, None, 0, "", 0), (205, [1.0, None], 0, "", 0), (210, [math.nan] * 5, 1, "", 0)]
    rows += [(215, [math.inf] * 5, 1, "", 0), (220, [1.0] * 5, None, "", 0), (225, [], 1, "", 0), (230, [0.5, 1.0], 2, "", 0), (235, [1.0] * 9, 1, "", 0)]
    rows += [(240 + i, [0.5, -0.25, 1.0], i % 2, "", 0) for i in range(12)]  # equal rows
    assert mined(spark, rows, 5) == scored(rows, 5)
    assert mined(spark, [], 5) == [] and mined(spark, rows[:1], 1) == []


def test_many_shards_and_blocks_give_the_same(spark, monkeypatch):
    rows = made(700, 33, list(range(4)), 2, 64)
    monkeypatch.setattr(H, "SHARD", 50)
    monkeypatch.setattr(H, "LEAST_SHARD", 50)
    monkeypatch.setattr(H, "ANCHORS", 20)
    assert mined(spark, rows, 7) == scored(rows, 7)


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(5)
    centre = rng.normal(0, 200, (6, 64))
    data = np.floor(centre[rng.integers(0, 6, 400)] + rng.normal(0, 10, (400, 64))).astype(np.int64)
    fine = H.summaries(data)
    exact, before = data @ data.T, None
    for times in H.LEVELS:
        mean, dev = H.coarser(fine, times)
        size = 64 // mean.shape[1]
        middle, spread = size * mean @ mean.T, size * dev @ dev.T
        assert (np.abs(exact - middle) <= spread * (1 + 1e-5) + 50).all()
        assert before is None or spread.sum() <= before  # finer segments are tighter
        before = spread.sum()


def test_rare_passing_pairs_are_scored_one_by_one():
    rng = np.random.default_rng(6)
    data = rng.integers(-100, 100, (300, 32))
    row = type("R", (), {})()
    row.row = row.id = np.arange(300, dtype=np.int64).tobytes()
    row.label, row.kind, row.data, row.fine = np.zeros(300, np.int64).tobytes(), "<i8", data.astype(np.int64).tobytes(), H.summaries(data).tobytes()
    block = H.Block(row)
    exact = data @ data.T
    low = np.sort(exact, axis=1)[:, -3][:, None]
    high = np.full((300, 1), 1 << 60)
    at, other, score = H.scores_near(block, block, low, high, np.ones((300, 300), bool))
    assert (exact[at, other] == score).all()
    found = set(zip(at.tolist(), other.tolist()))
    assert {(i, int(j)) for i, j in zip(*np.nonzero(exact >= low))} <= found and len(found) < 300 * 300 * 0.9
