import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from wardlight.operators import trees as T

ENTRY = "row_id string, features {}, entries array<struct<label:int,y:int,fold:int>>"


def rows(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6)).round(2)
    x[:, 5] = 1.0  # a feature that parts nothing
    y = np.stack([x[:, 0] + x[:, 1] * x[:, 2] > 0.8, x[:, 3] > 0], 1).astype(int)
    out = []
    for i in range(n):
        entries = [(0, int(y[i, 0]), T.TEST if i % 5 == 0 else i % 2)]
        if i % 3:
            entries.append((1, int(y[i, 1]), i % 2))
        out.append((f"r{i}", Vectors.dense(x[i]), entries))
    return out


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame(rows(), ["row_id", "features", "entries"]).selectExpr(
        "row_id", "features", "transform(entries, e -> named_struct('label', int(e._1), 'y', int(e._2), 'fold', int(e._3))) AS entries"
    )
    binning = T.bin_features(df)
    return binning, T.pack_rows(df, binning, 2, block_rows=60)


def loaded(trees):
    return {(r.forest, r.tree): (r.w0, r.w1, T.Tree.load(r)) for r in trees.toPandas().itertuples()}


def same(a, b):
    return a.keys() == b.keys() and all(
        a[k][:2] == b[k][:2] and all(np.array_equal(getattr(a[k][2], n), getattr(b[k][2], n)) for n in T.Tree.KINDS) for k in a
    )


FORESTS = [
    T.Forest(0, 3, 6, 4, 2, "sqrt", "balanced", 1),
    T.Forest(0, 2, 30, 2, 1, "log2", "balanced_subsample", None, 7),
    T.Forest(1, 2, 4, 2, 3, "all", None, 0),
]


def test_trees_do_not_depend_on_where_they_grow(spark, table):
    binning, blocks = table
    whole = loaded(T.grow(blocks, FORESTS, binning))
    assert len(whole) == 7
    for local_rows in (1, 60):
        assert same(whole, loaded(T.grow(blocks, FORESTS, binning, local_rows=local_rows)))


def test_settings_change_the_trees(spark, table):
    binning, blocks = table

    def grown(**changed):
        base = dict(label=0, n_estimators=3, max_depth=12, class_weight="balanced")
        return loaded(T.grow(blocks, [T.Forest(**{**base, **changed})], binning))

    base = grown()
    assert same(base, grown())
    split = grown(min_samples_split=40)
    assert all(len(split[k][2].node) < len(base[k][2].node) for k in base)
    for k, (_, _, tree) in split.items():  # no split of fewer rows; drawn rows are at least as many as rows
        assert ((tree.n0 + tree.n1)[tree.feature != T.LEAF] >= 40).all()
    leaf = grown(min_samples_leaf=15)
    assert all(((t.n0 + t.n1)[t.feature == T.LEAF] >= 15).all() for _, _, t in leaf.values())
    assert all(T._depth(t.node).max() <= 2 for _, _, t in grown(max_depth=2).values())
    sub = grown(class_weight="balanced_subsample")
    assert not same(base, sub)
    for k, (w0, w1, tree) in sub.items():  # weights of the drawn rows: both classes weigh the same in every tree
        assert w0 * tree.n0[0] == pytest.approx(w1 * tree.n1[0])
    assert len({x[:2] for x in base.values()}) == 1 and len({x[:2] for x in sub.values()}) == 3


def test_every_tree_partitions_its_rows(spark, table):
    binning, blocks = table
    for _, _, tree in loaded(T.grow(blocks, FORESTS, binning)).values():
        leaves = tree.feature == T.LEAF
        assert tree.n0[leaves].sum() == tree.n0[0] and tree.n1[leaves].sum() == tree.n1[0]
        inner = set(tree.node[~leaves].tolist())
        assert set(tree.node.tolist()) == {1} | {2 * i + s for i in inner for s in (0, 1)}


def test_best_split_is_that_of_brute_force():
    rng = np.random.default_rng(3)
    bins, y, drawn = rng.integers(0, 5, (60, 3)).astype(np.uint8), rng.integers(0, 2, 60), rng.integers(1, 4, 60)
    weights, least = (0.7, 1.9), 4

    def gini(some):
        a, b = weights[0] * drawn[some & (y == 0)].sum(), weights[1] * drawn[some & (y == 1)].sum()
        return (a + b) * (1 - (a / (a + b)) ** 2 - (b / (a + b)) ** 2)

    best = {}
    for f in range(3):
        for cut in range(4):
            left = bins[:, f] <= cut
            if min(left.sum(), (~left).sum()) >= least:
                best[f, cut] = gini(left | True) - gini(left) - gini(~left)
    counts = T.counts_by_bin(bins, np.zeros(60, np.int64), y, drawn, np.arange(3)[None], 5)
    feature, last, gain = T.best_splits(counts, np.arange(3)[None], weights, least)
    assert gain[0] == pytest.approx(max(best.values())) and best[feature[0], last[0]] == pytest.approx(gain[0])


def test_votes_are_those_of_the_trees(spark, table):
    binning, blocks = table
    trees = T.grow(blocks, FORESTS, binning)
    whole = T.Block.of([T.Block.load(r) for r in blocks.toPandas().itertuples()])
    got = {(r.forest, r.row): (r.y, r.p) for r in T.votes(trees, blocks, FORESTS).collect()}
    want, grown = {}, loaded(trees)
    for i, forest in enumerate(FORESTS):
        fold = T.TEST if forest.without_fold is None else forest.without_fold
        asked = (whole.labels[:, forest.label] >= 0) & (whole.folds[:, forest.label] == fold)
        p = np.mean([t.probability((w0, w1))[t.end_of(whole.bins)] for (f, _), (w0, w1, t) in grown.items() if f == i], axis=0)
        want |= {(i, int(r)): (int(y), pytest.approx(q)) for r, y, q in zip(whole.rows[asked], whole.labels[asked, forest.label], p[asked])}
    assert got == want
    sums = T.confusion(trees, blocks, FORESTS)
    assert sum(sums[0].values()) == sum(1 for f, _ in want if f == 0)
    shares = T.importance(trees).groupBy("forest").sum("importance").collect()
    assert all(r[1] == pytest.approx(1) for r in shares) and len(shares) == 3


def test_bootstrap_counts_are_poisson():
    counts = T.bootstrap(3, 1, np.arange(200_000))
    assert counts.mean() == pytest.approx(1, abs=0.01) and counts.var() == pytest.approx(1, abs=0.02)
    assert (counts == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)
    features = T.drawn_features(1, 2, np.arange(1, 5000), 10, 3)
    assert features.shape == (4999, 3) and (np.diff(features, axis=1) > 0).all()
    assert np.bincount(features.ravel()) == pytest.approx(1500, rel=0.1)


def test_sorting_finds_the_splits_that_counting_finds():
    rng = np.random.default_rng(5)
    n, nodes = 900, 60
    bins, y, drawn = rng.integers(0, 9, (n, 12)).astype(np.uint8), rng.integers(0, 2, n).astype(np.int8), rng.integers(1, 5, n)
    bins[:, :4] = 3  # nothing to part
    node = np.concatenate([np.arange(nodes), rng.integers(0, nodes, n - nodes)])
    features = T.drawn_features(1, 2, np.arange(1, nodes + 1), 12, 3)
    for weights, least in (((1.0, 1.0), 1), ((0.6, 1.9), 4)):
        counted = T.best_splits(T.counts_in_turn(bins, node, y, drawn, features, 16), features, weights, least)
        found = T.best_splits_sorted(bins, node, y, drawn, features, weights, least, 16)
        split = counted[0] != T.LEAF
        assert split.any() and not split.all()
        assert np.array_equal(found[0], counted[0])
        assert all(np.array_equal(a[split], b[split]) for a, b in zip(found[1:], counted[1:]))


def test_trees_that_are_only_tried_are_scored_where_they_grow(spark, table, monkeypatch):
    binning, blocks = table
    kept, sums = T.grow_and_score(blocks, FORESTS, binning)
    assert same(loaded(kept), loaded(T.grow(blocks, FORESTS, binning))) and sums == T.confusion(kept, blocks, FORESTS)
    assert T.grow_and_score(blocks, FORESTS, binning, keep_trees=False, local_rows=60) == (None, sums)
    written = []
    stage = T.write_stage
    monkeypatch.setattr(T, "write_stage", lambda df, name: written.append(stage(df, name)) or written[-1])
    monkeypatch.setattr(T, "drop_stage", lambda df: None)
    assert T.grow_and_score(blocks, FORESTS, binning, keep_trees=False) == (None, sums)
    assert len(written) == 1 and written[0].filter(f"tree <> {T.NO_ROW}").isEmpty()


def test_rows_that_come_twice_are_scored_once(spark, table):
    df = spark.createDataFrame(rows() + rows()[:90], ["row_id", "features", "entries"]).selectExpr(
        "row_id", "features", "transform(entries, e -> named_struct('label', int(e._1), 'y', int(e._2), 'fold', int(e._3))) AS entries"
    )
    blocks = T.pack_rows(df, table[0], 2, block_rows=60)
    trees, sums = T.grow_and_score(blocks, FORESTS, table[0])
    assert sums == T.confusion(trees, blocks, FORESTS) and sum(sums[1].values()) == 80


def test_trees_are_not_repeated_for_every_few_blocks(spark, table):
    """A larger table makes runs of blocks longer, not more of them than tasks."""
    binning, blocks = table
    trees = T.grow(blocks, FORESTS, binning)
    tasks = 4 * spark.sparkContext.defaultParallelism
    many = spark.range(40 * tasks).selectExpr("id AS block", "1 AS n", *[f"cast(null AS binary) AS {c}" for c in ("rows", "bins", "labels", "folds")])
    pairs = T._pairs(trees, many, 40 * tasks, 64)
    assert pairs.filter("kind = 0").count() <= tasks * len(loaded(trees)) and pairs.filter("kind = 1").count() == 40 * tasks
