"""Forests of many labels, settings and folds, grown together over one table of binned features.

Features are binned once. Rows lie in blocks, each with the labels and folds of its rows. As long as a node
holds many rows, all trees grow level by level: every task goes over some blocks with some trees and counts rows
by (tree, node, feature, bin), and the counts, added up, decide the splits. A node with few rows is finished in
one task (as in PLANET, VLDB 2009); a table with few rows makes each whole tree such a node.

A row's bootstrap count and a node's choice of features are hashes of numbers, so a tree does not depend on the
partitioning, nor on where its nodes were split.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_stage, write_stage

MAX_BINS = 64
BLOCK_ROWS = 8_192
#: Tables of at most so many rows and bytes are sent to all tasks, which grow whole trees.
WHOLE_ROWS, LOCAL_BYTES = 2_000_000, 128 << 20
#: In larger tables, nodes with at most so many rows are finished in one task.
LOCAL_ROWS = 50_000
#: Counts that a task holds at a time, and blocks that it goes over with the same trees at least.
HELD_CELLS, IN_TURN = 4_000_000, 16
#: Trees, and bytes of trees, that a task scores together.
SCORED_TREES, SCORED_BYTES = 64, 64 << 20
#: Nodes with at most so many rows are split by sorting their values, larger ones by counting them by bin.
SORTED_ROWS = 64
TEST = -1
NO_ROW = -1
LEAF = -1

# Tasks get the functions of this module with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Forest:
    """One forest to grow: on the rows of a label, but for those of a fold, with its settings."""

    label: int
    n_estimators: int
    max_depth: int
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: str = "sqrt"
    class_weight: str | None = None
    without_fold: int | None = None
    seed: int = 42
    bootstrap: bool = True

    def features_tried(self, n: int) -> int:
        tried = {"sqrt": int(n**0.5), "log2": int(np.log2(n)) if n else 0, "all": n}[self.max_features]
        return max(1, min(n, tried))


# --- hashes ---------------------------------------------------------------------------------------------------------


def mix(*parts) -> np.ndarray:
    """64 well mixed bits of some whole numbers (the finaliser of SplitMix64, after each part)."""
    out = np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        for part in parts:
            out = out + np.asarray(part).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
            out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            out = out ^ (out >> np.uint64(31))
    return out


#: Upper ends of 0, 1, 2, .. in a Poisson distribution of mean 1.
_poisson = np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 16)]))


def bootstrap(seed: int, tree: int, rows: np.ndarray) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson of mean 1, by a hash of seed, tree and row."""
    unit = (mix(seed, tree, rows) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return np.searchsorted(_poisson, unit, side="right")


def drawn_features(seed: int, tree: int, nodes: np.ndarray, n_features: int, tried: int) -> np.ndarray:
    """(nodes, tried) features for each node, in ascending order."""
    if tried >= n_features:
        return np.broadcast_to(np.arange(n_features), (len(nodes), n_features))
    place = mix(seed + 1, tree, nodes[:, None], np.arange(n_features)[None, :])
    return np.sort(np.argpartition(place, tried - 1, axis=1)[:, :tried], axis=1)


# --- splits ---------------------------------------------------------------------------------------------------------


def counts_by_bin(bins: np.ndarray, node: np.ndarray, y: np.ndarray, drawn: np.ndarray, features: np.ndarray, n_bins: int) -> np.ndarray:
    """(nodes, features, bins, 3): rows, drawn rows of class 0 and of class 1. node numbers the rows of `features`."""
    n_nodes, tried = features.shape
    at = np.take_along_axis(bins, features[node], axis=1).astype(np.int64)
    cell = ((node[:, None] * tried + np.arange(tried)) * n_bins + at).ravel()
    size = n_nodes * tried * n_bins
    parts = [np.ones(len(node)), drawn * (y == 0), drawn * (y == 1)]
    sums = [np.bincount(cell, np.repeat(p, tried), size) for p in parts]
    return np.stack(sums, -1).reshape(n_nodes, tried, n_bins, 3).astype(np.int64)


def counts_in_turn(bins: np.ndarray, node: np.ndarray, y: np.ndarray, drawn: np.ndarray, features: np.ndarray, n_bins: int) -> np.ndarray:
    """counts_by_bin over a bounded number of rows at a time."""
    step = max(1, HELD_CELLS // features.shape[1])
    sums = counts_by_bin(bins[:step], node[:step], y[:step], drawn[:step], features, n_bins)
    for start in range(step, len(node), step):
        some = slice(start, start + step)
        sums += counts_by_bin(bins[some], node[some], y[some], drawn[some], features, n_bins)
    return sums


def _impurity(counts: np.ndarray, weights: tuple[float, float]) -> np.ndarray:
    """Gini impurity times weight; the last axis holds rows and the drawn rows of both classes."""
    a, b = weights[0] * counts[..., 1], weights[1] * counts[..., 2]
    return 2 * a * b / np.maximum(a + b, 1e-300)


def best_splits(counts: np.ndarray, features: np.ndarray, weights: tuple[float, float], least_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature or LEAF, last bin to the left, decrease of impurity) of each node; ties go to the first feature and bin."""
    left = counts.cumsum(axis=2)
    whole = left[:, :, -1:]
    right = whole - left
    gain = _impurity(whole, weights) - _impurity(left, weights) - _impurity(right, weights)
    gain = np.where((left[..., 0] >= least_rows) & (right[..., 0] >= least_rows), np.maximum(gain, 0.0), -1.0)
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    slot, last = np.divmod(best, counts.shape[2])
    gain = flat[np.arange(len(flat)), best]
    feature = np.where(gain >= 0, features[np.arange(len(flat)), slot], LEAF)
    return feature, last, gain


def best_splits_sorted(
    bins: np.ndarray, node: np.ndarray, y: np.ndarray, drawn: np.ndarray, features: np.ndarray, weights: tuple[float, float], least_rows: int, n_bins: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What best_splits finds from counts_by_bin, from sorted values: for many nodes of few rows each.

    Every node must have rows, and least_rows must be 1 or more: then the first best cut is behind a bin with rows.
    """
    n_nodes, tried = features.shape
    at = np.take_along_axis(bins, features[node], axis=1).astype(np.int64)
    cell = (node[:, None] * tried + np.arange(tried)) * n_bins + at
    most = int(drawn.max()) + 1
    # Classes and counts ride below the cell in the same number, so that one sort of numbers does.
    packed = np.sort(((cell * most + drawn[:, None]) * 2 + y[:, None]).ravel())
    cell, drawn, y = packed // (2 * most), packed // 2 % most, packed % 2
    n = np.bincount(node, minlength=n_nodes)
    sums = [np.concatenate([[0], np.cumsum(v)]) for v in (drawn * (y == 0), drawn * (y == 1))]
    # The values of a node's feature lie together, n[node] of them.
    size = np.repeat(n, tried)
    begin = np.cumsum(size) - size
    cut = np.flatnonzero(cell[1:] != cell[:-1]) + 1
    part, last = np.divmod(cell[cut - 1], n_bins)
    first, end = begin[part], begin[part] + size[part]
    fits = (cut - first >= least_rows) & (end - cut >= least_rows)
    cut, part, last, first, end = (v[fits] for v in (cut, part, last, first, end))

    def counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.stack([b - a, sums[0][b] - sums[0][a], sums[1][b] - sums[1][a]], -1)

    gain = _impurity(counts(first, end), weights) - _impurity(counts(first, cut), weights) - _impurity(counts(cut, end), weights)
    gain = np.maximum(gain, 0.0)
    owner, slot = np.divmod(part, tried)
    feature, behind, best = np.full(n_nodes, LEAF), np.zeros(n_nodes, np.int64), np.full(n_nodes, -1.0)
    if len(owner):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        best[owner[starts]] = np.maximum.reduceat(gain, starts)
        hits = np.flatnonzero(gain == best[owner])
        some, where = np.unique(owner[hits], return_index=True)
        feature[some], behind[some] = features[some, slot[hits[where]]], last[hits[where]]
    return feature, behind, best


@dataclass
class Tree:
    """Nodes in ascending order of their numbers; the children of node i are 2i and 2i + 1, the root is 1.

    n0 and n1 are the drawn rows of both classes; a leaf has the feature LEAF.
    """

    node: np.ndarray
    feature: np.ndarray
    last: np.ndarray
    n0: np.ndarray
    n1: np.ndarray
    gain: np.ndarray

    KINDS = {"node": "<i8", "feature": "<i4", "last": "<i4", "n0": "<i8", "n1": "<i8", "gain": "<f8"}

    @classmethod
    def of(cls, parts: Sequence[Tree]) -> Tree:
        """The nodes of all parts together."""
        whole = {n: np.concatenate([getattr(p, n) for p in parts] or [[]]).astype(k) for n, k in cls.KINDS.items()}
        order = np.argsort(whole["node"], kind="stable")
        return cls(**{n: v[order] for n, v in whole.items()})

    def dump(self) -> list[bytes]:
        return [getattr(self, n).astype(k).tobytes() for n, k in self.KINDS.items()]

    @classmethod
    def load(cls, row) -> Tree:
        return cls(**{n: np.frombuffer(getattr(row, n), k) for n, k in cls.KINDS.items()})

    @cached_property
    def children(self) -> np.ndarray:
        """(nodes, 2) places of the children of each node, NO_ROW where a child is not in this tree."""
        numbers = 2 * self.node[:, None] + np.arange(2)
        place = np.minimum(np.searchsorted(self.node, numbers), len(self.node) - 1)
        return np.where((self.node[place] == numbers) & (self.feature != LEAF)[:, None], place, NO_ROW)

    def end_of(self, bins: np.ndarray) -> np.ndarray:
        """The place in this tree of the last known node that each row comes to."""
        at = np.zeros(len(bins), np.int64)
        going = np.arange(len(bins))
        while len(going):
            here = at[going]
            # A leaf has no children, whatever value its feature number picks.
            child = self.children[here, (bins[going, self.feature[here]] > self.last[here]).astype(np.int8)]
            known = child != NO_ROW
            going = going[known]
            at[going] = child[known]
        return at

    def probability(self, weights: tuple[float, float]) -> np.ndarray:
        """Share of class 1 in each node."""
        a, b = weights[0] * self.n0, weights[1] * self.n1
        return b / np.maximum(a + b, 1e-300)


STORED = ", ".join(f"{n} binary" for n in Tree.KINDS)


def _depth(nodes: np.ndarray) -> np.ndarray:
    return np.frexp(nodes.astype(np.float64))[1] - 1


def is_open(forest: Forest, nodes: np.ndarray, rows: np.ndarray, n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Whether a node may be split at all."""
    return (_depth(nodes) < forest.max_depth) & (rows >= forest.min_samples_split) & (n0 > 0) & (n1 > 0)


def _portions(wanted: np.ndarray, few: np.ndarray, rows: np.ndarray, tried: int, n_bins: int) -> Iterator[tuple[np.ndarray, bool]]:
    """(nodes to split together, whether by sorting), so that a bounded number of values or counts is held at a time."""
    counted, step = np.flatnonzero(wanted & ~few), max(1, HELD_CELLS // (3 * tried * n_bins))
    for start in range(0, len(counted), step):
        yield counted[start : start + step], False
    sorted_ones = np.flatnonzero(wanted & few)
    turn = rows[sorted_ones].cumsum() * tried // HELD_CELLS
    for some in np.split(sorted_ones, np.flatnonzero(np.diff(turn)) + 1):
        if len(some):
            yield some, True


def grow_below(
    forest: Forest, tree: int, weights: tuple[float, float], bins: np.ndarray, y: np.ndarray, drawn: np.ndarray, n_bins: int, root: int = 1
) -> Tree:
    """The part of a tree from `root` on, level by level, on the rows that come there. All of them have been drawn."""
    parts, n_features = [], bins.shape[1]
    ids, node = np.array([root]), np.zeros(len(y), np.int64)
    while len(ids):
        rows = np.bincount(node, minlength=len(ids))
        n0, n1 = (np.bincount(node, drawn * (y == c), len(ids)).astype(np.int64) for c in (0, 1))
        feature, last, gain = np.full(len(ids), LEAF), np.zeros(len(ids), np.int64), np.zeros(len(ids))
        left = is_open(forest, ids, rows, n0, n1)
        # Where none of the drawn features parts the rows, all others are tried too.
        few = (rows <= SORTED_ROWS) & (forest.min_samples_leaf >= 1)
        for tried in (forest.features_tried(n_features), n_features):
            for some, by_sorting in _portions(left, few, rows, tried, n_bins):
                number = np.full(len(ids), NO_ROW)
                number[some] = np.arange(len(some))
                here = np.flatnonzero(number[node] >= 0)
                features = drawn_features(forest.seed, tree, ids[some], n_features, tried)
                of_rows = bins[here], number[node[here]], y[here], drawn[here]
                if by_sorting:
                    found = best_splits_sorted(*of_rows, features, weights, forest.min_samples_leaf, n_bins)
                else:
                    found = best_splits(counts_in_turn(*of_rows, features, n_bins), features, weights, forest.min_samples_leaf)
                feature[some], last[some], gain[some] = found
            left = left & (feature == LEAF)
        split = feature != LEAF
        parts.append(Tree(ids, feature, np.where(split, last, 0), n0, n1, np.where(split, gain, 0.0)))
        goes_on = split[node]
        bins, y, drawn, node = bins[goes_on], y[goes_on], drawn[goes_on], node[goes_on]
        side = bins[np.arange(len(node)), feature[node]] > last[node] if len(node) else np.zeros(0, bool)
        ids, node = np.unique(2 * ids[node] + side, return_inverse=True)
    return Tree.of(parts)


# --- blocks of rows -------------------------------------------------------------------------------------------------


@dataclass
class Binning:
    """For each feature the ascending bounds between its bins: a value goes to the bin of the first bound not below it."""

    bounds: list[np.ndarray]

    @property
    def n_bins(self) -> int:
        return 1 + max((len(b) for b in self.bounds), default=0)

    def bins(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(values.shape, np.uint8)
        for i, bounds in enumerate(self.bounds):
            out[:, i] = np.searchsorted(bounds, values[:, i], side="left")
        return out


def bin_features(df: DataFrame, features: str = "features", max_bins: int = MAX_BINS) -> Binning:
    """Bounds at the quantiles of each feature. Only max_bins numbers a feature reach the driver."""
    each = df.select(F.posexplode(vector_to_array(features)).alias("feature", "value"))
    shares = [i / max_bins for i in range(1, max_bins)]
    found = each.groupBy("feature").agg(F.percentile_approx("value", shares, 10_000).alias("cuts"), F.max("value").alias("most")).collect()
    bounds = [np.array(sorted({c for c in r["cuts"] if c < r["most"]})) for r in sorted(found, key=lambda r: r["feature"])]
    return Binning(bounds)


BLOCK = "block bigint, n int, rows binary, bins binary, labels binary, folds binary"


@dataclass
class Block:
    """Rows with their bins and, for each label, their class and fold (NO_ROW where a row is not of that label)."""

    rows: np.ndarray
    bins: np.ndarray
    labels: np.ndarray
    folds: np.ndarray

    @classmethod
    def load(cls, row) -> Block:
        def get(data: bytes, kind: type) -> np.ndarray:
            return np.frombuffer(data, kind).reshape(row.n, -1)

        return cls(get(row.rows, np.int64)[:, 0], get(row.bins, np.uint8), get(row.labels, np.int8), get(row.folds, np.int16))

    @classmethod
    def of(cls, blocks: Sequence[Block]) -> Block:
        return cls(*[np.concatenate([getattr(b, n) for b in blocks]) for n in ("rows", "bins", "labels", "folds")])

    def drawn(self, forest: Forest, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, counts) of the rows that a tree learns from."""
        fold = self.folds[:, forest.label]
        used = (self.labels[:, forest.label] >= 0) & (fold != TEST)
        if forest.without_fold is not None:
            used &= fold != forest.without_fold
        places = np.flatnonzero(used)
        counts = bootstrap(forest.seed, tree, self.rows[places]) if forest.bootstrap else np.ones(len(places), np.int64)
        return places[counts > 0], counts[counts > 0]

    def asked(self, forest: Forest) -> np.ndarray:
        """Places of the rows of its label that a forest did not learn from: the fold it left out, or the test rows."""
        fold = TEST if forest.without_fold is None else forest.without_fold
        return np.flatnonzero((self.labels[:, forest.label] >= 0) & (self.folds[:, forest.label] == fold))


def pack_rows(df: DataFrame, binning: Binning, n_labels: int, features: str = "features", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of about block_rows rows: a table that is written once.

    df: row_id, features, entries ARRAY<STRUCT<label: INT, y: INT, fold: INT>>: what a row is in each label
    that it belongs to, with the fold TEST for rows that no forest learns from. Row ids must be unique;
    whole numbers stay as they are, other ids become 64-bit hashes.
    """
    number = F.col("row_id") if dict(df.dtypes)["row_id"] == "bigint" else F.xxhash64(F.col("row_id").cast("string"))
    rows = df.select(number.alias("row"), vector_to_array(features).alias("x"), "entries")
    n_blocks = max(1, -(-df.count() // block_rows))
    width = len(binning.bounds)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row")
        values = np.stack(group["x"].to_numpy()).astype(float).reshape(len(group), width)
        labels, folds = np.full((len(group), n_labels), NO_ROW, np.int8), np.full((len(group), n_labels), TEST, np.int16)
        for at, entries in enumerate(group["entries"]):
            for e in entries:
                labels[at, e["label"]], folds[at, e["label"]] = e["y"], e["fold"]
        parts = {"rows": group["row"].to_numpy(np.int64), "bins": binning.bins(values), "labels": labels, "folds": folds}
        return pd.DataFrame({"block": group["block"].iloc[:1], "n": len(group), **{k: [v.tobytes()] for k, v in parts.items()}})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)))
    return write_stage(dealt.groupBy("block").applyInPandas(pack, BLOCK), "blocks")


# --- growing --------------------------------------------------------------------------------------------------------


def class_weights(forest: Forest, rows: tuple[int, int], drawn: tuple[int, int]) -> tuple[float, float]:
    """Weights of class 0 and 1: n / (2 x rows of the class), of all rows or, with balanced_subsample, of the drawn ones."""
    if forest.class_weight is None:
        return 1.0, 1.0
    n0, n1 = drawn if forest.class_weight == "balanced_subsample" else rows
    return tuple((n0 + n1) / (2 * n) if n else 1.0 for n in (n0, n1))


def _class_rows(blocks: DataFrame, forests: Sequence[Forest]) -> dict[tuple[int, int | None], tuple[int, int]]:
    """Rows of both classes for each label and left-out fold: a few numbers for each label."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in map(Block.load, batch.itertuples()):
                at, label = np.nonzero((block.labels >= 0) & (block.folds != TEST))
                found = pd.DataFrame({"label": label, "fold": block.folds[at, label], "y": block.labels[at, label]})
                yield found.groupby(["label", "fold", "y"]).size().reset_index(name="n")

    counted = blocks.mapInPandas(count, "label int, fold int, y int, n bigint").groupBy("label", "fold", "y").agg(F.sum("n").alias("n")).collect()
    return {
        (f.label, f.without_fold): tuple(
            sum(r["n"] for r in counted if r["label"] == f.label and r["y"] == y and (f.without_fold is None or r["fold"] != f.without_fold)) for y in (0, 1)
        )
        for f in forests
    }


def _task_trees(spark, forests: Sequence[Forest]) -> DataFrame:
    """(forest, tree): one row for each tree to grow, spread evenly over many tasks; those of a forest lie together."""
    ends = np.cumsum([f.n_estimators for f in forests]).tolist()
    tasks = max(1, min(ends[-1], 8 * spark.sparkContext.defaultParallelism))
    forest = F.size(F.filter(F.array(*map(F.lit, ends)), lambda end: end <= F.col("id")))
    numbered = spark.range(0, ends[-1], 1, tasks).withColumn("forest", forest)
    return numbered.select("forest", (F.col("id") - F.get(F.array(*map(F.lit, [0, *ends])), F.col("forest"))).cast("int").alias("tree"))


GROWN = f"forest int, tree int, w0 double, w1 double, {STORED}"
SCORED = "first int, trees int, y binary, total binary"


def _grow_in_tasks(blocks: DataFrame, forests: Sequence[Forest], rows_of: dict, n_bins: int, keep_trees: bool, score: bool) -> DataFrame:
    """Whole trees, each in one task, over a table that has been measured to be small.

    With keep_trees there is a row for each tree. With score there are rows with the tree NO_ROW: what the trees of a
    task, from `first` on, give in total to each row that their forest did not learn from, next to the classes of those.
    """
    spark = blocks.sparkSession
    packed = [tuple(r) for r in blocks.orderBy("block").collect()]
    sent = spark.sparkContext.broadcast(packed)  # at most LOCAL_BYTES
    names = blocks.columns
    columns = _names(f"{GROWN}, {SCORED}")
    no_tree, no_score = [0.0, 0.0, *[None] * len(Tree.KINDS)], [0, 0, None, None]

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = Block.of([Block.load(b) for b in pd.DataFrame(sent.value, columns=names).itertuples()])
        wanted = ((int(f), int(t)) for b in batches for f, t in zip(b["forest"], b["tree"], strict=True))
        number, first, n, asked, total = None, 0, 0, None, None

        def scored() -> pd.DataFrame:
            # Rows of the same number are one row, as in votes.
            rows, place, copies = np.unique(whole.rows[asked], return_inverse=True, return_counts=True)
            y = np.zeros(len(rows), np.int8)
            np.maximum.at(y, place, whole.labels[asked, forests[number].label])
            mean = np.bincount(place, total, len(rows)) / copies
            return pd.DataFrame([(number, NO_ROW, *no_tree, first, n, y.tobytes(), mean.tobytes())], columns=columns)

        for following, tree in wanted:
            forest = forests[following]
            if score and following != number:
                if number is not None:
                    yield scored()
                first, n, asked = tree, 0, whole.asked(forest)
                total = np.zeros(len(asked))
            number = following
            at, drawn = whole.drawn(forest, tree)
            y = whole.labels[at, forest.label]
            sums = int(drawn[y == 0].sum()), int(drawn[y == 1].sum())
            weights = class_weights(forest, rows_of[forest.label, forest.without_fold], sums)
            made = grow_below(forest, tree, weights, whole.bins[at], y, drawn, n_bins)
            if keep_trees:
                yield pd.DataFrame([(number, tree, *weights, *made.dump(), *no_score)], columns=columns)
            if score:
                total, n = total + made.probability(weights)[made.end_of(whole.bins[asked])], n + 1
        if score and number is not None:
            yield scored()

    return write_stage(_task_trees(spark, forests).mapInPandas(grow, f"{GROWN}, {SCORED}"), "trees")


def _confusion_of_totals(scored: DataFrame) -> dict[int, dict[str, int]]:
    """tp, fp, fn and tn of each forest from the totals that its trees gave in several tasks."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("first")
        total = sum(np.frombuffer(t, np.float64) for t in rows["total"])
        yes, hit = total / rows["trees"].sum() > 0.5, np.frombuffer(rows["y"].iloc[0], np.int8) == 1
        sums = [int(x.sum()) for x in (yes & hit, yes & ~hit, ~yes & hit, ~yes & ~hit)]
        return pd.DataFrame([(rows["forest"].iloc[0], *sums)], columns=["forest", "tp", "fp", "fn", "tn"])

    kinds = "forest int, tp bigint, fp bigint, fn bigint, tn bigint"
    counted = scored.select("forest", "first", "trees", "y", "total").groupBy("forest").applyInPandas(count, kinds)
    return {r["forest"]: {k: r[k] for k in ("tp", "fp", "fn", "tn")} for r in counted.collect()}


def _pairs(trees: DataFrame, blocks: DataFrame, n_blocks: int, group_trees: int) -> DataFrame:
    """Every group of trees beside every run of blocks: rows of trees first, then those of blocks, in the same partition.

    Trees are repeated for each run, so there are no more runs than keep all tasks busy, however many blocks there are.
    """
    size = sum(F.octet_length(c) for c in Tree.KINDS)
    n_trees, n_bytes = trees.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    n_groups = max(1, -(-n_trees // group_trees), -(-n_bytes // SCORED_BYTES))
    wanted = -(-4 * trees.sparkSession.sparkContext.defaultParallelism // n_groups)
    in_turn = max(IN_TURN, -(-n_blocks // wanted))
    runs = -(-n_blocks // in_turn)
    every_run = F.explode(F.sequence(F.lit(0), F.lit(runs - 1)))
    every_group = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))
    number = F.pmod(F.xxhash64("forest", "tree"), F.lit(n_groups)).cast("int")
    left = trees.select(number.alias("group"), every_run.alias("run"), F.lit(0).alias("kind"), "*")
    right = blocks.select(every_group.alias("group"), F.floor(F.col("block") / in_turn).cast("int").alias("run"), F.lit(1).alias("kind"), "*")
    both = left.unionByName(right, allowMissingColumns=True)
    return both.repartition(min(n_groups * runs, 10_000), "group", "run").sortWithinPartitions("group", "run", "kind", "block")


def _each_run(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, Iterator[Block]]]:
    """(rows of trees, their blocks) of each group and run; the blocks must be read before the next run."""
    rows = (r for b in batches for r in b.itertuples(index=False))
    row = next(rows, None)
    while row is not None:
        key, trees = (row.group, row.run), []
        while row is not None and (row.group, row.run) == key and row.kind == 0:
            trees.append(row)
            row = next(rows, None)

        def blocks() -> Iterator[Block]:
            nonlocal row
            while row is not None and (row.group, row.run) == key:
                yield Block.load(row._replace(n=int(row.n)))
                row = next(rows, None)

        made = blocks()
        yield trees, made
        for _ in made:
            pass


def _grow_by_level(blocks: DataFrame, n_blocks: int, forests: Sequence[Forest], rows_of: dict, n_bins: int, local_rows: int) -> DataFrame:
    """All trees level by level while nodes are large; what remains below small nodes is grown there in one go."""
    spark = blocks.sparkSession
    n_features = Block.load(blocks.limit(1).collect()[0]).bins.shape[1]
    known = f"forest int, tree int, w0 double, w1 double, {STORED}, open binary, wide binary, small binary"

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            one, none = np.array([1], "<i8").tobytes(), b""
            yield pd.DataFrame([(f, t, 0.0, 0.0, *[none] * len(Tree.KINDS), one, none, none) for f, t in zip(b["forest"], b["tree"], strict=True)],
                               columns=["forest", "tree", "w0", "w1", *Tree.KINDS, "open", "wide", "small"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, parts in _each_run(batches):
            wanted = []
            for r in rows:
                forest = forests[int(r.forest)]
                for ids, tried in ((r.open, forest.features_tried(n_features)), (r.wide, n_features)):
                    ids = np.frombuffer(ids, "<i8")
                    if len(ids):
                        features = drawn_features(forest.seed, int(r.tree), ids, n_features, tried)
                        wanted.append((r, forest, Tree.load(r), ids, features, np.zeros((*features.shape, n_bins, 3), np.int64)))
            for block in parts:
                for r, forest, tree, ids, features, sums in wanted:
                    at, drawn = block.drawn(forest, int(r.tree))
                    bins = block.bins[at]
                    node = _next_node(tree, bins)
                    place = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
                    here = ids[place] == node
                    sums += counts_by_bin(bins[here], place[here], block.labels[at[here], forest.label], drawn[here], features, n_bins)
            for r, _, _, ids, features, sums in wanted:
                yield pd.DataFrame({"forest": int(r.forest), "tree": int(r.tree), "node": ids, "tried": features.shape[1], "sums": [s.tobytes() for s in sums]})

    def decide(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        columns = ["forest", "tree", "w0", "w1", *Tree.KINDS, "open", "wide", "small"]
        if rows.empty:
            return pd.DataFrame(columns=columns)
        r = next(rows.itertuples(index=False))
        forest, before, parts = forests[r.forest], Tree.load(r), []
        weights = r.w0, r.w1
        still_wide, opened, small = [], [], [np.frombuffer(r.small, "<i8")]
        for tried, same in found.groupby("tried"):
            ids = np.unique(same["node"].to_numpy())
            sums = np.zeros((len(ids), tried, n_bins, 3), np.int64)
            for node, data in zip(np.searchsorted(ids, same["node"]), same["sums"], strict=True):
                sums[node] += np.frombuffer(data, np.int64).reshape(sums.shape[1:])
            n, n0, n1 = np.moveaxis(sums[:, 0].sum(axis=1), 1, 0)
            if ids[0] == 1 and not len(before.node):
                weights = class_weights(forest, rows_of[forest.label, forest.without_fold], (int(n0[0]), int(n1[0])))
                if n[0] <= local_rows:  # a small root: the whole tree is grown in one go
                    return pd.DataFrame([(r.forest, r.tree, *weights, *before.dump(), b"", b"", np.array([1], "<i8").tobytes())], columns=columns)
            features = drawn_features(forest.seed, r.tree, ids, n_features, tried)
            may = is_open(forest, ids, n, n0, n1)
            feature, last, gain = best_splits(sums, features, weights, forest.min_samples_leaf)
            feature = np.where(may, feature, LEAF)
            again = may & (feature == LEAF) & (tried < n_features)
            still_wide.append(ids[again])
            split = feature != LEAF
            last = np.where(split, last, 0)
            done = ~again
            parts.append(Tree(ids[done], feature[done], last[done], n0[done], n1[done], np.where(split, gain, 0.0)[done]))
            sizes = np.take_along_axis(sums[np.arange(len(ids)), _slot(features, feature), :, 0].cumsum(axis=1), last[:, None], axis=1)[:, 0]
            for side, size in ((0, sizes), (1, n - sizes)):
                opened.append(2 * ids[split & (size > local_rows)] + side)
                small.append(2 * ids[split & (size <= local_rows)] + side)
        lists = [np.sort(np.concatenate(x)).astype("<i8").tobytes() if x else b"" for x in (opened, still_wide, small)]
        return pd.DataFrame([(r.forest, r.tree, *weights, *Tree.of([before, *parts]).dump(), *lists)], columns=columns)

    def rows_below(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, parts in _each_run(batches):
            loaded = [(r, forests[int(r.forest)], Tree.load(r), np.frombuffer(r.small, "<i8")) for r in rows if len(r.small)]
            for block in parts:
                for r, forest, tree, ids in loaded:
                    at, drawn = block.drawn(forest, int(r.tree))
                    bins = block.bins[at]
                    node = _next_node(tree, bins)
                    here = np.isin(node, ids)
                    order = np.argsort(node[here], kind="stable")
                    at, drawn, bins, node = at[here][order], drawn[here][order], bins[here][order], node[here][order]
                    numbers, starts = np.unique(node, return_index=True)
                    y = block.labels[at, forest.label]
                    for number, some in zip(numbers, np.split(np.arange(len(node)), starts[1:]), strict=False):
                        data = bins[some].tobytes(), y[some].astype(np.int8).tobytes(), drawn[some].astype(np.int16).tobytes()
                        yield pd.DataFrame([(int(r.forest), int(r.tree), r.w0, r.w1, int(number), *data)], columns=["forest", "tree", "w0", "w1", "number", "bins", "y", "drawn"])

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        r = next(group.itertuples(index=False))
        y, drawn = (np.frombuffer(b"".join(group[c]), k) for c, k in (("y", np.int8), ("drawn", np.int16)))
        bins = np.frombuffer(b"".join(group["bins"]), np.uint8).reshape(len(y), n_features)
        made = grow_below(forests[r.forest], r.tree, (r.w0, r.w1), bins, y, drawn.astype(np.int64), n_bins, r.number)
        return pd.DataFrame([(r.forest, r.tree, r.w0, r.w1, *made.dump())], columns=["forest", "tree", "w0", "w1", *Tree.KINDS])

    def whole(parts: pd.DataFrame) -> pd.DataFrame:
        r = next(parts.itertuples(index=False))
        made = Tree.of([Tree.load(p) for p in parts.itertuples(index=False)])
        return pd.DataFrame([(r.forest, r.tree, r.w0, r.w1, *made.dump())], columns=["forest", "tree", "w0", "w1", *Tree.KINDS])

    trees = write_stage(_task_trees(spark, forests).mapInPandas(begin, known), "trees")
    most_tried = max(f.features_tried(n_features) for f in forests)
    while True:
        most = trees.select((F.octet_length("open") / 8 * most_tried + F.octet_length("wide") / 8 * n_features).alias("n")).agg(F.max("n")).first()[0]
        if not most:
            break
        group = max(1, int(HELD_CELLS // (3 * n_bins * most)))
        active = trees.filter(F.octet_length("open") + F.octet_length("wide") > 0)
        sums = _pairs(active, blocks, n_blocks, group).mapInPandas(count, "forest int, tree int, node bigint, tried int, sums binary")
        decided = active.groupBy("forest", "tree").cogroup(sums.groupBy("forest", "tree")).applyInPandas(decide, known)
        idle = trees.filter(F.octet_length("open") + F.octet_length("wide") == 0)
        following = write_stage(decided.unionByName(idle), "trees")
        drop_stage(trees)
        trees = following
    parts = "forest int, tree int, w0 double, w1 double, number bigint, bins binary, y binary, drawn binary"
    below = _pairs(trees, blocks, n_blocks, SCORED_TREES).mapInPandas(rows_below, parts)
    ends = below.groupBy("forest", "tree", "number").applyInPandas(finish, GROWN)
    return write_stage(trees.select(*_names(GROWN)).unionByName(ends).groupBy("forest", "tree").applyInPandas(whole, GROWN), "trees")


def _names(kinds: str) -> list[str]:
    return [c.split()[0] for c in kinds.split(", ")]


def _slot(features: np.ndarray, feature: np.ndarray) -> np.ndarray:
    """Where each node's feature stands among those it tried; 0 for leaves."""
    return np.argmax(features == feature[:, None], axis=1)


def _next_node(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The number of the node that each row comes to, which may not be in the tree yet; 0 behind a leaf."""
    if not len(tree.node):
        return np.ones(len(bins), np.int64)
    end = tree.end_of(bins)
    feature = tree.feature[end]
    side = bins[np.arange(len(bins)), np.maximum(feature, 0)] > tree.last[end]
    return np.where(feature == LEAF, 0, 2 * tree.node[end] + side)


def _is_whole(blocks: DataFrame, local_rows: int, local_bytes: int) -> tuple[bool, int]:
    """(whether blocks are few enough to be sent to all tasks, number of blocks)."""
    size = F.octet_length("bins") + F.octet_length("labels") + F.octet_length("folds") + F.octet_length("rows")
    n_rows, n_bytes, n_blocks = blocks.agg(F.sum("n"), F.sum(size), F.max("block") + 1).first()
    return n_rows <= local_rows and n_bytes <= local_bytes, n_blocks


def grow(blocks: DataFrame, forests: Sequence[Forest], binning: Binning, local_rows: int = WHOLE_ROWS, local_bytes: int = LOCAL_BYTES) -> DataFrame:
    """(forest, tree, w0, w1 and the arrays of a Tree) of all trees of all forests: a table.

    blocks comes from pack_rows. The forests share every scan of it. A table of at most local_rows rows and
    local_bytes bytes is sent to all tasks, which then grow whole trees; the trees are the same either way.
    """
    whole, n_blocks = _is_whole(blocks, local_rows, local_bytes)
    rows_of = _class_rows(blocks, forests)
    if whole:
        return _grow_in_tasks(blocks, forests, rows_of, binning.n_bins, True, False).select(*_names(GROWN))
    return _grow_by_level(blocks, n_blocks, forests, rows_of, binning.n_bins, min(local_rows, LOCAL_ROWS))


def grow_and_score(
    blocks: DataFrame, forests: Sequence[Forest], binning: Binning, keep_trees: bool = True, local_rows: int = WHOLE_ROWS, local_bytes: int = LOCAL_BYTES
) -> tuple[DataFrame | None, dict[int, dict[str, int]]]:
    """(the table of grow, or None unless keep_trees; the confusion of each forest).

    Where whole trees grow in a task they score their rows there, so trees that are only tried are never written.
    """
    whole, _ = _is_whole(blocks, local_rows, local_bytes)
    if whole:
        made = _grow_in_tasks(blocks, forests, _class_rows(blocks, forests), binning.n_bins, keep_trees, True)
        sums = _confusion_of_totals(made.filter(F.col("tree") == NO_ROW))
        trees = made.filter(F.col("tree") != NO_ROW).select(*_names(GROWN))
    else:
        trees = grow(blocks, forests, binning, local_rows, local_bytes)
        sums = confusion(trees, blocks, forests)
    if keep_trees:
        return trees, sums
    drop_stage(trees)
    return None, sums


# --- using forests --------------------------------------------------------------------------------------------------


def votes(trees: DataFrame, blocks: DataFrame, forests: Sequence[Forest] | None = None, n_blocks: int | None = None) -> DataFrame:
    """(forest, row, y, p): the mean share of class 1 over the trees of a forest, for every row it is asked about.

    With `forests`, those are the rows of its label that it did not learn from: the fold it left out, or the
    test rows. Without, all rows, and y is null.
    """
    n_blocks = n_blocks or blocks.agg(F.max("block") + 1).first()[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, parts in _each_run(batches):
            loaded = [(int(r.forest), Tree.load(r), (r.w0, r.w1)) for r in rows]
            loaded = [(f, t, t.probability(w)) for f, t, w in sorted(loaded, key=lambda x: x[0])]
            for block in parts:
                sums: dict[int, np.ndarray] = {}
                asked: dict[int, np.ndarray] = {}
                for number, tree, share in loaded:
                    if number not in asked:
                        if forests is None:
                            asked[number] = np.arange(len(block.rows))
                        else:
                            asked[number] = block.asked(forests[number])
                        sums[number] = np.zeros((2, len(asked[number])))
                    sums[number] += np.stack([share[tree.end_of(block.bins[asked[number]])], np.ones(len(asked[number]))])
                for number, (total, n) in sums.items():
                    at = asked[number]
                    y = block.labels[at, forests[number].label] if forests is not None else np.zeros(len(at), int)
                    yield pd.DataFrame({"forest": number, "row": block.rows[at], "y": y, "total": total, "n": n})

    each = _pairs(trees, blocks, n_blocks, SCORED_TREES).mapInPandas(run, "forest int, row bigint, y int, total double, n double")
    return each.groupBy("forest", "row").agg(F.max("y").alias("y"), (F.sum("total") / F.sum("n")).alias("p"))


def confusion(trees: DataFrame, blocks: DataFrame, forests: Sequence[Forest]) -> dict[int, dict[str, int]]:
    """tp, fp, fn and tn of each forest on the rows that it did not learn from: four numbers a forest."""
    found = votes(trees, blocks, forests).withColumn("yes", F.col("p") > 0.5)
    hit = F.col("y") == 1
    counted = found.groupBy("forest").agg(
        F.count_if(F.col("yes") & hit).alias("tp"), F.count_if(F.col("yes") & ~hit).alias("fp"),
        F.count_if(~F.col("yes") & hit).alias("fn"), F.count_if(~F.col("yes") & ~hit).alias("tn"),
    )
    return {r["forest"]: {k: r[k] for k in ("tp", "fp", "fn", "tn")} for r in counted.collect()}


def importance(trees: DataFrame) -> DataFrame:
    """(forest, feature, importance): the decrease of impurity by feature, as a share of each tree, averaged over the trees."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                tree = Tree.load(r)
                split = tree.feature != LEAF
                total = tree.gain.sum()
                if total > 0:
                    sums = np.bincount(tree.feature[split], tree.gain[split]) / total
                    some = np.flatnonzero(sums)
                    yield pd.DataFrame({"forest": r.forest, "tree": r.tree, "feature": some, "share": sums[some]})

    each = trees.mapInPandas(run, "forest int, tree int, feature int, share double")
    split_trees = each.groupBy("forest").agg(F.count_distinct("tree").alias("n"))
    return each.groupBy("forest", "feature").agg(F.sum("share").alias("s")).join(split_trees, "forest").select("forest", "feature", (F.col("s") / F.col("n")).alias("importance"))


def node_table(trees: DataFrame, binning: Binning) -> DataFrame:
    """One row for each node: forest, tree, w0, w1, node, feature (LEAF for leaves), threshold (rows up to it go
    left; null for leaves), n0, n1, gain."""
    bounds = binning.bounds

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                tree = Tree.load(r)
                cuts = [bounds[f][b] if f != LEAF else None for f, b in zip(tree.feature.tolist(), tree.last.tolist(), strict=True)]
                parts = {"node": tree.node, "feature": tree.feature, "threshold": cuts, "n0": tree.n0, "n1": tree.n1, "gain": tree.gain}
                yield pd.DataFrame({"forest": r.forest, "tree": r.tree, "w0": r.w0, "w1": r.w1, **parts})

    kinds = "node bigint, feature int, threshold double, n0 bigint, n1 bigint, gain double"
    return trees.mapInPandas(run, f"forest int, tree int, w0 double, w1 double, {kinds}")
