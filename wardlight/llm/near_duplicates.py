"""Near-duplicate texts: SuperMinHash signatures, bands, checks on full sets, and union-find groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..operators.skew import fits_broadcast
from ..session import write_stage
from . import shingles
from .common import pick, ship

PLACES = 120
#: Of pairs that are just similar enough, so many may share no band.
LOST = 1e-5
#: Members of a bucket that one task compares with each other at once, and rounds of hubs before that.
BLOCK, AGAINST, HUB_ROUNDS = 512, 4096, 2
#: Sets of at most so many elements are compared whole, larger ones by a sample of half as many or more.
SAMPLED = 512


def rows_per_band(percent: int, places: int = PLACES, lost: float = LOST) -> int:
    """The longest bands by which a pair of that similarity still meets but for a share `lost`."""
    s = percent / 100
    fitting = [r for r in range(1, 17) if (1 - s**r) ** (places // r) <= lost]
    return max(fitting, default=1)


def signatures(rows: DataFrame, words: int, places: int, band_rows: int) -> DataFrame:
    """(id, n, f1, f2, bands) of rows (id, text): set size, fingerprint of the set, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in shingles.slices(batch.column("text")):
                sets = shingles.shingle_sets(texts, words)
                marks = shingles.super_min_hash(sets, places)
                keys = shingles.band_keys(marks, band_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, len(texts)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        *_fingerprints(sets),
                        pa.array(list(keys), pa.list_(pa.int64())),
                    ],
                    ["id", "n", "f1", "f2", "bands"],
                )

    return rows.mapInArrow(run, "id bigint, n bigint, f1 bigint, f2 bigint, bands array<bigint>")


def _fingerprints(sets: list[np.ndarray]) -> list[pa.Array]:
    """Two 64-bit sums over each set's elements, mixed in two ways: equal sets have equal ones."""
    sums = [[(shingles.mix(s ^ salt)).sum(dtype=np.uint64) for s in sets] for salt in (np.uint64(1), np.uint64(1 << 40))]
    return [pa.array(np.array(x, np.uint64).astype(np.int64), pa.int64()) for x in sums]


def full_sets(rows: DataFrame, words: int) -> DataFrame:
    """(id, f1, f2, set, sample) of rows (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in shingles.slices(batch.column("text")):
                sets = shingles.shingle_sets(texts, words)
                lists = pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))
                ids = batch.column("id").slice(first, len(texts))
                samples = pa.array([sample(s).tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, *_fingerprints(sets), lists, samples], ["id", "f1", "f2", "set", "sample"])

    return rows.mapInArrow(run, "id bigint, f1 bigint, f2 bigint, set array<bigint>, sample binary")


def sample_depth(sizes: np.ndarray) -> np.ndarray:
    """How often a set is halved for its sample."""
    return np.ceil(np.log2(np.maximum(sizes, 1) / SAMPLED)).clip(0).astype(np.int64)


def sample(elements: np.ndarray) -> np.ndarray:
    """The upper halves of the elements whose first bits, as many as the set's depth, are 0."""
    high = (elements >> np.uint64(32)).astype(np.uint32)
    return high[high < 1 << (32 - int(sample_depth(np.array([len(elements)]))[0]))] if len(elements) > SAMPLED else high


def close_pairs(ids, roots, sizes, samples, asking, percent: int) -> np.ndarray:
    """Pairs (smaller id, larger id) of an asking row and another one of other root that may be similar.

    Shared elements are counted over an inverted index of the rows that do not ask, so the work follows
    the shared elements and not the pairs. Sets held whole are judged to two hundredths, samples to six
    standard deviations. Of pairs far above the bound only those that join two groups are returned.
    """
    asks, others = np.flatnonzero(asking), np.flatnonzero(~asking)
    values = [np.frombuffer(samples[i], np.uint32) for i in others]
    owner = np.repeat(np.arange(len(others)), [len(v) for v in values])
    values = np.concatenate(values) if values else np.empty(0, np.uint32)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    depth = sample_depth(sizes)
    bound = (np.int64(1) << (32 - depth)) >> 1
    whole = np.array([len(x) // 4 for x in samples])
    half = np.array([np.count_nonzero(np.frombuffer(x, np.uint32) < b) for x, b in zip(samples, bound, strict=True)])
    least, found = percent / 100, []
    above = {int(r): int(r) for r in roots}

    def top(x: int) -> int:
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    for at in asks:
        mine = np.frombuffer(samples[at], np.uint32)
        low, high = np.searchsorted(values, mine, "left"), np.searchsorted(values, mine, "right")
        runs = high - low
        shared = np.bincount(owner[np.repeat(low - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())], minlength=len(others))
        near = np.flatnonzero((roots[others] != roots[at]) & (shared > 0))
        near = near[np.minimum(sizes[others[near]], sizes[at]) * 100 >= np.maximum(sizes[others[near]], sizes[at]) * percent]
        them = others[near]
        a = np.where(depth[them] > depth[at], half[at], whole[at])
        b = np.where(depth[them] < depth[at], half[them], whole[them])
        union = np.maximum(a + b - shared[near], 1)
        share = shared[near] / union
        exact = (depth[them] == 0) & (depth[at] == 0)
        slack = np.where(exact, 0.02, 6 * np.sqrt(least * (1 - least) / union))
        fits = share >= least - slack
        for other, sure in zip(them[fits].tolist(), (exact & (share >= least + 0.02))[fits].tolist(), strict=True):
            if sure:
                one, two = top(int(roots[at])), top(int(roots[other]))
                if one == two:
                    continue
                above[max(one, two)] = min(one, two)
            found.append((min(ids[at], ids[other]), max(ids[at], ids[other])))
    return np.array(found, np.int64).reshape(-1, 2)


def _similar_sizes(a: str, b: str, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def hub_pairs(members: DataFrame, percent: int, turn: int) -> DataFrame:
    """(a, b): in every bucket, one member against all that are not in its component.

    members: key, id, n, copies, root. In the first turn the hub is the text with the most copies, later
    one chosen by a hash among those outside the bucket's largest component. A bucket gives at most as
    many pairs as it has members.
    """
    if turn == 0:
        hubs = members.groupBy("key").agg(F.max(F.struct("copies", (-F.col("id")).alias("place"), "id", "n", "root")).alias("hub"))
    else:
        small = members.join(_largest_roots(members), "key").filter("root <> largest")
        order = F.xxhash64("id", F.lit(turn)).alias("place")
        hubs = small.groupBy("key").agg(F.max(F.struct(order, "id", "n", "root")).alias("hub"))
    met = members.join(hubs, "key").filter((F.col("root") != F.col("hub.root")) & _similar_sizes("n", "hub.n", percent))
    return met.select(F.least("id", "hub.id").alias("a"), F.greatest("id", "hub.id").alias("b")).distinct()


def _largest_roots(members: DataFrame) -> DataFrame:
    """(key, largest, size, others): each bucket's component with the most members, and the numbers in and out of it."""
    counts = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    per_key = counts.groupBy("key").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("size"))
    return per_key.select("key", F.col("top.root").alias("largest"), "size", (F.col("size") - F.col("top.n")).alias("others"))


def _mixed(members: DataFrame) -> DataFrame:
    """The members of buckets that hold several components."""
    keys = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return members.join(keys.select("key"), "key", "left_semi")


def rest_pairs(members: DataFrame, samples: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs across components that share a bucket and may be similar by samples of their sets.

    In each bucket the members outside its largest component, in blocks of BLOCK, meet all members, in
    blocks of AGAINST; small buckets share a task. Only pairs that may be similar come out.
    """
    rows = members.join(_largest_roots(members), "key").join(samples, "id")
    blocks, spreads = F.ceil(F.col("others") / BLOCK), F.ceil(F.col("size") / AGAINST)
    rows = rows.withColumns({"blocks": blocks, "spreads": spreads})
    rows = rows.withColumn("wide", F.pmod(F.xxhash64("id"), F.col("spreads")))
    out = F.when(F.col("root") != F.col("largest"), F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")))
    rows = rows.withColumn("narrow", out)
    zero = F.lit(0).cast("bigint")
    base = rows.withColumn("block", F.explode(F.sequence(zero, F.col("blocks") - 1))).withColumn("asks", F.lit(False))
    asks = rows.filter("narrow is not null").withColumn("block", F.col("narrow")).withColumn("asks", F.lit(True))
    asks = asks.withColumn("wide", F.explode(F.sequence(zero, F.col("spreads") - 1)))
    columns = ["key", "wide", "block", "asks", "id", "n", "root", "sample"]
    # About AGAINST / 8 small buckets of a few rows come together in one group.
    groups = max(64, members.select("key").distinct().count() * 8 // AGAINST)
    both = base.select(*columns, "size").unionAll(asks.select(*columns, "size"))
    both = both.withColumn("part", F.when(F.col("size") > 64, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(groups))))
    both = both.withColumn("small", F.col("size") <= 64).drop("size")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", kind="stable")
        keys, ids, roots, sizes, asking = (group[c].to_numpy() for c in ("key", "id", "root", "n", "asks"))
        held = group["sample"].tolist()
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        found = [close_pairs(ids[i:j], roots[i:j], sizes[i:j], held[i:j], asking[i:j], percent) for i, j in zip(cuts, cuts[1:], strict=False)]
        pairs = np.unique(np.concatenate(found), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return both.groupBy("small", "part", "wide", "block").applyInPandas(compare, "a bigint, b bigint").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v) of the pairs whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    union = F.size("sa") + F.size("sb") - shared
    return both.filter(100 * shared >= percent * union).select(F.col("a").alias("u"), F.col("b").alias("v"))


def union_find(edges: DataFrame) -> DataFrame:
    """The edges of each partition thinned to a forest with the same components."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        above: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := above.setdefault(x, x)) != x:
                above[x] = x = above[up]
            return x

        for batch in batches:
            kept = []
            for u, v in zip(batch["u"].tolist(), batch["v"].tolist(), strict=True):
                a, b = root(u), root(v)
                if a != b:
                    above[max(a, b)] = min(a, b)
                    kept.append((u, v))
            yield pd.DataFrame(kept, columns=["u", "v"], dtype="int64")

    return edges.mapInPandas(run, "u bigint, v bigint")


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """members with the root of each id; an id without links is its own root."""
    linked = members.drop("root").join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
    return linked.withColumn("root", F.coalesce("root", "id"))


def group_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, words: int = shingles.WORDS, places: int = PLACES
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Two texts are linked when 100 * |intersection| >= percent * |union| of their sets of word shingles.
    component_id is the smallest id reachable over links, kept says that it is the row's own.

    A null or empty text, or one without words, has an empty set and is linked with nothing. Rows that
    share an id count as one document with all their links. A row with a null id cannot name a
    component: it gets that of an equal set that has an id, or its component_id is null, and it is not
    kept. Other columns are not looked at; an empty table gives an empty result.

    Equal sets are grouped first, so copies meet no pair. In the buckets of the bands, hubs settle large
    groups in as many pairs as they have members; what is left across components is compared in blocks.
    Every link that matters to a component is checked on full sets.
    """
    ship(df.sparkSession)
    rows = pick(df, id=id_col, text=text_col).select(F.col("id").cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    marks = write_stage(signatures(rows, words, places, rows_per_band(percent, places)), "signatures")
    key = ["n", "f1", "f2"]
    named = marks.filter("n > 0 and id is not null")
    copies = named.groupBy(*key).agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands")
    )
    classes = write_stage(copies, "classes")
    links = _links(rows, classes, percent, words)
    # Rows of one id may lie in several classes: those classes are one document.
    several = named.select("id", *key).join(classes.select(*key, "rep"), key).filter("id <> rep").select("id", "rep").distinct()
    several = several.join(classes.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    links = links.unionAll(several.select(F.col("id").alias("u"), F.col("rep").alias("v")))
    roots = connected_components(union_find(links))
    rooted = _rooted(classes.select(*key, F.col("rep").alias("id")), roots)
    labels = rooted.groupBy(*key).agg(F.min("root").alias("root"))
    out = marks.select("id", *key).join(labels, key, "left")
    alone = F.when(F.col("n") == 0, F.col("id"))
    out = out.withColumn("component_id", F.coalesce("root", alone))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85) -> DataFrame:
    """The rows of df, with all their columns, but for documents that another one of their group stands for.

    Rows with a null id stay. The ids to drop are broadcast only after they have been measured.
    """
    grouped = write_stage(group_near_duplicates(df, id_col, text_col, percent), "groups")
    dropped = grouped.filter(~F.col("kept") & F.col(id_col).isNotNull()).select(id_col).distinct()
    return df.join(F.broadcast(dropped) if fits_broadcast(dropped, [id_col]) else dropped, id_col, "left_anti").select(df.columns)


def _links(rows: DataFrame, classes: DataFrame, percent: int, words: int) -> DataFrame:
    """(u, v) between representatives of classes: enough links to give their components."""
    spread = classes.select(F.explode("bands").alias("key"), F.col("rep").alias("id"), "n", "copies")
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = write_stage(spread.join(shared, "key", "left_semi").withColumn("root", F.col("id")), "buckets")
    wanted = classes.join(members.select("id").distinct(), classes["rep"] == F.col("id"), "left_semi")
    wanted = write_stage(wanted.select(F.col("rep").alias("id"), "n", "f1", "f2"), "wanted")
    names = wanted.select("id").distinct()
    texts = rows.join(F.broadcast(names) if fits_broadcast(names, ["id"]) else names, "id", "left_semi")
    sets = full_sets(texts, words).join(wanted.select("id", "f1", "f2"), ["id", "f1", "f2"], "left_semi").select("id", "set", "sample")
    sets = write_stage(sets, "sets")

    links = write_stage(verified(hub_pairs(members, percent, 0), sets, percent), "links")
    for turn in range(1, HUB_ROUNDS + 1):
        left = write_stage(_mixed(_rooted(members, connected_components(union_find(links)))), "mixed")
        largest = left.groupBy("key").count().agg(F.max("count")).first()[0]
        if turn == HUB_ROUNDS or not largest or largest <= BLOCK:
            break
        more = write_stage(verified(hub_pairs(left, percent, turn), sets, percent), "links")
        if more.isEmpty():
            break  # hubs find nothing any more; the blocks below see to the rest
        links = write_stage(links.unionAll(more), "links")
    samples = sets.groupBy("id").agg(F.first("sample").alias("sample"))
    rest = write_stage(rest_pairs(left, samples, percent), "rest")
    return links.unionAll(verified(rest, sets, percent))
