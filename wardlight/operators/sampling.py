"""Samples and splits of exact size that do not depend on the partitioning.

Every row gets the md5 of seed and row id. "The n rows with the smallest hash" is a random sample, and
finding the n-th hash needs only bucket counts: count rows per hash prefix, descend into the bucket that
holds the n-th row until it is small, and read that bucket. The sample is then a plain filter on the
hash: no sort, no shuffle of rows, no group larger than BUCKET_ROWS. Row ids must be unique.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_stage
from .clean import quoted
from .indexing import add_dense_index
from .skew import lookup_join

BUCKET_ROWS = 5_000
PREFIX_STEP = 3  # hex digits per descent: 4096 buckets
MAX_CLASSES = 100  # beyond these the cut-offs of the classes are a table
NOTHING, EVERYTHING = "", "g"  # below and above every hex digit


def row_hash(id_column: Column | str, seed: int | str) -> Column:
    c = quoted(id_column) if isinstance(id_column, str) else id_column
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")).cast("binary"))


def _class_text(label: Column | None) -> Column:
    return F.lit("") if label is None else F.coalesce(label.cast("string"), F.lit("null"))


def _bucket_counts(keyed: DataFrame, width: int) -> dict[str, list[tuple[str, int]]]:
    counted = keyed.groupBy("cls", F.substring("h", 1, width).alias("prefix")).count()
    found = defaultdict(list)
    for r in counted.collect():
        found[r["cls"]].append((r["prefix"], r["count"]))
    return {c: sorted(b) for c, b in found.items()}


def _descend(buckets: list[tuple[str, int]], rank: int) -> tuple[str, int, int]:
    """Bucket that holds the rank-th row, the rank within it, and its size."""
    for prefix, size in buckets:
        if rank <= size:
            return prefix, rank, size
        rank -= size
    raise ValueError("rank beyond the number of rows")


def _in_buckets(wanted: set[tuple[str, str]]) -> Column:
    by_width = defaultdict(list)
    for cls, prefix in sorted(wanted):
        by_width[len(prefix)].append(f"{cls}|{prefix}")
    tests = [F.concat_ws("|", "cls", F.substring("h", 1, w)).isin(keys) for w, keys in by_width.items()]
    return reduce(lambda a, b: a | b, tests)


def hash_cutoffs(keyed: DataFrame, ranks: Callable[[dict[str, int]], dict[str, list[int]]]) -> dict[str, list[str]]:
    """For each class the hash at each wanted rank.

    keyed has the columns cls and h; ranks turns the class sizes into the wanted ranks (0 = none).
    """
    width = PREFIX_STEP
    buckets = _bucket_counts(keyed, width)
    sizes = {c: sum(n for _, n in b) for c, b in buckets.items()}
    wanted = ranks(sizes)
    spot = {
        (c, r): _descend(buckets[c], r) for c, rs in wanted.items() for r in rs if 0 < r < sizes[c]
    }
    while deep := {k: v for k, v in spot.items() if v[2] > BUCKET_ROWS}:
        if width > 24:
            raise ValueError("row ids are not unique")
        width += PREFIX_STEP
        finer = _bucket_counts(keyed.filter(_in_buckets({(c, v[0]) for (c, _), v in deep.items()})), width)
        for (c, r), (prefix, rank, _) in deep.items():
            spot[c, r] = _descend([b for b in finer[c] if b[0].startswith(prefix)], rank)
    hashes = defaultdict(list)
    if spot:
        for row in keyed.filter(_in_buckets({(c, v[0]) for (c, _), v in spot.items()})).select("cls", "h").collect():
            hashes[row["cls"]].append(row["h"])
    cut = {}
    for (c, r), (prefix, rank, _) in spot.items():
        inside = sorted(h for h in hashes[c] if h.startswith(prefix))
        if rank < len(inside) and inside[rank - 1] == inside[rank]:
            raise ValueError("row ids are not unique")
        cut[c, r] = inside[rank - 1]
    return {
        c: [cut.get((c, r), NOTHING if r <= 0 else EVERYTHING) for r in rs] for c, rs in wanted.items()
    }


def cutoff_table(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, k, cut): the hash at each wanted rank, for any number of classes; only counts of levels reach the driver.

    keyed has the columns cls and h; wanted has cls, k, rank and size, the rows of the class. All classes
    descend together: each level counts the rows per longer prefix below the one found so far, at most 4096
    for each wanted rank, and stops for a rank once its prefix holds no more than BUCKET_ROWS rows.
    """
    inside = (F.col("rank") > 0) & (F.col("rank") < F.col("size"))
    edge = F.when(F.col("rank") <= 0, NOTHING).otherwise(EVERYTHING)
    done = [wanted.filter(~inside).select("cls", "k", edge.alias("cut"))]
    state = write_stage(wanted.filter(inside).select("cls", "k", "rank", "size", F.lit("").alias("prefix")), "ranks")
    width = 0
    while True:
        below = lookup_join(keyed.withColumn("prefix", F.substring("h", 1, width)), state, ["cls", "prefix"], "inner")
        small = below.filter(F.col("size") <= BUCKET_ROWS)
        order = Window.partitionBy("cls", "k").orderBy("h")
        picked = small.withColumn("n", F.row_number().over(order)).filter(F.col("n") == F.col("rank"))
        done.append(picked.select("cls", "k", F.col("h").alias("cut")))
        if state.filter(F.col("size") > BUCKET_ROWS).isEmpty():
            return write_stage(reduce(DataFrame.unionAll, done), "cuts")
        width += PREFIX_STEP
        if width > 32:
            raise ValueError("row ids are not unique")
        large = below.filter(F.col("size") > BUCKET_ROWS).groupBy("cls", "k", "rank", F.substring("h", 1, width).alias("prefix")).count()
        running = F.sum("count").over(Window.partitionBy("cls", "k").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
        found = large.withColumn("upto", running).filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("count") < F.col("rank")))
        state = write_stage(found.select("cls", "k", (F.col("rank") - F.col("upto") + F.col("count")).alias("rank"), F.col("count").alias("size"), "prefix"), "ranks")


def share_out_table(sizes: DataFrame, test_size: float) -> DataFrame:
    """share_out for a table (cls, size): adds rank, the test rows of each class."""
    total = sizes.agg(F.sum("size")).first()[0] or 0
    tests = math.ceil(total * test_size)
    exact = F.lit(float(tests)) * F.col("size") / F.lit(float(max(1, total)))
    floors = write_stage(sizes.withColumn("rank", F.floor(exact)).withColumn("_less", F.col("rank") - exact), "shares")
    extra = tests - (floors.agg(F.sum("rank")).first()[0] or 0)
    ordered = add_dense_index(floors, "_less", "_place", ("cls",))
    return ordered.withColumn("rank", F.col("rank") + (F.col("_place") < extra).cast("int")).drop("_less", "_place")


def _many_classes(df: DataFrame, label: Column) -> bool:
    return df.select(_class_text(label)).distinct().limit(MAX_CLASSES + 1).count() > MAX_CLASSES


def _with_cutoffs(df: DataFrame, id_column: str, seed: int | str, label: Column, wanted: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """df with _h, the hash of each row, and _cuts, the ascending cut-offs of its class, for any number of classes."""
    keyed = _keyed(df, id_column, seed, label)
    sizes = write_stage(keyed.groupBy("cls").agg(F.count(F.lit(1)).alias("size")), "classes")
    cuts = cutoff_table(keyed, wanted(sizes)).groupBy(F.col("cls").alias("_cls")).agg(F.sort_array(F.collect_list("cut")).alias("_cuts"))
    marked = df.withColumn("_cls", _class_text(label)).withColumn("_h", row_hash(id_column, seed))
    return lookup_join(marked, cuts, ["_cls"]).drop("_cls")


def _keyed(df: DataFrame, id_column: str, seed: int | str, label: Column | None = None) -> DataFrame:
    return df.select(_class_text(label).alias("cls"), row_hash(id_column, seed).alias("h"))


def _cutoff_of(label: Column | None, cuts: dict[str, list[str]], i: int) -> Column:
    if not cuts:
        return F.lit(NOTHING)
    table = F.create_map(*[F.lit(x) for c, hs in cuts.items() for x in (c, hs[i])])
    return F.coalesce(F.try_element_at(table, _class_text(label)), F.lit(NOTHING))


def sample_data(df: DataFrame, id_column: str, n: int = 200_000, seed: int | str = 42) -> DataFrame:
    """Exactly n rows, or all rows if there are fewer."""
    cuts = hash_cutoffs(_keyed(df, id_column, seed), lambda size: {c: [min(n, k)] for c, k in size.items()})
    return df.filter(row_hash(id_column, seed) <= _cutoff_of(None, cuts, 0))


def undersample(df: DataFrame, label: str, id_column: str, ratio: float = 0.5, seed: int | str = 42) -> DataFrame:
    """All positives and floor(positives / ratio) negatives (all, if there are no more than that)."""
    positive = quoted(label) == 1
    cls = F.when(positive, "1").otherwise("0")

    def ranks(size: dict[str, int]) -> dict[str, list[int]]:
        return {"0": [min(int(size.get("1", 0) / ratio), size["0"])]} if "0" in size else {}

    cuts = hash_cutoffs(_keyed(df, id_column, f"{seed}:under", cls), ranks)
    return df.filter(positive | (row_hash(id_column, f"{seed}:under") <= _cutoff_of(cls, cuts, 0)))


def share_out(sizes: dict[str, int], test_size: float) -> dict[str, int]:
    """ceil(n x test_size) test rows shared out in proportion, largest remainders first."""
    total = sum(sizes.values())
    tests = math.ceil(total * test_size)
    exact = {c: tests * n / total for c, n in sizes.items()}
    out = {c: math.floor(x) for c, x in exact.items()}
    order = sorted(sizes, key=lambda c: (out[c] - exact[c], c))
    for c in order[: tests - sum(out.values())]:
        out[c] += 1
    return out


def mark_test(df: DataFrame, id_column: str, test_size: float = 0.2, seed: int | str = 42, stratify: str | None = None) -> DataFrame:
    """Add is_test; with `stratify` every class has the same share of test rows, however many classes there are."""
    label = None if stratify is None else quoted(stratify)
    seed = f"{seed}:split"
    if label is not None and _many_classes(df, label):
        found = _with_cutoffs(df, id_column, seed, label, lambda sizes: share_out_table(sizes, test_size).withColumn("k", F.lit(0)))
        return found.withColumn("is_test", F.col("_h") <= F.get("_cuts", F.lit(0))).drop("_h", "_cuts")
    cuts = hash_cutoffs(
        _keyed(df, id_column, seed, label), lambda size: {c: [k] for c, k in share_out(size, test_size).items()}
    )
    return df.withColumn("is_test", row_hash(id_column, seed) <= _cutoff_of(label, cuts, 0))


def split_data(df: DataFrame, id_column: str, test_size: float = 0.2, seed: int | str = 42, stratify: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test)."""
    marked = mark_test(df, id_column, test_size, seed, stratify)
    return marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")


def add_folds(df: DataFrame, label: str, id_column: str, folds: int = 5, seed: int | str = 42) -> DataFrame:
    """Add fold (0..folds-1); within each class, of any number, the fold sizes differ by at most one."""
    cls = quoted(label)
    seed = f"{seed}:fold"
    if _many_classes(df, cls):
        ranks = F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), lambda i: F.ceil(F.col("size") * i / folds)) if folds > 1 else F.array()
        found = _with_cutoffs(df, id_column, seed, cls, lambda sizes: sizes.select("cls", "size", F.posexplode(ranks).alias("k", "rank")))
        above = F.filter(F.coalesce("_cuts", F.array().cast("array<string>")), lambda c: c < F.col("_h"))
        return found.withColumn("fold", F.size(above)).drop("_h", "_cuts")
    cuts = hash_cutoffs(
        _keyed(df, id_column, seed, cls),
        lambda size: {c: [math.ceil(k * i / folds) for i in range(1, folds)] for c, k in size.items()},
    )
    h = row_hash(id_column, seed)
    above = [(h > _cutoff_of(cls, cuts, i)).cast("int") for i in range(folds - 1)]
    return df.withColumn("fold", reduce(lambda a, b: a + b, above, F.lit(0)))
