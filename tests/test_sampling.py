import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wardlight.operators import sampling as P
from wardlight.operators.indexing import add_dense_index


def table(spark, n=3000, parts=3):
    label = F.when(F.col("id") % 10 == 0, 1).otherwise(0)
    return spark.range(0, n, 1, parts).select("id", label.alias("y"))


@pytest.fixture(params=[P.BUCKET_ROWS, 2])
def bucket(request, monkeypatch):
    """The second value forces several descents."""
    monkeypatch.setattr(P, "BUCKET_ROWS", request.param)


def test_sample_is_exact_and_independent_of_partitions(spark, bucket):
    got = {r["id"] for r in P.sample_data(table(spark), "id", 777).collect()}
    assert got == {r["id"] for r in P.sample_data(table(spark, parts=7), "id", 777).collect()}
    order = sorted(range(3000), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert got == set(order[:777])
    assert P.sample_data(table(spark), "id", 9999).count() == 3000
    assert P.sample_data(table(spark), "id", 0).count() == 0


def test_undersample_keeps_positives(spark, bucket):
    got = Counter(r["y"] for r in P.undersample(table(spark), "y", "id", 0.3).collect())
    assert got == {1: 300, 0: 1000}


def test_stratified_split_sizes(spark, bucket):
    train, test = P.split_data(table(spark, 1007), "id", 0.2, stratify="y")
    assert (train.count(), test.count()) == (1007 - 202, 202)
    shares = Counter(r["y"] for r in test.collect())
    assert abs(shares[1] - 101 * 0.2) <= 1
    assert train.join(test, "id").count() == 0


def test_allocation_adds_up():
    for sizes in ({"a": 3, "b": 5}, {"a": 1, "b": 1, "c": 1}, {"a": 1000}):
        assert sum(P.share_out(sizes, 0.2).values()) == math.ceil(sum(sizes.values()) * 0.2)


def test_folds_are_even_within_classes(spark, bucket):
    got = Counter((r["y"], r["fold"]) for r in P.add_folds(table(spark, 1003), "y", "id", 4).collect())
    for y in (0, 1):
        sizes = [got[y, f] for f in range(4)]
        assert max(sizes) - min(sizes) <= 1


def test_repeated_ids_are_refused(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_ROWS", 5)
    with pytest.raises(ValueError):
        P.sample_data(spark.range(100).select(F.lit(1).alias("id")), "id", 10).count()


@pytest.mark.parametrize("size", [7, 10_000])
def test_dense_index_follows_the_key(spark, size):
    df = spark.range(100).select((F.col("id") * 37 % 101 - 50).alias("k"))
    got = add_dense_index(df, "k", "i", rows_per_bucket=size).orderBy("k").collect()
    assert [r["i"] for r in got] == list(range(100))


@pytest.mark.parametrize("most", [1, 100])
def test_splits_and_folds_of_many_classes_are_those_of_few(spark, bucket, monkeypatch, most):
    """The table of cut-offs and the cut-offs in the driver choose the same rows."""
    rows = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 7).cast("string")).alias("y"), F.lit(1).alias("cls"))
    want_split = {(r["id"], r["is_test"]) for r in P.mark_test(rows, "id", 0.2, stratify="y").collect()}
    want_fold = {(r["id"], r["fold"]) for r in P.add_folds(rows, "y", "id", 3).collect()}
    monkeypatch.setattr(P, "MAX_CLASSES", most)
    split, folds = P.mark_test(rows, "id", 0.2, stratify="y"), P.add_folds(rows, "y", "id", 3)
    assert split.columns == ["id", "y", "cls", "is_test"] and folds.columns == ["id", "y", "cls", "fold"]
    assert {(r["id"], r["is_test"]) for r in split.collect()} == want_split
    assert {(r["id"], r["fold"]) for r in folds.collect()} == want_fold


def test_hundreds_of_classes(spark):
    rows = spark.range(3000).select("id", (F.col("id") % 700).alias("y"))
    marked = P.mark_test(rows, "id", 0.25, stratify="y").groupBy("y").agg(F.count_if("is_test").alias("k")).collect()
    assert len(marked) == 700 and sum(r["k"] for r in marked) == 750 and {r["k"] for r in marked} <= {1, 2}
    assert P.mark_test(rows.limit(0), "id", stratify="y").count() == 0
