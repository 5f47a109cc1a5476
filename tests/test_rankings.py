import random
from collections import Counter

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wardlight.operators import labels as L
from wardlight.operators import metrics as M


def brute_auc(rows):
    up, down = [s for y, s in rows if y == 1], [s for y, s in rows if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in up for b in down) / (len(up) * len(down))


@pytest.mark.parametrize("ranked_rows", [1_000_000, 7])
def test_auc_is_exact_with_ties(spark, ranked_rows):
    rnd = random.Random(4)
    rows = [(rnd.randint(0, 1), rnd.choice([0.0, -0.0, -1.5, 0.25, float("inf"), rnd.random()])) for _ in range(300)] + [(1, 0.25)] * 80
    odd = [(None, 0.5), (1, None), (0, float("nan"))]
    got = M.roc_auc(spark.createDataFrame(rows + odd, "label int, probability double"), ranked_rows=ranked_rows).first()
    assert got["positive"] + got["negative"] == 380 and got["auc"] == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "label int, probability double")
    assert tuple(M.roc_auc(df).first()) == (2, 0, None) and tuple(M.roc_auc(df.limit(0)).first()) == (0, 0, None)


def test_auc_finds_the_range_of_a_score_by_halves(spark):
    """No row goes through the cuts one by one, so its time does not grow with the number of ranges."""
    df = spark.range(2_000).selectExpr("int(id % 3 = 0) AS label", "id / 7D AS probability")
    made = M.roc_auc(df, ranked_rows=5)
    assert "lambda" not in made._jdf.queryExecution().toString().lower()
    assert made.first()["auc"] == pytest.approx(brute_auc([(int(i % 3 == 0), i / 7) for i in range(2_000)]), abs=1e-12)


def test_top_labels_of_one_huge_and_many_small_districts(spark):
    rows = [("huge", [f"t{i % 997}", "all", None]) for i in range(5000)] + [(f"d{i}", ["b", "a", "a"]) for i in range(20)]
    rows += [(None, ["a"]), ("none", []), ("none", None)]
    df = spark.createDataFrame(rows, "district string, type array<string>")
    got = {}
    for r in L.top_labels_by(df, "district", k=3).orderBy("district", "rank").collect():
        got.setdefault(r["district"], []).append((r["label"], r["n"], r["rank"]))
    counts = Counter(t for d, ts in rows if d == "huge" for t in set(ts) if t)
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:3]
    assert got.pop("huge") == [(t, n, i + 1) for i, (t, n) in enumerate(want)]
    assert len(got) == 20 and all(v == [("a", 1, 1), ("b", 1, 2)] for v in got.values())


def test_report_of_labels(spark):
    df = spark.createDataFrame([(1, 0, 1, 0), (1, 0, 0, 0), (0, 0, 1, 0)], "a int, b int, pa int, pb int")
    got = {r["target"]: tuple(r)[1:] for r in M.multilabel_report(df, ["a", "b"], ["pa", "pb"]).collect()}
    assert got == {"a": (2, 2, 1, 0.5, 0.5, 0.5), "b": (0, 0, 0, 0.0, 0.0, 0.0)}
    assert M.multilabel_report(df.limit(0), ["a"], ["pa"]).first()["f1"] == 0.0


def test_values_in_a_table(spark):
    rows = [(i, ["hot", f"v{i}", None, f"v{i}"] if i % 9 else None) for i in range(400)] + [(900, [])]
    df = spark.createDataFrame(rows, "id bigint, types array<string>").withColumn("place", F.lit("x"))
    made, table = L.encode_by_table(df, "types", "hot_vector", "id")
    names = {r["place"]: r["value"] for r in table.collect()}
    assert sorted(names) == list(range(len(names))) and set(names.values()) == {v for _, vs in rows for v in vs or [] if v}
    out = {r["id"]: r for r in made.collect()}
    assert len(out) == 401 and set(made.columns) == {"id", "types", "place", "hot_vector", "hot_vector_places"}
    for i, values in rows:
        vector = out[i]["hot_vector"]
        assert {names[p] for p in vector.indices} == {v for v in values or [] if v} and vector.size == len(names) and set(vector.values) <= {1.0}
    again, _ = L.encode_by_table(df.repartition(7), "types", "hot_vector", "id")
    assert {r["id"]: r["hot_vector_places"] for r in again.collect()} == {i: r["hot_vector_places"] for i, r in out.items()}
    empty, none = L.encode_by_table(df.limit(0), "types", "v", "id")
    assert empty.count() == 0 and none.count() == 0


def test_parts_of_a_vector_with_very_many_places(spark):
    """A sparse vector is read as it is stored: its zeros are never written out."""
    rows = [(1, Vectors.sparse(2_000_000_000, [5, 1_999_999_999], [1.0, 2.0])), (2, Vectors.dense([0.0, 3.0])), (3, Vectors.sparse(4, [], [])), (4, None)]
    df = spark.createDataFrame(rows, StructType([StructField("id", LongType()), StructField("v", VectorUDT())]))
    got = {r["id"]: r["p"] for r in df.select("id", L.vector_parts(F.col("v")).alias("p")).collect()}
    assert tuple(got[1]) == (2_000_000_000, [5, 1_999_999_999], [1.0, 2.0])
    assert tuple(got[2]) == (2, None, [0.0, 3.0]) and tuple(got[3]) == (4, [], []) and got[4] is None
