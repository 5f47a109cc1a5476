"""Classification metrics from counts; division by zero gives 0."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_stage
from .clean import quoted


def _over(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def _f1(p: Column, r: Column) -> Column:
    return _over(p * r * 2, p + r)


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall and f1 of class 1, with the four counts; one row."""
    y, p = quoted(label) == 1, quoted(prediction) == 1
    n = df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return n.select(
        "tp",
        "fp",
        "fn",
        "tn",
        _over(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _over(tp, tp + fp).alias("precision"),
        _over(tp, tp + fn).alias("recall"),
        _over(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n)."""
    pairs = df.select(quoted(label).alias("label"), quoted(prediction).alias("prediction"))
    return pairs.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """precision, recall, f1 and support of every class."""
    n, y, p = F.col("n"), F.col("label"), F.col("prediction")
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(y.cast("double").alias("cls"), n.alias("support"), zero.alias("predicted"), F.when(y == p, n).otherwise(0).alias("hit")),
        F.struct(p.cast("double").alias("cls"), zero.alias("support"), n.alias("predicted"), zero.alias("hit")),
    )
    each = confusion_counts(df, label, prediction).select(F.explode(sides).alias("s")).select("s.*")
    per = each.groupBy("cls").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    precision, recall = _over(F.col("hit"), F.col("predicted")), _over(F.col("hit"), F.col("support"))
    return per.select(
        "cls", "support", "hit", precision.alias("precision"), recall.alias("recall"), _f1(precision, recall).alias("f1")
    )


def weighted_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, and precision, recall and f1_score averaged over classes by support; one row."""
    w = F.col("support")
    return class_report(df, label, prediction).agg(
        (F.sum("hit") / F.sum(w)).alias("accuracy"),
        *[(F.sum(F.col(c) * w) / F.sum(w)).alias(n) for c, n in (("precision", "precision"), ("recall", "recall"), ("f1", "f1_score"))],
    )


def multilabel_metrics(df: DataFrame, labels: Sequence[str], predictions: Sequence[str]) -> DataFrame:
    """Subset accuracy and micro and macro precision, recall, f1 over 0/1 columns; one pass, one row."""
    pairs = [(quoted(y) == 1, quoted(p) == 1) for y, p in zip(labels, predictions, strict=True)]
    same = reduce(lambda a, b: a & b, [y == p for y, p in pairs])
    counts = [F.avg(same.cast("double")).alias("accuracy")]
    for i, (y, p) in enumerate(pairs):
        counts += [F.count_if(y & p).alias(f"tp{i}"), F.count_if(p).alias(f"pp{i}"), F.count_if(y).alias(f"ap{i}")]
    tp, pp, ap = ([F.col(f"{k}{i}") for i in range(len(pairs))] for k in ("tp", "pp", "ap"))

    def add(cs: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a + b, cs)

    def macro(cs: Sequence[Column]) -> Column:
        return add(cs) / len(pairs)

    precision, recall = [_over(a, b) for a, b in zip(tp, pp)], [_over(a, b) for a, b in zip(tp, ap)]
    return df.agg(*counts).select(
        "accuracy",
        _over(add(tp), add(pp)).alias("precision_micro"),
        macro(precision).alias("precision_macro"),
        _over(add(tp), add(ap)).alias("recall_micro"),
        macro(recall).alias("recall_macro"),
        _over(add(tp) * 2, add(pp) + add(ap)).alias("f1_micro"),
        macro([_over(a * 2, b + c) for a, b, c in zip(tp, pp, ap)]).alias("f1_macro"),
    )


def multilabel_report(df: DataFrame, labels: Sequence[str], predictions: Sequence[str]) -> DataFrame:
    """(target, support, predicted, hit, precision, recall, f1) of class 1 of every label; all labels in one pass."""
    zero = F.lit(0).cast("bigint")
    counts = [
        F.struct(
            F.lit(y).alias("target"), F.coalesce(F.count_if(quoted(y) == 1), zero).alias("support"),
            F.coalesce(F.count_if(quoted(p) == 1), zero).alias("predicted"), F.coalesce(F.count_if((quoted(y) == 1) & (quoted(p) == 1)), zero).alias("hit"),
        )
        for y, p in zip(labels, predictions, strict=True)
    ]
    each = df.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))
    precision, recall = _over(F.col("hit"), F.col("predicted")), _over(F.col("hit"), F.col("support"))
    return each.select("*", precision.alias("precision"), recall.alias("recall"), _f1(precision, recall).alias("f1"))


#: Distinct scores that one task ranks, and the most ranges of scores.
RANKED_ROWS, MAX_RANGES = 200_000, 10_000


def roc_auc(df: DataFrame, label: str = "label", score: str = "probability", ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """(positive, negative, auc): the exact area under the ROC curve, ties counting one half; one row.

    Equal scores are counted before anything is ordered. Quantiles cut the scores into ranges, whose totals add up
    to what lies below each range; within a range the counts run on by themselves. Rows with a null or NaN
    score or a null label take no part; auc is null unless both classes occur.
    """
    pairs = df.select((quoted(label) == 1).alias("y"), quoted(score).cast("double").alias("s")).filter("y is not null and s is not null and not isnan(s)")
    counted = pairs.groupBy("s").agg(F.count_if("y").alias("p"), F.count_if(~F.col("y")).alias("n"))
    counted = write_stage(counted, "scores")
    ranges = min(MAX_RANGES, -(-counted.count() // ranked_rows))
    if ranges > 1:
        cuts = counted.approxQuantile("s", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))
        splits = [-math.inf, *sorted({c for c in cuts if math.isfinite(c)}), math.inf]
        # A search by halves: the time of a row does not grow with the number of ranges.
        placed = Bucketizer(splits=splits, inputCol="s", outputCol="r").transform(counted).withColumn("r", F.col("r").cast("int"))
    else:
        placed = counted.withColumn("r", F.lit(0))
    below, start = 0, {}
    for r in placed.groupBy("r").agg(F.sum("n").alias("n")).orderBy("r").collect():
        start[r["r"]], below = below, below + r["n"]
    starts = df.sparkSession.createDataFrame(list(start.items()), "r int, before bigint")
    placed, before = placed.join(F.broadcast(starts), "r"), F.col("before")
    inside = F.sum("n").over(Window.partitionBy("r").orderBy("s").rowsBetween(Window.unboundedPreceding, -1))
    # Twice the pairs in which the positive scores higher, a tie counting once: whole numbers, exact.
    twice = F.col("p").cast("decimal(20, 0)") * (2 * (before + F.coalesce(inside, F.lit(0))) + F.col("n")).cast("decimal(18, 0)")
    total = placed.withColumn("twice", twice).agg(F.sum("p").alias("positive"), F.sum("n").alias("negative"), F.sum("twice").alias("twice"))
    both = (F.col("positive") > 0) & (F.col("negative") > 0)
    auc = F.col("twice").cast("double") / (2.0 * F.col("positive") * F.col("negative"))
    zero = F.lit(0).cast("bigint")
    return total.select(F.coalesce("positive", zero).alias("positive"), F.coalesce("negative", zero).alias("negative"), F.when(both, auc).alias("auc"))
