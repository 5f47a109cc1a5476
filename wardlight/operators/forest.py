"""Random forests per label: features, search, evaluation, importance, storage."""

from __future__ import annotations

import hashlib
import json
import random
import re
import statistics
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import feature_category, is_cyclical_name, is_district_name
from ..session import drop_stage, work_folder, write_stage
from .clean import numeric_columns, quoted
from .labels import class_distribution
from .metrics import class_report, multilabel_metrics, weighted_metrics
from .resampling import ResamplingStats, determine_resampling_strategy, non_adaptive_strategy, resample
from .sampling import add_folds, mark_test
from .trees import TEST, Binning, Forest, Tree, bin_features, grow, grow_and_score, importance, pack_rows, votes

MAX_DEPTH = 30  # the deepest tree Spark grows; stands for "unlimited"
#: What ids of rows that were not made up begin with, and the bytes of a forest that are sent to all tasks.
REAL = "row:"
SENT_BYTES = 32 << 20

# Ranges (ends included) and choices of the random search.
SEARCH_SPACE = {
    "n_estimators": (100, 300),
    "max_depth": (10, 30),
    "min_samples_split": (2, 5),
    "min_samples_leaf": (1, 3),
    "max_features": ["sqrt", "log2"],
    "class_weight": ["balanced", "balanced_subsample"],
}
# Columns that are never features.
NOT_FEATURES = ("timestamp", "timestamp_col", "timestamp_hour", "date", "time")
SCORES = {
    "accuracy": {"metricName": "accuracy"},
    "f1": {"metricName": "fMeasureByLabel", "metricLabel": 1.0},
    "precision": {"metricName": "precisionByLabel", "metricLabel": 1.0},
    "recall": {"metricName": "recallByLabel", "metricLabel": 1.0},
    "f1_weighted": {"metricName": "f1"},
}





@dataclass
class TrainedModel:
    model: RandomForestClassificationModel | VotingForest | None
    metrics: dict[str, float]
    best_params: dict[str, int | str]
    minority_ratio: float
    resampling: ResamplingStats | None = None
    path: str | None = None
    importance: DataFrame | None = field(default=None, repr=False)


def feature_columns(df: DataFrame, labels: Sequence[str] = (), exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns that are neither labels, ids nor raw times."""
    taken = {*NOT_FEATURES, *labels, *exclude}
    return [c for c in numeric_columns(df) if c not in taken and not c.startswith("type_")]


def assemble(df: DataFrame, id_column: str, features: Sequence[str], keep: Sequence[str] = (), vectors: Sequence[str] = ()) -> DataFrame:
    """(row_id, features, kept columns); missing values are 0. Vector columns follow the plain ones, and stay sparse."""
    plain = df.select(
        quoted(id_column).cast("string").alias("row_id"),
        *[F.nanvl(F.coalesce(quoted(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"_f{i}") for i, c in enumerate(features)],
        *[quoted(c) for c in keep],
        *[quoted(c).alias(f"_v{i}") for i, c in enumerate(vectors)],
    )
    names = [f"_f{i}" for i in range(len(features))]
    if vectors:
        parts = [*names, *[f"_v{i}" for i in range(len(vectors))]]
        return VectorAssembler(inputCols=parts, outputCol="features").transform(plain).select("row_id", "features", *[quoted(c) for c in keep])
    # Dense arrays keep one layout for all rows, whatever the share of zeros.
    return plain.select("row_id", array_to_vector(F.array(*names)).alias("features"), *[quoted(c) for c in keep])


def forest(n_estimators: int = 100, max_depth: int | None = None, seed: int = 42, label: str = "label", **params) -> RandomForestClassifier:
    # Cached node ids spare passing the deep trees to every task again.
    return RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=n_estimators, maxDepth=max_depth or MAX_DEPTH,
        seed=seed, cacheNodeIds=True, **params,
    )


def _plain(label: int, n_estimators: int, max_depth: int | None, seed: int) -> Forest:
    """A forest as Spark's own one is by default."""
    return Forest(label, n_estimators, min(max_depth or MAX_DEPTH, MAX_DEPTH), max_features="sqrt" if n_estimators > 1 else "all", seed=seed)


def _is_binary(rows: DataFrame, labels: Sequence[str]) -> bool:
    """Whether all labels are 0 or 1 and all features are there and finite. Other rows are left to Spark's own forest."""
    known = [F.coalesce(quoted(c).cast("double").isin(0.0, 1.0), F.lit(False)) for c in labels]
    odd = F.exists(vector_to_array("features"), lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
    fine = reduce(lambda a, b: a & b, known, ~F.coalesce(odd, F.lit(True)))
    n, fitting = rows.agg(F.count(F.lit(1)), F.count_if(fine)).first()
    return 0 < n == fitting


def train_classifier(df: DataFrame, label: str | Sequence[str] = "label", n_estimators: int = 100, max_depth: int | None = None, seed: int = 42):
    """One forest, or for several labels one forest per label as a dict, all grown in the same scans.

    Labels of 0 and 1 give a VotingForest; labels of more classes are left to Spark's own forest.
    """
    names = [label] if isinstance(label, str) else list(label)
    rows = write_stage(df.select(F.monotonically_increasing_id().alias("row_id"), "features", *map(quoted, names)), "train")
    if _is_binary(rows, names):
        entries = [F.struct(F.lit(i).alias("label"), quoted(n).cast("int").alias("y"), F.lit(0).alias("fold")) for i, n in enumerate(names)]
        rows_of_all = rows.select("row_id", "features", F.array(*entries).alias("entries"))
        binning = bin_features(rows_of_all)
        blocks = pack_rows(rows_of_all, binning, len(names))
        trees = grow(blocks, [_plain(i, n_estimators, max_depth, seed) for i in range(len(names))], binning)
        models = {n: VotingForest(trees.filter(F.col("forest") == i), binning) for i, n in enumerate(names)}
        drop_stage(blocks)
        drop_stage(rows)
        return models[label] if isinstance(label, str) else models
    drop_stage(rows)
    if isinstance(label, str):
        return forest(n_estimators, max_depth, seed, label).fit(df)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {name: forest(n_estimators, max_depth, seed, name).fit(df) for name in label}
    finally:
        df.unpersist()


def predict_all(models: dict[str, RandomForestClassificationModel | VotingForest], df: DataFrame) -> DataFrame:
    """Add one column pred_<label> per model."""
    for name, model in models.items():
        if isinstance(model, VotingForest):
            df = model.transform(df, f"pred_{name}", None)
        else:
            df = model.setPredictionCol(f"pred_{name}").setRawPredictionCol("").setProbabilityCol("").transform(df)
    return df


def evaluate_classifier(models, df: DataFrame, label: str | Sequence[str] = "label") -> DataFrame:
    """Accuracy and weighted scores of one model, or subset accuracy, micro and macro scores of several."""
    if isinstance(models, dict):
        return multilabel_metrics(predict_all(models, df), list(models), [f"pred_{n}" for n in models])
    return weighted_metrics(models.transform(df), label)


def evaluation(model: RandomForestClassificationModel | VotingForest, df: DataFrame, label: str = "label") -> dict[str, DataFrame]:
    """The scores of evaluate_classifier, the report per class, and the predictions themselves."""
    predictions = model.transform(df)
    return {"scores": weighted_metrics(predictions, label), "report": class_report(predictions, label), "predictions": predictions}


def draw_params(n_iter: int, seed: int = 42, space: dict | None = None) -> list[dict[str, int | str]]:
    """n_iter random settings; ranges are drawn uniformly with both ends."""
    rng = random.Random(seed)
    space = SEARCH_SPACE if space is None else space
    return [
        {k: rng.randint(*v) if isinstance(v, tuple) else rng.choice(v) for k, v in space.items()} for _ in range(n_iter)
    ]


class VotingForest:
    """A grown forest: the mean share of class 1 over its trees, class 1 from above one half."""

    def __init__(self, trees: DataFrame, binning: Binning):
        self.trees, self.binning = trees, binning

    @property
    def featureImportances(self) -> DenseVector:
        found = importance(self.trees).collect()
        shares = {r["feature"]: r["importance"] for r in found}
        total = sum(shares.values()) or 1.0
        return DenseVector([shares.get(i, 0.0) / total for i in range(len(self.binning.bounds))])

    def transform(self, df: DataFrame, prediction: str = "prediction", probability: str | None = "probability") -> DataFrame:
        """Add probability (unless it has no name) and prediction. A forest is sent to the tasks only if it has been
        measured to be small."""
        size = sum(F.octet_length(c) for c in Tree.KINDS)
        if (self.trees.agg(F.sum(size)).first()[0] or 0) <= SENT_BYTES:
            found = df.withColumn("_share", self._small()(vector_to_array("features")))
        else:
            rows = write_stage(df.withColumn("_row", F.monotonically_increasing_id()), "scored")
            asked = rows.select(F.col("_row").alias("row_id"), "features", F.expr("cast(array() as array<struct<label:int,y:int,fold:int>>)").alias("entries"))
            share = votes(self.trees, pack_rows(asked, self.binning, 1)).select(F.col("row").alias("_row"), F.col("p").alias("_share"))
            found = rows.join(write_stage(share, "votes"), "_row").drop("_row")
        named = found if probability is None else found.withColumn(probability, F.col("_share"))
        return named.withColumn(prediction, (F.col("_share") > 0.5).cast("double")).drop("_share")

    def _small(self):
        spark, binning = self.trees.sparkSession, self.binning
        sent = spark.sparkContext.broadcast([tuple(r) for r in self.trees.select("w0", "w1", *Tree.KINDS).collect()])

        @F.pandas_udf("double")
        def share(values: pd.Series) -> pd.Series:
            if not len(values):
                return pd.Series([], dtype=float)
            bins, total = binning.bins(np.stack(values.to_numpy()).astype(float)), np.zeros(len(values))
            for w0, w1, *parts in sent.value:
                tree = Tree(*[np.frombuffer(p, k) for p, k in zip(parts, Tree.KINDS.values(), strict=True)])
                total += tree.probability((w0, w1))[tree.end_of(bins)]
            return pd.Series(total / max(1, len(sent.value)))

        return share

    def save(self, path: str, mode: str = "overwrite") -> None:
        self.trees.write.mode(mode).parquet(f"{path}/trees")
        save_json(self.trees.sparkSession, f"{path}/bounds", [b.tolist() for b in self.binning.bounds])

    def write(self) -> ForestWriter:
        return ForestWriter(self)

    @staticmethod
    def load(spark: SparkSession, path: str) -> VotingForest:
        return VotingForest(spark.read.parquet(f"{path}/trees"), Binning([np.array(b, float) for b in load_json(spark, f"{path}/bounds")]))


@dataclass
class ForestWriter:
    """What Spark's models have: model.write().overwrite().save(path)."""

    forest: VotingForest
    mode: str = "error"

    def overwrite(self) -> ForestWriter:
        return replace(self, mode="overwrite")

    def save(self, path: str) -> None:
        self.forest.save(path, self.mode)


def _rows_of_labels(base: DataFrame, sets: Sequence[tuple[DataFrame, DataFrame | None]], folds: int, seed: int) -> DataFrame:
    """(row_id, features, entries): every row once, with all labels that it belongs to; made-up rows belong to one.

    Rows of base have ids that begin with REAL; only their ids move until all labels are known.
    """
    real, made = [], []
    for i, (train, test) in enumerate(sets):
        parts = [add_folds(train, "label", "row_id", folds, seed)]
        if test is not None:
            parts.append(test.withColumn("fold", F.lit(TEST)))
        for part in parts:
            entry = F.struct(F.lit(i).alias("label"), F.col("label").cast("int").alias("y"), F.col("fold").cast("int").alias("fold"))
            is_real = F.startswith(F.col("row_id"), F.lit(REAL))
            real.append(part.filter(is_real).select("row_id", entry.alias("entry")))
            made.append(part.filter(~is_real).select(F.concat(F.lit(f"{i}:"), "row_id").alias("row_id"), "features", F.array(entry).alias("entries")))
    entries = reduce(DataFrame.unionAll, real).groupBy("row_id").agg(F.collect_list("entry").alias("entries"))  # at most one a label
    known = base.select("row_id", "features").join(entries, "row_id")
    return write_stage(reduce(DataFrame.unionAll, made, known), "rows")


def _setting(label: int, params: dict[str, int | str], seed: int, without_fold: int | None = None) -> Forest:
    return Forest(
        label, params["n_estimators"], min(params["max_depth"] or MAX_DEPTH, MAX_DEPTH), params["min_samples_split"], params["min_samples_leaf"],
        params["max_features"], params["class_weight"], without_fold, seed,
    )


def _positive_scores(tp: int = 0, fp: int = 0, fn: int = 0, tn: int = 0) -> dict[str, float]:
    """Scores of class 1; 0 where there is nothing to divide by."""

    def share(a: int, b: int) -> float:
        return a / b if b else 0.0

    return {"accuracy": share(tp + tn, tp + fp + fn + tn), "precision": share(tp, tp + fp), "recall": share(tp, tp + fn), "f1": share(2 * tp, 2 * tp + fp + fn)}


def search_together(
    base: DataFrame, sets: Sequence[tuple[DataFrame, DataFrame | None]], n_iter: int = 5, seed: int = 42, folds: int = 2, space: dict | None = None
) -> list[tuple[VotingForest, dict[str, int | str], list[float], dict[str, float]]]:
    """For each label: the forest of the best setting, that setting, the mean f1 of class 1 of every setting, test scores.

    base: row_id (beginning with REAL), features. sets: for each label its training rows (row_id, features,
    label), made-up ones among them, and its test rows or None. Features are binned once; the forests of all
    labels, settings and folds grow in the same scans, and then the forests of the best settings.
    """
    settings = draw_params(n_iter, seed, space)
    rows = _rows_of_labels(base, sets, folds, seed)
    binning = bin_features(rows)
    blocks = pack_rows(rows, binning, len(sets))
    tried = [_setting(i, s, seed, fold) for i in range(len(sets)) for s in settings for fold in range(folds)]
    _, sums = grow_and_score(blocks, tried, binning, keep_trees=False)
    f1 = np.array([_positive_scores(**sums.get(n, {}))["f1"] for n in range(len(tried))]).reshape(len(sets), n_iter, folds).mean(axis=2)
    best = [int(x.argmax()) for x in f1]
    final = [_setting(i, settings[n], seed) for i, n in enumerate(best)]
    trees, tested = grow_and_score(blocks, final, binning)
    out = []
    for i, n in enumerate(best):
        model = VotingForest(trees.filter(F.col("forest") == i), binning)
        out.append((model, settings[n], f1[i].tolist(), _positive_scores(**tested.get(i, {}))))
    drop_stage(blocks)
    drop_stage(rows)
    return out


def random_search(train: DataFrame, n_iter: int = 5, seed: int = 42, folds: int = 2, space: dict | None = None):
    """(model refitted with the best setting, best setting, mean f1 of class 1 of every setting).

    train: row_id, features, label. A single setting is scored like any other.
    """
    named = write_stage(train.withColumn("row_id", F.concat(F.lit(REAL), F.col("row_id").cast("string"))), "train")
    return search_together(named, [(named, None)], n_iter, seed, folds, space)[0][:3]


def _followed(estimator: RandomForestClassifier) -> Forest | None:
    """The settings of an estimator as a Forest; None where it asks for what only Spark's own forest has."""
    known = {"featuresCol", "labelCol", "numTrees", "maxDepth", "seed", "cacheNodeIds"}
    if {p.name for p in estimator.params if estimator.isSet(p)} - known or (estimator.getFeaturesCol(), estimator.getLabelCol()) != ("features", "label"):
        return None
    return replace(_plain(0, estimator.getNumTrees(), None, estimator.getSeed()), max_depth=estimator.getMaxDepth())


def _score(scoring: str, tp: int = 0, fp: int = 0, fn: int = 0, tn: int = 0) -> float:
    """One of SCORES from the counts of a fold."""
    if scoring != "f1_weighted":
        return _positive_scores(tp, fp, fn, tn)[scoring]
    of_one, of_zero = _positive_scores(tp, fp, fn, tn)["f1"], _positive_scores(tn, fn, fp, tp)["f1"]
    return ((tp + fn) * of_one + (tn + fp) * of_zero) / max(1, tp + fp + fn + tn)


def cross_validate(df: DataFrame, estimator: RandomForestClassifier | None = None, cv: int = 5, scoring: str = "accuracy", seed: int = 42) -> tuple[DataFrame, float, float]:
    """(fold, score) per fold, their mean and population standard deviation.

    For labels of 0 and 1 the forests of all folds grow in the same scans.
    """
    estimator = estimator or forest(seed=seed)
    evaluator = MulticlassClassificationEvaluator(**SCORES[scoring])
    folded, setting = add_folds(df, "label", "row_id", cv, seed), _followed(estimator)
    rows = write_stage(folded.select(F.monotonically_increasing_id().alias("row_id"), "features", "label", "fold"), "folds")
    if setting is not None and _is_binary(rows, ["label"]):
        entry = F.struct(F.lit(0).alias("label"), F.col("label").cast("int").alias("y"), F.col("fold").cast("int").alias("fold"))
        entered = rows.select("row_id", "features", F.array(entry).alias("entries"))
        binning = bin_features(entered)
        blocks = pack_rows(entered, binning, 1)
        _, sums = grow_and_score(blocks, [replace(setting, without_fold=i) for i in range(cv)], binning, keep_trees=False)
        drop_stage(blocks)
        scores = [_score(scoring, **sums.get(i, {})) for i in range(cv)]
    else:
        folded = folded.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            scores = []
            for i in range(cv):
                model = estimator.fit(folded.filter(F.col("fold") != i))
                scores.append(float(evaluator.evaluate(model.transform(folded.filter(F.col("fold") == i)))))
        finally:
            folded.unpersist()
    drop_stage(rows)
    table = df.sparkSession.createDataFrame(list(enumerate(scores)), "fold int, score double")
    return table, statistics.fmean(scores), statistics.pstdev(scores)


def feature_importance(models, names: Sequence[str] | None, spark: SparkSession) -> DataFrame:
    """(feature, importance), largest first; several models are averaged; generic names if the given do not fit."""
    models = list(models.values()) if isinstance(models, dict) else [models]
    values = [statistics.fmean(v) for v in zip(*[m.featureImportances.toArray().tolist() for m in models])]
    if names is None or len(names) != len(values):
        names = [f"feature_{i}" for i in range(len(values))]
    table = spark.createDataFrame(list(zip(names, values)), "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def importance_report(importance: DataFrame, cyclical: bool = False, districts: bool = True, top: int | None = 20) -> DataFrame:
    """Importance with its category, without cyclical or district features unless asked for."""
    kept = importance.withColumn("category", feature_category("feature"))
    if not cyclical:
        kept = kept.filter(~is_cyclical_name("feature"))
    if not districts:
        kept = kept.filter(~is_district_name("feature"))
    kept = kept.orderBy(F.desc("importance"), "feature")
    return kept if top is None else kept.limit(top)


def _prepared(
    data: DataFrame, adaptive_resampling: bool, seed: int, resample_before_split: bool, test_size: float
) -> tuple[DataFrame, DataFrame, float, ResamplingStats]:
    """(training rows, test rows, share of positives, what resampling did) of one binary label."""
    counted = data.agg(F.count_if(F.col("label") == 1).alias("p"), F.count(F.lit(1)).alias("n")).first()
    ratio = counted["p"] / counted["n"]
    strategy = determine_resampling_strategy(ratio) if adaptive_resampling else non_adaptive_strategy(ratio)
    if resample_before_split:
        data, stats = resample(data, strategy=strategy, seed=seed)
    marked = mark_test(data, "row_id", test_size, seed, stratify="label")
    train, test = marked.filter(~F.col("is_test")).drop("is_test"), marked.filter("is_test").drop("is_test")
    if not resample_before_split:
        train, stats = resample(train, strategy=strategy, seed=seed)
    return train, test, ratio, stats


def train_single_type_model(
    data: DataFrame,
    n_iter: int = 5,
    adaptive_resampling: bool = True,
    seed: int = 42,
    resample_before_split: bool = False,
    space: dict | None = None,
    test_size: float = 0.2,
) -> TrainedModel:
    """Resample, search, refit and score one binary label.

    data: row_id, features, label. The test rows are set aside first, so that no synthetic row is
    tested; resample_before_split=True does it the other way round. Without adaptive_resampling only
    rare labels are resampled.
    """
    named = write_stage(data.withColumn("row_id", F.concat(F.lit(REAL), F.col("row_id").cast("string"))), "label")
    train, test, ratio, stats = _prepared(named, adaptive_resampling, seed, resample_before_split, test_size)
    model, best, _, metrics = search_together(named, [(train, test)], n_iter, seed, space=space)[0]
    return TrainedModel(model, metrics, best, ratio, stats)


def train_all_types(
    table: DataFrame,
    feature_names: Sequence[str],
    n_iter: int = 5,
    min_samples: int = 50,
    output_dir: str | None = None,
    adaptive_resampling: bool = True,
    seed: int = 42,
    resample_before_split: bool = False,
    space: dict | None = None,
    parallelism: int = 2,
    keep_models: bool = True,
    test_size: float = 0.2,
) -> dict[str, TrainedModel]:
    """One model per label with enough positives, most frequent label first.

    table: row_id, features, type ARRAY<STRING>. Labels are counted in one pass; a few at a time are split and
    resampled, and then the forests of all labels grow in the same scans. With keep_models=False a model that
    has been saved is let go.
    """
    spark = table.sparkSession
    named = write_stage(table.select(F.concat(F.lit(REAL), F.col("row_id").cast("string")).alias("row_id"), "features", "type"), "table")

    def one(label: str) -> tuple[DataFrame, DataFrame, float, ResamplingStats]:
        data = named.select("row_id", "features", F.array_contains("type", label).cast("double").alias("label"))
        return _prepared(data, adaptive_resampling, seed, resample_before_split, test_size)

    enough = class_distribution(named).filter(F.col("positive") >= min_samples)
    labels = [r["label"] for r in enough.select("label").collect()]
    if not labels:
        return {}
    with ThreadPoolExecutor(parallelism) as pool:
        sets = list(pool.map(one, labels))
    found = search_together(named, [(train, test) for train, test, *_ in sets], n_iter, seed, space=space)
    results = {}
    for label, (_, _, ratio, stats), (model, best, _, metrics) in zip(labels, sets, found, strict=True):
        trained = TrainedModel(model, metrics, best, ratio, stats, importance=feature_importance(model, feature_names, spark))
        if output_dir:
            trained.path = save_model(spark, model, f"{output_dir}/{file_name(label)}_model", {"label": label, "features": list(feature_names)})
            trained.model = VotingForest.load(spark, trained.path) if keep_models else None
        results[label] = trained
    if output_dir:
        save_json(spark, f"{output_dir}/feature_names", list(feature_names))
    return results


def training_summary(results: dict[str, TrainedModel], spark: SparkSession) -> DataFrame:
    """One row per label, best f1 first."""
    rows = [
        (name, *[r.metrics[k] for k in ("accuracy", "precision", "recall", "f1")], r.best_params["n_estimators"], r.best_params["max_depth"], r.path)
        for name, r in results.items()
    ]
    kinds = "type string, accuracy double, precision double, recall double, f1 double, n_estimators int, max_depth int, model_file string"
    return spark.createDataFrame(rows, kinds).orderBy(F.desc("f1"), "type")


def file_name(label: str) -> str:
    """A label as part of a path; labels that had to be changed get a digest, so that no two share a name."""
    plain = re.sub(r"[/\\:?#%*\s]", "_", label)
    return plain if plain == label else f"{plain}-{hashlib.md5(label.encode()).hexdigest()[:8]}"


def save_json(spark: SparkSession, path: str, value) -> str:
    spark.createDataFrame([(json.dumps(value, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def load_json(spark: SparkSession, path: str):
    return json.loads(spark.read.text(path).first()["value"])


def save_model(spark: SparkSession, model: RandomForestClassificationModel | VotingForest, path: str, metadata: dict | None = None) -> str:
    if isinstance(model, VotingForest):
        model.save(path)
    else:
        model.write().overwrite().save(path)
    save_json(spark, f"{path}/_about", {"saved_at": datetime.now(UTC).isoformat(), "metadata": metadata or {}})
    return path


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def load_model(spark: SparkSession, path: str) -> tuple[RandomForestClassificationModel | VotingForest, dict]:
    """(model, {saved_at, metadata}); the second part is empty for a model saved without it."""
    about = load_json(spark, f"{path}/_about") if _exists(spark, f"{path}/_about") else {}
    if _exists(spark, f"{path}/bounds"):
        return VotingForest.load(spark, path), about
    return RandomForestClassificationModel.load(path), about


def list_models(spark: SparkSession, folder: str) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    found = [s.getPath().getName() for s in files.listStatus(target)]
    return sorted(f for f in found if f.endswith("_model"))
