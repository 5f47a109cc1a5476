import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wardlight.operators import forest as R
from wardlight.operators import metrics as M

SPACE = {**R.SEARCH_SPACE, "n_estimators": (4, 6), "max_depth": (3, 4)}


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (600, 4))
    rows = []
    for i, r in enumerate(x):
        types = ["any"] + (["high"] if r[0] > 0.5 else []) + (["rare"] if r[1] > 1.9 else []) + (["few"] if i < 20 else [])
        rows.append((str(i), [float(v) for v in r], types))
    df = spark.createDataFrame(rows, "row_id string, f array<double>, type array<string>")
    return df.select("row_id", array_to_vector("f").alias("features"), "type").cache()


def labelled(table, label):
    return table.select("row_id", "features", F.array_contains("type", label).cast("double").alias("label"))


def test_metrics_from_a_hand_counted_table(spark):
    pairs = [(1, 1)] * 6 + [(0, 1)] * 2 + [(1, 0)] * 3 + [(0, 0)] * 9
    df = spark.createDataFrame(pairs, "label int, prediction int")
    got = M.binary_metrics(df).first()
    assert (got["tp"], got["fp"], got["fn"], got["tn"]) == (6, 2, 3, 9)
    assert got["accuracy"] == 0.75 and got["precision"] == 0.75
    assert got["recall"] == pytest.approx(2 / 3) and got["f1"] == pytest.approx(12 / 17)
    weighted = M.weighted_metrics(df).first()
    assert weighted["precision"] == pytest.approx((9 * 0.75 + 11 * 0.75) / 20)
    assert weighted["f1_score"] == pytest.approx((9 * 12 / 17 + 11 * 18 / 23) / 20)


def test_metrics_without_positives_are_zero(spark):
    got = M.binary_metrics(spark.createDataFrame([(0, 0)], "label int, prediction int")).first()
    assert (got["precision"], got["recall"], got["f1"], got["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_drawn_settings_stay_in_range():
    drawn = R.draw_params(50, 1)
    assert drawn == R.draw_params(50, 1)
    assert all(100 <= p["n_estimators"] <= 300 and 10 <= p["max_depth"] <= 30 for p in drawn)
    assert {p["max_features"] for p in drawn} == {"sqrt", "log2"}


def test_feature_columns_and_assembly(spark):
    df = spark.createDataFrame([(1, "x", 2.0, None, 1, 5)], "id int, s string, a double, b double, type_q int, hour int")
    names = R.feature_columns(df, exclude=["id"])
    assert names == ["a", "b", "hour"]
    assert R.assemble(df, "id", names).first()["features"].toArray().tolist() == [2.0, 0.0, 5.0]


def test_cross_validation(table):
    scores, mean, std = R.cross_validate(labelled(table, "high"), R.forest(4, 3), cv=3, scoring="f1")
    values = [r["score"] for r in scores.collect()]
    assert len(values) == 3 and mean == pytest.approx(np.mean(values)) and std == pytest.approx(np.std(values))
    assert mean > 0.8


def test_single_label_both_orders(table):
    for before in (False, True):
        got = R.train_single_type_model(labelled(table, "rare"), n_iter=1, space=SPACE, resample_before_split=before)
        assert got.resampling.strategy == "smote_under" and got.resampling.error is None
        assert set(got.metrics) == {"accuracy", "precision", "recall", "f1"}


def test_a_single_setting_is_scored(table):
    train = labelled(table, "high")
    _, setting, scores = R.random_search(train, n_iter=1, space=SPACE)
    assert len(scores) == 1 and 0 <= scores[0] <= 1 and setting["n_estimators"] >= 1


def test_evaluation_returns_report_and_predictions(table):
    rows = labelled(table, "high")
    made = R.evaluation(R.train_classifier(rows, n_estimators=4, max_depth=3), rows)
    assert made["predictions"].count() == rows.count() and made["report"].count() == 2
    assert all(0 <= v <= 1 for v in made["scores"].first())


def test_the_older_rule_resamples_rare_labels_only(table):
    assert R.train_single_type_model(labelled(table, "rare"), 1, adaptive_resampling=False, space=SPACE).resampling.strategy == "smote_under"
    assert R.train_single_type_model(labelled(table, "high"), 1, adaptive_resampling=False, space=SPACE).resampling.strategy == "class_weight"


def test_no_two_labels_share_a_file_name():
    names = [R.file_name(x) for x in ("a/b", "a_b", "a b", "a:b", "ถนน")]
    assert len(set(names)) == 5 and names[1] == "a_b" and names[4] == "ถนน" and "/" not in names[0]


def test_several_labels_at_once(table):
    both = labelled(table, "high").withColumnRenamed("label", "y0").join(
        labelled(table, "rare").select("row_id", F.col("label").alias("y1")), "row_id"
    )
    models = R.train_classifier(both, ["y0", "y1"], 4, 3)
    got = R.evaluate_classifier(models, both, ["y0", "y1"]).first()
    assert 0.8 < got["accuracy"] <= 1 and set(got.asDict()) >= {"f1_micro", "f1_macro"}
    mean = R.feature_importance(models, list("abcd"), table.sparkSession).collect()
    assert sum(r["importance"] for r in mean) == pytest.approx(1)


def test_all_types_storage_and_summary(spark, table, tmp_path):
    folder = str(tmp_path)
    results = R.train_all_types(table, list("abcd"), n_iter=2, min_samples=100, output_dir=folder, space=SPACE)
    assert list(results) == ["any", "high"]
    summary = R.training_summary(results, spark).collect()
    assert [r["f1"] for r in summary] == sorted((r["f1"] for r in summary), reverse=True)
    assert R.list_models(spark, folder) == ["any_model", "high_model"]
    model, about = R.load_model(spark, f"{folder}/high_model")
    assert about["metadata"]["features"] == list("abcd")
    assert R.load_json(spark, f"{folder}/feature_names") == list("abcd")
    top = R.feature_importance(model, about["metadata"]["features"], spark).first()
    assert top["feature"] == "a"
    assert R.feature_importance(model, ["x"], spark).first()["feature"] == "feature_0"
    plain = str(tmp_path / "plain_model")
    R.train_classifier(labelled(table, "high"), n_estimators=2, max_depth=2).write().overwrite().save(plain)
    assert R.load_model(spark, plain)[1] == {}
    assert all(set(r.best_params) == set(R.SEARCH_SPACE) for r in results.values())


def test_labels_together_are_as_each_alone(spark, table):
    """Every label's forest is what training that label alone gives, whatever else grows in the same scans."""
    results = R.train_all_types(table, list("abcd"), n_iter=2, min_samples=100, space=SPACE)
    alone = R.train_single_type_model(labelled(table, "any"), n_iter=2, space=SPACE)
    assert alone.metrics == results["any"].metrics and alone.best_params == results["any"].best_params
    assert R.train_all_types(table, list("abcd"), min_samples=10**6) == {}


def test_large_forests_score_like_small_ones(table, monkeypatch):
    rows = labelled(table, "high")
    model, _, _ = R.random_search(rows, n_iter=1, space=SPACE)
    small = {r["row_id"]: r["probability"] for r in model.transform(rows).collect()}
    monkeypatch.setattr(R, "SENT_BYTES", 0)
    large = {r["row_id"]: r["probability"] for r in model.transform(rows).collect()}
    assert small.keys() == large.keys() and all(small[k] == pytest.approx(large[k]) for k in small)


def test_plain_forests_of_two_classes_are_tables_of_trees(table):
    """Trees stay a table instead of objects of the driver that every prediction has to carry along."""
    rows = labelled(table, "high")
    models = R.train_classifier(rows.withColumn("other", 1 - F.col("label")), ["label", "other"], 6, 8)
    assert all(isinstance(m, R.VotingForest) for m in models.values())
    got = R.predict_all(models, rows).collect()
    assert sum(r["pred_label"] == r["label"] for r in got) > 560 and sum(r["pred_other"] == 1 - r["label"] for r in got) > 560
    assert set(got[0].asDict()) == {"row_id", "features", "label", "pred_label", "pred_other"}


def test_folds_are_scored_from_counts():
    assert R._score("accuracy", 3, 1, 2, 4) == 0.7 and R._score("precision", 3, 1, 2, 4) == 0.75 and R._score("recall", 3, 1, 2, 4) == 0.6
    assert R._score("f1_weighted", 3, 1, 2, 4) == pytest.approx((5 * 6 / 9 + 5 * 8 / 11) / 10) and R._score("f1") == 0.0


def test_labels_of_three_classes_and_own_settings_keep_spark_forest(spark, table):
    three = table.select("row_id", "features", F.pmod(F.col("row_id").cast("int"), F.lit(3)).cast("double").alias("label"))
    model = R.train_classifier(three, n_estimators=2, max_depth=2)
    assert model.numClasses == 3 and R.evaluate_classifier(model, three).first()["accuracy"] > 0.3
    assert R._followed(R.forest(7, 3)) == R._plain(0, 7, 3, 42) and R._followed(R.forest(7, 3, impurity="entropy")) is None
    scores, _, _ = R.cross_validate(three, R.forest(2, 2), cv=2)
    assert scores.count() == 2
