from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowlens.functions.values import columns_of
from flowlens.operators import evaluate as ev, features as ft, models as ml
from flowlens.plans import runs
from flowlens.plans.fixtures import view
from flowlens.schemas import EVALUATION
from flowlens.session import new_path

QUICK = {"random_forest": {"trees": 10, "depth": 6}, "xgboost": {"rounds": 5, "depth": 4},
         "logistic_regression": {"max_iter": 50}}


@pytest.fixture(scope="module")
def run(spark, sf):
    return runs.train(view(spark, sf, "training"), params=QUICK)


def test_mode_takes_the_smallest_on_a_tie_and_unknown_without_values(spark):
    df = spark.createDataFrame([("b", None), ("a", None), (None, None)], "x string, y string")
    assert ft.modes(df, ["x", "y"]) == {"x": "a", "y": "unknown"}


def test_clean(spark):
    rows = [(1, 1.0, "a"), (1, 1.0, "a"), (2, None, "b"), (3, 4.0, None), (4, float("nan"), "b")]
    out = ft.clean(spark.createDataFrame(rows, "k int, v double, s string")).orderBy("k").collect()
    assert [tuple(r) for r in out] == [(1, 1.0, "a"), (2, 2.5, "b"), (3, 4.0, "b"), (4, 2.5, "b")]


def test_integer_gaps_take_a_fractional_median(spark):
    out = ft.clean(spark.createDataFrame([(1, 1), (2, 2), (3, None)], "k int, v int")).orderBy("k").collect()
    assert [r["v"] for r in out] == [1.0, 2.0, 1.5]


def test_quality_counts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, None)], "a int, b string")
    assert tuple(ft.quality_counts(df).first()) == (4, 4, 1)
    assert tuple(ft.quality_counts(df.limit(0)).first()) == (0, 0, 0)


def test_codes_sort_as_text_and_unseen_values_fail(spark):
    df = spark.createDataFrame([(10,), (2,), (1,)], "n int")
    codes = ft.fit_codes(df, ["n"])
    assert {r["value"]: r["code"] for r in codes.collect()} == {"1": 0, "10": 1, "2": 2}
    with pytest.raises(Exception, match="no code for n = 7"):
        ft.encode(spark.createDataFrame([(7,)], "n int"), codes, ["n"]).collect()


def test_constant_columns_and_target(spark):
    df = spark.createDataFrame([(1, None, "x", 5.0), (2, None, "x", None)], "t int, empty string, same string, one double")
    assert ft.constant_columns(df) == ["empty", "same", "one"]
    with pytest.raises(ValueError, match="single value"):
        ft.select_features(df, "same")
    kept, names = ft.select_features(df.withColumn("uri", F.col("t")), "t")
    assert kept.columns == ["t"] and names == []


def test_scaler_without_spread(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "a double, b double")
    out = ft.scale(df, ft.fit_scaler(df, ["a", "b"])).orderBy("b").collect()
    assert [tuple(r) for r in out] == [(0.0, -1.0), (0.0, 1.0)]


def test_column_kinds(spark):
    df = spark.createDataFrame([(1, 1.0, "x", True)], "a int, b double, c string, d boolean")
    assert (columns_of(df, "numeric"), columns_of(df, "text")) == (["a", "b"], ["c"])


def test_training_rows_are_balanced_and_scaled_on_themselves(run):
    prepared, models, status = run
    sizes = {r[0]: r[1] for r in prepared.train.groupBy("label_index").count().collect()}
    assert len(set(sizes.values())) == 1 and len(sizes) == 3
    assert prepared.preparation.labels == ["ddos", "normal", "port_scan"]
    assert "constant_col" not in prepared.preparation.inputs
    assert status.where("trained").count() == 5 == len(models)


def test_models_beat_the_majority(run):
    prepared, models, _ = run
    results, best = runs.evaluate_models(prepared, models)
    got = {r["model_name"]: r for r in results.collect()}
    base = ev.summary(prepared.test.select(F.lit("base").alias("model_name"), F.col("label").alias("y_true"),
                                           F.lit("normal").alias("y_pred"))).first()["f1_score"]
    for name in ("random_forest", "xgboost", "decision_tree"):
        assert got[name]["f1_score"] > base and got[name]["roc_auc"] > 0.9
    assert got["svm"]["roc_auc"] is None and got["svm"]["f1_score"] > 0.5
    assert best.first()["model_name"] in got
    with pytest.raises(ValueError, match="proto"):
        ml.score(models["svm"], prepared.test.drop("proto"))


def test_probabilities(run):
    prepared, models, _ = run
    for name, model in models.items():
        out = ml.score(model, prepared.test)
        total = F.aggregate("probabilities", F.lit(0.0), lambda a, v: a + v)
        bad = (F.size("probabilities") != 3) | (F.abs(total - 1) > 1e-9)
        assert out.where(bad).count() == 0
        if name == "svm":
            assert out.where(~F.col("confidence").isin(0.0, 1.0)).count() == 0


def test_training_is_repeatable(spark, run):
    prepared, models, _ = run
    again = ml.train_model("random_forest", prepared, QUICK["random_forest"])
    a = ml.score(models["random_forest"], prepared.test).select("predicted_label", "confidence").collect()
    b = ml.score(again, prepared.test).select("predicted_label", "confidence").collect()
    assert a == b


@pytest.mark.parametrize("name", ["random_forest", "svm", "xgboost", "logistic_regression"])
def test_saved_models_predict_the_same(spark, run, name):
    prepared, models, _ = run
    path = new_path(spark, "model")
    ml.save_model(models[name], path)
    loaded = ml.load_model(spark, path)
    key = ["predicted_label", "confidence"]
    assert ml.score(models[name], prepared.test).select(key).collect() == ml.score(loaded, prepared.test).select(key).collect()
    assert loaded.preparation == models[name].preparation


def test_unseen_value_in_scoring_fails(run):
    prepared, models, _ = run
    with pytest.raises(Exception):
        ml.score(models["decision_tree"], prepared.test.withColumn("proto", F.lit("new"))).collect()


def test_unknown_models(run):
    prepared, models, _ = run
    with pytest.raises(ValueError, match="unknown model"):
        ml.train_model("nope", prepared)
    with pytest.raises(ValueError, match="not trained"):
        ml.named_model(models, "nope")
    fitted, status = ml.train_all(prepared, ["decision_tree", "nope"])
    assert list(fitted) == ["decision_tree"]
    assert status.where("not trained").first()["error"].startswith("ValueError: unknown model")


def test_importance(spark, run):
    _, models, _ = run
    for name in ("random_forest", "xgboost", "logistic_regression"):
        weights = [r["importance"] for r in ml.feature_importance(models[name], spark).collect()]
        assert weights == sorted(weights, reverse=True) and len(weights) == 5
    assert ml.feature_importance(models["svm"], spark).count() == 0


def test_cross_validation(run):
    prepared, _, _ = run
    folds = ml.cross_validate("decision_tree", prepared, k=3)
    row = ev.cv_summary(folds).first()
    assert len(row["scores"]) == 3 and 0.5 < row["mean_accuracy"] <= 1


SCORES = "model_name string, y_true int, y_pred int, score double"


def test_auc_with_one_class_is_null(spark):
    df = spark.createDataFrame([("m", 1, 1, 0.5), ("m", 1, 0, 0.1)], SCORES)
    assert ev.binary_auc(df, F.col("y_true") == 1).first()["roc_auc"] is None


def test_auc_when_split(spark):
    rows = [(f"m{i % 2}", int(i * 31 % 7 < 3), 0, i * 17 % 101 / 100) for i in range(500)]
    df = spark.createDataFrame(rows, SCORES)
    a = ev.binary_auc(df, F.col("y_true") == 1).orderBy("model_name").collect()
    b = ev.binary_auc(df, F.col("y_true") == 1, rows_per_bucket=10).orderBy("model_name").collect()
    assert a == b


def test_best_model_ignores_null_and_keeps_the_first_on_a_tie(spark):
    df = spark.createDataFrame([("a", None), ("b", 0.5), ("c", 0.5)], "model_name string, roc_auc double")
    assert ev.best_model(df, "roc_auc", ["c", "b", "a"]).first()["model_name"] == "c"
    assert ev.best_model(df, "roc_auc").first()["model_name"] == "b"


def test_evaluation_schema(spark):
    df = spark.createDataFrame([("m", 1, 1, 0.5), ("m", 0, 1, 0.1)], SCORES)
    out = ev.evaluate(df)
    assert out.select(*[f.name for f in spark.createDataFrame([], EVALUATION).schema]).schema.simpleString() == \
        spark.createDataFrame([], EVALUATION).schema.simpleString()
    assert out.first()["confusion_matrix"] == [[0, 1], [0, 1]]
