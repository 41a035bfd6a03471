"""Queries over trained models. Models have no golden numbers, so most have no check SQL."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from flowlens.operators import detect, evaluate as ev, models as ml
from flowlens.plans.fixtures import view
from flowlens.plans.registry import query
from flowlens.session import new_path, stage

_trained: dict[tuple[str, str], tuple] = {}


def trained(spark, sf):
    """Preparation, models, status and scored test rows; trained once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _trained:
        prepared = ml.prepare(view(spark, sf, "training"))
        models, status = ml.train_all(prepared)
        scored = stage(ml.score_all(models, prepared.test), "scored")
        _trained[key] = (prepared, models, status, scored)
    return _trained[key]


@query("model_status", """
select unnest(['random_forest', 'svm', 'xgboost', 'decision_tree', 'logistic_regression']) as model_name,
       true as trained""")
def model_status(spark, sf):
    return trained(spark, sf)[2].select("model_name", "trained")


@query("model_scores")
def model_scores(spark, sf):
    return trained(spark, sf)[3].groupBy("model_name", "y_true", "y_pred").agg(F.count("*").alias("rows"))


TEST_ROWS = "select label, cast(floor(count(*) * 0.2 + 0.5) as bigint) as n from rows_once group by label"
MODELS = "select unnest(['random_forest', 'svm', 'xgboost', 'decision_tree', 'logistic_regression']) as model_name"


@query("model_scores_hold", f"""
with t as ({TEST_ROWS}), m as ({MODELS})
select model_name, label as y_true, n as "rows", n as scored, true as beats_chance from m, t""")
def model_scores_hold(spark, sf):
    """Each model scores every held-out row of every class, and better than chance: its mean recall is above that of guessing."""
    prepared, _, _, scored = trained(spark, sf)
    labels = prepared.preparation.labels
    per = scored.groupBy("model_name", "y_true").agg(
        F.count("*").alias("rows"), F.count_if(F.col("y_pred").isin(labels)).alias("scored"),
        F.avg((F.col("y_true") == F.col("y_pred")).cast("double")).alias("recall"))
    mean = per.groupBy("model_name").agg((F.avg("recall") > 1 / len(labels)).alias("beats_chance"))
    return per.drop("recall").join(mean, "model_name")


@query("model_proba")
def model_proba(spark, sf):
    """The probabilities of all five models."""
    prepared, models, _, _ = trained(spark, sf)
    return ml.score_each(models, prepared.test).select(
        "model_name", "packet_count", "syn_count", "label", "predicted_label", "has_probabilities",
        *[F.round(F.get("probabilities", F.lit(i)), 6).alias(f"p_{v}") for i, v in enumerate(prepared.preparation.labels)])


@query("model_proba_hold", f"""
with t as (select sum(n) as n from ({TEST_ROWS})), m as ({MODELS})
select model_name, cast(n as bigint) as "rows", 0::bigint as off_sum, 0::bigint as off_range, 0::bigint as not_largest,
       0::bigint as off_confidence, model_name <> 'svm' as has_probabilities from m, t""")
def model_proba_hold(spark, sf):
    """Of each model: probabilities outside of 0 to 1, sums that are not 1, predictions that are not the likeliest class, and
    confidences that are not the largest probability (without probabilities: 1 for an attack, else 0)."""
    prepared, models, _, _ = trained(spark, sf)
    p = F.col("probabilities")
    total = F.aggregate(p, F.lit(0.0), lambda a, v: a + v)
    place = F.array_position(F.array(*[F.lit(v) for v in prepared.preparation.labels]), F.col("predicted_label"))
    sure = F.when(F.col("has_probabilities"), F.array_max(p)).otherwise((F.col("predicted_label") != "normal").cast("double"))
    return ml.score_each(models, prepared.test).groupBy("model_name").agg(
        F.count("*").alias("rows"), F.count_if(F.abs(total - 1) > 1e-9).alias("off_sum"),
        F.count_if((F.array_min(p) < 0) | (F.array_max(p) > 1)).alias("off_range"),
        F.count_if(F.get(p, (place - 1).cast("int")) < F.array_max(p) - 1e-12).alias("not_largest"),
        F.count_if(F.abs(F.col("confidence") - sure) > 1e-12).alias("off_confidence"), F.bool_and("has_probabilities").alias("has_probabilities"))


@query("score_confidence")
def score_confidence(spark, sf):
    """Label and confidence of each held-out row by all five models."""
    prepared, models, _, _ = trained(spark, sf)
    return ml.score_each(models, prepared.test).select(
        "model_name", "packet_count", "syn_count", "predicted_label", F.round("confidence", 6).alias("confidence"))


@query("detect_ml")
def detect_ml(spark, sf):
    """The detections of all five models."""
    prepared, models, _, _ = trained(spark, sf)
    out = None
    for name, model in models.items():
        hits = detect.model_hits(ml.score(model, prepared.test), "2024-01-01T02:00:00Z").select(
            F.lit(name).alias("model_name"), "type", "confidence", "src_ip", "dst_ip")
        out = hits if out is None else out.unionByName(hits)
    return out


@query("detect_ml_hold", f"select model_name, 0::bigint as missed, 0::bigint as false_type, 0::bigint as unsure from ({MODELS})")
def detect_ml_hold(spark, sf):
    """Of each model: rows it calls an attack with enough confidence less its detections, and detections that should not be."""
    prepared, models, _, _ = trained(spark, sf)
    attack = (F.col("predicted_label") != "normal") & (F.col("confidence") > 0.7)
    expected = ml.score_each(models, prepared.test).groupBy("model_name").agg(F.count_if(attack).alias("expected"))
    found = detect_ml(spark, sf).groupBy("model_name").agg(
        F.count("*").alias("found"), F.count_if(F.col("type") != detect.MODEL_RULE).alias("false_type"),
        F.count_if(F.col("confidence") <= 0.7).alias("unsure"))
    none = F.lit(0).cast("bigint")
    return expected.join(found, "model_name", "left").select(
        "model_name", (F.col("expected") - F.coalesce("found", none)).alias("missed"), F.coalesce("false_type", none).alias("false_type"),
        F.coalesce("unsure", none).alias("unsure"))


@query("feature_importance")
def feature_importance(spark, sf):
    _, models, _, _ = trained(spark, sf)
    parts = [ml.feature_importance(m, spark).withColumn("model_name", F.lit(n)) for n, m in models.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("model_name", "feature", F.round("importance", 6).alias("importance"))


@query("feature_importance_hold", """
select unnest(['random_forest', 'xgboost', 'decision_tree', 'logistic_regression']) as model_name, 5::bigint as features,
       0::bigint as negative, true as in_order, true as whole""")
def feature_importance_hold(spark, sf):
    """Each model with importances names every input once, by falling importance; those of trees sum to 1. The kernel machine has none."""
    _, models, _, _ = trained(spark, sf)
    out = None
    for name, model in models.items():
        rows = ml.feature_importance(model, spark).withColumn("place", F.monotonically_increasing_id())
        before = F.lag("importance").over(Window.orderBy("place"))  # one row per input
        part = rows.withColumn("before", before).agg(
            F.count_distinct("feature").alias("features"), F.count_if(F.col("importance") < 0).alias("negative"),
            F.bool_and(F.coalesce(F.col("before") >= F.col("importance"), F.lit(True))).alias("in_order"),
            (F.lit(name == "logistic_regression") | (F.abs(F.sum("importance") - 1) < 1e-6)).alias("whole"))
        part = part.select(F.lit(name).alias("model_name"), "*").where("features > 0")
        out = part if out is None else out.unionByName(part)
    return out


@query("model_roundtrip", f"""
select model_name, label, n as "rows", 0::bigint as changed from ({MODELS}), ({TEST_ROWS})""")
def model_roundtrip(spark, sf):
    """All five models, saved and loaded: held-out rows and those whose label or confidence changed."""
    prepared, models, _, _ = trained(spark, sf)
    base, out = new_path(spark, "model"), None
    for name, model in models.items():
        path = f"{base}/{name}"
        ml.save_model(model, path)
        before = ml.score(model, prepared.test)
        after = ml.score(ml.load_model(spark, path), before.withColumnsRenamed({
            "predicted_label": "label_before", "confidence": "confidence_before"}).drop("probabilities", "has_probabilities"))
        same = (F.col("label_before") == F.col("predicted_label")) & (F.col("confidence_before") == F.col("confidence"))
        part = after.groupBy("label").agg(F.count("*").alias("rows"), F.count_if(~same).alias("changed")).withColumn("model_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


# Fewer trees and rounds than in training: each model is fitted once per fold.
FOLD_PARAMS = {"random_forest": {"trees": 20}, "xgboost": {"rounds": 5}, "svm": {"features": 30}}


def folds(spark, sf):
    """Accuracy of each fold of the five models; once per session and folder."""
    key = (spark.sparkContext.applicationId, f"{sf}#folds")
    if key not in _trained:
        _trained[key] = stage(ml.cross_validate_all(trained(spark, sf)[0], params=FOLD_PARAMS), "folds")
    return _trained[key]


@query("cross_validation")
def cross_validation(spark, sf):
    """Five folds of all five models."""
    return ev.cv_summary(folds(spark, sf))


@query("cross_validation_hold", f"select model_name, 5::bigint as folds, 0::bigint as off_range, true as beats_chance from ({MODELS})")
def cross_validation_hold(spark, sf):
    """Each model has five folds with accuracies from 0 to 1; the classes are balanced, so guessing gives a third."""
    return folds(spark, sf).groupBy("model_name").agg(
        F.count_distinct("fold").alias("folds"), F.count_if(~F.col("accuracy").between(0, 1)).alias("off_range"),
        (F.avg("accuracy") > 1 / 3).alias("beats_chance"))


@query("model_comparison")
def model_comparison(spark, sf):
    prepared, _, _, scored = trained(spark, sf)
    return ev.comparison(ev.evaluate(scored, prepared.preparation.labels))


@query("model_comparison_hold", f"select model_name, 0::bigint as off_range, 0::bigint as off_accuracy from ({MODELS})")
def model_comparison_hold(spark, sf):
    """Every metric lies within 0 to 1, and the accuracy is the share of right rows of the score table."""
    _, _, _, scored = trained(spark, sf)
    right = scored.groupBy("model_name").agg(F.avg((F.col("y_true") == F.col("y_pred")).cast("double")).alias("share"))
    off = [~F.col(c).between(0, 1) for c in [*ev.METRICS, "roc_auc"]]
    return model_comparison(spark, sf).join(right, "model_name").groupBy("model_name").agg(
        F.sum(sum((F.coalesce(o, F.lit(False)).cast("bigint") for o in off[1:]), off[0].cast("bigint"))).alias("off_range"),
        F.count_if(F.abs(F.col("accuracy") - F.col("share")) > 1e-9).alias("off_accuracy"))
