"""Classifier evaluation from tables of true labels, predicted labels and scores.

Every function takes the columns to group by, ``model_name`` by default, so all models of a
scored table are evaluated together. Scored rows are read for the counts and for the AUC; the
rest works on counts per pair of labels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowlens.functions.values import named
from flowlens.operators.scale import DIRECT_ROWS, split_total
from flowlens.session import stage

METRICS = ["accuracy", "precision", "recall", "f1_score"]
BY = ["model_name"]


def _by(by: list[str] | None) -> list[str]:
    return BY if by is None else by


def label_pairs(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per (true, predicted) label that occurs."""
    return scored.groupBy(*_by(by), "y_true", "y_pred").agg(F.count("*").alias("n"))


def confusion(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows per (true, predicted) label, zeros included, over the labels of each model."""
    keys = _by(by)
    pairs = label_pairs(scored, keys)
    labels = pairs.groupBy(*keys).agg(F.array_distinct(F.flatten(F.collect_set(
        F.array("y_true", "y_pred")))).alias("labels"))
    grid = labels.select(*keys, "labels", F.explode("labels").alias("y_true")).select(
        *keys, "y_true", F.explode("labels").alias("y_pred"))
    # A missing label is a label of its own.
    counts = pairs.select(*[F.col(c).alias(f"_{c}") for c in [*keys, "y_true", "y_pred"]], "n")
    same = [grid[c].eqNullSafe(counts[f"_{c}"]) for c in [*keys, "y_true", "y_pred"]]
    return grid.join(counts, same, "left").select(*keys, "y_true", "y_pred", "n").na.fill(0, ["n"])


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _f1(p: Column, r: Column) -> Column:
    return _ratio(2 * p * r, p + r)


def per_class(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support of each label; 0 where a base is empty."""
    keys = _by(by)
    sides = label_pairs(scored, keys).select(*keys, F.inline(F.array(
        F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"),
                 F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(F.lit(0)).alias("hit")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hit")))))
    sums = sides.groupBy(*keys, "label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hit")])
    scores = sums.withColumn("precision", _ratio(F.col("hit"), F.col("predicted"))).withColumn(
        "recall", _ratio(F.col("hit"), F.col("support")))
    return scores.withColumn("f1_score", _f1(F.col("precision"), F.col("recall"))).select(
        *keys, "label", "precision", "recall", "f1_score", "support", "hit", "predicted")


def summary(scored: DataFrame, by: list[str] | None = None, average: str = "weighted") -> DataFrame:
    """Accuracy, precision, recall and F1 per model; ``weighted``, ``macro`` or ``micro`` average."""
    keys = _by(by)
    classes = per_class(scored, keys)
    hits, total = F.sum("hit"), F.sum("support")
    if average == "weighted":
        means = [_ratio(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in METRICS[1:]]
    elif average == "macro":
        means = [F.avg(m).alias(m) for m in METRICS[1:]]
    elif average == "micro":
        p, r = _ratio(hits, F.sum("predicted")), _ratio(hits, total)
        means = [p.alias("precision"), r.alias("recall"), _f1(p, r).alias("f1_score")]
    else:
        raise ValueError(f"unknown average: {average}")
    return classes.groupBy(*keys).agg(_ratio(hits, total).alias("accuracy"), *means)


def class_report(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per label and one each for ``accuracy``, ``macro avg`` and ``weighted avg``."""
    keys = _by(by)
    columns = [*keys, "label", "precision", "recall", "f1_score", "support"]
    classes = per_class(scored, keys).withColumn("label", F.col("label").cast("string")).withColumn(
        "support", F.col("support").cast("double"))
    support = classes.groupBy(*keys).agg(F.sum("support").alias("support"))

    def averaged(name: str, average: str) -> DataFrame:
        means = summary(scored, keys, average).withColumn("label", F.lit(name))
        return means.join(support, keys or F.lit(True)).select(*columns)

    accuracy = averaged("accuracy", "micro")
    return (classes.select(*columns).unionByName(accuracy)
            .unionByName(averaged("macro avg", "macro"))
            .unionByName(averaged("weighted avg", "weighted")))


def binary_auc(scored: DataFrame, positive: Column, score: str = "score",
               by: list[str] | None = None, rows_per_bucket: int = DIRECT_ROWS) -> DataFrame:
    """Area under the ROC curve of ``score`` for ``positive``; NULL with one class only.

    Rows are tallied per distinct score, and the running count of negatives over the scores is
    split by value, so no task sorts all rows. Equal scores count half.
    """
    keys = _by(by)
    tally = stage(scored.where(named(score).isNotNull()).groupBy(
        *[named(k) for k in keys], named(score).cast("double").alias("score")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")), "scores")
    upto = split_total(tally, keys, "score", {"neg_upto": "neg"}, rows_per_bucket=rows_per_bucket)
    below = (F.col("neg_upto") - F.col("neg")).cast("double") + F.col("neg") / 2
    area, pos, neg = F.sum(F.col("pos") * below), F.sum("pos"), F.sum("neg")
    return upto.groupBy(*keys).agg(F.when((pos > 0) & (neg > 0), area / (
        pos.cast("double") * neg)).alias("roc_auc"))


def multiclass_auc(scored: DataFrame, labels: list, probabilities: str = "probabilities",
                   by: list[str] | None = None) -> DataFrame:
    """Mean one-against-rest area over the labels; with two labels the area of the second."""
    keys = _by(by)
    if len(labels) == 2:
        rows = scored.withColumn("_p", F.get(named(probabilities), F.lit(1)))
        return binary_auc(rows, F.col("y_true") == F.lit(labels[1]), "_p", keys)
    long = scored.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(label).alias("_label"), (F.col("y_true") == F.lit(label)).alias("_is"),
                 F.get(named(probabilities), F.lit(i)).alias("_p")) for i, label in enumerate(labels)])))
    areas = binary_auc(long, F.col("_is"), "_p", [*keys, "_label"])
    whole = F.count("roc_auc") == len(labels)
    return areas.groupBy(*keys).agg(F.when(whole, F.avg("roc_auc")).alias("roc_auc"))


def evaluate(scored: DataFrame, labels: list | None = None, average: str = "weighted") -> DataFrame:
    """One row per model: averages, AUC (NULL without probabilities), matrix and class report."""
    result = summary(scored, average=average)
    if labels is not None and "probabilities" in scored.columns:
        areas = multiclass_auc(scored.where(F.col("probabilities").isNotNull()), labels)
        result = result.join(areas, BY, "left")
    else:
        result = result.withColumn("roc_auc", F.lit(None).cast("double"))
    lines = confusion(scored).groupBy("model_name", "y_true").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("y_pred", "n"))), lambda c: c["n"]).alias("counts"))
    matrix = lines.groupBy("model_name").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("y_true", "counts"))), lambda r: r["counts"])
        .alias("confusion_matrix"))
    report = class_report(scored).groupBy("model_name").agg(F.map_from_entries(F.collect_list(F.struct(
        "label", F.struct("precision", "recall", F.col("f1_score").alias("f1-score"), "support"))))
        .alias("classification_report"))
    return result.join(matrix, BY).join(report, BY)


def comparison(results: DataFrame) -> DataFrame:
    """Models by F1, best first."""
    return results.select("model_name", *METRICS, "roc_auc").orderBy(F.desc("f1_score"), "model_name")


def best_model(results: DataFrame, metric: str = "f1_score", order: list[str] | None = None) -> DataFrame:
    """The model with the highest metric; on a tie the first of ``order``. NULL never wins."""
    place = F.col("model_name") if order is None else F.coalesce(
        F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model_name")), F.lit(0))
    known = results.where(named(metric).isNotNull())
    top = F.min_by(F.struct("model_name", named(metric).alias("value")),
                   F.struct((-named(metric)).alias("m"), place.alias("p")))
    return known.agg(top.alias("best")).where(F.col("best").isNotNull()).select("best.*")


def long_metrics(results: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    return results.unpivot(["model_name"], metrics or METRICS, "metric", "score")


def cv_summary(fold_scores: DataFrame) -> DataFrame:
    """Mean, population deviation and list of the fold accuracies per model."""
    return fold_scores.groupBy("model_name").agg(
        F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("std_accuracy"),
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "accuracy"))),
                    lambda s: s["accuracy"]).alias("scores"))
