"""Classifiers on prepared features, with the preparation inside the saved model."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, OneVsRest,
    RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlens import settings
from flowlens.functions.values import columns_of, named
from flowlens.operators import features as ft
from flowlens.operators.smote import oversample
from flowlens.session import stage

MAX_BINS = 256
MAX_VOCABULARY = 100_000
LEAST_PARTITION_ROWS, MOST_PARTITION_ROWS = 5_000, 1_000_000


@dataclass
class Preparation:
    """What was fitted on the training rows."""
    target: str
    inputs: list[str]
    labels: list[str]
    fills: dict[str, float | str] = field(default_factory=dict)
    vocabularies: dict[str, list[str]] = field(default_factory=dict)
    scaler: dict[str, tuple[float, float]] = field(default_factory=dict)


@dataclass
class Prepared:
    """Training rows in feature space, raw test rows, and the preparation between them."""
    train: DataFrame
    test: DataFrame
    preparation: Preparation


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql(expressions: dict[str, str]) -> SQLTransformer:
    parts = ", ".join(f"{e} AS {_quoted(c)}" for c, e in expressions.items())
    return SQLTransformer(statement=f"SELECT *, {parts} FROM __THIS__")


def input_stages(prep: Preparation) -> list:
    """Raw columns to unscaled numeric inputs ``x_<name>``: gaps filled, text coded."""
    fills, stages = {}, []
    for c in prep.inputs:
        value = prep.fills.get(c)
        if c in prep.vocabularies:
            raw = f"CAST({_quoted(c)} AS STRING)"
            fills[f"t_{c}"] = raw if value is None else f"coalesce({raw}, {_text(str(value))})"
        else:
            raw = f"nanvl(CAST({_quoted(c)} AS DOUBLE), NULL)"
            fills[f"x_{c}"] = raw if value is None else f"coalesce({raw}, {float(value)!r}D)"
    stages.append(_sql(fills))
    for c, words in prep.vocabularies.items():
        stages.append(StringIndexerModel.from_labels(words, f"t_{c}", f"x_{c}", "error"))
    return stages


def vector_stages(prep: Preparation) -> list:
    """Inputs ``x_<name>`` to the scaled vector ``features``."""
    scaled = {}
    for c in prep.inputs:
        mean, std = prep.scaler.get(c, (0.0, 1.0))
        scaled[f"z_{c}"] = f"({_quoted(f'x_{c}')} - {float(mean)!r}D) / {float(std or 1.0)!r}D"
    assembler = VectorAssembler(inputCols=list(scaled), outputCol="features")
    return [_sql(scaled), assembler]


def prepare(raw: DataFrame, target: str = "label", smote: bool = True, scale: bool = True,
            share: float = settings.TEST_SHARE, seed: int = settings.SEED,
            order: str | None = None) -> Prepared:
    """Distinct rows, exact stratified split, then everything else fitted on the training part.

    Medians, modes, vocabularies, constant columns and the scaler see training rows only. The
    result holds the training rows with columns ``x_<name>`` and ``label_index``, and the test
    rows as they came.
    """
    distinct = stage(raw.dropDuplicates(), "distinct")
    train, test = ft.stratified_split(distinct, target, share, seed, order)
    fills = ft.fit_fills(train, train.columns)
    filled, inputs = ft.select_features(ft.fill(train, {c: v for c, v in fills.items() if c != target}),
                                        target)
    text = [c for c in columns_of(filled, "text") if c != target]
    codes = stage(ft.fit_codes(filled, [*text, target]), "codes")
    sizes = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count("*").alias("n")).collect()}
    large = [c for c, n in sizes.items() if n > MAX_VOCABULARY]
    if large:
        raise ValueError(f"columns with more than {MAX_VOCABULARY} values are no model input: {large}")
    words: dict[str, list[str]] = {c: [] for c in [*text, target]}
    for r in codes.orderBy("column", "code").collect():
        words[r["column"]].append(r["value"])
    labels = words.pop(target)
    prep = Preparation(target, inputs, labels, {c: v for c, v in fills.items() if c in inputs}, words)
    coded = PipelineModel([*input_stages(prep), label_stage(prep)]).transform(train)
    names = [f"x_{c}" for c in inputs]
    rows = stage(coded.select("label_index", *[named(n) for n in names]), "train")
    if smote:
        rows = stage(oversample(rows, "label_index", names, seed=seed), "resampled")
    if scale:
        fitted = ft.fit_scaler(rows, names)
        prep.scaler = {c: fitted[f"x_{c}"] for c in inputs}
    return Prepared(rows, test, prep)


def label_stage(prep: Preparation) -> StringIndexerModel:
    return StringIndexerModel.from_labels(prep.labels, prep.target, "label_index", "error")


@dataclass
class TrainedModel:
    """A fitted classifier with its preparation; scores raw rows."""
    name: str
    pipeline: PipelineModel
    preparation: Preparation

    @property
    def classifier(self):
        return self.pipeline.stages[-1]


def estimator_stages(name: str, classes: int, rows: int, train: DataFrame | None = None,
                     inputs: Iterable[str] = (), params: dict | None = None) -> list:
    """Derived-column stages, if any, and the learner of a name.

    Boosting and the SVM are one-against-rest above two classes.
    """
    known = settings.MODEL_PARAMS
    if name not in known:
        raise ValueError(f"unknown model: {name}")
    unknown = set(params or {}) - set(known[name])
    if unknown:
        raise ValueError(f"unknown parameters of {name}: {sorted(unknown)}")
    p = {**known[name], **(params or {})}
    columns = {"labelCol": "label_index", "featuresCol": "features"}
    if name == "random_forest":
        return [RandomForestClassifier(numTrees=p["trees"], maxDepth=p["depth"], seed=p["seed"],
                                       maxBins=MAX_BINS, **columns)]
    if name == "decision_tree":
        return [DecisionTreeClassifier(maxDepth=p["depth"], seed=p["seed"], maxBins=MAX_BINS, **columns)]
    if name == "logistic_regression":
        return [LogisticRegression(maxIter=p["max_iter"], regParam=1.0 / (p["C"] * rows),
                                   tol=p["tol"], elasticNetParam=0.0, standardization=False,
                                   **columns)]
    if name == "xgboost":
        boosted = GBTClassifier(maxIter=p["rounds"], maxDepth=p["depth"], stepSize=p["rate"],
                                seed=p["seed"], maxBins=MAX_BINS, **columns)
        return [boosted if classes <= 2 else OneVsRest(classifier=boosted, parallelism=classes, **columns)]
    zs = [f"z_{c}" for c in inputs]
    gamma = p["gamma"]
    if gamma == "scale":
        cells = train.agg(*[F.avg(named(z)).alias(f"m{i}") for i, z in enumerate(zs)],
                          *[F.avg(named(z) * named(z)).alias(f"s{i}") for i, z in enumerate(zs)]).first()
        mean = sum(cells[f"m{i}"] for i in range(len(zs))) / len(zs)
        spread = sum(cells[f"s{i}"] for i in range(len(zs))) / len(zs) - mean * mean
        gamma = 1.0 / (len(zs) * spread) if spread > 0 else 1.0
    rff, assembler = fourier_stages(zs, gamma, p["features"], p["seed"])
    machine = LinearSVC(regParam=1.0 / (p["C"] * rows), maxIter=100, tol=p["tol"], labelCol="label_index",
                        featuresCol="kernel_features")
    if classes > 2:
        machine = OneVsRest(classifier=machine, labelCol="label_index", parallelism=classes,
                            featuresCol="kernel_features")
    return [rff, assembler, machine]


def fourier_stages(inputs: list[str], gamma: float, count: int, seed: int) -> list:
    """Random Fourier features (Rahimi and Recht, 2007) of the RBF kernel as column expressions."""
    rng = np.random.default_rng(seed)
    w = rng.normal(scale=np.sqrt(2 * gamma), size=(count, len(inputs)))
    b = rng.uniform(0, 2 * np.pi, size=count)
    size = float(np.sqrt(2.0 / count))
    waves = {}
    for i in range(count):
        phase = " + ".join(f"{float(v)!r}D * {_quoted(z)}" for v, z in zip(w[i], inputs))
        waves[f"rff_{i}"] = f"{size!r}D * cos({phase} + {float(b[i])!r}D)"
    return [_sql(waves), VectorAssembler(inputCols=list(waves), outputCol="kernel_features")]


def train_model(name: str, prepared: Prepared, params: dict | None = None) -> TrainedModel:
    vectors, rows = _vectors(prepared)
    return _fit(name, prepared, vectors, rows, params)


def _vectors(prepared: Prepared) -> tuple[DataFrame, int]:
    """The training vectors, written in partitions for learning, and their number.

    Learners run very many short jobs: as many partitions as cores, fewer for few rows, more
    only when a partition would get large. A forest draws rows per partition, so the layout is
    the same each time.
    """
    prep = prepared.preparation
    rows = prepared.train.count()
    few, many = math.ceil(rows / LEAST_PARTITION_ROWS), math.ceil(rows / MOST_PARTITION_ROWS)
    cores = prepared.train.sparkSession.sparkContext.defaultParallelism
    out = PipelineModel(vector_stages(prep)).transform(prepared.train).select(
        "label_index", "features", *[named(f"z_{c}") for c in prep.inputs])
    return stage(out.repartition(max(1, many, min(few, cores))), "vectors"), rows


def _fit(name: str, prepared: Prepared, vectors: DataFrame, rows: int, params: dict | None) -> TrainedModel:
    prep = prepared.preparation
    stages = estimator_stages(name, len(prep.labels), rows, vectors, prep.inputs, params)
    *derived, learner = stages
    data = vectors
    if derived:  # derived columns are computed once, not in every pass of the learner
        data = stage(PipelineModel(derived).transform(vectors).select(
            "label_index", learner.getFeaturesCol()), "derived")
    fitted = learner.fit(data)
    return TrainedModel(name, PipelineModel(
        [*input_stages(prep), *vector_stages(prep), *derived, fitted]), prep)


def train_all(prepared: Prepared, names: Iterable[str] | None = None,
              params: dict[str, dict] | None = None) -> tuple[dict[str, TrainedModel], DataFrame]:
    """All models, fitted side by side, and a status table. One that fails is left out and named."""
    wanted = list(names or settings.MODEL_NAMES)
    spark = prepared.train.sparkSession
    vectors, rows = _vectors(prepared)

    def attempt(name: str):
        try:
            return name, _fit(name, prepared, vectors, rows, (params or {}).get(name)), None
        except Exception as e:  # the status table carries it
            return name, None, f"{type(e).__name__}: {e}".splitlines()[0][:500]

    with ThreadPoolExecutor(max_workers=len(wanted)) as pool:
        done = list(pool.map(attempt, wanted))
    status = spark.createDataFrame([(n, m is not None, e) for n, m, e in done],
                                   "model_name string, trained boolean, error string")
    return {n: m for n, m, _ in done if m is not None}, status


def score(model: TrainedModel, raw: DataFrame) -> DataFrame:
    """Raw rows with ``predicted_label``, ``probabilities`` and ``confidence``.

    Probabilities follow the order of the label list. One-against-rest boosting turns the margin
    of each class into a probability and brings the sum to one. A model without probabilities
    gets the one-hot of its prediction, and confidence 1 for an attack, else 0.
    """
    labels = model.preparation.labels
    absent = [c for c in model.preparation.inputs if c not in raw.columns]
    if absent:
        raise ValueError(f"columns the model was trained on are missing: {absent}")
    out = model.pipeline.transform(raw)
    label = F.get(F.array(*[F.lit(v) for v in labels]), F.col("prediction").cast("int"))
    kept = [named(c) for c in raw.columns]
    if "probability" in out.columns:
        probabilities = vector_to_array("probability")
    elif model.name == "xgboost":
        logistic = F.transform(vector_to_array("rawPrediction"), lambda m: 1 / (1 + F.exp(-2 * m)))
        total = F.aggregate(logistic, F.lit(0.0), lambda a, v: a + v)
        probabilities = F.transform(logistic, lambda v: v / total)
    else:
        probabilities = None
    if probabilities is None:
        one_hot = F.array(*[(F.col("prediction") == i).cast("double") for i in range(len(labels))])
        sure = F.when(label != settings.NORMAL_LABEL, 1.0).otherwise(0.0)
        return out.select(*kept, label.alias("predicted_label"), one_hot.alias("probabilities"),
                          sure.alias("confidence"), F.lit(False).alias("has_probabilities"))
    return out.select(*kept, label.alias("predicted_label"), probabilities.alias("probabilities"),
                      F.array_max(probabilities).alias("confidence"),
                      F.lit(True).alias("has_probabilities"))


def score_all(models: dict[str, TrainedModel], raw: DataFrame) -> DataFrame:
    """One table with the rows of every model, ready for evaluation."""
    parts = [score(m, raw).select(
        F.lit(n).alias("model_name"), named(m.preparation.target).cast("string").alias("y_true"),
        F.col("predicted_label").alias("y_pred"), "confidence",
        F.when(F.col("has_probabilities"), F.col("probabilities")).alias("probabilities"))
        for n, m in models.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def named_model(models: dict[str, TrainedModel], name: str) -> TrainedModel:
    if name not in models:
        raise ValueError(f"model {name} is not trained")
    return models[name]


def feature_importance(model: TrainedModel, spark: SparkSession) -> DataFrame:
    """Importance per input, largest first; empty for a model that has none."""
    classifier = model.classifier
    if hasattr(classifier, "featureImportances"):
        weights = classifier.featureImportances.toArray()
    elif model.name == "xgboost":
        weights = np.mean([m.featureImportances.toArray() for m in classifier.models], axis=0)
    elif hasattr(classifier, "coefficientMatrix"):
        weights = np.abs(classifier.coefficientMatrix.toArray()[0])
    else:
        weights = []
    rows = [(c, float(w)) for c, w in zip(model.preparation.inputs, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def cross_validate(name: str, prepared: Prepared, k: int = settings.FOLDS,
                   params: dict | None = None, seed: int = settings.SEED) -> DataFrame:
    """Accuracy per stratified fold: (model_name, fold, accuracy)."""
    spark = prepared.train.sparkSession
    prep = prepared.preparation
    names = [f"x_{c}" for c in prep.inputs]
    rows = stage(ft.mark_folds(prepared.train.select("label_index", *[named(n) for n in names]),
                               "label_index", k, seed), "folds")
    scores = []
    for fold in range(k):
        part = Prepared(rows.where(F.col("fold") != fold).drop("fold"), prepared.test, prep)
        fitted = train_model(name, part, params)
        stages = fitted.pipeline.stages[len(input_stages(prep)):]
        held = PipelineModel(stages).transform(rows.where(F.col("fold") == fold))
        hit = held.agg(F.avg((F.col("prediction") == F.col("label_index")).cast("double"))).first()[0]
        scores.append((name, fold, hit))
    return spark.createDataFrame(scores, "model_name string, fold int, accuracy double")


def cross_validate_all(prepared: Prepared, names: Iterable[str] | None = None, k: int = settings.FOLDS,
                       params: dict[str, dict] | None = None, seed: int = settings.SEED) -> DataFrame:
    """``cross_validate`` of several models, side by side."""
    wanted = list(names or settings.MODEL_NAMES)
    with ThreadPoolExecutor(max_workers=len(wanted)) as pool:
        done = list(pool.map(lambda n: cross_validate(n, prepared, k, (params or {}).get(n), seed), wanted))
    out = done[0]
    for one in done[1:]:
        out = out.unionByName(one)
    return out


def score_each(models: dict[str, TrainedModel], raw: DataFrame) -> DataFrame:
    """``score`` of every model, one below the other, with ``model_name``."""
    parts = [score(m, raw).withColumn("model_name", F.lit(n)) for n, m in models.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def save_model(model: TrainedModel, path: str) -> None:
    """The pipeline and its description below ``path``."""
    spark = SparkSession.active()
    model.pipeline.write().save(f"{path}/pipeline")
    about = {"name": model.name, **vars(model.preparation)}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/about")


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    about = json.loads(spark.read.text(f"{path}/about", wholetext=True).first()["value"])
    name = about.pop("name")
    about["scaler"] = {c: tuple(v) for c, v in about["scaler"].items()}
    return TrainedModel(name, PipelineModel.load(f"{path}/pipeline"), Preparation(**about))
