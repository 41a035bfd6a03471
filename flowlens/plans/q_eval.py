"""Queries over scored predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.operators import evaluate as ev
from flowlens.plans.fixtures import view
from flowlens.plans.registry import DERIVED, query

# Three models over the same labels: the given prediction, a cut on the score, and always 0.
DERIVED["scored"] = """
select 'given' as model_name, doc_id, y_true, y_pred, score from predictions union all
select 'cut', doc_id, y_true, case when score > 0.5 then 1 else 0 end, 1 - score from predictions union all
select 'zero', doc_id, y_true, 0, score * score from predictions"""
DERIVED["classes"] = """
select model_name, label, count(*) filter (y_true = label) as support,
       count(*) filter (y_pred = label) as predicted,
       count(*) filter (y_true = label and y_pred = label) as hit
from scored, (select distinct y_true as label from predictions) group by all"""
DERIVED["class_scores"] = """
select *, case when p + r > 0 then 2 * p * r / (p + r) else 0 end as f from (
  select *, case when predicted > 0 then hit / predicted else 0 end as p,
         case when support > 0 then hit / support else 0 end as r from classes)"""
DERIVED["averages"] = """
select model_name, sum(hit) / sum(support) as accuracy, sum(p * support) / sum(support) as precision,
       sum(r * support) / sum(support) as recall, sum(f * support) / sum(support) as f1_score
from class_scores group by model_name"""
DERIVED["areas"] = """
select model_name, (sum(place) filter (y_true = 1) - any_value(np) * (any_value(np) + 1) / 2)
                   / (any_value(np) * any_value(nn)) as roc_auc
from (select *, rank() over (partition by model_name order by score)
             + (count(*) over (partition by model_name, score) - 1) / 2.0::double as place,
             (count(*) filter (y_true = 1) over (partition by model_name))::double as np,
             (count(*) filter (y_true = 0) over (partition by model_name))::double as nn from scored)
group by model_name"""
ROUNDED = ", ".join(f"round({m}, 9) as {m}" for m in ev.METRICS)


def scored(spark, sf):
    rows = view(spark, sf, "predictions")
    parts = [("given", F.col("y_pred"), F.col("score")),
             ("cut", F.when(F.col("score") > 0.5, 1).otherwise(0), 1 - F.col("score")),
             ("zero", F.lit(0), F.col("score") * F.col("score"))]
    return rows.select("doc_id", "y_true", F.inline(F.array(*[
        F.struct(F.lit(n).alias("model_name"), p.alias("y_pred"), s.alias("score")) for n, p, s in parts])))


def rounded(df, *names):
    return df.select(*[F.round(c, 9).alias(c) if c in names else F.col(c) for c in df.columns])


@query("eval_confusion", """
select model_name, a.label as y_true, b.label as y_pred, count(*) filter (s.y_true = a.label and s.y_pred = b.label) as n
from scored s, (select distinct y_true as label from predictions) a, (select distinct y_true as label from predictions) b
group by all""")
def eval_confusion(spark, sf):
    return ev.confusion(scored(spark, sf))


@query("eval_accuracy", "select model_name, round(accuracy, 9) as accuracy from averages")
def eval_accuracy(spark, sf):
    return rounded(ev.summary(scored(spark, sf)).select("model_name", "accuracy"), "accuracy")


@query("eval_weighted_prf", f"select model_name, {ROUNDED} from averages")
def eval_weighted_prf(spark, sf):
    return rounded(ev.summary(scored(spark, sf)), *ev.METRICS)


@query("eval_macro_prf", """
select model_name, round(avg(p), 9) as precision, round(avg(r), 9) as recall, round(avg(f), 9) as f1_score
from class_scores group by model_name""")
def eval_macro_prf(spark, sf):
    return rounded(ev.summary(scored(spark, sf), average="macro").drop("accuracy"), *ev.METRICS)


@query("eval_roc_auc", "select model_name, round(roc_auc, 9) as roc_auc from areas")
def eval_roc_auc(spark, sf):
    return rounded(ev.binary_auc(scored(spark, sf), F.col("y_true") == 1), "roc_auc")


@query("eval_multiclass_auc", """
with three as (select doc_id % 3 as y_true, unnest([0, 1, 2]) as label,
         unnest([score, (1 - score) / 2, (1 - score) / 2 * ((doc_id % 11) / 10)]) as p
  from predictions),
placed as (select *, rank() over (partition by label order by p)
             + (count(*) over (partition by label, p) - 1) / 2.0::double as place,
             (count(*) filter (y_true = label) over (partition by label))::double as np,
             (count(*) filter (y_true <> label) over (partition by label))::double as nn from three)
select 'three' as model_name, round(avg(auc), 9) as roc_auc from (
  select label, (sum(place) filter (y_true = label) - any_value(np) * (any_value(np) + 1) / 2)
                / (any_value(np) * any_value(nn)) as auc from placed group by label)""")
def eval_multiclass_auc(spark, sf):
    rest = (1 - F.col("score")) / 2
    rows = view(spark, sf, "predictions").select(
        F.lit("three").alias("model_name"), (F.col("doc_id") % 3).cast("int").alias("y_true"),
        F.array("score", rest, rest * ((F.col("doc_id") % 11) / 10)).alias("probabilities"))
    return rounded(ev.multiclass_auc(rows, [0, 1, 2]), "roc_auc")


@query("eval_class_report", """
select model_name, cast(label as varchar) as label, round(p, 9) as precision, round(r, 9) as recall,
       round(f, 9) as f1_score, cast(support as double) as support from class_scores
union all
select model_name, 'accuracy', round(accuracy, 9), round(accuracy, 9), round(accuracy, 9),
       (select cast(count(*) as double) from predictions) from averages
union all
select model_name, 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f), 9), cast(sum(support) as double)
from class_scores group by model_name
union all
select model_name, 'weighted avg', round(precision, 9), round(recall, 9), round(f1_score, 9),
       (select cast(count(*) as double) from predictions) from averages""")
def eval_class_report(spark, sf):
    return rounded(ev.class_report(scored(spark, sf)), *ev.METRICS)


def results(spark, sf):
    rows = scored(spark, sf)
    areas = ev.binary_auc(rows, F.col("y_true") == 1)
    return ev.summary(rows).join(areas, "model_name")


@query("eval_comparison", f"""
select model_name, {ROUNDED}, round(roc_auc, 9) as roc_auc from averages join areas using (model_name)
order by f1_score desc, model_name""")
def eval_comparison(spark, sf):
    return rounded(ev.comparison(results(spark, sf)), *ev.METRICS, "roc_auc")


@query("eval_best_model", """
select model_name, round(f1_score, 9) as value from averages order by f1_score desc, model_name limit 1""")
def eval_best_model(spark, sf):
    return rounded(ev.best_model(results(spark, sf)), "value")


@query("eval_long_metrics", f"""
select * from (unpivot (select model_name, {ROUNDED} from averages) on accuracy, precision, recall, f1_score
into name metric value score)""")
def eval_long_metrics(spark, sf):
    return rounded(ev.long_metrics(results(spark, sf)), "score")


@query("cv_summary", """
select model_name, round(avg(accuracy), 9) as mean_accuracy, round(stddev_pop(accuracy), 9) as std_accuracy,
       cast(count(*) as int) as folds
from (select model_name, doc_id % 5 as fold, avg((y_true = y_pred)::int) as accuracy from scored group by all)
group by model_name""")
def cv_summary(spark, sf):
    folds = scored(spark, sf).groupBy("model_name", (F.col("doc_id") % 5).alias("fold")).agg(
        F.avg((F.col("y_true") == F.col("y_pred")).cast("int")).alias("accuracy"))
    out = ev.cv_summary(folds).select("model_name", "mean_accuracy", "std_accuracy", F.size("scores").alias("folds"))
    return rounded(out, "mean_accuracy", "std_accuracy")
