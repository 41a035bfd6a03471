"""Queries over whole runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from flowlens import settings
from flowlens.operators import evaluate as ev
from flowlens.plans import runs
from flowlens.plans.fixtures import view
from flowlens.plans.q_blocks import LEDGER_AS_OF, order_ledger
from flowlens.plans.q_logs import short
from flowlens.plans.q_models import trained
from flowlens.plans.q_packets import FLOW_SQL
from flowlens.plans.q_sources import CONN_TYPES, capture_files
from flowlens.plans.registry import CHECKS, query
from flowlens.session import new_path, stage, tune
from flowlens.operators.flows import FLOW_KEYS, flow_features
from flowlens.sources import logs, tables


def log_paths(spark, sf):
    base = new_path(spark, "logs")
    for kind in ("conn", "dns", "http"):
        logs.write_log(view(spark, sf, f"{kind}_log"), f"{base}/{kind}", kind, CONN_TYPES)
    return {kind: f"{base}/{kind}" for kind in ("conn", "dns", "http")}


@query("pipe_log_features", """
select orig_h, resp_h, proto, duration, total_bytes, total_pkts, conn_state, orig_byte_rate, query, rtt, method, uri,
       total_transfer from conn_dns_http""")
def pipe_log_features(spark, sf):
    return short(runs.log_features(spark, log_paths(spark, sf))).select(
        "orig_h", "resp_h", "proto", "duration", "total_bytes", "total_pkts", "conn_state", "orig_byte_rate",
        "query", "rtt", "method", "uri", "total_transfer")


@query("pipe_packet_flows", FLOW_SQL)
def pipe_packet_flows(spark, sf):
    captures = capture_files(spark, sf)
    return runs.capture_flows(spark, captures, names=captures.names).select(
        "flow_key", *FLOW_KEYS, "packet_count", "byte_count", "flow_duration", "packet_rate", "byte_rate")


@query("pipe_detect_block", f"""
with opened as ({CHECKS['block_new_candidates']})
select ip, 1704067600000000 as block_us, reason, duration from opened
union all
select ip, block_us, reason, duration from ledger
where 1704067600000000 - block_us <= 300000000 and ip not in (select ip from opened)""")
def pipe_detect_block(spark, sf):
    flows = stage(flow_features(view(spark, sf, "packets")), "flows")
    alarm = runs.detect_and_block(flows, order_ledger(spark, sf), LEDGER_AS_OF)
    return alarm.ledger.withColumn("block_us", F.unix_micros("block_time")).drop("block_time")


@query("pipe_full_summary", f"""
select (select count(*) from conn_dns_http) as log_rows, 36 as log_columns, (select count(*) from flows) as flows,
       19 as flow_columns, (select count(*) from detections) as detections,
       (select count(*) from ({CHECKS['block_new_candidates']})) as blocked_ips, 5::bigint as trained_models, true as best_is_known,
       5::bigint as saved_models, '2024-01-01T00:06:40.000000' as finished""")
def pipe_full_summary(spark, sf):
    """The whole run, training of small models and their saving included."""
    tune(spark)  # the finishing time is shown in UTC
    small = {"random_forest": {"trees": 10, "depth": 5}, "xgboost": {"rounds": 3, "depth": 3}, "svm": {"features": 20},
             "decision_tree": {"depth": 5}, "logistic_regression": {"max_iter": 50}}
    path, at = new_path(spark, "models"), dt.datetime(2024, 1, 1, 0, 6, 40)
    captures = capture_files(spark, sf)
    out = runs.full_run(spark, captures, log_paths(spark, sf), order_ledger(spark, sf), view(spark, sf, "training"),
                        LEDGER_AS_OF, small, path, at, captures.names)
    saved = spark.read.text(f"{path}/*_20240101_000640/about", wholetext=True).agg(F.count("*").alias("saved_models"))
    return out.withColumn("best_is_known", F.col("best_model").isin(*settings.MODEL_NAMES)).drop("best_model").join(saved, F.lit(True))


@query("pipe_train_evaluate")
def pipe_train_evaluate(spark, sf):
    prepared, models, _, _ = trained(spark, sf)
    results, best = runs.evaluate_models(prepared, models, new_path(spark, "evaluation"))
    chosen = best.select(F.col("model_name").alias("best"))
    return ev.comparison(results).join(chosen, F.col("model_name") == F.col("best"), "left").select(
        "model_name", *ev.METRICS, "roc_auc", F.col("best").isNotNull().alias("is_best"))


@query("pipe_train_evaluate_hold", """
select 5::bigint as models, 1::bigint as best, true as best_is_first, 5::bigint as saved""")
def pipe_train_evaluate_hold(spark, sf):
    """One model is chosen, none has a larger F1, and the saved evaluation holds all of them."""
    prepared, models, _, _ = trained(spark, sf)
    path = new_path(spark, "evaluation")
    results, best = runs.evaluate_models(prepared, models, path)
    top = results.agg(F.max("f1_score").alias("top"), F.count("*").alias("models"))
    chosen = results.join(best.select("model_name"), "model_name").agg(F.count("*").alias("best"), F.max("f1_score").alias("f1"))
    saved = tables.load_evaluation(spark, path).agg(F.count("*").alias("saved"))
    return top.join(chosen, F.lit(True)).join(saved, F.lit(True)).select(
        "models", "best", (F.col("f1") == F.col("top")).alias("best_is_first"), "saved")
