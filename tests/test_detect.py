from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from flowlens.operators import blocks, detect, history
from flowlens.schemas import BLOCKS, DETECTIONS

NOW = "2024-01-01 00:10:00"


def flows(spark, rows, schema="flow_key string, src_ip string, dst_ip string, dst_port int, packet_rate double, byte_rate double, syn_count bigint"):
    return spark.createDataFrame(rows, schema)


def test_thresholds_are_strict(spark):
    rows = [(f"f{i}", "a", "b", 80, 1.0, float(i), 10) for i in range(20)]
    found = detect.detect_statistical(flows(spark, rows), NOW).collect()
    assert [(r["type"], r["flow_key"]) for r in found] == [("high_byte_rate", "f19")]
    assert found[0]["details"] == "Byte rate: 19.00"


def test_syn_floor_and_quantile(spark):
    rows = [(f"f{i}", "a", "b", 80, 1.0, 1.0, n) for i, n in enumerate([0] * 18 + [10, 11])]
    found = detect.detect_statistical(flows(spark, rows), NOW).collect()
    assert [(r["type"], r["details"]) for r in found] == [("syn_flood", "SYN count: 11")]


@pytest.mark.parametrize("ports,hits", [(50, 0), (51, 1)])
def test_port_scan_needs_more_than_fifty(spark, ports, hits):
    rows = [(f"f{i}", "a", "b", i, 1.0, 1.0, 0) for i in range(ports)] + [
        ("n", None, "b", p, 1.0, 1.0, 0) for p in range(100)] + [("x", "a", "b", None, 1.0, 1.0, 0)]
    found = detect.port_scans(flows(spark, rows), NOW).collect()
    assert len(found) == hits
    assert all(r["dst_ip"] == "multiple" and r["src_ip"] == "a" for r in found)


def test_missing_columns_leave_rules_out(spark):
    df = spark.createDataFrame([(float(i),) for i in range(40)], "packet_rate double")
    found = detect.detect_statistical(df, NOW).collect()
    assert {(r["type"], r["src_ip"], r["dst_ip"]) for r in found} == {("high_packet_rate", "unknown", "unknown")}
    assert len(found) == 2
    assert detect.detect_statistical(df.select(F.lit(1).alias("x")), NOW).count() == 0


def test_empty_input(spark):
    assert detect.detect_statistical(flows(spark, []), NOW).count() == 0


def test_outliers_list_each_feature(spark):
    df = spark.createDataFrame([(float(i % 2), 5.0) for i in range(100)] + [(50.0, 6.0)], "a double, b double")
    base = spark.createDataFrame([("a", 0.5, 0.5), ("b", 5.0, 0.0), ("c", 1.0, 1.0)], "feature string, mean double, std double")
    hit = detect.detect_outliers(df, base).where("is_anomaly").collect()
    assert len(hit) == 1 and hit[0]["anomaly_count"] == 2
    assert [(a["feature"], a["z_score"]) for a in hit[0]["anomalies"]] == [("a", 99.0), ("b", float("inf"))]


def test_model_hits(spark):
    df = spark.createDataFrame([("a", "ddos", 0.7), ("b", "ddos", 0.71), ("c", "normal", 0.99), ("d", "dos", 0.9)],
                               "src_ip string, predicted_label string, confidence double")
    assert {r["src_ip"] for r in detect.model_hits(df, NOW).collect()} == {"b", "d"}
    assert {r["src_ip"] for r in detect.model_hits(df, NOW, attack_labels=["dos"]).collect()} == {"d"}


def test_bad_rule_fails_when_given(spark):
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(Exception, match="nope"):
        detect.rule_notices(df, [{"condition": "nope > 1"}])
    assert detect.rule_notices(df, [{"description": "no condition"}]).count() == 0


def ledger(spark, rows):
    at = [(ip, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), why, d) for ip, s, why, d in rows]
    return spark.createDataFrame(at, BLOCKS)


def test_block_holds_at_exactly_its_duration(spark):
    table = ledger(spark, [("on", 300, "r", 300), ("off", 299, "r", 300)])
    assert [r["ip"] for r in blocks.active_blocks(table, NOW).collect()] == ["on"]
    assert {r["ip"]: r["remaining_seconds"] for r in blocks.block_list(table, NOW).collect()} == {"on": 0, "off": -1}
    assert blocks.block_list(table, NOW, only_active=True).count() == 1


def detections(spark, rows):
    return spark.createDataFrame(
        [(t, c, s, "d", dt.datetime(2024, 1, 1), "", n, f"k{n}") for n, (t, c, s) in enumerate(rows)],
        DETECTIONS + ", rule_no int, flow_key string")


def test_who_gets_blocked(spark):
    found = detections(spark, [("low", 0.7, "a"), ("first", 0.8, "a"), ("second", 0.9, "a"), ("x", 0.9, "unknown"),
                               ("x", 0.9, None), ("x", 0.9, ""), ("x", 0.9, "held"), ("x", 0.9, "over")])
    table = ledger(spark, [("held", 500, "r", 300), ("over", 0, "r", 300)])
    new = blocks.new_blocks(found, table, NOW)
    assert {(r["ip"], r["reason"], r["duration"]) for r in new.collect()} == {("a", "first", 300), ("over", "x", 300)}
    assert blocks.new_blocks(found, table, NOW, auto_block=False).count() == 0
    after = {r["ip"]: r["reason"] for r in blocks.cleanup(blocks.upsert(table, new), NOW).collect()}
    assert after == {"a": "first", "over": "x", "held": "r"}


def test_blocks_of_an_ip_never_overlap(spark, sf):
    from pyspark.sql import Window

    from flowlens.plans.fixtures import view
    out = blocks.block_timeline(view(spark, sf, "packets"), duration=2)
    gap = F.col("ts_us") - F.lag("ts_us").over(Window.partitionBy("ip").orderBy("ts_us"))
    assert out.withColumn("gap", gap).where("gap <= 2000000").count() == 0


def test_history(spark):
    found = detections(spark, [("a", 0.8, "x")] * 12 + [("b", 0.9, "y")])
    assert {r["type"]: r["detections"] for r in history.counts_by_type(found).collect()} == {"a": 12, "b": 1}
    assert history.most_recent(found, 10, ties=["rule_no"]).count() == 10
    row = history.detection_stats(found, ledger(spark, [("i", 500, "r", 300)]), NOW, kept=5).first()
    assert (row["total_detections"], row["detections_in_all"], row["blocked_ips_count"]) == (5, 13, 1)
    assert row["attack_counts"] == {"a": 12, "b": 1}


def test_every_detection_names_a_flow(spark, sf):
    from flowlens.plans.q_detect import flows as flow_table
    table = flow_table(spark, sf)
    found = detect.detect_statistical(table, NOW)
    assert found.where("flow_key is not null").join(table, "flow_key", "left_anti").count() == 0


def test_thresholds_of_windows_when_split(spark, sf):
    from flowlens.operators.flows import window_flows
    from flowlens.plans.fixtures import view
    table = window_flows(view(spark, sf, "packets"), "1 minute")
    a = detect.window_thresholds(table).orderBy("window_start").collect()
    b = detect.window_thresholds(table, rows_per_bucket=50).orderBy("window_start").collect()
    assert a == b and len(a) > 3


def test_confusion_counts_missing_labels(spark):
    from flowlens.operators import evaluate
    scored = spark.createDataFrame([("m", t, p) for t in ("a", None) for p in ("a", None)], "model_name string, y_true string, y_pred string")
    got = {(r.y_true, r.y_pred): r.n for r in evaluate.confusion(scored).collect()}
    assert got == {(t, p): 1 for t in ("a", None) for p in ("a", None)}


def test_unknown_parameters_are_refused(spark):
    from flowlens.operators import models
    with pytest.raises(ValueError, match="unknown parameters"):
        models.estimator_stages("decision_tree", 2, 10, params={"leaves": 3})
