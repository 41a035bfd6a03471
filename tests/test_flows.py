from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from flowlens.functions import packets as fp, timing, values
from flowlens.operators import flows as fl

PACKET = "src_ip string, dst_ip string, src_port int, dst_port int, protocol_type string, flags string, packet_size int, ts_us bigint"


def packets(spark, rows):
    return spark.createDataFrame(rows, PACKET).withColumn("timestamp", timing.from_micros(F.col("ts_us")))


def one(df):
    return df.collect()[0].asDict()


def test_single_packet_flow_has_null_deviation_and_count_as_rate(spark):
    row = one(fl.flow_features(packets(spark, [("a", "b", 1, 2, "tcp", "S", 60, 5)])))
    assert row["std_packet_size"] is None
    assert (row["flow_duration"], row["packet_rate"], row["byte_rate"]) == (0.0, 1.0, 60.0)
    assert list(row) == fl.FLOW_COLUMNS


def test_equal_times_count_as_no_time(spark):
    row = one(fl.flow_features(packets(spark, [("a", "b", 1, 2, "udp", "", s, 9) for s in (50, 70)])))
    assert (row["packet_rate"], row["byte_rate"]) == (2.0, 120.0)
    assert math.isclose(row["std_packet_size"], 14.142135623730951)


def test_direction_and_flags(spark):
    rows = [("a", "b", 1, 2, "tcp", f, 40, t) for t, f in enumerate(["S", "SA", "FA", "R", ""])]
    rows += [("b", "a", 2, 1, "tcp", "SA", 40, 1), ("a", "b", 1, 2, "udp", "S", 40, 1)]
    out = {r["flow_key"]: r for r in fl.flow_features(packets(spark, rows)).collect()}
    assert set(out) == {"a_b_1_2_tcp", "b_a_2_1_tcp", "a_b_1_2_udp"}
    flow = out["a_b_1_2_tcp"]
    assert [flow[c] for c in fl.FLAG_COUNTS] == [2, 2, 1, 1]
    assert out["a_b_1_2_udp"]["syn_count"] == 0


def test_null_class_is_dropped_and_null_address_is_spelt(spark):
    rows = [("a", "b", 1, 2, None, "", 40, 1), (None, "b", 1, 2, "tcp", None, 40, 1)]
    out = fl.flow_features(packets(spark, rows)).collect()
    assert [(r["flow_key"], r["syn_count"]) for r in out] == [("None_b_1_2_tcp", 0)]


def test_counts_add_up_whatever_the_layout(spark, sf):
    from flowlens.plans.fixtures import view
    rows = view(spark, sf, "packets")
    first = fl.flow_features(rows)
    other = fl.flow_features(rows.repartition(13))
    key = ["flow_key", "packet_count", "byte_count", "packet_rate", "byte_rate"]
    assert first.agg(F.sum("packet_count")).first()[0] == rows.count()
    assert sorted(map(tuple, first.select(key).collect())) == sorted(map(tuple, other.select(key).collect()))


def test_sessions_split_at_a_longer_gap_only(spark):
    gap = 1_000_000
    rows = [("a", "b", 1, 2, "tcp", "S", 40 + t % 7, t) for t in (0, gap, 2 * gap + 1, 2 * gap + 5, 9 * gap)]
    out = fl.session_flows(packets(spark, rows), 1).orderBy("session_start_us").collect()
    assert [(r["session_start_us"], r["session_last_us"], r["packet_count"]) for r in out] == [
        (0, gap, 2), (2 * gap + 1, 2 * gap + 5, 2), (9 * gap, 9 * gap, 1)]


def test_session_deviation_equals_the_direct_one(spark):
    rows = [("a", "b", 1, 2, "tcp", "S", s, i * 400_000) for i, s in enumerate((40, 1500, 60, 700, 701, 90))]
    got = one(fl.session_flows(packets(spark, rows), 1))["std_packet_size"]
    want = one(fl.flow_features(packets(spark, rows)))["std_packet_size"]
    assert math.isclose(got, want, rel_tol=1e-12)


def test_protocol_class_and_letters(spark):
    df = spark.createDataFrame([(6, 0, 0x12), (17, 0, 0), (1, 0, 0), (47, 0, 0), (6, 3, 2)],
                               "p int, frag int, bits int")
    out = df.select(fp.protocol_class(F.col("p"), F.col("frag")), fp.flag_letters(F.col("bits"))).collect()
    assert [tuple(r) for r in out] == [("tcp", "SA"), ("udp", ""), ("icmp", ""), ("other", ""), ("other", "S")]


@pytest.mark.parametrize("text,number", [("-", 0.0), ("(empty)", 0.0), ("NaN", 0.0), ("1e3", 1000.0),
                                         (" 7 ", 7.0), (None, 0.0), ("", 0.0)])
def test_text_to_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(values.to_number(F.col("c"))).first()[0] == number


@pytest.mark.parametrize("text,zone,micros", [
    ("Jan  1, 2024 00:00:07.179575000 UTC", "UTC", 1704067207179575),
    ("Jan 11, 2024 10:00:00.000001000 CET", "Europe/Berlin", 1704963600000001),
    ("garbage", "UTC", None)])
def test_capture_time(spark, text, zone, micros):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(timing.micros(timing.capture_time(F.col("c"), zone))).first()[0] == micros


def test_export_keeps_order_and_skips_missing(spark, sf):
    df = spark.createDataFrame([(1, 2, 3)], "byte_rate int, other int, packet_size int")
    assert fl.export_columns(df).columns == ["packet_size", "byte_rate"]
