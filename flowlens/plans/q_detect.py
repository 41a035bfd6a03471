"""Queries over detections, rate limits and notices."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.functions import timing
from flowlens.operators import detect, history, ports, ranks
from flowlens.operators.flows import flow_features, window_flows
from flowlens.operators.scale import exact_quantiles
from flowlens.plans.fixtures import table, view
from flowlens.plans.registry import query
from flowlens.session import stage, tune

AS_OF = "2024-01-01T02:00:00Z"
SHOWN = ["type", "confidence", "src_ip", "dst_ip"]
RULE_SET = [
    {"description": "Half-open connection", "condition": "conn_state = 'S0' and resp_p = 443",
     "notice_type": "Custom::HalfOpen", "message": "no answer"},
    {"description": "Rejected", "condition": "conn_state = 'REJ'"},
    {"description": "Never fires"},
]


def flows(spark, sf):
    return stage(flow_features(view(spark, sf, "packets")), "flows")


def _rule(spark, sf, rule):
    table = flows(spark, sf)
    column = {"high_packet_rate": "packet_rate", "high_byte_rate": "byte_rate",
              "syn_flood": "syn_count"}[rule]
    share = 0.90 if rule == "syn_flood" else 0.95
    limits = exact_quantiles(table, {column: share})
    return detect.flow_rule_hits(table, limits, AS_OF, rules=[rule]).select(*SHOWN, "flow_key")


def _rule_sql(rule):
    return f"select type, confidence, src_ip, dst_ip, flow_key from detections where type = '{rule}'"


@query("flow_quantiles", """
select 'packet_rate' as feature, 0.95::double as q, round(p_rate, 6) as threshold from limits union all
select 'byte_rate', 0.95::double, round(b_rate, 6) from limits union all
select 'syn_count', 0.9::double, round(syn, 6) from limits""")
def flow_quantiles(spark, sf):
    wanted = {"packet_rate": 0.95, "byte_rate": 0.95, "syn_count": 0.90}
    found = exact_quantiles(flows(spark, sf), wanted)
    return spark.createDataFrame([(c, q, found[c]) for c, q in wanted.items()],
                                 "feature string, q double, threshold double").withColumn(
        "threshold", F.round("threshold", 6))


@query("detect_high_packet_rate", _rule_sql("high_packet_rate"))
def detect_high_packet_rate(spark, sf):
    return _rule(spark, sf, "high_packet_rate")


@query("detect_high_byte_rate", _rule_sql("high_byte_rate"))
def detect_high_byte_rate(spark, sf):
    return _rule(spark, sf, "high_byte_rate")


@query("detect_syn_flood", _rule_sql("syn_flood"))
def detect_syn_flood(spark, sf):
    return _rule(spark, sf, "syn_flood")


@query("detect_port_scan", "select type, confidence, src_ip, dst_ip from detections where type = 'port_scan'")
def detect_port_scan(spark, sf):
    return detect.port_scans(flow_features(view(spark, sf, "packets")), AS_OF).select(*SHOWN)


def statistical(spark, sf):
    return detect.detect_statistical(flows(spark, sf), AS_OF)


@query("detect_all", "select type, confidence, src_ip, dst_ip, flow_key from detections")
def detect_all(spark, sf):
    return statistical(spark, sf).select(*SHOWN, "flow_key")


@query("detect_details", """
select type, flow_key, src_ip, case type when 'high_packet_rate' then 'Packet rate: ' || printf('%.2f', packet_rate)
         when 'high_byte_rate' then 'Byte rate: ' || printf('%.2f', byte_rate) else 'SYN count: ' || syn_count end as details,
       1704074400000000 as ts_us
from detections join flows using (flow_key, src_ip)
union all
select 'port_scan', null, src_ip, 'Unique ports: ' || count(distinct dst_port), 1704074400000000
from flows group by src_ip having count(distinct dst_port) > 50""")
def detect_details(spark, sf):
    return statistical(spark, sf).select("type", "flow_key", "src_ip", "details", F.unix_micros("timestamp").alias("ts_us"))


@query("detect_first_n", """
select type, confidence, src_ip, dst_ip from detections
order by rule_no, flow_key nulls first, src_ip limit 5""")
def detect_first_n(spark, sf):
    return detect.first_detections(statistical(spark, sf)).select(*SHOWN)


@query("detect_empty", "select count(*) as detections from detections where false")
def detect_empty(spark, sf):
    nothing = flow_features(view(spark, sf, "packets")).where(F.col("packet_count") < 0)
    return detect.detect_statistical(nothing, AS_OF).agg(F.count("*").alias("detections"))


@query("detect_zscore", """
with long as (
  select flow_key, unnest(['packet_count', 'byte_count', 'syn_count']) as feature,
         unnest([cast(packet_count as double), cast(byte_count as double), cast(syn_count as double)]) as value
  from flows),
base as (select feature, avg(value) as mean, stddev_pop(value) as std from long group by feature)
select flow_key, feature, value, round(abs(value - mean) / std, 6) as z_score,
       count(*) over (partition by flow_key) as anomaly_count
from long join base using (feature) where abs(value - mean) > 3 * std""")
def detect_zscore(spark, sf):
    table = flows(spark, sf)
    baseline = detect.fit_baseline(table, ["packet_count", "byte_count", "syn_count"])
    hits = detect.detect_outliers(table, baseline).where("is_anomaly")
    return hits.select("flow_key", F.col("anomaly_count").cast("bigint").alias("anomaly_count"),
                       F.inline("anomalies")).select(
        "flow_key", "feature", "value", F.round("z_score", 6).alias("z_score"), "anomaly_count")


@query("detect_per_window", """
with wflows as (
  select ts_us // 600000000 * 600000000 as window_us, src_ip, dst_ip, src_port, dst_port, protocol_type,
         count(*) as packet_count, cast(sum(packet_size) as double) as byte_count,
         cast(max(ts_us) - min(ts_us) as double) / 1000000 as d,
         cast(count(*) filter (protocol_type = 'tcp' and contains(flags, 'S')) as double) as syn_count
  from packets group by all),
rated as (select *, case when d > 0 then packet_count / d else cast(packet_count as double) end as packet_rate,
                 case when d > 0 then byte_count / d else byte_count end as byte_rate
          from wflows),
cuts as (select window_us, quantile_cont(packet_rate, 0.95) as p, quantile_cont(byte_rate, 0.95) as b, quantile_cont(syn_count, 0.90) as s
         from rated group by window_us)
select window_us, 'high_packet_rate' as type, src_ip, dst_ip, count(*) as detections from rated join cuts using (window_us)
where packet_rate > p group by all
union all
select window_us, 'high_byte_rate', src_ip, dst_ip, count(*) from rated join cuts using (window_us)
where byte_rate > b group by all
union all
select window_us, 'syn_flood', src_ip, dst_ip, count(*) from rated join cuts using (window_us)
where syn_count > s and syn_count > 10 group by all
union all
select window_us, 'port_scan', src_ip, 'multiple', 1 from wflows group by window_us, src_ip having count(distinct dst_port) > 50""")
def detect_per_window(spark, sf):
    table = stage(window_flows(view(spark, sf, "packets"), "10 minutes"), "windows")
    return by_window(detect.detect_windows(table, AS_OF))


def by_window(detections):
    """Detections of each window, rule and pair of hosts."""
    return detections.groupBy(F.unix_micros("window_start").alias("window_us"), "type", "src_ip", "dst_ip").agg(
        F.count("*").alias("detections"))


@query("distinct_ports", """
select src_ip, dst_ip, count(distinct dst_port) as ports from packets group by all""")
def distinct_ports(spark, sf):
    return ports.distinct_ports(view(spark, sf, "packets"), ["src_ip", "dst_ip"])


@query("flow_rank_quantiles", """
with long as (
  select protocol_type, unnest(['packet_rate', 'byte_rate', 'flow_duration', 'avg_packet_size']) as feature,
         unnest([packet_rate, byte_rate, flow_duration, avg_packet_size]) as value from flows)
select protocol_type, feature, round(case feature when 'packet_rate' then quantile_cont(value, 0.95)
         when 'byte_rate' then quantile_cont(value, 0.95) else quantile_cont(value, 0.5) end, 6) as value
from long group by protocol_type, feature""")
def flow_rank_quantiles(spark, sf):
    """Quantiles of four columns of each protocol, selected together; brackets of over 100 rows are cut, so several rounds run."""
    columns = {"packet_rate": 0.95, "byte_rate": 0.95, "flow_duration": 0.5, "avg_packet_size": 0.5}
    long = flows(spark, sf).select("protocol_type", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns])))
    share = F.create_map(*[F.lit(x) for pair in columns.items() for x in pair])[F.col("feature")]
    found = ranks.quantiles(long, ["protocol_type", "feature"], "value", share, direct_rows=100, parts=16)
    return found.withColumn("value", F.round("value", 6))


@query("rate_limit_trailing", """
select src_ip, dst_ip, dst_port, ts_us, recent, count(*) as events from (
  select *, count(*) over (partition by src_ip, dst_ip, dst_port order by ts_us
                           range between 59999999 preceding and current row) as recent
  from packets) where recent > 10 group by all""")
def rate_limit_trailing(spark, sf):
    return detect.rate_limited(view(spark, sf, "packets"), threshold=10)


@query("rate_limit_events", """
select src_ip, dst_ip, dst_port, ts_us, recent, count(*) as events from (
  select src_ip, dst_ip, dst_port, epoch_us(ts) as ts_us,
         count(*) over (partition by src_ip, dst_ip, dst_port order by epoch_us(ts)
                        range between 3599999999 preceding and current row) as recent
  from conn_events) where recent > 2 group by all""")
def rate_limit_events(spark, sf):
    return detect.rate_limited(view(spark, sf, "conn_events"), threshold=2,
                               window_us=3600 * timing.MICROS)


@query("rule_notices", """
select "orig_h", "orig_p", "resp_h", "resp_p", 0 as rule_no, 'Half-open connection' as description,
       'connection_state_remove' as event, 'Custom::HalfOpen' as note, 'no answer' as msg
from conn_log where conn_state = 'S0' and resp_p = 443
union all
select "orig_h", "orig_p", "resp_h", "resp_p", 1, 'Rejected', 'connection_state_remove',
       'Custom::Attack', 'Potential attack detected' from conn_log where conn_state = 'REJ'""")
def rule_notices(spark, sf):
    conn = view(spark, sf, "conn_log").withColumnsRenamed(
        {"id.orig_h": "orig_h", "id.orig_p": "orig_p", "id.resp_h": "resp_h", "id.resp_p": "resp_p"})
    return detect.rule_notices(conn, RULE_SET).select(
        "orig_h", "orig_p", "resp_h", "resp_p", "rule_no", "description", "event", "note", "msg")


@query("detection_counts", "select type, count(*) as detections from detections group by type")
def detection_counts(spark, sf):
    return history.counts_by_type(statistical(spark, sf))


def event_history(spark, sf):
    """Events as a detection history with one instant per row."""
    rows = table(spark, sf, "events").withColumnRenamed("event_type", "type")
    return rows.select(
        "event_id", "type", F.lit(0.8).alias("confidence"),
        F.concat(F.lit("10.2.0."), (F.col("user_id") % 20).cast("string")).alias("src_ip"),
        F.lit("192.168.2.1").alias("dst_ip"),
        timing.from_micros(timing.local_micros(F.col("ts"))).alias("timestamp"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("details"))


@query("detection_recent", """
select event_id, event_type as type from events order by ts desc, event_id desc limit 1000""")
def detection_recent(spark, sf):
    return history.most_recent(event_history(spark, sf), ties=["event_id"]).select("event_id", "type")


@query("detection_stats", """
select count(*) as detections_in_all, least(count(*), 1000) as total_detections,
       count(*) filter (event_type = 'error') as errors,
       (select count(*) from orders where o_orderkey * 2 % 700 >= 100) as blocked_ips_count,
       (select string_agg(event_id, ' ' order by ts desc, event_id desc)
        from (select ts, event_id from events order by ts desc, event_id desc limit 10)) as last_ten
from events""")
def detection_stats(spark, sf):
    from flowlens.plans.q_blocks import order_ledger
    stats = history.detection_stats(event_history(spark, sf), order_ledger(spark, sf),
                                    "2024-01-01T00:06:40Z", ties=["event_id"])
    ids = F.transform("recent_detections", lambda r: r["event_id"].cast("string"))
    return stats.select("detections_in_all", "total_detections", F.col("attack_counts")["error"].alias("errors"),
                        "blocked_ips_count", F.array_join(ids, " ").alias("last_ten"))


@query("iso_time_roundtrip", """
select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as iso, epoch_us(ts) as ts_us from events""")
def iso_time_roundtrip(spark, sf):
    tune(spark)  # the text is in UTC
    rows = event_history(spark, sf).select("event_id", timing.iso_text(F.col("timestamp")).alias("iso"))
    return rows.withColumn("ts_us", timing.micros(timing.from_iso(F.col("iso"))))


@query("rate_limit_hot_keys", """
select src_ip, dst_ip, dst_port, ts_us, recent, count(*) as events from (
  select *, count(*) over (partition by src_ip, dst_ip, dst_port order by ts_us
                           range between 59999999 preceding and current row) as recent
  from packets) where recent > 10 group by all""")
def rate_limit_hot_keys(spark, sf):
    """The same, with every key of more than 20 packets treated as a busy one."""
    return detect.rate_limited(view(spark, sf, "packets"), threshold=10, hot_rows=20)
