"""Queries over packets and flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.functions.packets import flag_letters, flow_key, protocol_class
from flowlens.operators import flows as fl
from flowlens.plans.fixtures import table, view
from flowlens.plans.registry import query

FLOW_SQL = """
select flow_key, src_ip, dst_ip, src_port, dst_port, protocol_type, packet_count, byte_count,
       flow_duration, packet_rate, byte_rate from flows"""


def packets(spark, sf):
    return view(spark, sf, "packets")


def flows(spark, sf):
    return fl.flow_features(packets(spark, sf))


@query("packet_protocol_class",
       "select protocol_type, protocol, count(*) as packets from packets group by all")
def packet_protocol_class(spark, sf):
    rows = packets(spark, sf).select("protocol", protocol_class(F.col("protocol")).alias("protocol_type"))
    return rows.groupBy("protocol_type", "protocol").agg(F.count("*").alias("packets"))


@query("tcp_flag_text", """
select bits, count(*) as packets,
       concat(case when bits & 1 <> 0 then 'F' else '' end, case when bits & 2 <> 0 then 'S' else '' end,
              case when bits & 4 <> 0 then 'R' else '' end, case when bits & 8 <> 0 then 'P' else '' end,
              case when bits & 16 <> 0 then 'A' else '' end, case when bits & 32 <> 0 then 'U' else '' end,
              case when bits & 64 <> 0 then 'E' else '' end, case when bits & 128 <> 0 then 'C' else '' end,
              case when bits & 256 <> 0 then 'N' else '' end) as letters
from (select cast((l_partkey * 31 + l_orderkey) % 512 as int) as bits from lineitem) group by bits""")
def tcp_flag_text(spark, sf):
    bits = table(spark, sf, "lineitem").select(
        ((F.col("l_partkey") * 31 + F.col("l_orderkey")) % 512).cast("int").alias("bits"))
    return bits.groupBy("bits", flag_letters(F.col("bits")).alias("letters")).agg(
        F.count("*").alias("packets"))


@query("flow_key", """
select concat_ws('_', src_ip, dst_ip, src_port, dst_port, protocol_type) as flow_key, count(*) as packets
from packets group by 1""")
def flow_key_text(spark, sf):
    grouped = packets(spark, sf).groupBy(*fl.FLOW_KEYS).agg(F.count("*").alias("packets"))
    return grouped.select(flow_key(*[F.col(k) for k in fl.FLOW_KEYS]).alias("flow_key"), "packets")


@query("flow_features", FLOW_SQL)
def flow_features(spark, sf):
    return flows(spark, sf).select(
        "flow_key", *fl.FLOW_KEYS, "packet_count", "byte_count", "flow_duration", "packet_rate",
        "byte_rate")


@query("flow_size_stats", """
select flow_key, avg_packet_size, round(std_packet_size, 6) as std_packet_size, min_packet_size,
       max_packet_size from flows""")
def flow_size_stats(spark, sf):
    return flows(spark, sf).select(
        "flow_key", "avg_packet_size", F.round("std_packet_size", 6).alias("std_packet_size"),
        "min_packet_size", "max_packet_size")


@query("flow_tcp_flags", "select flow_key, syn_count, ack_count, fin_count, rst_count from flows")
def flow_tcp_flags(spark, sf):
    return flows(spark, sf).select("flow_key", *fl.FLAG_COUNTS)


@query("flow_summary", """
select count(*) as flows, round(avg(packet_count), 9) as mean_packets, max(packet_count) as max_packets,
       round(avg(byte_count), 6) as mean_bytes, max(byte_count) as max_bytes from flows""")
def flow_summary(spark, sf):
    return fl.flow_summary(flows(spark, sf)).select(
        "flows", F.round("mean_packets", 9).alias("mean_packets"), "max_packets",
        F.round("mean_bytes", 6).alias("mean_bytes"), "max_bytes")


@query("top_flows", """
select flow_key, src_ip, dst_ip, packet_count from flows order by packet_count desc, flow_key limit 5""")
def top_flows(spark, sf):
    return fl.top_flows(flows(spark, sf)).select("flow_key", "src_ip", "dst_ip", "packet_count")


@query("flows_ordered", "select flow_key, packet_count, byte_count from flows order by flow_key")
def flows_ordered(spark, sf):
    return fl.in_key_order(flows(spark, sf).select("flow_key", "packet_count", "byte_count"))


@query("packet_cap", "select least(count(*), 10000) as kept from packets")
def packet_cap(spark, sf):
    return packets(spark, sf).limit(10_000).agg(F.count("*").alias("kept"))


@query("packet_filter", """
select src_ip, dst_ip, dst_port, flags, packet_size, ts_us from packets
where protocol_type = 'tcp' and dst_port = 443 and packet_size > 1000""")
def packet_filter(spark, sf):
    return packets(spark, sf).where(
        (F.col("protocol_type") == "tcp") & (F.col("dst_port") == 443) & (F.col("packet_size") > 1000)
    ).select("src_ip", "dst_ip", "dst_port", "flags", "packet_size", "ts_us")


@query("export_columns",
       "select src_port, dst_port, flow_duration, packet_count, byte_count, packet_rate, byte_rate from flows")
def export_columns(spark, sf):
    return fl.export_columns(flows(spark, sf))


@query("protocol_hierarchy", """
select case when grouping(protocol_type) = 1 then 'ip' else concat('ip:', protocol_type) end as protocol,
       count(*) as frames, cast(sum(packet_size) as bigint) as bytes
from packets group by rollup (protocol_type)""")
def protocol_hierarchy(spark, sf):
    return fl.protocol_hierarchy(packets(spark, sf))


@query("flow_window_features", """
select ts_us // 60000000 * 60000000 as window_us, src_ip, dst_ip, src_port, dst_port, protocol_type,
       count(*) as packet_count, cast(sum(packet_size) as bigint) as byte_count,
       cast(max(ts_us) - min(ts_us) as double) / 1000000 as flow_duration,
       count(*) filter (protocol_type = 'tcp' and contains(flags, 'S')) as syn_count
from packets group by all""")
def flow_window_features(spark, sf):
    out = fl.window_flows(packets(spark, sf), "1 minute")
    return out.select(F.unix_micros("window_start").alias("window_us"), *fl.FLOW_KEYS,
                      "packet_count", "byte_count", "flow_duration", "syn_count")


@query("flow_sliding_windows", """
select w.window_us, src_ip, dst_ip, src_port, dst_port, protocol_type, count(*) as packet_count
from packets, (select unnest([0, 30000000]) as back) b,
     lateral (select (ts_us // 30000000 * 30000000) - back as window_us) w
group by all""")
def flow_sliding_windows(spark, sf):
    out = fl.window_flows(packets(spark, sf), "1 minute", "30 seconds")
    return out.select(F.unix_micros("window_start").alias("window_us"), *fl.FLOW_KEYS, "packet_count")


@query("flow_sessions", """
with marked as (
  select *, case when ts_us - lag(ts_us) over w > 1000000 then 1 else 0 end as opens
  from packets window w as (partition by src_ip, dst_ip, src_port, dst_port, protocol_type order by ts_us)),
numbered as (
  select *, sum(opens) over (partition by src_ip, dst_ip, src_port, dst_port, protocol_type
                             order by ts_us rows unbounded preceding) as session from marked)
select concat_ws('_', src_ip, dst_ip, src_port, dst_port, protocol_type) as flow_key,
       min(ts_us) as session_start_us, max(ts_us) as session_last_us, count(*) as packet_count,
       cast(sum(packet_size) as bigint) as byte_count,
       round(stddev_samp(packet_size), 6) as std_packet_size,
       count(*) filter (protocol_type = 'tcp' and contains(flags, 'S')) as syn_count
from numbered group by src_ip, dst_ip, src_port, dst_port, protocol_type, session""")
def flow_sessions(spark, sf):
    out = fl.session_flows(packets(spark, sf), 1)
    return out.select("flow_key", "session_start_us", "session_last_us", "packet_count",
                      "byte_count", F.round("std_packet_size", 6).alias("std_packet_size"),
                      "syn_count")
