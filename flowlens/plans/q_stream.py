"""Queries that run a stream over files to its end and return the sink table.

A window or session counts once the watermark has passed it, so the check SQL of an append
query is its batch twin, limited to what is closed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.functions.timing import from_micros
from flowlens.operators.detect import DETECTION_COLUMNS
from flowlens.operators.flows import FLOW_KEYS
from flowlens.plans.fixtures import view
from flowlens.plans.q_detect import by_window, event_history
from flowlens.plans.q_sources import PACKET_SQL, capture_files
from flowlens.plans.registry import CHECKS, DERIVED, query
from flowlens.session import new_path, tune
from flowlens.sources.pcap import resolved, stream_pcap
from flowlens.streaming import packets as sp, sinks, state

DERIVED["mark"] = "select (max(ts_us) // 1000 - 10000) * 1000 as mark_us from packets"


def landed(spark, df, *parts):
    """The table, or each of its parts, as files in a landing folder."""
    path = new_path(spark, "landing")
    for part in parts or (df,):
        part.write.mode("append").parquet(path)
    return path


def packet_stream(spark, sf, *conditions, max_files=None):
    rows = view(spark, sf, "packets")
    parts = [rows.where(c).coalesce(1) for c in conditions]
    return sp.table_stream(tune(spark), landed(spark, rows, *parts), rows.schema, max_files)


def drained(spark, stream):
    """Everything the stream appends to a table."""
    path = new_path(spark, "sink")
    sinks.append_table(stream, path, new_path(spark, "checkpoint"), available_now=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query("stream_packet_fields", """
select src_ip, dst_ip, protocol, case when protocol = 6 then src_port end as src_port,
       case when protocol = 6 then dst_port end as dst_port, packet_size, protocol_type, ts_us from packets""")
def stream_packet_fields(spark, sf):
    tune(spark)
    path = new_path(spark, "fields")
    tcp = F.col("protocol") == 6
    stamp = F.col("timestamp")
    shown = F.concat(F.date_format(stamp, "MMM"), F.lit(" "), F.lpad(F.date_format(stamp, "d"), 2, " "),
                     F.date_format(stamp, ", yyyy HH:mm:ss.SSSSSS"), F.lit("000 UTC"))
    line = F.concat_ws("\t", shown, "src_ip", "dst_ip", "protocol",
                       F.when(tcp, F.col("src_port").cast("string")).otherwise(""),
                       F.when(tcp, F.col("dst_port").cast("string")).otherwise(""), "packet_size")
    view(spark, sf, "packets").select(line.alias("value")).write.text(path)
    return drained(spark, sp.packet_fields(spark, path)).drop("timestamp")


@query("stream_flow_windows", f"""
with w as (select ts_us // 60000000 * 60000000 as window_us, {', '.join(FLOW_KEYS)}, count(*) as packet_count,
                  cast(sum(packet_size) as bigint) as byte_count from packets group by all)
select w.* from w, mark where window_us + 60000000 <= mark_us""")
def stream_flow_windows(spark, sf):
    out = drained(spark, sp.stream_window_flows(packet_stream(spark, sf), "1 minute"))
    return out.select(F.unix_micros("window_start").alias("window_us"), *FLOW_KEYS, "packet_count", "byte_count")


@query("stream_flow_sessions", """
with marked as (
  select *, case when ts_us - lag(ts_us) over w > 1000000 then 1 else 0 end as opens
  from packets window w as (partition by src_ip, dst_ip, src_port, dst_port, protocol_type order by ts_us)),
numbered as (
  select *, sum(opens) over (partition by src_ip, dst_ip, src_port, dst_port, protocol_type
                             order by ts_us rows unbounded preceding) as session from marked)
select concat_ws('_', src_ip, dst_ip, src_port, dst_port, protocol_type) as flow_key,
       min(ts_us) as session_us, count(*) as packet_count, cast(sum(packet_size) as bigint) as byte_count
from numbered, mark group by src_ip, dst_ip, src_port, dst_port, protocol_type, session
having max(ts_us) + 1000000 <= any_value(mark_us)""")
def stream_flow_sessions(spark, sf):
    out = drained(spark, sp.stream_session_flows(packet_stream(spark, sf), "1 second"))
    return out.select("flow_key", F.unix_micros("session_start").alias("session_us"), "packet_count", "byte_count")


@query("stream_rate_limit", f"select r.* from ({CHECKS['rate_limit_trailing']}) r, mark where r.ts_us < mark_us")
def stream_rate_limit(spark, sf):
    return drained(spark, state.stream_rate_limited(packet_stream(spark, sf), threshold=10))


@query("stream_block_timeline", f"""
select b.* from ({CHECKS['block_timeline']}) b
where ts_us < (select (max(epoch_us(ts)) // 1000 - 10000) * 1000 from events)""")
def stream_block_timeline(spark, sf):
    rows = view(spark, sf, "conn_events").withColumnRenamed("ts", "timestamp")
    stream = sp.table_stream(tune(spark), landed(spark, rows), rows.schema)
    return drained(spark, state.stream_block_timeline(stream))


@query("stream_detect", f"""
select d.* from ({CHECKS['detect_per_window']}) d, mark where window_us + 600000000 <= mark_us""")
def stream_detect(spark, sf):
    path = new_path(spark, "detections")
    flows = sp.stream_window_flows(packet_stream(spark, sf), "10 minutes")
    sinks.detect_closed_windows(flows, path, new_path(spark, "checkpoint"), "2024-01-01T02:00:00Z",
                                available_now=True).awaitTermination()
    return by_window(spark.read.parquet(path))


@query("stream_port_counts", """
select ts_us // 600000000 * 600000000 as window_us, src_ip, count(distinct dst_port) as ports
from packets, mark where ts_us // 600000000 * 600000000 + 600000000 <= mark_us group by 1, 2""")
def stream_port_counts(spark, sf):
    counts = sp.stream_port_counts(packet_stream(spark, sf), "10 minutes")
    return drained(spark, counts).select(F.unix_micros("window_start").alias("window_us"), "src_ip", "ports")


@query("stream_dedup", "select distinct src_ip, dst_ip, src_port, dst_port, protocol, packet_size, flags, ts_us from packets")
def stream_dedup(spark, sf):
    """Every packet lands twice."""
    columns = ["src_ip", "dst_ip", "src_port", "dst_port", "protocol", "packet_size", "flags", "ts_us"]
    stream = packet_stream(spark, sf, F.lit(True), F.lit(True))
    return drained(spark, sp.without_repeats(stream, columns, "2 hours")).select(*columns)


@query("stream_late_rows", """
with w as (select ts_us // 60000000 * 60000000 as window_us, ts_us >= 1704067350000000 as early from packets)
select window_us, count(*) as packets from w, mark
where window_us + 60000000 <= mark_us and early group by window_us""")
def stream_late_rows(spark, sf):
    """The later packets land first, in two files; the mark of the first rules out the third."""
    early = F.col("timestamp") >= from_micros(F.lit(1704067350000000))
    even = F.col("ts_us") % 2 == 0
    stream = packet_stream(spark, sf, early & even, early & ~even, ~early, max_files=1)
    counts = stream.withWatermark("timestamp", "10 seconds").groupBy(F.window("timestamp", "1 minute")).agg(
        F.count("*").alias("packets"))
    return drained(spark, counts).select(F.unix_micros("window.start").alias("window_us"), "packets")


@query("stream_detection_log", """
select event_type as type, 0.8::double as confidence, concat('10.2.0.', user_id % 20) as src_ip,
       '192.168.2.1' as dst_ip, epoch_us(ts) as ts_us, concat('event ', event_id) as details
from events""")
def stream_detection_log(spark, sf):
    rows = event_history(spark, sf)
    stream = sp.table_stream(tune(spark), landed(spark, rows), rows.schema)
    path = new_path(spark, "history")
    log = stream.select(*DETECTION_COLUMNS)
    sinks.detection_log(log, path, new_path(spark, "checkpoint"), available_now=True).awaitTermination()
    out = spark.read.parquet(path)
    return out.withColumn("ts_us", F.unix_micros("timestamp")).drop("timestamp")


@query("stream_pcap_landing", PACKET_SQL)
def stream_pcap_landing(spark, sf):
    """Captures land in groups; the stream stops after each and goes on with the next, so each file is decoded once."""
    tune(spark)
    captures, path, mark = capture_files(spark, sf), new_path(spark, "sink"), new_path(spark, "checkpoint")
    for _ in captures:
        stream = stream_pcap(spark, f"{captures.base}/*", glob="*.pcap")
        sinks.append_table(stream, path, mark, available_now=True).awaitTermination()
    return resolved(spark.read.schema(stream.schema).parquet(path), captures.names).drop("timestamp")
