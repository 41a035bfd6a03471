"""Packet streams: reading, flows per window or session, repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlens.functions.packets import protocol_class
from flowlens.functions.timing import capture_time, micros
from flowlens.functions.values import named
from flowlens.operators.flows import FLOW_COLUMNS, flow_features, window_flows
from flowlens.operators.ports import count_ports, port_words
from flowlens.schemas import LIVE_FIELDS


def packet_fields(spark: SparkSession, folder: str, zone: str = "UTC",
                  max_files: int | None = None) -> DataFrame:
    """The live capture fields, tab-separated lines that land in ``folder``, as a packet stream.

    Only TCP ports are in the lines, so the ports of other packets are NULL.
    """
    reader = spark.readStream.schema(LIVE_FIELDS).option("sep", "\t").option("quote", "")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    at = capture_time(named("frame.time"), zone)
    return reader.csv(folder).select(
        named("ip.src").alias("src_ip"), named("ip.dst").alias("dst_ip"),
        named("ip.proto").alias("protocol"), named("tcp.srcport").alias("src_port"),
        named("tcp.dstport").alias("dst_port"), named("frame.len").alias("packet_size"),
        protocol_class(named("ip.proto")).alias("protocol_type"), at.alias("timestamp"),
        micros(at).alias("ts_us"))


def table_stream(spark: SparkSession, folder: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files that land in ``folder`` as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def stream_window_flows(packets: DataFrame, width: str, slide: str | None = None,
                        delay: str = "10 seconds") -> DataFrame:
    """Flows per window; a window is given out once the watermark has passed its end."""
    return window_flows(packets.withWatermark("timestamp", delay), width, slide)


def stream_session_flows(packets: DataFrame, gap: str, delay: str = "10 seconds") -> DataFrame:
    """Flows closed by inactivity."""
    late = packets.withWatermark("timestamp", delay)
    flows = flow_features(late, [F.session_window("timestamp", gap)])
    return flows.select(F.col("session_window.start").alias("session_start"),
                        F.col("session_window.end").alias("session_end"), *FLOW_COLUMNS)


def without_repeats(packets: DataFrame, keys: list[str], delay: str = "10 seconds") -> DataFrame:
    """Each key once within the watermark delay."""
    return packets.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(keys)


def stream_port_counts(packets: DataFrame, width: str, delay: str = "10 seconds") -> DataFrame:
    """Distinct destination ports of each source and window, once the watermark has passed the window.

    The state is a bitmap per source and window, merged from batch to batch, so it does not grow with packets or flows.
    """
    late = packets.withWatermark("timestamp", delay).where(F.col("src_ip").isNotNull())
    words = port_words(late, [F.window("timestamp", width), F.col("src_ip")])
    counted = count_ports(words, [F.col("window"), F.col("src_ip")])
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "src_ip", "ports")
