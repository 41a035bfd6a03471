"""Packets to directional flows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlens import settings
from flowlens.functions.packets import flow_key, has_flag, rate
from flowlens.functions.values import named
from flowlens.functions.timing import MICROS

FLOW_KEYS = ["src_ip", "dst_ip", "src_port", "dst_port", "protocol_type"]
FLAG_COUNTS = {"syn_count": "S", "ack_count": "A", "fin_count": "F", "rst_count": "R"}
FLOW_COLUMNS = [
    "flow_key", *FLOW_KEYS, "packet_count", "byte_count", "flow_duration", "packet_rate",
    "byte_rate", "avg_packet_size", "std_packet_size", "min_packet_size", "max_packet_size",
    *FLAG_COUNTS]


def _flag_count(letter: str) -> Column:
    return F.count_if((F.col("protocol_type") == "tcp") & has_flag(F.col("flags"), letter))


def _key() -> Column:
    return flow_key(*[F.col(k) for k in FLOW_KEYS])


def _rates(duration: Column) -> list[Column]:
    return [duration.alias("flow_duration"),
            rate(F.col("packet_count"), duration).alias("packet_rate"),
            rate(F.col("byte_count"), duration).alias("byte_rate")]


def _seconds() -> Column:
    return (F.col("last_us") - F.col("first_us")) / MICROS


def flow_features(packets: DataFrame, by: list[Column] | None = None) -> DataFrame:
    """One row per directional flow with size, rate and flag features.

    ``by`` adds further grouping columns, such as a time window. All aggregates are partial
    ones: a flow with very many packets is reduced before the shuffle.
    """
    extra = by or []
    grouped = packets.where(F.col("protocol_type").isNotNull()).groupBy(*extra, *FLOW_KEYS)
    totals = grouped.agg(
        F.count("*").alias("packet_count"),
        F.sum("packet_size").cast("bigint").alias("byte_count"),
        F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"),
        F.avg("packet_size").alias("avg_packet_size"),
        F.stddev_samp("packet_size").alias("std_packet_size"),
        F.min("packet_size").alias("min_packet_size"),
        F.max("packet_size").alias("max_packet_size"),
        *[_flag_count(letter).alias(name) for name, letter in FLAG_COUNTS.items()])
    added = [c for c in totals.columns if c not in FLOW_COLUMNS and c not in ("first_us", "last_us")]
    return totals.select(
        *added, _key().alias("flow_key"), *FLOW_KEYS, "packet_count", "byte_count",
        *_rates(_seconds()), *FLOW_COLUMNS[FLOW_COLUMNS.index("avg_packet_size"):])


def window_flows(packets: DataFrame, width: str, slide: str | None = None,
                 time: str = "timestamp") -> DataFrame:
    """Flow features per tumbling or sliding window; works on batch and stream input."""
    flows = flow_features(packets, [F.window(time, width, slide)])
    return flows.select(F.col("window.start").alias("window_start"),
                        F.col("window.end").alias("window_end"), *FLOW_COLUMNS)


def session_flows(packets: DataFrame, gap_seconds: float) -> DataFrame:
    """Flows closed by ``gap_seconds`` without a packet.

    Packets of one flow in the same stretch of ``gap`` length always share a session, so they
    are reduced to one row first; only those rows are put in order, at most one per stretch.
    """
    gap = int(gap_seconds * MICROS)
    size = F.col("packet_size").cast("bigint")
    pieces = (packets.where(F.col("protocol_type").isNotNull())
              .groupBy(*FLOW_KEYS, F.floor(F.col("ts_us") / gap).alias("stretch"))
              .agg(F.count("*").alias("n"), F.sum("packet_size").cast("bigint").alias("bytes"),
                   F.min("ts_us").alias("lo"), F.max("ts_us").alias("hi"),
                   F.sum(size * size).alias("squares"),
                   F.min("packet_size").alias("least"), F.max("packet_size").alias("most"),
                   *[_flag_count(letter).alias(c) for c, letter in FLAG_COUNTS.items()]))
    order = Window.partitionBy(*FLOW_KEYS).orderBy("stretch")
    before = F.lag("hi").over(order)
    opened = pieces.withColumn(
        "opens", F.when(before.isNull() | (F.col("lo") - before > gap), 1).otherwise(0))
    numbered = opened.withColumn("session", F.sum("opens").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    totals = numbered.groupBy(*FLOW_KEYS, "session").agg(
        F.sum("n").alias("packet_count"), F.sum("bytes").alias("byte_count"),
        F.min("lo").alias("first_us"), F.max("hi").alias("last_us"),
        F.sum(F.col("squares").cast("decimal(28,0)")).cast("decimal(38,0)").alias("squares"),
        F.min("least").alias("min_packet_size"), F.max("most").alias("max_packet_size"),
        *[F.sum(c).alias(c) for c in FLAG_COUNTS])
    n = F.col("packet_count")
    average = F.col("byte_count") / n
    # Whole numbers up to the last division, so nothing cancels.
    whole = "cast(packet_count * squares - cast(byte_count as decimal(19,0)) * byte_count as double)"
    spread = F.expr(whole) / n
    return totals.select(
        _key().alias("flow_key"), *FLOW_KEYS, F.col("first_us").alias("session_start_us"),
        F.col("last_us").alias("session_last_us"), "packet_count", "byte_count",
        *_rates(_seconds()), average.alias("avg_packet_size"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("std_packet_size"),
        "min_packet_size", "max_packet_size", *FLAG_COUNTS)


def flow_summary(flows: DataFrame) -> DataFrame:
    return flows.agg(
        F.count("*").alias("flows"),
        F.avg("packet_count").alias("mean_packets"), F.max("packet_count").alias("max_packets"),
        F.avg("byte_count").alias("mean_bytes"), F.max("byte_count").alias("max_bytes"))


def top_flows(flows: DataFrame, n: int = 5) -> DataFrame:
    """The flows with most packets; equal counts keep the order of the flow key."""
    return flows.orderBy(F.desc("packet_count"), "flow_key").limit(n)


def in_key_order(flows: DataFrame) -> DataFrame:
    return flows.orderBy("flow_key")


def protocol_hierarchy(packets: DataFrame) -> DataFrame:
    """Frames and bytes of the whole capture and of each protocol class below it."""
    return (packets.rollup("protocol_type")
            .agg(F.count("*").alias("frames"),
                 F.sum("packet_size").cast("bigint").alias("bytes"),
                 F.grouping("protocol_type").alias("total"))
            .select(F.when(F.col("total") == 1, "ip")
                    .otherwise(F.concat(F.lit("ip:"), F.col("protocol_type"))).alias("protocol"),
                    "frames", "bytes"))


def export_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The columns of a feature export that the table has, in their fixed order."""
    return df.select(*[named(c) for c in columns or settings.EXPORT_COLUMNS if c in df.columns])
