"""Detection history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlens import settings
from flowlens.functions.timing import micros, moment


def counts_by_type(history: DataFrame) -> DataFrame:
    return history.groupBy("type").agg(F.count("*").alias("detections"))


def most_recent(history: DataFrame, n: int = settings.HISTORY_KEPT,
                time: str = "timestamp", ties: list[str] | None = None) -> DataFrame:
    """The last ``n`` detections, newest first. Only ``n`` rows per task are kept."""
    order = [F.desc(time), *[F.desc(c) for c in ties or []]]
    return history.orderBy(*order).limit(n)


def detection_stats(history: DataFrame, ledger: DataFrame, as_of=None,
                    kept: int = settings.HISTORY_KEPT, shown: int = settings.HISTORY_SHOWN, ties: list[str] | None = None) -> DataFrame:
    """One row: detections in all, kept ones, a count per type, the blocks still open and the last ``shown`` detections, newest
    first; ``ties`` order those of one instant, newest last."""
    per_type = counts_by_type(history).agg(
        F.coalesce(F.sum("detections"), F.lit(0)).alias("detections_in_all"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("type", "detections"))))
        .alias("attack_counts"))
    now = moment(as_of)
    open_blocks = ledger.agg(F.count_if(
        micros(now) - micros(F.col("block_time")) <= F.col("duration").cast("bigint") * 1_000_000)
        .alias("blocked_ips_count"))
    order = ["timestamp", *(ties or [])]
    last = most_recent(history, shown, ties=ties).agg(F.sort_array(F.collect_list(F.struct(
        *order, *[c for c in history.columns if c not in order])), asc=False).alias("recent_detections"))
    # One-row aggregates side by side.
    return (per_type.join(open_blocks, F.lit(True)).join(last, F.lit(True))
            .withColumn("total_detections", F.least("detections_in_all", F.lit(kept).cast("bigint"))))
