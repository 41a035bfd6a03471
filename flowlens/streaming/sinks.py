"""Stream sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.detect import detect_windows
from flowlens.session import stage


def append_table(stream: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                 mode: str = "append") -> StreamingQuery:
    """Rows appended to Parquet below ``path``, each exactly once."""
    writer = (stream.writeStream.format("parquet").outputMode(mode)
              .option("path", path).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def each_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
               available_now: bool = False) -> StreamingQuery:
    """``fn`` on every batch; it has to give the same result when a batch comes again."""
    writer = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def detect_closed_windows(window_flows: DataFrame, path: str, checkpoint: str, as_of=None,
                          available_now: bool = False) -> StreamingQuery:
    """The rules on each closed window of a flow stream; one folder per batch, replaced on a repeat."""
    def detect(batch: DataFrame, number: int) -> None:
        hits = detect_windows(stage(batch, "closed"), as_of)
        hits.write.mode("overwrite").parquet(f"{path}/batch={number}")
    return each_batch(window_flows, detect, checkpoint, available_now)


def detection_log(detections: DataFrame, path: str, checkpoint: str,
                  available_now: bool = False) -> StreamingQuery:
    """Detections appended to the history table."""
    return append_table(detections, path, checkpoint, available_now)
