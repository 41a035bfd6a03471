"""Keyed state over event time: exact trailing counts and the block list."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowlens import settings
from flowlens.functions.timing import MICROS, micros


def _instants(rows: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct times and how often each occurs, reduced batch by batch."""
    times, counts = np.array([], dtype=np.int64), np.array([], dtype=np.int64)
    for pdf in rows:
        t, n = np.unique(pdf["ts_us"].to_numpy(dtype=np.int64), return_counts=True)
        times, counts = _merge(times, counts, t, n)
    return times, counts


def _merge(t1, n1, t2, n2) -> tuple[np.ndarray, np.ndarray]:
    times, where = np.unique(np.concatenate([t1, t2]), return_inverse=True)
    counts = np.bincount(where, weights=np.concatenate([n1, n2]), minlength=len(times)).astype(np.int64)
    return times, counts


def _held(state) -> tuple[np.ndarray, np.ndarray]:
    rows = list(state.get()) if state.exists() else []
    none = np.array([], dtype=np.int64)
    return _merge(none, none, np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64))


def _due(ts_us: int) -> int:
    """The first watermark in milliseconds that has passed an instant."""
    return int(ts_us) // 1000 + 1


CONNECTION = ["src_ip", "dst_ip", "dst_port"]
INSTANTS = pa.schema([("src_ip", pa.string()), ("dst_ip", pa.string()), ("dst_port", pa.int32()), ("ts_us", pa.int64()), ("events", pa.int64())])
BUCKETS = 512          # of connections; each is one key of the state
CHUNK_ROWS = 100_000   # instants that are kept as one value


def _summed(tables: list[pa.Table]) -> pa.Table:
    """Each instant of a connection once, with its events."""
    one = pa.concat_tables(tables).group_by([*CONNECTION, "ts_us"]).aggregate([("events", "sum")])
    return one.rename_columns([*CONNECTION, "ts_us", "events"]).cast(INSTANTS)


def _packed(instants: pa.Table) -> list[tuple[bytes]]:
    """Instants as values of a list state."""
    out = []
    for at in range(0, instants.num_rows, CHUNK_ROWS):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, INSTANTS, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
            writer.write_table(instants.slice(at, CHUNK_ROWS).combine_chunks())
        out.append((sink.getvalue().to_pybytes(),))
    return out


def _unpacked(state) -> pa.Table:
    chunks = [pa.ipc.open_stream(bytes(row[0])).read_all() for row in state.get()] if state.exists() else []
    return _summed([INSTANTS.empty_table(), *chunks])


def _recent(instants: pa.Table, window_us: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Instants by connection and time: their places in the table, times, events, and the events of the connection in the
    window up to each."""
    times, counts = instants["ts_us"].to_numpy(), instants["events"].to_numpy()
    connection = np.zeros(len(times), np.int64)
    for name in CONNECTION:
        codes = instants[name].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        connection = np.unique(connection * (len(times) + 1) + codes, return_inverse=True)[1]
    order = np.lexsort((times, connection))
    times, counts, connection = times[order], counts[order], connection[order]
    known = np.unique(times)
    steps = connection * (len(known) + 1)
    gone = np.searchsorted(steps + np.searchsorted(known, times), steps + np.searchsorted(known, times - window_us, side="right"))
    upto = np.concatenate([[0], np.cumsum(counts)])
    return order, times, counts, upto[1:] - upto[gone]


class TrailingCount(StatefulProcessor):
    """Adds instants to the state as they come; counts them once the watermark has passed them, so that their order
    of arrival does not matter. Instants stay until no later one can count them.

    A key of the state is a bucket of connections, whose instants are kept as packed tables and counted together: what a
    key costs does not depend on its connections.
    """

    def __init__(self, window_us: int, threshold: int):
        self.window_us, self.threshold = window_us, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "instants binary")
        self.done = handle.getValueState("done", "mark_us bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, held, tables = None, 0, []
        for pdf in rows:
            pdf = pdf[pdf["ts_us"].notna()].assign(events=1)
            if not len(pdf):
                continue
            tables.append(_summed([pa.Table.from_pandas(pdf, schema=INSTANTS, preserve_index=False)]))
            first = min(int(pdf["ts_us"].min()), first) if first is not None else int(pdf["ts_us"].min())
            held += tables[-1].num_rows
            if held >= CHUNK_ROWS:
                self.seen.appendList(_packed(_summed(tables)))
                held, tables = 0, []
        if tables:
            self.seen.appendList(_packed(_summed(tables)))
        if first is not None:
            self.handle.registerTimer(_due(first))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        done = self.done.get()[0] if self.done.exists() else None
        if done == mark:
            return iter([])  # another timer of this batch has done it
        instants = _unpacked(self.seen)
        order, times, counts, recent = _recent(instants, self.window_us)
        closed = (times < mark) & (done is None or times >= done)
        alive = times > mark - self.window_us
        if alive.any():
            self.seen.put(_packed(instants.take(order[alive])))
            self.done.update((int(mark),))
            pending = times[times >= mark]
            self.handle.registerTimer(_due(pending.min()) if len(pending) else _due(times.max() + self.window_us))
        else:
            self.seen.clear()
            self.done.clear()
        hits = np.flatnonzero(closed & (recent > self.threshold))
        if not len(hits):
            return iter([])
        named = instants.select(CONNECTION).take(order[hits])
        out = pd.DataFrame({name: pd.Series(named[name].to_pylist(), dtype=object) for name in CONNECTION})
        return iter([out.assign(ts_us=times[hits], events=counts[hits], recent=recent[hits])])

    def close(self) -> None:
        pass


def stream_rate_limited(packets: DataFrame, threshold: int = settings.RATE_LIMIT,
                        window_us: int = settings.RATE_WINDOW_SECONDS * MICROS,
                        delay: str = "10 seconds") -> DataFrame:
    """Instants with more than ``threshold`` events of a (src, dst, port) in the trailing window, once the watermark passed them."""
    bucket = F.pmod(F.xxhash64(*CONNECTION), F.lit(BUCKETS)).alias("bucket")
    rows = packets.withWatermark("timestamp", delay).select(bucket, *CONNECTION, "timestamp", "ts_us")
    return rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=TrailingCount(window_us, threshold),
        outputStructType="src_ip string, dst_ip string, dst_port int, ts_us bigint, events bigint, "
                         "recent bigint",
        outputMode="Append", timeMode="EventTime")


class BlockList(StatefulProcessor):
    """Adds events to the state as they come and replays them once the watermark has passed them. The time of the running
    block of an ip is kept until the block is over.
    """

    def __init__(self, duration_us: int):
        self.duration_us = duration_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "ts_us bigint, events bigint")
        self.last = handle.getValueState("last", "ts_us bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times, events = _instants(rows)
        if len(times):
            self.waiting.appendList([(int(t), int(n)) for t, n in zip(times, events)])
            self.handle.registerTimer(_due(times[0]))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        times, counts = _held(self.waiting)
        closed, pending = times[times < mark], times >= mark
        last = self.last.get()[0] if self.last.exists() else None
        opened = []
        at = 0 if last is None else int(np.searchsorted(closed, last + self.duration_us, side="right"))
        while at < len(closed):
            last = int(closed[at])
            opened.append(last)
            at = int(np.searchsorted(closed, last + self.duration_us, side="right"))
        if pending.any():
            self.waiting.put([(int(t), int(n)) for t, n in zip(times[pending], counts[pending])])
            self.handle.registerTimer(_due(times[pending][0]))
        else:
            self.waiting.clear()
        if last is not None and last + self.duration_us >= mark:
            self.last.update((last,))
            self.handle.registerTimer(_due(last + self.duration_us))
        else:
            self.last.clear()
        return iter([pd.DataFrame({"ip": key[0], "ts_us": opened})]) if opened else iter([])

    def close(self) -> None:
        pass


def stream_block_timeline(events: DataFrame, ip: str = "src_ip",
                          duration: int = settings.BLOCK_SECONDS, delay: str = "10 seconds") -> DataFrame:
    """Blocks, in whatever order events arrive, once the watermark has passed their opening."""
    rows = events.withWatermark("timestamp", delay).select(
        F.col(ip).alias("ip"), "timestamp", micros(F.col("timestamp")).alias("ts_us"))
    return rows.where(F.col("ip").isNotNull()).groupBy("ip").transformWithStateInPandas(
        statefulProcessor=BlockList(duration * MICROS), outputStructType="ip string, ts_us bigint",
        outputMode="Append", timeMode="EventTime")
