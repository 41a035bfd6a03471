"""Block ledger: a table of (ip, block_time, reason, duration)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowlens import settings
from flowlens.functions.timing import MICROS, expired, from_micros, moment, remaining_seconds
from flowlens.operators.detect import REPORT_ORDER
from flowlens.operators.scale import bounded
from flowlens.session import stage

LEDGER = ["ip", "block_time", "reason", "duration"]


def _over(as_of) -> Column:
    return expired(F.col("block_time"), F.col("duration"), moment(as_of))


def active_blocks(ledger: DataFrame, as_of=None) -> DataFrame:
    """Blocks not yet over; one that is exactly ``duration`` old still holds."""
    return ledger.where(~_over(as_of))


def expired_blocks(ledger: DataFrame, as_of=None) -> DataFrame:
    return ledger.where(_over(as_of))


def blocked_among(addresses: DataFrame, ledger: DataFrame, as_of=None) -> DataFrame:
    """The rows of ``addresses`` whose ``ip`` is blocked."""
    return addresses.join(active_blocks(ledger, as_of).select("ip"), "ip", "left_semi")


def first_reasons(detections: DataFrame, threshold: float = settings.CONFIDENCE_THRESHOLD,
                  order: list[str] | None = None) -> DataFrame:
    """The first qualifying detection of each source. Reduced per task before the shuffle."""
    by = [F.col(c) for c in order or REPORT_ORDER if c in detections.columns]
    usable = detections.where(
        F.col("src_ip").isNotNull() & ~F.col("src_ip").isin("", "unknown")
        & (F.col("confidence") > threshold))
    return usable.groupBy(F.col("src_ip").alias("ip")).agg(
        F.min_by("type", F.struct(*by)).alias("reason"))


def new_blocks(detections: DataFrame, ledger: DataFrame, as_of=None, auto_block: bool = True,
               threshold: float = settings.CONFIDENCE_THRESHOLD,
               duration: int = settings.BLOCK_SECONDS,
               order: list[str] | None = None) -> DataFrame:
    """Ledger rows for sources that should be blocked and are not."""
    found = first_reasons(detections, threshold, order)
    if not auto_block:
        found = found.where(F.lit(False))
    free = found.join(active_blocks(ledger, as_of).select("ip"), "ip", "left_anti")
    return free.select("ip", moment(as_of).alias("block_time"), "reason",
                       F.lit(duration).alias("duration"))


def upsert(ledger: DataFrame, added: DataFrame) -> DataFrame:
    """``added`` replaces the old row of the same ip."""
    both = (ledger.select(*LEDGER, F.lit(0).alias("version"))
            .unionByName(added.select(*LEDGER, F.lit(1).alias("version"))))
    kept = both.groupBy("ip").agg(F.max_by(
        F.struct("block_time", "reason", "duration"),
        F.struct("version", "block_time", "reason", "duration")).alias("row"))
    return kept.select("ip", "row.*")


def release(ledger: DataFrame, ips: DataFrame) -> DataFrame:
    return ledger.join(ips.select("ip"), "ip", "left_anti")


def cleanup(ledger: DataFrame, as_of=None) -> DataFrame:
    return active_blocks(ledger, as_of)


def block_list(ledger: DataFrame, as_of=None, only_active: bool = False) -> DataFrame:
    """The ledger with the seconds left; rows that are over show a negative number."""
    rows = active_blocks(ledger, as_of) if only_active else ledger
    return rows.withColumn("remaining_seconds", remaining_seconds(
        F.col("block_time"), F.col("duration"), moment(as_of)))


def block_timeline(events: DataFrame, ip: str = "src_ip", time: str = "ts_us",
                   duration: int = settings.BLOCK_SECONDS,
                   rows_per_part: int = 1_000_000) -> DataFrame:
    """Replay of qualifying detections: a block opens only once the previous one is over.

    Returns (ip, block_time, ts_us), one row per opened block.

    The distinct instants are range-partitioned by (ip, time) and written, so every part has about ``rows_per_part`` rows and a
    busy ip spans several parts. What a part does to the running block is a map, from the last block before the part to the last one
    after it, see ``_part_map``. The maps of an ip, one after another, give the block that runs when each of its parts begins;
    then all parts are replayed at once.
    """
    span = duration * MICROS
    hits = events.where(F.col(ip).isNotNull() & F.col(time).isNotNull()).select(
        F.col(ip).alias("ip"), F.col(time).alias("t"))
    parts = max(1, math.ceil(hits.count() / rows_per_part))
    if parts == 1:
        held, entries = hits.distinct().withColumn("part", F.lit(0)), None
    else:
        held = stage(hits.distinct().repartitionByRange(parts, "ip", "t").withColumn(
            "part", F.spark_partition_id()), "instants")
        entries = _entries(held, span)
    opened = _open_blocks(held, entries, span)
    return opened.select("ip", from_micros(F.col("t")).alias("block_time"), F.col("t").alias("ts_us"))


def _open_blocks(held: DataFrame, entries: DataFrame | None, span: int) -> DataFrame:
    """Opened blocks as rows (ip, t), one task per part. ``entries`` hold the last block before a part (ip, part, t)."""
    rows = held.select("ip", "t", "part", F.lit(False).alias("before"))
    if entries is not None:
        rows = rows.unionByName(entries.select("ip", "t", "part", F.lit(True).alias("before")))

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ip", "t"], kind="stable")  # what lies before a part is less than all of it
        ips, times, before = pdf["ip"].to_numpy(), pdf["t"].to_numpy(), pdf["before"].to_numpy()
        edges = np.flatnonzero(np.r_[True, ips[1:] != ips[:-1], True])
        kept = []
        for start, end in zip(edges[:-1], edges[1:]):
            at = start
            if before[start]:
                at += max(1, int(np.searchsorted(times[start:end], times[start] + span, side="right")))
            while at < end:
                kept.append(at)
                at += 1
                if at < end:
                    at += int(np.searchsorted(times[at:end], times[kept[-1]] + span, side="right"))
        return pd.DataFrame({"ip": ips[kept], "t": times[kept]})

    return rows.groupBy("part").applyInPandas(replay, "ip string, t bigint")


FRESH = -(1 << 63)  # no block before


def _part_map(key: tuple, rows: pa.Table, span: int) -> pa.Table:
    """What a part of an ip does to the block that runs before it, as pieces: a block that opened at ``upto`` - 1 or earlier (and
    not in an earlier piece) leads to ``t`` as the last block of the part. One that opened later outlasts the part.

    The block before opened before the part began, so only instants in the first ``span`` of the part begin a piece.
    """
    times = np.sort(np.asarray(rows["t"]))
    after = np.searchsorted(times, times + span, side="right")
    # The last block of the chain that begins at each instant, by doubling the steps.
    last = np.where(after < len(times), after, np.arange(len(times)))
    while True:
        further = last[last]
        if (further == last).all():
            break
        last = further
    size = min(len(times), int(np.searchsorted(times, times[0] - 1 + span, side="right")) + 1)
    upto, ends = times[:size] - span, times[last[:size]]
    keep = np.r_[ends[1:] != ends[:-1], True]
    n = int(keep.sum())
    return pa.table({"ip": pa.array([key[0].as_py()] * n, pa.string()), "part": pa.array(np.full(n, key[1].as_py(), np.int32)),
                     "upto": upto[keep], "t": ends[keep]})


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last block before each part but the first, from the pieces of the maps in the order of ip, part and ``upto``."""
    now, last, settled = None, FRESH, False
    for batch in batches:
        ips, parts = batch.column(0).to_pylist(), np.asarray(batch.column(1))
        upto, ends = np.asarray(batch.column(2)), np.asarray(batch.column(3))
        codes = np.asarray(batch.column(0).dictionary_encode().indices)
        edges = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (parts[1:] != parts[:-1]), True])[:-1] if len(ips) else []
        out: list[tuple[str, int, int]] = []
        for start, end in zip(edges, [*edges[1:], len(ips)]):
            here = (ips[start], int(parts[start]))
            if here != now:
                if now is not None:
                    out.append((now[0], last, now[1] + 1))
                    if now[0] != here[0]:
                        last = FRESH
                now, settled = here, False
            if not settled:
                k = int(np.searchsorted(upto[start:end], last, side="right"))
                if k < end - start:
                    last, settled = int(ends[start + k]), True
        yield _entry_batch(out)
    if now is not None:
        yield _entry_batch([(now[0], last, now[1] + 1)])


def _entry_batch(out: list[tuple[str, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*out)) if out else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32())],
                                      names=["ip", "t", "part"])


def _entries(held: DataFrame, span: int) -> DataFrame:
    """(ip, t, part): the last block before each part of an ip that spans several, except its first.

    The maps are made by all parts at once. They are then walked in order, piece by piece and in constant memory; an ip brings
    the pieces of its parts, not their instants: those in the first ``span`` of a part at most.
    """
    spread = held.groupBy("ip").agg(F.min("part").alias("first_part"), F.max("part").alias("last_part")) \
        .where("first_part < last_part")  # two ips a part at most
    rows = held.join(bounded(spread), "ip").where("part < last_part").select("ip", "part", "t")
    maps = rows.groupBy("ip", "part").applyInArrow(lambda key, found: _part_map(key, found, span), "ip string, part int, upto bigint, t bigint")
    return stage(maps.repartition("ip").sortWithinPartitions("ip", "part", "upto").mapInArrow(_walk, "ip string, t bigint, part int"), "entries")
