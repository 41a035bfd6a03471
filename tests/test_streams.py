"""Streams over several batches, next to their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.functions.timing import from_micros
from flowlens.operators import blocks, detect
from flowlens.plans.fixtures import view
from flowlens.plans.q_stream import drained, landed
from flowlens.session import new_path, tune
from flowlens.streaming import packets as sp, sinks, state


def in_slices(spark, df, slices=4):
    """The rows as one file per stretch of time, oldest first, read one by one."""
    tune(spark)
    lo, hi = df.agg(F.min("ts_us"), F.max("ts_us")).first()
    step = (hi - lo) // slices + 1
    parts = [df.where(F.floor((F.col("ts_us") - lo) / step) == i).coalesce(1) for i in range(slices)]
    return sp.table_stream(spark, landed(spark, df, *parts), df.schema, max_files=1)


def same(a, b):
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def closed(df, rows):
    """What the watermark has passed at the end of the rows."""
    mark = (rows.agg(F.max("ts_us")).first()[0] // 1000 - 10_000) * 1000
    return df.where(F.col("ts_us") < mark)


def test_rate_limit_over_batches(spark, sf):
    rows = view(spark, sf, "packets")
    key = ["src_ip", "dst_ip", "dst_port", "ts_us", "events", "recent"]
    got = drained(spark, state.stream_rate_limited(in_slices(spark, rows), threshold=10))
    same(got.select(key), closed(detect.rate_limited(rows, threshold=10), rows).select(key))


def test_block_timeline_over_batches(spark, sf):
    rows = view(spark, sf, "packets")
    got = drained(spark, state.stream_block_timeline(in_slices(spark, rows), duration=1))
    same(got.select("ip", "ts_us"), closed(blocks.block_timeline(rows, duration=1), rows).select("ip", "ts_us"))


def out_of_order(spark):
    """Seconds 10 to 12, then 5 and 6, then the rest, one file each; the last but two moves the watermark on."""
    tune(spark)
    files = [(10, 11, 12), (5, 6), (8, 13, 19, 20), (21, 40, 23), (90, 95), (96,), (70,)]
    schema = "src_ip string, dst_ip string, dst_port int, ts_us bigint"
    parts = [spark.createDataFrame([("a", "b", 1, s * 1_000_000 + k) for s in f for k in (0, 999_999 * (s % 2))], schema)
             .withColumn("timestamp", from_micros(F.col("ts_us"))).coalesce(1) for f in files]
    arrived = parts[0]
    for part in parts[1:-1]:  # the last file comes after a batch has closed its time and counts nowhere
        arrived = arrived.unionAll(part)
    return sp.table_stream(spark, landed(spark, parts[0], *parts), parts[0].schema, max_files=1), arrived


def test_rate_limit_out_of_order(spark):
    stream, rows = out_of_order(spark)
    key = ["src_ip", "dst_ip", "dst_port", "ts_us", "events", "recent"]
    got = drained(spark, state.stream_rate_limited(stream, threshold=2, window_us=5_000_000))
    same(got.select(key), closed(detect.rate_limited(rows, threshold=2, window_us=5_000_000), rows).select(key))
    assert got.count() > 3


def test_block_timeline_out_of_order(spark):
    stream, rows = out_of_order(spark)
    got = drained(spark, state.stream_block_timeline(stream, duration=4))
    same(got.select("ip", "ts_us"), closed(blocks.block_timeline(rows, duration=4), rows).select("ip", "ts_us"))
    assert got.agg(F.min("ts_us")).first()[0] == 5_000_000


def test_windows_over_batches_hold_every_closed_packet(spark, sf):
    rows = view(spark, sf, "packets")
    got = drained(spark, sp.stream_window_flows(in_slices(spark, rows), "1 minute", delay="1 second"))
    last = got.agg(F.max("window_end").alias("m"))
    kept = rows.join(last, F.col("timestamp") < F.col("m")).drop("m")
    assert got.agg(F.sum("packet_count")).first()[0] == kept.count()


def test_log_restarts_where_it_stopped(spark):
    tune(spark)
    rows = spark.range(10).select(F.col("id"), from_micros(F.col("id") * 1_000_000).alias("timestamp"))
    folder, sink, mark = landed(spark, rows), new_path(spark, "sink"), new_path(spark, "checkpoint")
    stream = sp.table_stream(spark, folder, rows.schema)
    sinks.append_table(stream, sink, mark, available_now=True).awaitTermination()
    rows.where("id < 3").write.mode("append").parquet(folder)
    sinks.append_table(stream, sink, mark, available_now=True).awaitTermination()
    assert spark.read.parquet(sink).count() == 13


def test_rate_limit_state_is_kept_by_buckets_of_connections(spark, monkeypatch):
    """Missing parts of a key, rows without a time, several packed values of one bucket, and few keys of the state."""
    tune(spark)
    monkeypatch.setattr(state, "BUCKETS", 3)
    monkeypatch.setattr(state, "CHUNK_ROWS", 7)
    schema = "src_ip string, dst_ip string, dst_port int, ts_us bigint"
    at = [(f"s{i % 5}" if i % 5 else None, f"d{i % 2}" if i % 3 else None, i % 4 or None, 1_000_000 * (i // 8 + 1) + i % 7) for i in range(900)]
    rows = spark.createDataFrame([r for r in at for _ in range(2)], schema).withColumn("timestamp", from_micros(F.col("ts_us")))
    lost = rows.limit(20).withColumn("ts_us", F.lit(None).cast("bigint"))
    parts = [rows.where(f"ts_us < {c} and ts_us >= {c - 40_000_000}").coalesce(1) for c in range(40_000_000, 160_000_000, 40_000_000)]
    stream = sp.table_stream(spark, landed(spark, rows, lost.coalesce(1), *parts), rows.schema, max_files=1)
    got = drained(spark, state.stream_rate_limited(stream, threshold=3, window_us=9_000_000))
    key = ["src_ip", "dst_ip", "dst_port", "ts_us", "events", "recent"]
    want = closed(detect.rate_limited(rows, threshold=3, window_us=9_000_000), rows).select(key)
    text = lambda df: sorted(str(tuple(r)) for r in df.select(key).collect())
    assert text(got) == text(want) and got.count() > 100 and got.where("src_ip is null").count() > 10
    assert state.stream_rate_limited(stream).schema == got.schema
    mark = state._packed(state.INSTANTS.empty_table())
    assert mark == []
    plan = state.stream_rate_limited(stream)._jdf.queryExecution().analyzed().toString()
    assert "bucket" in plan.split("TransformWithState", 1)[1].splitlines()[0]
