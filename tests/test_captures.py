"""Packet tables as capture files, written by columns and in groups."""

from __future__ import annotations

import glob
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowlens.plans import captures as made, catalog, runs
from flowlens.sources import pcap
from tools.check_queries import compare

COLUMNS = ["src_ip", "dst_ip", "protocol", "packet_size", "src_port", "dst_port", "flags", "ts_us"]


def packet_rows(n, seed=3, sizes=(0, 1, 20, 41, 53, 54, 55, 77, 1440, 65535)):
    draw = random.Random(seed)
    return [{"src_ip": f"10.{draw.randrange(256)}.0.{draw.randrange(256)}", "dst_ip": f"192.168.0.{draw.randrange(4)}",
             "protocol": draw.choice([1, 6, 17, 47]), "packet_size": draw.choice(sizes), "src_port": draw.randrange(65536),
             "dst_port": draw.randrange(65536), "flags": draw.choice(["", "S", "SA", "FSRPAUECN"]),
             "ts_us": 1_704_067_200_000_000 + draw.randrange(10 ** 10)} for _ in range(n)]


def packet_table(spark, n):
    """Rows as they are read back: no ports and flags where the protocol has none."""
    rows = packet_rows(n, sizes=(60, 77, 900, 1440))
    for r in rows:
        if r["protocol"] not in (6, 17):
            r |= {"src_port": 0, "dst_port": 0}
        if r["protocol"] != 6:
            r["flags"] = ""
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows],
                                 "src_ip string, dst_ip string, protocol int, packet_size int, src_port int, dst_port int, flags string, ts_us bigint")


@pytest.mark.parametrize("first", [0, 1, 499, 500, 737])
def test_frames_by_columns_equal_single_frames(first):
    rows = packet_rows(1200)
    batch = pa.RecordBatch.from_pylist(rows)
    for nanos in (False, True):
        for short in (False, True):
            assert made.classic_frames(batch, nanos, short) == b"".join(made.frame(r, nanos, short) for r in rows)
    want = b""
    for i, r in enumerate(rows, first):
        want += made.SECTION_HEAD * (i % 500 == 0) + made.packet_block(made.frame(r), i % 2, 1_000_000 if i % 2 == 0 else 1_000_000_000)
    assert made.block_frames(batch, first, 500) == want


def test_a_field_that_does_not_fit_is_an_error():
    for bad in ({"src_port": 65536, "protocol": 6}, {"protocol": 300}, {"packet_size": None}, {"flags": None}, {"src_ip": "1.2.3.256"}):
        with pytest.raises(ValueError):
            made.classic_frames(pa.RecordBatch.from_pylist([packet_rows(1)[0] | bad, packet_rows(1)[0]]))


@pytest.mark.parametrize("how", [{}, {"blocks": True}, {"zipped": True}, {"blocks": True, "zipped": True}])
def test_groups_of_captures_hold_every_packet_and_lie_there_one_at_a_time(spark, monkeypatch, how):
    monkeypatch.setattr(made, "GROUP_BYTES", 300_000)
    table = packet_table(spark, 1500)
    groups = made.Captures(spark, table, 2, **how)
    assert groups.groups > 2
    base, seen = groups.base.replace("file:", ""), []

    def watched():
        for folder in groups:
            seen.append(glob.glob(f"{base}/*/part-*"))
            yield folder

    got = pcap.read_groups(spark, watched(), split_bytes=20_000)
    assert len(seen) == groups.groups and all(len(files) == 2 for files in seen) and not glob.glob(f"{base}/*/part-*")
    assert not glob.glob(f"{base.rsplit('/', 1)[0]}/inflated-*/*")
    assert sorted(map(tuple, got.select(COLUMNS).collect())) == sorted(map(tuple, table.collect()))


def test_blocks_are_followed_in_bytes_of_any_size(tmp_path, monkeypatch):
    batch = pa.RecordBatch.from_pylist(packet_rows(900, sizes=(0, 60, 1440, 20_000)))
    path = tmp_path / "a.pcapng"
    path.write_bytes(made.block_frames(batch, 0, 70))
    whole = [r for b in pcap.decode_range(str(path), 0, None) for r in b.to_pylist()]
    assert len(whole) == 900
    for size in (64, 1000, 50_000):
        monkeypatch.setattr(pcap, "BLOCK_BYTES", size)
        monkeypatch.setattr(pcap, "BATCH_ROWS", 33)
        assert [r for b in pcap.decode_range(str(path), 0, None) for r in b.to_pylist()] == whole


def test_counts_of_groups_add_up(spark, monkeypatch):
    monkeypatch.setattr(made, "GROUP_BYTES", 300_000)
    cut = packet_table(spark, 1000).withColumn("packet_size", F.when(F.col("src_port") % 2 == 1, 0).otherwise(F.col("packet_size")))
    counts = pcap.read_groups(spark, made.Captures(spark, cut, short=True), pcap.corrupt_packets)
    got = {r["corrupt"]: r["n"] for r in counts.groupBy("corrupt").agg(F.sum("packets").alias("n")).collect()}
    bad = cut.where("packet_size = 0").count()
    assert got == {True: bad, False: 1000 - bad}


NAMES = [("10.0.300.7", "10.0.0.1"), ("10.0.0.01", "240.0.0.9"), ("host-a", "10.0.1406.64"), ("10.0.0.1", "host-a"), ("240.0.0.3", "10.0.0.01")]


def test_names_that_no_header_holds_come_back(spark):
    row = "6 as protocol, 60 as packet_size, 7 as src_port, 8 as dst_port, 'S' as flags, cast(1000000 as bigint) as ts_us"
    table = spark.createDataFrame(NAMES, "src_ip string, dst_ip string").selectExpr("src_ip", "dst_ip", *row.split(", "))
    groups = made.Captures(spark, table, 2)
    got = pcap.resolved(pcap.read_groups(spark, groups), groups.names).select("src_ip", "dst_ip").collect()
    assert sorted(map(tuple, got)) == sorted(NAMES)
    held = {r["address"]: r["name"] for r in groups.names.collect()}
    assert sorted(held.values()) == ["10.0.0.01", "10.0.1406.64", "10.0.300.7", "host-a"] and not {a for pair in NAMES for a in pair} & set(held)
    assert made.Captures(spark, table.where("src_ip = '240.0.0.3'").withColumn("dst_ip", F.lit("1.2.3.4"))).names is None


@pytest.fixture(scope="module")
def many_suppliers(spark, sf, tmp_path_factory):
    """A folder of tables whose suppliers have keys around 65,536."""
    folder = tmp_path_factory.mktemp("suppliers")
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").limit(1500)
    rows.withColumn("l_suppkey", F.col("l_suppkey") + 65_530).write.parquet(f"{folder}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{folder}/lineitem.parquet/*.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", ["src_pcap_roundtrip", "src_pcap_split", "src_pcap_corrupt", "pipe_packet_flows", "src_pcap_gzip",
                                  "stream_pcap_landing"])
def test_suppliers_beyond_two_octets(spark, many_suppliers, monkeypatch, name):
    """Their names have a third part above 255; captures come in more than one group."""
    folder, con = many_suppliers
    monkeypatch.setattr(made, "GROUP_BYTES", 700_000)
    assert compare(spark, con, catalog.QUERIES[name], catalog.ORACLES[name], folder) is None


def test_flows_over_groups_of_captures_are_whole(spark, monkeypatch):
    """The packets of a flow lie in several groups, and one flow has most of them."""
    monkeypatch.setattr(made, "GROUP_BYTES", 300_000)
    table = packet_table(spark, 1200).withColumn("src_ip", F.when(F.col("packet_size") > 77, "10.0.0.1").otherwise("10.0.0.2")) \
        .withColumn("src_port", F.lit(7)).withColumn("dst_port", F.lit(9)).withColumn("protocol", F.lit(17)).withColumn("flags", F.lit(""))
    groups = made.Captures(spark, table)
    flows = runs.capture_flows(spark, groups, names=groups.names)
    want = table.groupBy("src_ip", "dst_ip").agg(F.count("*"), F.sum("packet_size"))
    assert groups.groups > 2 and flows.count() == 8
    assert sorted(map(tuple, flows.select("src_ip", "dst_ip", "packet_count", "byte_count").collect())) == sorted(map(tuple, want.collect()))
