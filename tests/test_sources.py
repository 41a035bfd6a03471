from __future__ import annotations

import gzip
import os
import struct

import pytest
from pyspark.sql import functions as F

from flowlens.plans import runs
from flowlens.plans.captures import frame
from flowlens.schemas import DETECTIONS
from flowlens.sources import logs, pcap, tables

IP_A, IP_B = bytes([10, 0, 0, 1]), bytes([10, 0, 0, 2])


def ipv4(proto, body, fragment=0, options=b""):
    size = 20 + len(options) + len(body)
    return struct.pack(">BBHHHBBH", 0x40 | (5 + len(options) // 4), 0, size, 0, fragment, 64, proto, 0) + IP_A + IP_B + options + body


def tcp(sport=1000, dport=80, bits=0x12):
    return struct.pack(">HHIIHHHH", sport, dport, 0, 0, (5 << 12) | bits, 0, 0, 0)


def udp(sport=53, dport=5353):
    return struct.pack(">HHHH", sport, dport, 8, 0)


def ether(kind, body, tags=()):
    out = b"\0" * 12
    for t in tags:
        out += struct.pack(">HH", t, 7)
    return out + struct.pack(">H", kind) + body


FRAMES = [
    ether(0x0800, ipv4(6, tcp())),
    ether(0x0800, ipv4(17, udp())),
    ether(0x0800, ipv4(1, b"\x08\0\0\0")),
    ether(0x0800, ipv4(47, b"\0" * 8)),
    ether(0x86DD, b"\x60" + b"\0" * 60),                      # IPv6: not a packet row
    ether(0x0800, ipv4(6, tcp(2000, 443, 0x02)), (0x8100,)),   # one tag
    ether(0x0800, ipv4(17, udp(1, 2)), (0x88A8, 0x8100)),       # two tags
    ether(0x0800, ipv4(6, b"\xff" * 30, fragment=100)),         # a later fragment has no ports
    ether(0x0800, ipv4(6, tcp(3000, 22, 0x1FF), options=b"\1" * 8)),
    ether(0x0800, ipv4(6, tcp()[:10])),                          # cut inside the TCP header
    ether(0x0806, b"\0" * 28),                                   # ARP
]
WANT = [("tcp", 1000, 80, "SA"), ("udp", 53, 5353, ""), ("icmp", 0, 0, ""), ("other", 0, 0, ""),
        ("tcp", 2000, 443, "S"), ("udp", 1, 2, ""), ("other", 0, 0, ""), ("tcp", 3000, 22, "FSRPAUECN")]


def classic(frames, order="<", nanos=False, link=1):
    magic = 0xA1B23C4D if nanos else 0xA1B2C3D4
    out = struct.pack(order + "IHHiIII", magic, 2, 4, 0, 0, 65535, link)
    for i, f in enumerate(frames):
        out += struct.pack(order + "IIII", 1_700_000_000 + i, 123456 * (1000 if nanos else 1), len(f), len(f)) + f
    return out


def block(kind, body, order="<"):
    body += b"\0" * (-len(body) % 4)
    size = 12 + len(body)
    return struct.pack(order + "II", kind, size) + body + struct.pack(order + "I", size)


def block_capture(frames, order="<", resolution=None):
    out = block(0x0A0D0D0A, struct.pack(order + "IHHq", 0x1A2B3C4D, 1, 0, -1), order)
    options = b""
    if resolution is not None:
        options = struct.pack(order + "HHB3x", 9, 1, resolution) + struct.pack(order + "HH", 0, 0)
    out += block(1, struct.pack(order + "HHI", 1, 0, 65535) + options, order)
    per_second = 10 ** (resolution or 6)
    for i, f in enumerate(frames):
        ticks = (1_700_000_000 + i) * per_second + 123456 * per_second // 1_000_000
        out += block(6, struct.pack(order + "IIIII", 0, ticks >> 32, ticks & 0xFFFFFFFF, len(f), len(f)) + f, order)
    return out


def put(tmp_path, data, name="a.pcap"):
    (tmp_path / name).write_bytes(data)
    return str(tmp_path / name)


def rows(df):
    return [(r["protocol_type"], r["src_port"], r["dst_port"], r["flags"]) for r in df.orderBy("ts_us").collect()]


@pytest.mark.parametrize("data", [
    classic(FRAMES), classic(FRAMES, ">"), classic(FRAMES, "<", True), classic(FRAMES, ">", True),
    block_capture(FRAMES), block_capture(FRAMES, ">"), block_capture(FRAMES, "<", 9)],
    ids=["le", "be", "le-nano", "be-nano", "blocks", "blocks-be", "blocks-nano"])
def test_containers(spark, tmp_path, data):
    df = pcap.read_pcap(spark, put(tmp_path, data))
    assert rows(df) == WANT
    first = df.orderBy("ts_us").first()
    assert (first["src_ip"], first["dst_ip"], first["protocol"]) == ("10.0.0.1", "10.0.0.2", 6)
    assert first["ts_us"] == 1_700_000_000_123_456
    assert first["packet_size"] == len(FRAMES[0])


@pytest.mark.parametrize("link,head", [(101, b""), (228, b""), (113, b"\0" * 14 + b"\x08\0"), (276, b"\x08\0" + b"\0" * 18),
                                       (0, b"\2\0\0\0")])
def test_link_types(spark, tmp_path, link, head):
    df = pcap.read_pcap(spark, put(tmp_path, classic([head + ipv4(6, tcp())], link=link)))
    assert rows(df) == WANT[:1]


def test_corrupt_packets_are_marked_or_left_out(spark, tmp_path):
    cut = classic(FRAMES)[:-20]  # the last record, no IPv4, loses its tail
    path = put(tmp_path, cut)
    assert rows(pcap.read_pcap(spark, path)) == WANT
    counts = {r["corrupt"]: r["packets"] for r in pcap.corrupt_packets(spark, path).collect()}
    assert counts == {False: len(WANT), True: 2}


def test_not_a_capture(spark, tmp_path):
    with pytest.raises(Exception, match="not a packet capture"):
        pcap.read_pcap(spark, put(tmp_path, b"hello" * 20)).collect()


def test_ranges_give_the_same_rows(spark, tmp_path):
    many = [ether(0x0800, ipv4(6, tcp(i % 60000, 80)) + b"x" * (i % 900)) for i in range(3000)]
    path = put(tmp_path, classic(many))
    size = os.path.getsize(path)
    whole = pcap.read_pcap(spark, path, split_bytes=None)
    parts = pcap.read_pcap(spark, path, split_bytes=size // 9)
    assert whole.count() == 3000
    key = ["ts_us", "src_port", "packet_size"]
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, parts.select(key).collect()))
    starts = {pcap.range_start(path, size, n) for n in range(0, size, size // 9)}
    assert len(starts) == 10


@pytest.mark.parametrize("at,length", [(2000, 7), (2000, 100_000), (2000, 2 ** 31 - 1), (0, 30), (2999, 9), (None, 0)])
def test_a_damaged_length_costs_one_record_in_any_ranges(spark, tmp_path, at, length):
    many = [ether(0x0800, ipv4(6, tcp(i % 60000, 80)) + b"x" * (i % 900)) for i in range(3000)]
    data = bytearray(classic(many))
    if at is not None:
        place = 24 + sum(16 + len(m) for m in many[:at])
        struct.pack_into("<I", data, place + 8, min(len(many[at]) + length, 2 ** 31 - 1))
        struct.pack_into("<I", data, place + 12, min(len(many[at]) + length, 2 ** 31 - 1))
    path = put(tmp_path, bytes(data))
    key = ["ts_us", "src_port", "packet_size", "corrupt"]
    found = [sorted(map(tuple, pcap.read_pcap(spark, path, split_bytes=n, keep_corrupt=True).select(key).collect()))
             for n in (None, 65_536, 1 << 20)]
    assert found[0] == found[1] == found[2]
    assert len(found[0]) == 3000 and sum(r[3] for r in found[0]) == (at is not None)


def test_records_above_the_usual_size_are_cut_too(spark, tmp_path):
    many = [ether(0x0800, ipv4(6, tcp(i, 80)) + b"x" * 50_000) for i in range(200)]
    path = put(tmp_path, classic(many))
    size = os.path.getsize(path)
    assert len({pcap.range_start(path, size, n) for n in range(0, size, size // 4)} - {None}) >= 4
    assert pcap.read_pcap(spark, path, split_bytes=size // 4).count() == 200


def test_written_frames_read_back(spark, tmp_path):
    row = {"src_ip": "1.2.3.4", "dst_ip": "5.6.7.8", "protocol": 6, "packet_size": 99, "src_port": 7,
           "dst_port": 8, "flags": "FA", "ts_us": 1_000_001}
    head = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1)
    got = pcap.read_pcap(spark, put(tmp_path, head + frame(row))).first().asDict()
    assert {k: got[k] for k in row} == row


LOG = """#separator \\x09
#fields\tts\tid.orig_h\tid.orig_p\tid.resp_h\tid.resp_p\turi \trequest_body_len\tstatus_code
#types\ttime\taddr\tport\taddr\tport\tstring\tcount\tcount
1.5\t10.0.0.1\t1000\t10.0.0.2\t80\t/a#b\t-\t200
2.5\t10.0.0.1\t1001\t10.0.0.2\t80\t(empty)\t7\t-
3.5\t10.0.0.1\t1002\t10.0.0.2\t80\tsay "hi"\t7\t404
#close\t2024
"""


def test_log_reader(spark, tmp_path):
    path = put(tmp_path, LOG.encode(), "http.log")
    text = logs.read_log(spark, path).orderBy("ts").collect()
    assert [r["uri"] for r in text] == ["/a#b", "(empty)", 'say "hi"']
    assert text[0]["request_body_len"] == "-"
    typed = logs.read_log(spark, path, typed=True)
    assert dict(typed.dtypes)["id.orig_p"] == "int" and dict(typed.dtypes)["ts"] == "double"
    assert [r["request_body_len"] for r in typed.orderBy("ts").collect()] == [None, 7, 7]


def test_log_discovery_and_empty_logs(spark, tmp_path):
    for name in ("zz", "http", "conn", "aa"):
        put(tmp_path, LOG.encode(), f"{name}.log")
    put(tmp_path, "\n".join(LOG.splitlines()[:3]).encode() + b"\n", "dns.log")
    put(tmp_path, b"", "ssl.log")
    files = logs.log_files(spark, str(tmp_path))
    assert list(files) == ["conn", "dns", "http", "aa", "zz"]
    assert list(logs.read_logs(spark, {**files, "gone": str(tmp_path / "gone.log")})) == ["conn", "http", "aa", "zz"]
    assert logs.read_log_or_empty(spark, str(tmp_path / "gone.log"), "uid string").count() == 0


def test_log_folders_rotate_and_change_columns(spark, tmp_path):
    for folder, name, text in (("d1", "conn", "#fields\tx\ty\n1\t2\n"), ("d2", "conn", "#fields\ty\tx\n20\t10\n"),
                               ("d2", "conn.2024-01-01", "#fields\tx\tz\n5\t7\n")):
        (tmp_path / folder).mkdir(exist_ok=True)
        put(tmp_path / folder, text.encode(), f"{name}.log")
    files = logs.log_files(spark, str(tmp_path))
    assert {k: len(v) for k, v in files.items()} == {"conn": 3}
    rows = logs.read_logs(spark, files)["conn"].select("x", "y", "z").collect()
    assert sorted(map(tuple, rows)) == [("1", "2", None), ("10", "20", None), ("5", None, "7")]


def test_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(1, 2.5, "x"), (2, None, None)], "a int, b double, c string")
    tables.write_csv(df, path)
    back = tables.read_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(Exception, match="already exists"):
        tables.write_csv(df, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_csv(spark, str(tmp_path / "none"))


def test_detect_and_block_run_keeps_history(spark, sf, tmp_path):
    from flowlens.plans.q_blocks import LEDGER_AS_OF, order_ledger
    from flowlens.plans.q_detect import flows
    path = str(tmp_path / "history")
    alarm = runs.detect_and_block(flows(spark, sf), order_ledger(spark, sf), LEDGER_AS_OF, history=path)
    saved = tables.read_history(spark, path)
    assert saved.count() == alarm.detections.count() == 114
    assert saved.schema.simpleString() == spark.createDataFrame([], DETECTIONS).schema.simpleString()
    assert alarm.ledger.join(alarm.opened.select("ip"), "ip", "left_semi").count() == alarm.opened.count()
    assert alarm.detections.where(F.col("timestamp") != F.lit(LEDGER_AS_OF).cast("timestamp")).count() == 0


def odd_capture(n=400, every=10, snap=65535, damage=None, head=None, body=b""):
    """Records of which each ``every``-th is damaged or has an odd header; the others' ports in order."""
    out, good = bytearray(struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, snap, 1)), []
    for i in range(n):
        frame = ether(0x0800, ipv4(6, tcp(i + 1, 80)) + b"x" * (i * 37 % 300))
        odd = i % every == every - 1
        frame += body if odd else b""
        sec, size, original = 1_700_000_000 + i, len(frame), len(frame)
        if odd and head:
            size, original = head(size)
            frame = frame[:size]
        record = struct.pack("<IIII", sec, 5, size, original)
        if odd and damage:
            record = damage(record)
        else:
            good += [i + 1] if size else []
        out += record + frame
    return bytes(out), good


@pytest.mark.parametrize("options,marks", [
    (dict(every=10, damage=lambda r: r[:8] + b"\xff\xff\xff\x7f" * 2), 40),
    (dict(every=2, damage=lambda r: r[:8] + b"\xff\xff\xff\x7f" * 2), 200),
    (dict(every=10, damage=lambda r: b"\xff" * 16), 40),
    (dict(every=10, damage=lambda r: r[:8] + struct.pack("<II", 5000, 5000)), 40),
    (dict(every=1, head=lambda n: (n, 0)), 0),
    (dict(every=10, head=lambda n: (n, 0)), 0),
    (dict(every=10, head=lambda n: (n, n - 20)), 0),
    (dict(every=5, head=lambda n: (0, n)), 0),
    (dict(every=100, snap=96, body=b"y" * 70_000, head=lambda n: (n, n)), 0)])
def test_records_between_damaged_or_odd_ones_are_kept(spark, tmp_path, options, marks):
    data, good = odd_capture(**options)
    path = put(tmp_path, data)
    for split in (None, 16_384):
        got = pcap.read_pcap(spark, path, split_bytes=split, keep_corrupt=True).select("src_port", "corrupt").collect()
        assert sorted(r.src_port for r in got if not r.corrupt) == good
        assert sum(r.corrupt for r in got) == marks


@pytest.mark.parametrize("order", ["<", ">"])
def test_large_and_damaged_blocks_do_not_end_a_file(spark, tmp_path, order):
    head, *rest = (block_capture(FRAMES[:k], order) for k in range(4))
    large = block(0xBAD, b"z" * (17 << 20), order)
    first, second, third = (rest[k][len(([head] + rest)[k]):] for k in range(3))
    path = put(tmp_path, head + first + large + second + third)
    assert rows(pcap.read_pcap(spark, path)) == WANT[:3]
    for size in (7, 100, 1 << 30):
        damaged = second[:4] + struct.pack(order + "I", size) + second[8:]
        got = pcap.read_pcap(spark, put(tmp_path, head + first + damaged + third, f"{size}.pcap"), keep_corrupt=True)
        assert sorted((r.corrupt, r.src_port) for r in got.collect()) == [(False, 0), (False, 1000), (True, 0)]


@pytest.mark.parametrize("split", [1000, 1777, 9000])
@pytest.mark.parametrize("order", ["<", ">"])
def test_ranges_of_blocks_equal_the_whole(spark, tmp_path, order, split):
    """Several sections, interfaces that later packets name, large foreign blocks, damaged lengths and a cut end."""
    parts = []
    for k in range(6):
        own = order if k != 3 else {"<": ">", ">": "<"}[order]
        data = block_capture(FRAMES * 3, own, 9 if k % 2 else None)
        parts += [data, block(0xBAD, bytes(900 * (k == 2) + 8), own)]
        # A whole capture as the body of a foreign block looks like blocks from inside.
        parts += [block(0xBAD, block_capture(FRAMES, own), own)]
    data = b"".join(parts)
    for name, bad in (("whole", data), ("cut", data[:-7]), ("hurt", data[:2000] + b"\xff" * 9 + data[2009:]),
                      ("size", data[:-900] + struct.pack(order + "I", 50) * 3 + data[-888:])):
        path = put(tmp_path, bad, f"{name}.pcapng")
        want = pcap.read_pcap(spark, path, split_bytes=None, keep_corrupt=True).drop("timestamp").collect()
        got = pcap.read_pcap(spark, path, split_bytes=split, keep_corrupt=True).drop("timestamp").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 100


def test_gzip_captures(spark, tmp_path):
    """Members one after another, a cut end and a second read of the same file."""
    plain = classic(FRAMES * 40)
    members = gzip.compress(plain[:3000]) + gzip.compress(plain[3000:])
    whole = rows(pcap.read_pcap(spark, put(tmp_path, plain)))
    for data in (gzip.compress(plain), members, members + bytes(64)):
        path = put(tmp_path, data, f"{len(data)}.pcap.gz")
        for _ in range(2):
            assert sorted(rows(pcap.read_pcap(spark, path, split_bytes=4096))) == sorted(whole)
    cut = put(tmp_path, gzip.compress(plain)[:-40], "cut.pcap.gz")
    assert 0 < pcap.read_pcap(spark, cut).count() < len(whole)
    blocks = put(tmp_path, gzip.compress(block_capture(FRAMES)), "b.pcapng.gz")
    assert rows(pcap.read_pcap(spark, blocks, split_bytes=100)) == WANT
    with pytest.raises(Exception, match="not a packet capture"):
        pcap.read_pcap(spark, put(tmp_path, gzip.compress(b"x" * 100), "no.gz")).count()


def test_landed_captures_are_read_in_ranges(spark, tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    data, good = odd_capture(n=300, every=20, damage=lambda r: b"\xff" * 16)
    put(folder, data)
    put(folder, gzip.compress(classic(FRAMES)), "b.pcap.gz")
    put(folder, block_capture(FRAMES), "c.pcapng")
    for split in (1000, 1 << 20):
        out, mark = str(tmp_path / f"out-{split}"), str(tmp_path / f"mark-{split}")
        stream = pcap.stream_pcap(spark, str(folder), split_bytes=split)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
        got = [r.src_port for r in spark.read.parquet(out).collect()]
        assert sorted(got) == sorted(good + 2 * [w[1] for w in WANT])


def test_records_in_blocks_of_bytes(spark, tmp_path, monkeypatch):
    """Records across the blocks that are read at once, and longer than one."""
    frames = [f + bytes(200 * (i % 7)) for i, f in enumerate(FRAMES * 20)]
    path = put(tmp_path, classic(frames))
    whole = list(pcap.decode_range(path, 0, None))
    for size in (64, 100, 700, 5000):
        monkeypatch.setattr(pcap, "BLOCK_BYTES", size)
        some = list(pcap.decode_range(path, 0, None))
        assert [r for b in some for r in b.to_pylist()] == [r for b in whole for r in b.to_pylist()]


def test_log_headers_with_their_own_separators(spark, tmp_path):
    text = ("#separator \\x2c\n#set_separator,;\n#empty_field,E\n#unset_field,U\n#path,x\n#fields,a,b,c,d\n#types,count,bool,set[int],vector[string]\n"
            "1,T,1;2,x;U\nU,F,E,E\n3,U,U,y\n#close,now\n")
    (tmp_path / "x.log").write_text(text)
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "x.log.gz").write_bytes(gzip.compress(text.encode()))
    want = [(1, True, [1, 2], ["x", None]), (3, None, None, ["y"]), (None, False, [], [])]
    for path in (tmp_path / "x.log", tmp_path / "z"):
        got = logs.read_log(spark, str(path), typed=True)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert logs.read_log(spark, str(tmp_path / "x.log")).where("a = 'U'").first()[2] == "E"
    header = logs.parse_header(text)
    assert (header.separator, header.set_separator, header.empty, header.unset) == (",", ";", "E", "U")
    assert logs.parse_header("#separator \\x09\nno header\n") is None
