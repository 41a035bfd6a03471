"""Packet views as capture files, so that the capture reader has something to read."""

from __future__ import annotations

import gzip
import math
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from flowlens.functions.packets import FLAG_LETTERS, dotted
from flowlens.session import drop_path, new_path, shuffles_freed, stage
from flowlens.sources.pcap import (BYTE_ORDER_MARK, ENHANCED_PACKET, INTERFACE, IPV4, MAGIC_MICRO, MAGIC_NANO, SECTION,
                                   open_target, resolved)

GROUP_BYTES = 1 << 30  # of captures that lie on the disk at a time,
MOST_GROUPS = 32       # or this part of all, if that is more
WRITTEN = pa.schema([("file", pa.string()), ("packets", pa.int64())])


def block(kind: int, body: bytes) -> bytes:
    """A block of a block-structured capture, its body filled up to whole words."""
    body += bytes(-len(body) % 4)
    return struct.pack("<II", kind, len(body) + 12) + body + struct.pack("<I", len(body) + 12)


def packet_block(record: bytes, interface: int, ticks: int) -> bytes:
    """The packet of a classic record as a block of an interface with ``ticks`` a second."""
    sec, micro, size, original = struct.unpack("<IIII", record[:16])
    at = (sec * 1_000_000 + micro) * (ticks // 1_000_000)
    return block(ENHANCED_PACKET, struct.pack("<IIIII", interface, at >> 32, at & 0xFFFFFFFF, size, original) + record[16:])


# Two interfaces: microseconds, and nanoseconds with the option that says so.
SECTION_HEAD = block(SECTION, struct.pack("<IHHq", BYTE_ORDER_MARK, 1, 0, -1)) + block(INTERFACE, struct.pack("<HHI", 1, 0, 65535)) + block(
    INTERFACE, struct.pack("<HHIHHBBBBHH", 1, 0, 65535, 9, 1, 9, 0, 0, 0, 0, 0))


def write_captures(packets: DataFrame, path: str, nanos: bool = False, short: bool = False, blocks: bool = False,
                   zipped: bool = False, section_packets: int = 500) -> DataFrame:
    """One capture file per partition below ``path``; returns the files with their counts.

    Files are classic, or block-structured with a new section every ``section_packets`` packets, which alternate between two
    interfaces; ``zipped`` puts either into gzip.

    Headers are rebuilt from the packet columns, the rest of a packet is zeros. A repeated task
    writes the same file again. With ``short`` a packet of size 0 is cut inside its IP header.
    """
    magic = MAGIC_NANO if nanos else MAGIC_MICRO

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = f"{path}/part-{TaskContext.get().partitionId():05d}.pcap" + ".gz" * zipped
        count = 0
        with open_target(target) as out:
            f = gzip.GzipFile(fileobj=out, mode="wb", compresslevel=1, mtime=0) if zipped else out
            if not blocks:
                f.write(struct.pack("<IHHiIII", magic, 2, 4, 0, 0, 65535, 1))
            for batch in batches:
                f.write(block_frames(batch, count, section_packets) if blocks else classic_frames(batch, nanos, short))
                count += batch.num_rows
            if blocks and not count:
                f.write(SECTION_HEAD)  # else the file would be no capture
            if zipped:
                f.close()
        yield pa.RecordBatch.from_pylist([{"file": target, "packets": count}], schema=WRITTEN)

    columns = ["src_ip", "dst_ip", "protocol", "packet_size", "src_port", "dst_port", "flags", "ts_us"]
    return packets.select(*columns).mapInArrow(save, "file string, packets bigint")


def frame(row: dict, nanos: bool = False, short: bool = False) -> bytes:
    """One classic record with an Ethernet frame of ``packet_size`` bytes."""
    def packed(ip: str) -> bytes:
        return bytes(int(p) for p in ip.split("."))
    bits = sum(1 << i for i, letter in enumerate(FLAG_LETTERS) if letter in row["flags"])
    if row["protocol"] == 6:
        body = struct.pack(">HHIIHHHH", row["src_port"], row["dst_port"], 0, 0, (5 << 12) | bits, 0, 0, 0)
    elif row["protocol"] == 17:
        body = struct.pack(">HHHH", row["src_port"], row["dst_port"], 8, 0)
    else:
        body = b"\0" * 4
    ip = struct.pack(">BBHHHBBH", 0x45, 0, max(20, row["packet_size"] - 14), 0, 0, 64, row["protocol"], 0)
    data = b"\0" * 12 + struct.pack(">H", IPV4) + ip + packed(row["src_ip"]) + packed(row["dst_ip"]) + body
    data = data[:20] if short and row["packet_size"] == 0 else data.ljust(row["packet_size"], b"\0")
    sec, micro = divmod(row["ts_us"], 1_000_000)
    return struct.pack("<IIII", sec, micro * (1000 if nanos else 1), len(data), len(data)) + data


HEADERS = 54  # bytes of the longest link, network and transport headers of a frame


def _numbers(batch: pa.RecordBatch, name: str, low: int, high: int, used: np.ndarray | bool = True) -> np.ndarray:
    """A column as numbers; those that are used have to be in [low, high], else a header has no place for them."""
    column = batch.column(name)
    values = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if (used & (column.is_null().to_numpy(zero_copy_only=False) | (values < low) | (values > high))).any():
        raise ValueError(f"{name} is missing or does not fit its field")
    return values


def _coded(batch: pa.RecordBatch, name: str, code: Callable[[str], int]) -> np.ndarray:
    """The code of each text of a column; distinct texts are coded once."""
    column = batch.column(name)
    if column.null_count:
        raise ValueError(f"{name} is missing")
    texts = column.dictionary_encode()
    codes = np.array([code(t) for t in texts.dictionary.to_pylist()], np.int64)
    return codes[texts.indices.to_numpy()] if len(codes) else codes


def _address(ip: str) -> int:
    return int.from_bytes(bytes(int(p) for p in ip.split(".")), "big")


def _frames(batch: pa.RecordBatch, short: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Times, lengths, and the first ``HEADERS`` bytes of the frame of each row, as ``frame`` makes them."""
    n = batch.num_rows
    protocol, size = _numbers(batch, "protocol", 0, 255), _numbers(batch, "packet_size", -1 << 31, 65549)
    bits = _coded(batch, "flags", lambda text: sum(1 << i for i, letter in enumerate(FLAG_LETTERS) if letter in text))
    tcp, udp = protocol == 6, protocol == 17
    sport, dport = (_numbers(batch, name, 0, 65535, tcp | udp) for name in ("src_port", "dst_port"))
    head = np.zeros((n, HEADERS), np.uint8)

    def put(at: int, width: int, values, rows=slice(None)) -> None:
        head[rows, at:at + width] = np.broadcast_to(values, n)[rows].astype(f">u{width}").reshape(-1, 1).view(np.uint8)

    put(12, 2, IPV4)
    put(14, 1, 0x45)
    put(16, 2, np.maximum(20, size - 14))
    put(22, 1, 64)
    put(23, 1, protocol)
    put(26, 4, _coded(batch, "src_ip", _address))
    put(30, 4, _coded(batch, "dst_ip", _address))
    put(34, 2, sport, tcp | udp)
    put(36, 2, dport, tcp | udp)
    put(38, 2, 8, udp)
    put(46, 2, (5 << 12) | bits, tcp)
    length = np.maximum(size, np.where(tcp, 54, np.where(udp, 42, 38)))
    return _numbers(batch, "ts_us", 0, (1 << 32) * 1_000_000 - 1), np.where(short & (size == 0), 20, length), head


def _scatter(out: np.ndarray, at: np.ndarray, rows: np.ndarray, widths=None) -> None:
    """Each row of bytes, or the first ``widths`` of it, at its offset."""
    where = at[:, None] + np.arange(rows.shape[1])
    if widths is None:
        out[where] = rows
    else:
        inside = np.arange(rows.shape[1]) < widths[:, None]
        out[where[inside]] = rows[inside]


def _words(n: int, *values) -> np.ndarray:
    """Rows of 32-bit words, as bytes."""
    return np.stack([np.broadcast_to(v, n).astype("<u4") for v in values], axis=1).view(np.uint8)


def classic_frames(batch: pa.RecordBatch, nanos: bool = False, short: bool = False) -> bytes:
    """The classic records of a batch: ``frame`` of each row, one after the other."""
    times, length, head = _frames(batch, short)
    n, ends = len(times), np.cumsum(16 + length)
    out = np.zeros(int(ends[-1]) if n else 0, np.uint8)
    record = _words(n, times // 1_000_000, times % 1_000_000 * (1000 if nanos else 1), length, length)
    _scatter(out, ends - 16 - length, np.concatenate([record, head], axis=1), 16 + np.minimum(length, HEADERS))
    return out.tobytes()


def block_frames(batch: pa.RecordBatch, number: int, section_packets: int) -> bytes:
    """The blocks of a batch whose first packet is number ``number`` of its file: ``packet_block`` of each row, interface by
    interface, and a new section every ``section_packets``."""
    times, length, head = _frames(batch, False)
    n = len(times)
    order = number + np.arange(n)
    opens, which, size = order % section_packets == 0, order % 2, 32 + (length + 3) // 4 * 4
    ticks = times * np.where(which == 0, 1, 1000)
    ends = np.cumsum(size + opens * len(SECTION_HEAD))
    at = ends - size
    out = np.zeros(int(ends[-1]) if n else 0, np.uint8)
    _scatter(out, at[opens] - len(SECTION_HEAD), np.broadcast_to(np.frombuffer(SECTION_HEAD, np.uint8), (int(opens.sum()), len(SECTION_HEAD))))
    record = _words(n, ENHANCED_PACKET, size, which, ticks >> 32, ticks & 0xFFFFFFFF, length, length)
    _scatter(out, at, np.concatenate([record, head], axis=1), 28 + np.minimum(length, HEADERS))
    _scatter(out, ends - 4, _words(n, size))
    return out.tobytes()


OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
ADDRESS = f"^{OCTET}([.]{OCTET}){{3}}$"
RESERVED = 240 << 24  # addresses from here on are assigned to nobody


def stand_ins(spark: SparkSession, rows: DataFrame) -> DataFrame | None:
    """An unused reserved address for each name that no packet header can hold (``address``, ``name``); None if there is none."""
    every = stage(rows.select(F.col("src_ip").alias("name")).union(rows.select("dst_ip")).distinct(), "addresses")
    held = F.col("name").rlike(ADDRESS)
    odd = every.where(~held)
    count = odd.count()
    if not count:
        return None
    number = sum(F.split("name", "[.]")[i].cast("bigint") * (1 << 24 - 8 * i) for i in range(4))
    last = every.where(held).agg(F.max(number)).first()[0]
    first = max(RESERVED, (last or 0) + 1)
    if first + count > 1 << 32:
        raise ValueError(f"no room for {count} names after the largest address")
    numbered = odd.orderBy("name").rdd.zipWithIndex().map(lambda found: (first + found[1], found[0][0]))
    return stage(spark.createDataFrame(numbered, "number bigint, name string").select(dotted(F.col("number")).alias("address"), "name"), "names")


def addressed(rows: DataFrame, names: DataFrame | None) -> DataFrame:
    """The rows with the stand-ins of their names; ``resolved`` is the way back."""
    return rows if names is None else resolved(rows, names.select(F.col("name").alias("address"), F.col("address").alias("name")))


class Captures:
    """A packet table as groups of capture files of about ``GROUP_BYTES``, handed out as folders, one after the other.

    The files of a group are written when it is asked for and deleted when the next one is. Frames are filled up with zeros, so
    all captures together take some thirty times the disk of the table. Names that are no IPv4 addresses are written as the
    addresses that ``names`` gives them, the same for the same table; pass it to ``resolved`` with what was read.
    """

    def __init__(self, spark: SparkSession, rows: DataFrame, parts: int = 4, base: str | None = None, **how):
        self.spark, self.parts, self.how = spark, parts, how
        self.base = base or new_path(spark, "captures")
        size = F.greatest(F.col("packet_size"), F.lit(HEADERS)).cast("bigint") + 32
        self.packets, total = rows.agg(F.count("*"), F.sum(size)).first()
        self.groups = min(MOST_GROUPS, max(1, math.ceil((total or 0) / GROUP_BYTES)))
        self.names = stand_ins(spark, rows)
        self.rows, self.sorted = addressed(rows, self.names), None

    def __iter__(self) -> Iterator[str]:
        try:
            for number in range(self.groups):
                folder = f"{self.base}/{number:05d}"
                try:
                    with shuffles_freed(self.spark):
                        write_captures(self._group(number).repartition(self.parts, "src_ip"), folder, **self.how).collect()
                    yield folder
                finally:
                    drop_path(self.spark, folder)
        finally:
            if self.sorted is not None:
                drop_path(self.spark, self.sorted)
                self.sorted = None

    def _group(self, number: int) -> DataFrame:
        """Rows of a group; a row belongs to one by all its values, and the table is sorted into groups once."""
        if self.groups == 1:
            return self.rows
        if self.sorted is None:
            path = new_path(self.spark, "groups")
            group = F.pmod(F.xxhash64(*self.rows.columns), F.lit(self.groups)).alias("group")
            with shuffles_freed(self.spark):
                self.rows.select("*", group).write.partitionBy("group").parquet(path)
            self.sorted = path
        schema = StructType([*self.rows.schema.fields, StructField("group", LongType())])
        return self.spark.read.schema(schema).parquet(self.sorted).where(F.col("group") == number).drop("group")
