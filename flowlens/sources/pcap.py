"""Packet capture files as a packet table, in batch and as files land.

Files are listed by Spark, decoded in Arrow batches on the executors and read as streams, so
memory stays flat whatever their size. A large classic capture is cut into byte ranges at proven
record starts; decoding searches on after a damaged record, and finds the same ones in any range.
A block-structured one is walked by all its ranges at once, each from a block found near its start; a range whose
start is not where the one before ends is walked again from there. Interfaces are handed from range to range. A gzip
capture is inflated once, to the shared folder, and then cut like any other.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO, NamedTuple

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from flowlens.functions.packets import dotted, flag_letters, protocol_class
from flowlens.functions.timing import from_micros
from flowlens.session import drop_path, new_path, shuffles_freed, stage, work_path
from flowlens.sources.files import exists, locate, open_input, publish

SPLIT_BYTES = 256 * 1024 * 1024
BATCH_ROWS = 50_000
BLOCK_BYTES = 4 * 1024 * 1024
WIDTH = 200               # bytes of a packet that are gathered: HEAD_BYTES and zeros
HEAD_BYTES = 160          # link header, tags, longest IPv4 header and the transport fields
PROOF_RECORDS = 64        # believable records in a row that prove a start
SEARCH_BYTES = 2 * 1024 * 1024  # read at a time while searching
NEAR_SECONDS = 86_400     # between the times of neighbours
MOST_BESIDE = 256 * 1024  # bytes after a range that are read with its last blocks
MOST_CAPTURED = 16 * 1024 * 1024  # bytes of a record, whatever the file header says

# Fixed values of the two container formats.
MAGIC_MICRO, MAGIC_NANO = 0xA1B2C3D4, 0xA1B23C4D
SECTION, INTERFACE, OLD_PACKET, SIMPLE_PACKET, ENHANCED_PACKET = 0x0A0D0D0A, 1, 2, 3, 6
BYTE_ORDER_MARK = 0x1A2B3C4D
# Link types: bytes before the network header, and where its type field is (None: raw IP).
LINKS = {1: (14, 12), 101: (0, None), 12: (0, None), 14: (0, None), 228: (0, None),
         113: (16, 14), 276: (20, 0), 0: (4, None), 108: (4, None)}
TAGS = (0x8100, 0x88A8, 0x9100)
IPV4 = 0x0800

RAW = ("file string, ts_us bigint, packet_size int, protocol int, src bigint, dst bigint, "
       "fragment int, sport int, dport int, bits int, corrupt boolean")
ARROW = pa.schema([
    ("file", pa.string()), ("ts_us", pa.int64()), ("packet_size", pa.int32()), ("protocol", pa.int32()),
    ("src", pa.int64()), ("dst", pa.int64()), ("fragment", pa.int32()), ("sport", pa.int32()),
    ("dport", pa.int32()), ("bits", pa.int32()), ("corrupt", pa.bool_())])


def open_stream(path: str) -> BinaryIO:
    """A file of any file system Arrow knows, opened for reading with seek."""
    if path.startswith("file:"):
        return open("/" + path[5:].lstrip("/"), "rb", buffering=BLOCK_BYTES)
    if "://" not in path:
        return open(path, "rb", buffering=BLOCK_BYTES)
    return open_input(path)


def open_target(path: str) -> BinaryIO:
    """A new file of any file system Arrow knows; folders are made."""
    system, inner = locate(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner, compression=None)  # else a name that ends with .gz would compress again


class _Classic:
    """File header of a classic capture."""
    size = 24

    def __init__(self, head: bytes):
        self.order = "<" if struct.unpack("<I", head[:4])[0] in (MAGIC_MICRO, MAGIC_NANO) else ">"
        magic, _, _, _, _, self.snap, link = struct.unpack(self.order + "IHHiIII", head[:24])
        self.per_second = 1_000_000_000 if magic == MAGIC_NANO else 1_000_000
        self.link = link & 0x0FFFFFFF
        self.record = struct.Struct(self.order + "IIII")
        self.largest = max(self.snap or 262144, 65535)

    def believable(self, head: bytes) -> bool:
        """Whether 16 bytes can be the header of a record."""
        if len(head) < 16:
            return False
        _, frac, size, original = self.record.unpack(head)
        return 0 < size <= min(self.largest, MOST_CAPTURED) and size <= original <= 0x40000 + self.largest \
            and frac < self.per_second

    def possible(self, head: bytes, sec: int | None) -> bool:
        """Whether 16 bytes can be the header of a neighbour of a record of that second, whatever its lengths say."""
        if len(head) < 16 or sec is None:
            return False
        own, frac, size, original = self.record.unpack(head)
        return abs(own - sec) <= NEAR_SECONDS and frac < self.per_second and (size > 0 or original > 0)

    def time(self, sec, frac):
        return sec * 1_000_000 + frac * 1_000_000 // self.per_second

    def follow(self, data: bytes, end: int, length: int) -> tuple[list[int], bool]:
        """Offsets of the records in a row whose headers are believable and lead to a possible neighbour, or to the end of the
        file, ``length``; they start before ``end``. And whether they only stop because the data does."""
        read, most, held = self.record.unpack_from, min(self.largest, MOST_CAPTURED), len(data)
        longest, per_second = 0x40000 + self.largest, self.per_second
        out, at = [], 0
        if held < 16:
            return out, False
        sec, frac, size, original = read(data, 0)
        while 0 < size <= most and size <= original <= longest and frac < per_second:
            following = at + 16 + size
            if following == length:
                out.append(at)
                return out, True
            if following + 16 > held:
                return out, held < length and at > 0
            own, frac, size, original = read(data, following)
            if not -NEAR_SECONDS <= own - sec <= NEAR_SECONDS or frac >= per_second or size == original == 0:
                return out, False
            out.append(at)
            at, sec = following, own
            if at >= end:
                return out, True
        return out, False

    def heads(self, data: bytes, offsets: list[int]) -> tuple[Heads, int]:
        """The records at these offsets, and the second of the last."""
        at = np.array(offsets, np.int64)
        raw = np.frombuffer(data + bytes(WIDTH + 16), np.uint8)
        fields = np.ascontiguousarray(sliding_window_view(raw, 16)[at]).view(self.order + "u4").astype(np.int64)
        sec, frac, size = fields[:, 0], fields[:, 1], fields[:, 2]
        grid = sliding_window_view(raw, WIDTH)[at + 16]
        grid[np.arange(WIDTH) >= np.minimum(size, HEAD_BYTES)[:, None]] = 0
        link = np.full(len(at), self.link, np.int64)
        return Heads(self.time(sec, frac), link, size, np.ones(len(at), bool), grid), int(sec[-1])

    def odd(self, f: BinaryIO, at: int, head: bytes, sec: int | None, length: int) -> bool:
        """Whether a header that is not believable belongs to a whole record: its length leads to a neighbour, or to the end."""
        if len(head) < 16:
            return False
        own, frac, size, original = self.record.unpack(head)
        following = at + 16 + size
        if size > MOST_CAPTURED or frac >= self.per_second or following > length or size == original == 0 \
                or (sec is not None and abs(own - sec) > NEAR_SECONDS):
            return False
        if following == length:
            return sec is not None
        f.seek(following)
        head = f.read(16)
        return self.possible(head, own) and self.record.unpack(head)[2] <= MOST_CAPTURED

    def candidates(self, data: bytes) -> np.ndarray:
        """Offsets in ``data`` at which a believable header lies."""
        out = []
        for shift in range(4):
            words = np.frombuffer(data, self.order + "u4", (len(data) - shift) // 4 if len(data) > shift else 0, shift).astype(np.int64)
            if len(words) < 4:
                continue
            frac, size, original = words[1:-2], words[2:-1], words[3:]
            good = (size > 0) & (size <= min(self.largest, MOST_CAPTURED)) & (size <= original) \
                & (original <= 0x40000 + self.largest) & (frac < self.per_second)
            out.append(np.flatnonzero(good) * 4 + shift)
        return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)


def _container(head: bytes) -> str | None:
    if len(head) < 24:
        return None
    for order in "<>":
        if struct.unpack(order + "I", head[:4])[0] in (MAGIC_MICRO, MAGIC_NANO):
            return "classic"
    return "blocks" if struct.unpack("<I", head[:4])[0] == SECTION else None


# A record is (time in microseconds, link type, first bytes, captured length, complete).
Record = tuple[int, int, bytes, int, bool]


class Heads:
    """First bytes of records, gathered: times, link types, captured lengths, whether they are whole, and a row of bytes each."""

    def __init__(self, times, links, sizes, whole, grid):
        self.times, self.links, self.sizes, self.whole, self.grid = times, links, sizes, whole, grid

    @classmethod
    def of(cls, records: list[Record]) -> Heads:
        grid = np.frombuffer(b"".join([r[2].ljust(WIDTH, b"\0") for r in records]), np.uint8).reshape(len(records), WIDTH)
        return cls(*(np.array([r[k] for r in records], kind) for k, kind in ((0, np.int64), (1, np.int64), (3, np.int64), (4, bool))), grid)

    @classmethod
    def joined(cls, heads: list[Heads]) -> Heads:
        return heads[0] if len(heads) == 1 else cls(
            *(np.concatenate([getattr(h, k) for h in heads]) for k in ("times", "links", "sizes", "whole", "grid")))


def gathered(found: Iterator[Heads | Record]) -> Iterator[Heads]:
    """Gathered and single records, in their order, together by about ``BATCH_ROWS``."""
    batch: list[Heads] = []
    single: list[Record] = []
    rows = 0
    for one in found:
        if isinstance(one, Heads):
            if single:
                batch, single = [*batch, Heads.of(single)], []
            batch.append(one)
            rows += len(one.times)
        else:
            single.append(one)
            rows += 1
        if rows >= BATCH_ROWS:
            yield Heads.joined([*batch, Heads.of(single)] if single else batch)
            batch, single, rows = [], [], 0
    if rows:
        yield Heads.joined([*batch, Heads.of(single)] if single else batch)


def classic_heads(f: BinaryIO, start: int, end: int | None) -> Iterator[Heads]:
    """Records that start in [start, end); both are starts of believable records, or the ends of the file.

    Records are followed inside blocks of bytes, and the heads of a block are gathered at once; where a header is odd, one step
    looks closer. A damaged record gives one incomplete record, and reading goes on at the next believable one. Whether a
    record is damaged depends on the file alone, so the ranges of a file give what the whole file gives.
    """
    f.seek(0)
    about = _Classic(f.read(_Classic.size))
    length = f.seek(0, 2)
    at, last = max(start, _Classic.size), None
    end = length if end is None else end
    single: list[Record] = []
    while at < end:
        f.seek(at)
        data = f.read(min(BLOCK_BYTES, length - at))
        offsets, more = about.follow(data, end - at, length - at)
        if offsets:
            if single:
                yield Heads.of(single)
                single = []
            heads, last = about.heads(data, offsets)
            yield heads
            at += offsets[-1] + 16 + int(heads.sizes[-1])
            if more or at >= end:
                continue
        record, following, last = _classic_step(f, about, at, last, length)
        single.append(record)
        if len(single) == BATCH_ROWS:
            yield Heads.of(single)
            single = []
        if following is None:
            break
        at = following
    if single:
        yield Heads.of(single)


def _classic_step(f: BinaryIO, about: _Classic, at: int, last: int | None, length: int) -> tuple[Record, int | None, int | None]:
    """The record at ``at``, where the next one starts (None: there is none) and the second of this one."""
    f.seek(at)
    head = f.read(16)
    if not about.believable(head) and not about.odd(f, at, head, last, length):
        return (0, about.link, b"", len(head), False), find_record(f, about, at + 1, length, last, True), last
    sec, frac, size, _ = about.record.unpack(head)
    following = at + 16 + size
    f.seek(at + 16)
    data = f.read(min(size, HEAD_BYTES))
    held = min(size, length - at - 16)
    f.seek(min(following, length))
    if following != length and not about.possible(f.read(16), sec):
        found = find_record(f, about, at + 16, length, sec, True)
        if found is not None and found < following:
            return (0, about.link, b"", 0, False), found, last  # its length leads past the next record
    # This record is whole, or cut off by the end of the file.
    return (about.time(sec, frac), about.link, data, held, held == size), following, sec


Interface = tuple[int, int, int, int]  # link type, ticks per second, seconds to add, snap length


class PacketRow(NamedTuple):
    """Packet blocks in a row: the bytes they were read in, and their offsets there."""
    data: memoryview
    offsets: list[int]
    order: str


def _in_a_row(data: memoryview, order: str, room: int) -> tuple[list[int], int]:
    """Offsets below ``room`` of the enhanced packet blocks at the beginning of ``data`` that are whole, and where they end."""
    head, tail, held = struct.Struct(order + "II").unpack_from, struct.Struct(order + "I").unpack_from, len(data)
    out, at = [], 0
    while at < room and at + 12 <= held:
        kind, size = head(data, at)
        if kind != ENHANCED_PACKET or not 32 <= size <= held - at or tail(data, at + size - 4)[0] != size:
            break
        out.append(at)
        at += size
    return out, at


def _blocks(f: BinaryIO, at: int, order: str, stop: int, length: int) -> Iterator[PacketRow | tuple[int, int | None, int, str, bool, int]]:
    """Blocks that start in [at, stop): offset, kind, size, byte order, whether the lengths agree, and where the next one starts.

    Whole packet blocks in a row are followed inside blocks of bytes and given out together. A damaged length gives kind -1, and
    reading goes on at the next block whose lengths agree.
    """
    data, begin = memoryview(b""), at  # bytes of the file, and their offset
    while at < min(stop, length):
        offsets, end = _in_a_row(data[at - begin:], order, stop - at)
        wanted = min(BLOCK_BYTES, length - at, stop - at + MOST_BESIDE)
        if not offsets and len(data) - (at - begin) <= wanted // 2:
            f.seek(at)
            data, begin = memoryview(f.read(wanted)), at
            offsets, end = _in_a_row(data, order, stop - at)
        if offsets:
            yield PacketRow(data[at - begin:at - begin + end], offsets, order)
            at += end
            continue
        kind, size, order, agreed = _block(f, at, order, length)
        following = at + size
        if not agreed:
            found = _find_block(f, at + 4, order, length)
            if found is not None or not 12 <= size:
                kind, following = -1, length if found is None else found
            # Else the end of the file cuts this block off.
        yield at, kind, size, order, agreed, following
        at = following


def walk_blocks(f: BinaryIO, at: int, order: str, stop: int) -> tuple[int, str, bool, list[Interface]]:
    """Where the walk from ``at`` leaves the range that ends at ``stop``, in which byte order, whether a section begins on the
    way, and the interfaces since then."""
    length, began, links = f.seek(0, 2), False, []
    for found in _blocks(f, at, order, stop, length):
        if isinstance(found, PacketRow):
            at += len(found.data)
            continue
        here, kind, size, order, agreed, at = found
        if kind == SECTION:
            began, links = True, []
        elif kind == INTERFACE and agreed:
            f.seek(here + 8)
            links.append(_interface(f.read(size - 12) + bytes(4), order))
    return at, order, began, links


def row_heads(row: PacketRow, links: list[Interface]) -> Heads:
    """The packets of blocks in a row, gathered at once."""
    at = np.array(row.offsets, np.int64)
    raw = np.frombuffer(bytes(row.data) + bytes(WIDTH), np.uint8)
    fields = np.ascontiguousarray(sliding_window_view(raw, 28)[at]).view(row.order + "u4").astype(np.int64)
    size, which, high, low, captured = (fields[:, k] for k in range(1, 6))
    known = [*links, (1, 1_000_000, 0, 0)]  # the last one is that of packets without an interface
    which = np.minimum(which, len(links))
    plain = np.array([0 < x[1] <= 10 ** 12 and abs(x[2]) < 1 << 40 for x in known])[which] & (high < 1 << 31)
    per_second = np.array([x[1] if 0 < x[1] <= 10 ** 12 else 1 for x in known], np.int64)[which]
    shift = np.array([x[2] if abs(x[2]) < 1 << 40 else 0 for x in known], np.int64)[which]
    ticks = ((high & 0x7FFFFFFF) << 32) | low
    seconds, rest = ticks // per_second, ticks % per_second
    plain &= seconds < 1 << 42
    times = (shift + np.where(plain, seconds, 0)) * 1_000_000 + rest * 1_000_000 // per_second
    for i in np.flatnonzero(~plain).tolist():  # too large for 64 bits on the way
        _, ticks_per_second, added, _ = known[which[i]]
        times[i] = added * 1_000_000 + ((int(high[i]) << 32) | int(low[i])) * 1_000_000 // ticks_per_second
    held = np.minimum(captured, size - 32)
    grid = sliding_window_view(raw, WIDTH)[at + 28]
    grid[np.arange(WIDTH) >= np.minimum(held, HEAD_BYTES)[:, None]] = 0
    return Heads(times, np.array([x[0] for x in known], np.int64)[which], held, held == captured, grid)


def block_records(f: BinaryIO, start: int = 0, stop: int | None = None, order: str = "<",
                  links: list[Interface] | None = None) -> Iterator[Heads | Record]:
    """Records of a block-structured capture, over all its sections and interfaces, or of the blocks that start in [start, stop).

    Packets in a row come gathered, others one by one.

    ``order`` and ``links`` are the byte order and the interfaces known at the start. Blocks of other kinds are stepped over,
    whatever their size; of packets only the first bytes are read. A damaged length gives one incomplete record.
    """
    length, links = f.seek(0, 2), list(links or [])
    for found in _blocks(f, start, order, length if stop is None else stop, length):
        if isinstance(found, PacketRow):
            yield row_heads(found, links)
            continue
        at, kind, size, order, agreed, _ = found
        room = min(size, length - at) - (12 if agreed else 8)  # of the body
        f.seek(at + 8)
        if kind == -1:
            yield 0, 1, b"", 0, False
        elif kind == SECTION:
            links = []
        elif kind == INTERFACE and agreed:
            links.append(_interface(f.read(room) + bytes(4), order))
        elif kind in (ENHANCED_PACKET, OLD_PACKET):
            body = f.read(min(room, 20 + HEAD_BYTES))
            if len(body) < 20:
                yield 0, 1, b"", len(body), False
            else:
                if kind == ENHANCED_PACKET:
                    which, high, low, captured, _ = struct.unpack(order + "IIIII", body[:20])
                else:
                    which, _, high, low, captured, _ = struct.unpack(order + "HHIIII", body[:20])
                link, per_second, shift, _ = links[which] if which < len(links) else (1, 1_000_000, 0, 0)
                ticks, held = (high << 32) | low, min(captured, room - 20)
                yield (shift * 1_000_000 + ticks * 1_000_000 // per_second, link, body[20:20 + min(held, HEAD_BYTES)],
                       held, held == captured)
        elif kind == SIMPLE_PACKET and room >= 4:
            link, _, _, snap = links[0] if links else (1, 1_000_000, 0, 0)
            body = f.read(min(room, 4 + HEAD_BYTES))
            original = struct.unpack(order + "I", body[:4])[0]
            captured = min(original, snap or original)
            held = min(captured, room - 4)
            yield 0, link, body[4:4 + min(held, HEAD_BYTES)], held, held == captured
        elif kind is None:  # less than a header
            yield 0, 1, b"", length - at, False


def _block(f: BinaryIO, at: int, order: str, length: int) -> tuple[int | None, int, str, bool]:
    """Kind, size and byte order of the block at ``at``, and whether the size at its end is the same."""
    f.seek(at)
    head = f.read(12)
    if len(head) < 8:
        return None, 12, order, False
    if struct.unpack("<I", head[:4])[0] == SECTION:  # the same in both orders
        order = "<" if head[8:] == struct.pack("<I", BYTE_ORDER_MARK) else ">"
    kind, size = struct.unpack(order + "II", head[:8])
    if not 12 <= size <= length - at:
        return kind, size, order, False
    f.seek(at + size - 4)
    return kind, size, order, f.read(4) == head[4:8]


def _find_block(f: BinaryIO, near: int, order: str, length: int) -> int | None:
    """The first offset from ``near`` on of a section, interface or packet whose lengths agree."""
    while near + 12 <= length:
        f.seek(near)
        data = f.read(min(SEARCH_BYTES + 7, length - near))
        out = []
        for shift in range(4):
            words = np.frombuffer(data, order + "u4", max(0, len(data) - shift) // 4, min(shift, len(data)))
            out.append(np.flatnonzero(np.isin(words[:-1], (SECTION, INTERFACE, OLD_PACKET, SIMPLE_PACKET, ENHANCED_PACKET))) * 4 + shift)
        for offset in np.sort(np.concatenate(out)).tolist():
            if _block(f, near + offset, order, length)[3]:
                return near + offset
        near += max(1, len(data) - 7)
    return None


def _interface(body: bytes, order: str) -> tuple[int, int, int, int]:
    """(link type, ticks per second, seconds to add, snap length) of an interface block."""
    link, _, snap = struct.unpack(order + "HHI", body[:8])
    per_second, shift, at = 1_000_000, 0, 8
    while at + 4 <= len(body) - 4:
        code, size = struct.unpack(order + "HH", body[at:at + 4])
        value = body[at + 4:at + 4 + size]
        if code == 0:
            break
        if code == 9 and size >= 1:
            per_second = 1 << (value[0] & 0x7F) if value[0] & 0x80 else 10 ** value[0]
        elif code == 14 and size >= 8:
            shift = struct.unpack(order + "q", value[:8])[0]
        at += 4 + (size + 3) // 4 * 4
    return link, per_second, shift, snap


def find_record(f: BinaryIO, about: _Classic, near: int, length: int, sec: int | None = None,
                short: bool = False) -> int | None:
    """The first offset from ``near`` on at which a long run of believable records starts, or one up to the end.

    With ``short`` a believable record will do whose length leads to a neighbour, if it is near the second ``sec`` or, without
    one, if the neighbour is believable too.
    """
    while near + 16 <= length:
        f.seek(near)
        data = f.read(min(SEARCH_BYTES + 15, length - near))
        for offset in about.candidates(data).tolist():
            if short and _linked(f, about, near + offset, sec) or _proven(f, about, near + offset, length):
                return near + offset
        near += max(1, len(data) - 15)
    return None


def _linked(f: BinaryIO, about: _Classic, at: int, sec: int | None) -> bool:
    f.seek(at)
    head = f.read(16)
    own, _, size, _ = about.record.unpack(head)
    if sec is not None and not about.possible(head, sec):
        return False
    f.seek(at + 16 + size)
    head = f.read(16)
    return about.possible(head, own) and (sec is not None or about.believable(head))


def _proven(f: BinaryIO, about: _Classic, at: int, length: int) -> bool:
    for _ in range(PROOF_RECORDS):
        if at == length:
            return True
        f.seek(at)
        head = f.read(16)
        if not about.believable(head):
            return False
        at += 16 + about.record.unpack(head)[2]
    return at <= length


def range_start(path: str, length: int, near: int) -> int | None:
    """Where the range that begins near ``near`` starts; None if it has no start of its own."""
    if near == 0:
        return 0
    with open_stream(path) as f:
        head = f.read(24)
        return find_record(f, _Classic(head), near, length) if _container(head) == "classic" else None


def _decode(file: str, heads: Heads) -> pa.RecordBatch:
    """IPv4 rows of a batch of records: fields are gathered by numpy, one pass per field."""
    times, sizes, whole, links, grid = heads.times, heads.sizes, heads.whole, heads.links, heads.grid
    n = len(times)
    held = np.minimum(sizes, HEAD_BYTES)
    rows = np.arange(n)

    def byte(at: np.ndarray) -> np.ndarray:
        return grid[rows, np.minimum(at, WIDTH - 1)].astype(np.int64)

    def word(at: np.ndarray) -> np.ndarray:
        return (byte(at) << 8) | byte(at + 1)

    start = np.zeros(n, dtype=np.int64)
    network = np.full(n, -1, dtype=np.int64)
    for link, (skip, field) in LINKS.items():
        of = links == link
        if not of.any():
            continue
        start[of] = skip
        if field is None:
            version = byte(np.full(n, skip)) >> 4
            network[of] = np.where(version == 4, IPV4, 0)[of]
        else:
            network[of] = word(np.full(n, field))[of]
    for _ in range(4):  # stacked tags
        tagged = np.isin(network, TAGS) & (start + 4 <= HEAD_BYTES)
        if not tagged.any():
            break
        network = np.where(tagged, word(start + 2), network)
        start = np.where(tagged, start + 4, start)
    version, header = byte(start) >> 4, (byte(start) & 15) * 4
    ip = (network == IPV4)
    short = ip & ((held < start + 20) | (version != 4) | (header < 20) | (held < start + header))
    fragment = word(start + 6) & 0x1FFF
    protocol = byte(start + 9)
    body = start + header
    first = ip & ~short & (fragment == 0)
    tcp, udp = first & (protocol == 6), first & (protocol == 17)
    short |= (tcp & (held < body + 20)) | (udp & (held < body + 8))
    ported = (tcp | udp) & ~short
    corrupt = short | ~whole
    kept = ip | ~whole

    def address(at: np.ndarray) -> np.ndarray:
        return (word(at) << 16) | word(at + 2)

    columns = {
        "ts_us": times, "packet_size": sizes, "protocol": protocol,
        "src": address(start + 12), "dst": address(start + 16), "fragment": fragment,
        "sport": np.where(ported, word(body), 0), "dport": np.where(ported, word(body + 2), 0),
        "bits": np.where(tcp & ~short, word(body + 12) & 0x1FF, 0), "corrupt": corrupt}
    arrays = [pa.array([file] * int(kept.sum()), pa.string())]
    for f in list(ARROW)[1:]:
        arrays.append(pa.array(columns[f.name][kept], f.type, safe=False))
    return pa.RecordBatch.from_arrays(arrays, schema=ARROW)


def decode_range(path: str, start: int, end: int | None, order: str | None = None, links: list[Interface] | None = None) -> Iterator[pa.RecordBatch]:
    """The packets of the records that start in [start, end); of a block-structured capture with the byte order and interfaces there."""
    with open_stream(path) as f:
        head = f.read(24)
        kind = _container(head)
        if kind is None:
            raise ValueError(f"not a packet capture: {path}")
        if kind == "classic":
            for heads in classic_heads(f, start, end):
                yield _decode(path, heads)
            return
        for heads in gathered(block_records(f, start, end, order or "<", links)):
            yield _decode(path, heads)


def _listing(spark: SparkSession, path: str | list[str], glob: str | None) -> DataFrame:
    """Path, length and time of change per file. Contents are not read: the content column is never selected."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", F.unix_micros("modificationTime").alias("changed"))


GZIP = b"\x1f\x8b"
CAPTURE = pa.schema([("path", pa.string()), ("length", pa.int64()), ("kind", pa.string())])


def inflate(source: BinaryIO, out: BinaryIO) -> int:
    """All members of a gzip file, block by block; bytes written. What follows damage, or the last member, is left out."""
    written, inner = 0, zlib.decompressobj(31)
    data = source.read(BLOCK_BYTES)
    while data:
        try:
            block = inner.decompress(data, BLOCK_BYTES)
        except zlib.error:
            break
        written += out.write(block)
        data = inner.unconsumed_tail
        if inner.eof:
            data, inner = inner.unused_data, zlib.decompressobj(31)
        data = data or source.read(BLOCK_BYTES)
    return written + out.write(inner.flush())


def _opened(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Container of each file; a gzip file is inflated to ``folder``, unless it was before, and its content takes its place."""
    for batch in batches:
        for row in batch.to_pylist():
            path, length = row["path"], row["length"]
            with open_stream(path) as f:
                head = f.read(24)
                if head[:2] == GZIP:
                    name = hashlib.md5(f"{path} {length} {row['changed']}".encode()).hexdigest()
                    plain = f"{folder}/{name}.pcap"
                    if not exists(plain):
                        f.seek(0)
                        publish(plain, lambda out: inflate(f, out))
                    path = plain
            if path != row["path"]:
                with open_stream(path) as f:
                    head, length = f.read(24), f.seek(0, 2)
            yield pa.RecordBatch.from_pylist([{"path": path, "length": length, "kind": _container(head)}], schema=CAPTURE)


def _packets(raw: DataFrame, keep_corrupt: bool) -> DataFrame:
    kind = protocol_class(F.col("protocol"), F.col("fragment"))
    ported = kind.isin("tcp", "udp")
    out = raw if keep_corrupt else raw.where(~F.col("corrupt"))
    return out.select(
        dotted(F.col("src")).alias("src_ip"), dotted(F.col("dst")).alias("dst_ip"), "protocol",
        "packet_size", F.when(ported, F.col("sport")).otherwise(0).alias("src_port"),
        F.when(ported, F.col("dport")).otherwise(0).alias("dst_port"),
        F.when(kind == "tcp", flag_letters(F.col("bits"))).otherwise("").alias("flags"),
        kind.alias("protocol_type"), from_micros(F.col("ts_us")).alias("timestamp"), "ts_us",
        *(["corrupt"] if keep_corrupt else []))


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            links = row.get("links")
            yield from decode_range(row["path"], row["start"], row["end"], row.get("order"),
                                    [(x["link"], x["ticks"], x["shift"], x["snap"]) for x in links] if links else None)


LINK = "struct<link: int, ticks: bigint, shift: bigint, snap: bigint>"
WALKED = f"path string, near bigint, stop bigint, start bigint, order string, left bigint, left_order string, began boolean, links array<{LINK}>"
PART = f"path string, start bigint, end bigint, order string, links array<{LINK}>"


def _link_rows(links: list[Interface]) -> list[dict]:
    return [dict(zip(("link", "ticks", "shift", "snap"), x)) for x in links]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each range, walked from its start, or from a block found near its beginning if no start is given."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            with open_stream(row["path"]) as f:
                length = f.seek(0, 2)
                start, order = row["start"], row["order"] or "<"
                if start is None and row["near"] == 0:
                    start = 0
                elif start is None:
                    order = _block(f, 0, "<", length)[2]  # that of the first section
                    start = _find_block(f, row["near"], order, length)
                    start = length if start is None else start
                left, left_order, began, links = walk_blocks(f, start, order, row["stop"])
            out.append({"path": row["path"], "near": row["near"], "stop": row["stop"], "start": start, "order": order,
                        "left": left, "left_order": left_order, "began": began, "links": _link_rows(links)})
        yield pa.RecordBatch.from_pylist(out, schema=WALKED_ARROW)


_LINK_ARROW = pa.list_(pa.struct([("link", pa.int32()), ("ticks", pa.int64()), ("shift", pa.int64()), ("snap", pa.int64())]))
WALKED_ARROW = pa.schema([("path", pa.string()), ("near", pa.int64()), ("stop", pa.int64()), ("start", pa.int64()), ("order", pa.string()),
                          ("left", pa.int64()), ("left_order", pa.string()), ("began", pa.bool_()), ("links", _LINK_ARROW)])


def _hand_on(key: tuple, walked: pa.Table) -> pa.Table:
    """The interfaces each range of a file begins with, handed from range to range."""
    out, links = [], []
    for row in sorted(walked.to_pylist(), key=lambda r: r["near"]):
        if row["start"] < row["stop"]:
            out.append({"path": row["path"], "start": row["start"], "end": row["stop"], "order": row["order"], "links": links})
        links = row["links"] if row["began"] else links + row["links"]
    return pa.Table.from_pylist(out, schema=pa.schema([("path", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                                       ("order", pa.string()), ("links", _LINK_ARROW)]))


def block_ranges(places: DataFrame) -> DataFrame:
    """Ranges of block-structured captures (``path``, ``near``, ``stop``) as ``path``, ``start``, ``end``, ``order``, ``links``.

    All ranges are walked at once. A range has to start where those before it end; one that does not, because what was found near
    its beginning only looked like a block, is walked again from there, until all agree. The first range of a file is
    right, so the ranges together read what one walk over the file reads.
    """
    nothing = [F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("string").alias("order")]
    walked = stage(places.select("path", "near", "stop", *nothing).mapInArrow(_walk, WALKED), "ranges")
    before = Window.partitionBy("path").orderBy("near").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        due = walked.withColumn("due", F.max(F.struct("left", "left_order")).over(before))
        off = F.col("due").isNotNull() & ((F.col("start") != F.col("due.left")) | (F.col("order") != F.col("due.left_order")))
        wrong = stage(due.where(off).select("path", "near", "stop", F.col("due.left").alias("start"), F.col("due.left_order").alias("order")), "again")
        if wrong.isEmpty():
            return walked.groupBy("path").applyInArrow(_hand_on, PART)
        redone = wrong.repartition(max(1, wrong.count())).mapInArrow(_walk, WALKED)
        walked = stage(walked.join(wrong.select("path", "near"), ["path", "near"], "left_anti").unionByName(redone), "ranges")


def read_pcap(spark: SparkSession, path: str | list[str], split_bytes: int | None = SPLIT_BYTES,
              keep_corrupt: bool = False, glob: str | None = None, inflated: str | None = None) -> DataFrame:
    """IPv4 packets of capture files or folders, in both container formats, plain or in gzip.

    A packet that cannot be decoded is left out, or kept and marked with ``keep_corrupt``. What is inflated goes to the folder
    ``inflated``, or else to one that is kept for the next read of the same files.
    """
    folder = inflated or work_path(spark, "inflated")
    files = _listing(spark, path, glob)
    files = stage(files.repartition(max(1, files.count()), "path").mapInArrow(
        lambda batches: _opened(batches, folder), "path string, length bigint, kind string"), "captures")
    size = F.lit(split_bytes) if split_bytes else F.col("length") + 1
    places = files.select("path", "length", "kind", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("length"), size.cast("bigint"))).alias("near"))
    tasks = max(1, places.count())

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [{"path": r["path"], "start": range_start(r["path"], r["length"], r["near"])}
                     for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(
                [r for r in found if r["start"] is not None],
                schema=pa.schema([("path", pa.string()), ("start", pa.int64())]))

    classic = places.where("kind is null or kind <> 'blocks'")
    known = classic.repartition(tasks).mapInArrow(starts, "path string, start bigint").distinct()
    following = Window.partitionBy("path").orderBy("start")
    parts = known.withColumn("end", F.lead("start").over(following)).select(
        "path", "start", "end", F.lit(None).cast("string").alias("order"), F.lit(None).cast(f"array<{LINK}>").alias("links"))
    if not files.where("kind = 'blocks'").isEmpty():
        reach = F.col("near") + (F.lit(split_bytes) if split_bytes else F.col("length") + 1)
        blocks = places.where("kind = 'blocks'").select("path", "near", reach.cast("bigint").alias("stop"))
        parts = parts.unionByName(block_ranges(blocks.repartition(tasks)))
    return _packets(parts.repartition(tasks).mapInArrow(_decode_batches, RAW), keep_corrupt)


def read_groups(spark: SparkSession, groups: Iterable[str | list[str]], read: Callable[..., DataFrame] = read_pcap, **options) -> DataFrame:
    """What ``read`` gives for each of several groups of captures, as one table.

    The rows of a group are written before the next group is asked for, and what was inflated for it is deleted, so that
    whoever hands out the groups can let go of each in turn: captures of any size need the disk of one group.
    """
    out, schema = new_path(spark, "packets"), None
    for group in groups:
        inflated = new_path(spark, "inflated")
        with shuffles_freed(spark):
            part = read(spark, group, inflated=inflated, **options)
            part.write.mode("append").parquet(out)
        schema = part.schema
        drop_path(spark, inflated)
    if schema is None:
        raise ValueError("no captures to read")
    return spark.read.schema(schema).parquet(out)


def resolved(packets: DataFrame, names: DataFrame | None) -> DataFrame:
    """Packets with the names of their addresses, where the table ``names`` (``address``, ``name``) has one."""
    if names is None:
        return packets
    out = packets
    for column in ("src_ip", "dst_ip"):
        known = names.select(F.col("address").alias("_address"), F.col("name").alias("_name"))
        out = out.join(known, F.col(column) == F.col("_address"), "left").withColumn(
            column, F.coalesce("_name", column)).drop("_address", "_name")
    return out


def stream_pcap(spark: SparkSession, path: str, keep_corrupt: bool = False, glob: str | None = None,
                max_files: int | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Packets of capture files as they land in a folder, plain or in gzip; each file is decoded once."""
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length bigint, content binary")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    folder = work_path(spark, "inflated")
    files = reader.load(path).select("path", "length", F.unix_micros("modificationTime").alias("changed")).mapInArrow(
        lambda batches: _opened(batches, folder), "path string, length bigint, kind string")
    # A classic capture is decoded by a task per range, any other one by one task.
    step = F.when(F.col("kind") == "blocks", F.col("length") + 1).otherwise(split_bytes).cast("bigint")
    ranges = files.select("path", "length", step.alias("step"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length"), step)).alias("near"))
    return _packets(ranges.repartition(4 * spark.sparkContext.defaultParallelism).mapInArrow(_decode_landed, RAW), keep_corrupt)


def _decode_landed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ranges of landed files, each up to where the next one with a start of its own begins."""
    for batch in batches:
        for row in batch.to_pylist():
            path, length, step = row["path"], row["length"], row["step"]
            start, near = range_start(path, length, row["near"]), row["near"] + step
            if start is None or start >= near and range_start(path, length, near) == start:
                continue  # the range that begins later has this start too
            end = None
            while end is None and near <= length:
                end = range_start(path, length, near)
                near += step
            yield from decode_range(path, start, end)


def corrupt_packets(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Packets per file state: decoded and undecodable."""
    return read_pcap(spark, path, keep_corrupt=True, **options).groupBy("corrupt").agg(
        F.count("*").alias("packets"))
