"""Packing of token sequences into windows: best-fit decreasing.

Documents are encoded where they lie and cut into full windows plus a rest. From then on only lengths are
needed. Pieces are dealt at random to groups of bounded size, and each group is packed alone: longest piece
first, into the open window with the least room that holds it. A group leaves few windows with room, so
the padding does not depend on how many groups there are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowlens.llm.common import lean, text_of
from flowlens.llm.tokens import encoder
from flowlens.session import stage

WINDOW = 4096
GROUP_PIECES = 8192  # pieces packed together, about
MOST_KEPT = 300_000  # pieces in a generation of the encoder; other steps' workers need the memory too


class OpenWindows:
    """Open windows by remaining room: a segment tree whose nodes count the windows below them."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._count = [0] * (2 * self._leaves)
        self._at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self._at[room].append(window)
        node = self._leaves + room
        while node:
            self._count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove a window with the least room of at least ``least``; its room and number."""
        count, node = self._count, self._leaves + least
        if not count[node]:
            # Up to the first right neighbour that holds a window, then down to its left-most one.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node <<= 1
                if not count[node]:
                    node += 1
        room = node - self._leaves
        window = self._at[room].pop()
        while node:
            count[node] -= 1
            node >>= 1
        return room, window


def best_fit(lengths: list[int], capacity: int = WINDOW) -> tuple[list[int], list[int]]:
    """Window and offset of each piece; pieces must come in descending length."""
    tree, windows, offsets, n = OpenWindows(capacity), [], [], 0
    for length in lengths:
        found = tree.take(length)
        room, window = found or (capacity, n)
        n += found is None
        windows.append(window)
        offsets.append(capacity - room)
        if room > length:
            tree.add(room - length, window)
    return windows, offsets


@lean
def _cut(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    encode_all, end = encoder(vocabulary, MOST_KEPT).encode_all, np.array([end_id], "<u4").tobytes()
    for batch in batches:
        out: dict[str, list] = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": []}
        for doc_id, ids in zip(batch.column(0).to_pylist(), encode_all(batch.column(1))):
            raw = ids + end
            total = len(raw) // 4
            for start in range(0, total, capacity):
                piece = raw[4 * start:4 * (start + capacity)]
                out["doc_id"].append(doc_id)
                out["start"].append(start)
                out["length"].append(len(piece) // 4)
                out["ids_crc32"].append(zlib.crc32(piece))
                out["doc_tokens"].append(total)
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
            [(name, batch.schema.field(0).type if name == "doc_id" else pa.int64()) for name in out]))


def _pack_group(table: pa.Table, capacity: int) -> pa.Table:
    table = table.sort_by([("length", "descending"), ("row", "ascending")])
    windows, offsets = best_fit(table["length"].to_pylist(), capacity)
    group = table["bin"][0].as_py() if len(table) else 0
    return table.drop_columns(["bin", "row"]) \
        .append_column("sequence_id", pa.array(np.array(windows, np.int64) + (group << 32))) \
        .append_column("offset", pa.array(offsets, pa.int64()))


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = WINDOW, group_pieces: int = GROUP_PIECES,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Null text is empty text, whose only id is the end id. Each row of a repeated document is packed. Equal lengths
    go in the order of the staged rows, so a second run of a task packs alike.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    columns = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = stage(plain.mapInArrow(lambda batches: _cut(batches, vocabulary, end_id, capacity), columns)
                   .withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = -(-pieces.count() // group_pieces) or 1
    return pieces.withColumn("bin", F.pmod(F.xxhash64("row"), F.lit(groups))) \
        .groupBy("bin").applyInArrow(lambda table: _pack_group(table, capacity),
                                     f"{columns}, sequence_id long, offset long")
