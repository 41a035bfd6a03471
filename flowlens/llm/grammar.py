"""Token ids in grammar-compressed shard files (Re-Pair), with random access.

Documents are put in ascending id order by range partitions. A task encodes its documents and writes shards of
about ``SHARD_IDS`` ids. In a shard, pairs of neighbouring symbols that occur often are replaced by new symbols,
again and again, until no pair is frequent. The file holds the rules, how many ids each one expands to, the
remaining symbols and the starts of the documents. Sums of the expansion lengths tell which symbols cover a
range of ids, so a document is decoded without the rest of its shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from flowlens.llm.common import parallel, text_of
from flowlens.llm.tokens import encoder
from flowlens.session import new_path, stage
from flowlens.sources.files import open_input, publish

MAGIC = b"RPG1"
SHARD_IDS = 1_000_000  # a shard ends with the document that reaches this
LEAST_COUNT = 12  # a pair that occurs less often is not replaced
LEAST_GAIN = 0.005  # rounds end when one shortens the shard by less than this share
ROUND_PAIRS = 4096  # pairs replaced in one round
_HEAD = struct.Struct("<4sIIIIQQ")  # magic, first new symbol, rules, bytes of a symbol, documents, symbols, ids


def compress(ids: np.ndarray, least_count: int = LEAST_COUNT) -> tuple[int, np.ndarray, np.ndarray]:
    """First new symbol, rules (one pair of symbols per row) and the remaining symbols.

    A round replaces the most frequent pairs, picked so that no symbol ends one and begins another: then two
    occurrences never overlap. Rule k names only ids and rules before k.
    """
    first = int(ids.max()) + 1 if len(ids) else 0
    symbols, rules = ids.astype(np.uint32), []
    n_rules = 0
    while len(symbols) > 1:
        # Two symbols of 16 bits make pairs of 32, which sort much faster.
        kind, width = (np.uint32, 16) if first + n_rules <= 1 << 16 else (np.uint64, 32)
        right_part = kind((1 << width) - 1)
        pairs = symbols[:-1].astype(kind) << kind(width) | symbols[1:]
        ordered, more = np.sort(pairs), least_count - 1
        # What equals the one so many places on; a pair that occurs that often is left once for each further time.
        often = ordered[:max(len(ordered) - more, 0)]
        often = often[often == ordered[more:]]
        if not len(often):
            break
        edge = np.flatnonzero(np.concatenate(([True], often[1:] != often[:-1])))
        often = often[edge[np.argsort(-np.diff(np.append(edge, len(often))), kind="stable")]][:ROUND_PAIRS].tolist()
        begins, ends, chosen = set(), set(), []
        for pair in often:
            left, right = pair >> width, pair & int(right_part)
            if left not in ends and right not in begins and left != right:
                begins.add(left)
                ends.add(right)
                chosen.append(pair)
        doubled = not chosen  # only pairs of one symbol are left
        if doubled:
            chosen = often[:1]
        picked = np.sort(np.array(chosen, kind))
        lefts, rights = picked >> kind(width), picked & right_part
        # The chosen pairs as a table of their left and right symbols.
        (left_ones, row), (right_ones, column) = (np.unique(x, return_inverse=True) for x in (lefts, rights))
        rule_of = np.full((len(left_ones), len(right_ones)), -1, np.int32)
        rule_of[row, column] = np.arange(len(picked))
        row_of, column_of = np.zeros((2, first + n_rules + 1), np.int32)
        row_of[left_ones], column_of[right_ones] = np.arange(len(left_ones)), np.arange(len(right_ones))
        sides = np.zeros(first + n_rules + 1, np.uint8)  # 1: the left one of a pair, 2: the right one, 3: both
        sides[left_ones] |= 1
        sides[right_ones] |= 2
        sides = sides[symbols]
        may = np.flatnonzero((sides[:-1] & sides[1:] >> 1).view(bool))
        rule = rule_of[row_of[symbols[may]], column_of[symbols[may + 1]]]
        hit = rule >= 0
        at, rule = may[hit], rule[hit]
        if doubled:  # in a run, every other occurrence
            run = np.concatenate(([0], np.cumsum(np.diff(at) != 1)))
            begin = np.concatenate(([True], run[1:] != run[:-1]))
            keep = (at - np.maximum.accumulate(np.where(begin, at, 0))) % 2 == 0
            at, rule = at[keep], rule[keep]
        before = len(symbols)
        symbols[at] = first + n_rules + rule
        symbols = np.delete(symbols, at + 1)
        rules.append(np.stack([lefts, rights], 1).astype(np.uint32))
        n_rules += len(picked)
        if before - len(symbols) < LEAST_GAIN * before:
            break
    return first, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), symbols


def _rounds(first: int, rules: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rules that name only ids and rules before the range."""
    highest, start = rules.max(axis=1, initial=0), 0
    while start < len(rules):
        later = np.flatnonzero(highest[start + 1:] >= first + start)
        end = start + 1 + int(later[0]) if len(later) else len(rules)
        yield start, end
        start = end


def expansion_lengths(first: int, rules: np.ndarray) -> np.ndarray:
    """How many ids each rule stands for."""
    lengths = np.ones(first + len(rules), np.int64)
    for start, end in _rounds(first, rules):
        lengths[first + start:first + end] = lengths[rules[start:end]].sum(axis=1)
    return lengths[first:]


class Shard:
    """A shard file in memory; decodes any range of ids, and single documents."""

    def __init__(self, raw: bytes):
        magic, self.first, n_rules, width, n_docs, n_symbols, self.n_ids = _HEAD.unpack_from(raw)
        if magic != MAGIC or zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("not a whole shard file")
        at = _HEAD.size

        def read(n: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        rules = read(2 * n_rules, "<u4").reshape(-1, 2)
        lengths = read(n_rules, "<u4").astype(np.int64)
        self.symbols = read(n_symbols, f"<u{width}").astype(np.int64)
        self.doc_ids, self.has_id = read(n_docs, "<i8"), read(n_docs, "u1")
        self.starts = np.append(read(n_docs, "<u8").astype(np.int64), self.n_ids)
        # All expansions one after another: a rule's is that of its left part, then of its right part.
        self._length = np.concatenate([np.ones(self.first, np.int64), lengths])
        self._place = np.concatenate([np.arange(self.first), self.first + np.cumsum(lengths) - lengths])
        self._flat = np.empty(self.first + int(lengths.sum()), np.uint32)
        self._flat[:self.first] = np.arange(self.first)
        for start, end in _rounds(self.first, rules):
            some, to = self._flat[self._spread(rules[start:end].ravel())], self._place[self.first + start]
            self._flat[to:to + len(some)] = some
        self._until = np.cumsum(self._length[self.symbols])

    def _spread(self, symbols: np.ndarray) -> np.ndarray:
        """Where the ids of symbols lie among all expansions."""
        sizes = self._length[symbols]
        ends = np.cumsum(sizes)
        return np.arange(ends[-1]) + np.repeat(self._place[symbols] - (ends - sizes), sizes)

    def ids(self, start: int, length: int) -> np.ndarray:
        """``length`` ids from position ``start`` on; only the symbols that cover them are expanded."""
        if not length:
            return np.zeros(0, np.uint32)
        low = int(np.searchsorted(self._until, start, "right"))
        high = int(np.searchsorted(self._until, start + length, "left")) + 1
        skip = start - int(self._until[low] - self._length[self.symbols[low]])
        return self._flat[self._spread(self.symbols[low:high])[skip:skip + length]]

    def document(self, k: int) -> np.ndarray:
        """The ids of the shard's document ``k``."""
        return self.ids(int(self.starts[k]), int(self.starts[k + 1] - self.starts[k]))


def shard_bytes(doc_ids: list[int | None], texts: list[bytes]) -> bytes:
    """A shard file of documents, given as little-endian 32-bit ids."""
    ids = np.frombuffer(b"".join(texts), "<u4")
    first, rules, symbols = compress(ids)
    kind = "<u2" if first + len(rules) <= 1 << 16 else "<u4"
    sizes = np.array([len(t) // 4 for t in texts], np.int64)
    parts = [_HEAD.pack(MAGIC, first, len(rules), int(kind[-1]), len(texts), len(symbols), len(ids)),
             rules.astype("<u4").tobytes(), expansion_lengths(first, rules).astype("<u4").tobytes(),
             symbols.astype(kind).tobytes(), np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
             np.array([x is not None for x in doc_ids], "u1").tobytes(),
             (np.cumsum(sizes) - sizes).astype("<u8").tobytes()]
    raw = b"".join(parts)
    return raw + struct.pack("<I", zlib.crc32(raw))


def _write_shards(batches: Iterator[pa.RecordBatch], folder: str, vocabulary: str, end_id: int,
                  shard_ids: int) -> Iterator[pa.RecordBatch]:
    part, seq, base = TaskContext.get().partitionId(), 0, 0
    encode_all, end = encoder(vocabulary).encode_all, np.array([end_id], "<u4").tobytes()
    ids, texts, held = [], [], 0

    def flush() -> pa.RecordBatch:
        nonlocal ids, texts, held, seq, base
        path, raw = f"{folder}/part-{part:06d}-{seq:06d}.rpg", shard_bytes(ids, texts)
        publish(path, lambda out: out.write(raw))
        row = {"part": [part], "seq": [seq], "path": [path], "base": [base], "n_ids": [held], "n_docs": [len(ids)],
               "n_bytes": [len(raw)]}
        ids, texts, seq, base, held = [], [], seq + 1, base + held, 0
        return pa.RecordBatch.from_pydict(row)

    for batch in batches:
        for doc_id, encoded in zip(batch.column(0).to_pylist(), encode_all(batch.column(1))):
            raw = encoded + end
            ids.append(doc_id)
            texts.append(raw)
            held += len(raw) // 4
            if held >= shard_ids:
                yield flush()
    if ids:
        yield flush()


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, shard_ids: int = SHARD_IDS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards of a table below ``folder``; the staged manifest has a row per file: ``path``,
    ``part`` and ``seq`` (files in that order hold ascending ids), ``base`` (ids in earlier files of its part),
    ``n_ids``, ``n_docs``, ``n_bytes``.

    Null text is empty: only the end id. Null ids come first, ties of an id in the order of their texts. A text
    is never cut: one that is longer than a shard makes its own large one. A repeated task writes equal files.
    """
    plain = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs, text_col).alias("text"))
    return stage(plain.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(
        lambda batches: _write_shards(batches, folder, vocabulary, end_id, shard_ids),
        "part long, seq long, path string, base long, n_ids long, n_docs long, n_bytes long"), "manifest")


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            with open_input(path) as file:
                shard = Shard(file.read())
            sums = [zlib.crc32(shard.document(k).astype("<u4").tobytes()) for k in range(len(shard.doc_ids))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.doc_ids, pa.int64(), mask=shard.has_id == 0),
                 pa.array(base + shard.starts[:-1], pa.int64()), pa.array(np.diff(shard.starts), pa.int64()),
                 pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, decoded from the files: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32`` of its ids as little-endian unsigned 32-bit integers."""
    # One row per written partition, however many files it has.
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_base"))
    files = manifest.join(parts, "part").select("path", (F.col("part_base") + F.col("base")).alias("base"))
    return files.repartition(parallel(manifest), "path").mapInArrow(
        _read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write the shards of ``docs`` (to a new shared folder, if none is named) and read them back."""
    folder = folder or new_path(docs.sparkSession, "grammar")
    return read_documents(write_shards(docs, folder, vocabulary, end_id))
