"""Language-model scores from a log-frequency Bloom filter in segments.

Pairs of words are counted over the whole training text, and every pair is held by the filter, which keeps its quantised log count:
the pair is put in under the levels 1, 2, ... up to its own, and is read back by asking for level after level until one is missing.
Levels are exact up to 7 occurrences and then a factor ``BASE`` apart. A pair belongs to one of many segments, whose number grows
with the training text, so that a segment has a bounded size. Scoring sends the pairs of the texts to the segments; a task loads one
segment at a time and streams past it all that ask for it. Pairs with a share of ``SHARE`` and more are also held by a filter that
all tasks get; there are at most 1 / ``SHARE`` of them, whatever the input, and no other pair is asked for often.

Word counts are exact. Words are known by 64-bit codes. The counts of the words of a range of rows are written beside the rows, so
the task that scores a text knows all its words. Words with that share go to all tasks instead.

p(w | u) = m(u) c(u w) / c(u) + (1 - m(u)) p(w), where p(w) is the add-one share of w, m(u) is ``DISCOUNT`` for words u of the
training text, else 0, and c(u w) is what the filter gives, at most c(u) and c(w).
"""

from __future__ import annotations

import functools
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from flowlens.llm import beside
from flowlens.llm.common import text_of, utf8_slices
from flowlens.llm.phrases import word_codes
from flowlens.session import new_path, shuffles_freed
from flowlens.sources.files import locate

SHARE = 2.0 ** -21  # of all characters and texts, which are at least as many as tokens
BASE = 1.15  # of the quantisation: the factor between levels
PROBES, BITS = 7, 20  # hash functions, and bits per stored level; twice as many in the filter that all tasks get
DISCOUNT = 0.95  # of the successor mass
END = 0x5851F42D4C957F2D  # code of the token after the last word of a text
COUNTED, ASKED_FOR = 1_000_000, 500_000  # tokens a task counts, and pairs it asks for, before it gives them out
BUCKET = 3 << 20  # characters of the training text per segment
KEY_BITS = 38  # of a pair inside its segment
READ_BUCKETS = 4  # segments in a file
VOCABULARY_ROWS = 4096  # rows whose word counts are read together
PACKED = 512  # entries in a row of a bucket
SCORED_BYTES = 1 << 20  # bytes scored at once; a longer text is scored alone
FIXED = float(1 << 20)  # log10 values are summed as whole multiples of its inverse, in any order
UNSEEN = math.log10(1 - DISCOUNT)  # gain of a pair that was not seen after a known word


def held_out(key: Column) -> Column:
    """Texts the model does not learn from: crc32 of the id as text leaves 2 when divided by 7."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of the input."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grid() -> np.ndarray:
    """The least count of each level from 1 on."""
    counts = [1]
    while counts[-1] < 1 << 50:
        counts.append(max(counts[-1] + 1, int(counts[-1] * BASE)))
    return np.array(counts, np.int64)


LEAST_OF = _grid()


def levels_of(counts: np.ndarray) -> np.ndarray:
    """The level of each count, 0 for none."""
    return np.searchsorted(LEAST_OF, counts, "right")


class LogBloom:
    """Quantised log counts of 64-bit keys: membership of (key, level)."""

    def __init__(self, bits: bytes):
        self._bits, self._size = np.frombuffer(bits, np.uint8), 8 * len(bits)

    @staticmethod
    def places(keys: np.ndarray, level: np.ndarray, size: int) -> np.ndarray:
        """Bits of (key, level), a row per pair, by double hashing."""
        mixed = _mix(keys.astype(np.uint64) ^ _mix(level.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
        a, b = mixed >> np.uint64(32), (mixed & np.uint64(0xFFFFFFFF)) | np.uint64(1)
        return ((a[:, None] + np.arange(PROBES, dtype=np.uint64) * b[:, None]) % np.uint64(size)).astype(np.int64)

    @staticmethod
    def build(keys: np.ndarray, levels: np.ndarray, bits_per_level: int) -> bytes:
        size = -(-bits_per_level * int(levels.sum()) // 64) * 64
        bits = np.zeros(size, bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            keys, levels = keys[levels >= level], levels[levels >= level]
            bits[LogBloom.places(keys, np.full(len(keys), level), size).ravel()] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def levels(self, keys: np.ndarray, most: np.ndarray) -> np.ndarray:
        """The level of each key, at most ``most``, 0 if it is not held: membership probes until one fails."""
        found = np.zeros(len(keys), np.int64)
        at, level = np.flatnonzero(most >= 1), 1
        while len(at) and self._size:
            bit = self.places(keys[at], np.full(len(at), level), self._size)
            at = at[((self._bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).all(axis=1)]
            found[at] = level
            level += 1
            at = at[most[at] >= level]
        return found


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the tokens of texts, one text after another, and the number of each text's. A-Z is lower-cased; bytes part at the
    six ASCII white spaces."""
    words = [t.lower().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    codes = word_codes(b" ".join([b" ".join(w) for w in words if w]))
    return np.insert(codes, np.cumsum(sizes), np.uint64(END)), sizes + 1


def _before(ids: np.ndarray) -> np.ndarray:
    """The token before each one; a text begins where another one ended."""
    return np.concatenate((np.array([END], np.uint64), ids[:-1]))[:len(ids)]


def pair_keys(before: np.ndarray, after: np.ndarray, buckets: int) -> np.ndarray:
    """Segment and, in the lowest ``KEY_BITS`` bits, key of pairs."""
    mixed = _mix(before * np.uint64(0x9FB21C651E98DF25) + _mix(after))
    return (mixed % np.uint64(buckets) << np.uint64(KEY_BITS) | mixed >> np.uint64(64 - KEY_BITS)).astype(np.int64)


_KEY = (1 << KEY_BITS) - 1
_ZSTD = pa.Codec("zstd", compression_level=1)


@functools.lru_cache
def _head(width: int) -> struct.Struct:
    """The end of a packed row: the bytes of each column, the first value of the last column, entries."""
    return struct.Struct(f"<{width}BqH")


def _packed(bucket: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Rows of up to ``PACKED`` entries of one bucket; entries are given in order of their buckets. Of each entry the lowest bytes come
    first, then the next ones, which compress well, as many as the column needs; the last column is held as differences."""
    first = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1))
    starts = np.concatenate([np.zeros(0, np.int64), *[np.arange(a, b, PACKED) for a, b in zip(first, np.append(first[1:], len(bucket)))]])
    last = columns[-1].astype(np.int64)
    steps = np.diff(last, prepend=0)
    steps[starts] = 0
    planes, sizes = [], []
    for column in (*columns[:-1], steps):
        column = column.astype(np.int64)
        column = (column << 1 ^ column >> 63).view(np.uint64)  # the sign is the lowest bit
        sizes.append(max(1, -(-int(column.max(initial=0)).bit_length() // 8)))
        planes.append(column.astype("<u8").view(np.uint8).reshape(len(column), 8)[:, :sizes[-1]])
    planes, pack = np.concatenate(planes, axis=1), _head(len(columns)).pack
    ends = np.append(starts[1:], len(bucket)).tolist() if len(starts) else []
    return bucket[starts], pa.array([_ZSTD.compress(planes[a:b].T.tobytes(), asbytes=True) + pack(*sizes, x, b - a)
                                     for a, b, x in zip(starts.tolist(), ends, last[starts].tolist())], pa.binary())


def _entries(packed: list[bytes], width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns of packed rows, and the number of entries of each row."""
    head = _head(width)
    heads = [head.unpack(x[-head.size:]) for x in packed]
    counts = np.array([x[-1] for x in heads], np.int64)
    ends = np.cumsum(counts).tolist()
    whole = np.zeros((width, int(counts.sum()), 8), np.uint8)
    for x, (*sizes, _, count), end in zip(packed, heads, ends):
        at = 0
        planes = np.frombuffer(_ZSTD.decompress(x[:-head.size], sum(sizes) * count, asbytes=True), np.uint8).reshape(-1, count)
        for k, size in enumerate(sizes):
            whole[k, end - count:end, :size] = planes[at:at + size].T
            at += size
    coded = whole.view("<u8")[:, :, 0]
    columns = (coded >> np.uint64(1)).view(np.int64) ^ -(coded & np.uint64(1)).view(np.int64)
    for (*_, start, count), end in zip(heads, ends):
        some = columns[-1, end - count:end]
        some[0] = start
        np.cumsum(some, out=some)
    return list(columns), counts


def _by_bucket(bucket: np.ndarray, buckets: int) -> np.ndarray:
    """Entries in order of their buckets; entries of one stay in order. Numbers of 16 bits sort much faster."""
    return np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")


def _once(key: np.ndarray, doc: np.ndarray, docs: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Of equal pairs of a text the first, and how many there are, by text and key."""
    bits = KEY_BITS + (buckets - 1).bit_length()
    if (docs - 1).bit_length() + bits > 64:
        order = np.lexsort((key, doc))
        first = np.flatnonzero(np.append(True, (np.diff(key[order]) != 0) | (np.diff(doc[order]) != 0))[:len(order)])
    else:  # as one number, which sorts faster
        both = doc.astype(np.uint64) << np.uint64(bits) | key.astype(np.uint64)
        order = np.argsort(both)
        first = np.flatnonzero(np.append(True, np.diff(both[order]) != 0)[:len(order)])
    return np.minimum.reduceat(order, first) if len(order) else order, np.diff(np.append(first, len(order)))


def _pieces(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of about ``SCORED_BYTES`` together, with the place of the first."""
    start, texts, size = 0, [], 0
    for i, raw in enumerate(utf8_slices(column)):
        texts.append(bytes(raw))
        size += len(raw)
        if size >= SCORED_BYTES or i == len(column) - 1:
            yield start, texts
            start, texts, size = i + 1, [], 0


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed counts of words and of pairs by bucket."""
    held, size = [], 0

    def out() -> Iterator[pa.RecordBatch]:
        nonlocal held, size
        ids = np.concatenate(held)
        held, size = [], 0
        keys, c = np.unique(pair_keys(_before(ids), ids, buckets), return_counts=True)
        words, times = np.unique(ids, return_counts=True)
        of = (words % np.uint64(buckets)).astype(np.int64)
        order = _by_bucket(of, buckets)
        for pairs, (at, data) in ((True, _packed(keys >> KEY_BITS, c, keys & _KEY)),
                                  (False, _packed(of[order], times[order], words[order].view(np.int64)))):
            yield pa.RecordBatch.from_arrays([pa.array(at), data, pa.array([pairs] * len(at), pa.bool_())], names=["bucket", "data", "pairs"])

    for batch in batches:
        for _, texts in _pieces(batch.column(0)):
            held.append(tokens_of(texts)[0])
            size += len(held[-1])
            if size >= COUNTED:
                yield from out()
    if held:
        yield from out()


def _merged(table: pa.Table, pairs: bool) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and their counts."""
    kinds = np.asarray(table["pairs"])
    (c, keys), _ = _entries([x for x, k in zip(table["data"].to_pylist(), kinds.tolist()) if k == pairs], 2)
    keys, back = np.unique(keys, return_inverse=True)
    return keys, np.bincount(back, c, len(keys)).astype(np.int64)


SEGMENT = "at long, bits binary, top array<long>, levels array<long>, words array<long>, counts array<long>"


def _segment(table: pa.Table, top_level: int, bits: int) -> pa.Table:
    """The filter of a bucket, its frequent pairs, and the counts of its words."""
    at = table["bucket"][0].as_py()
    keys, c = _merged(table, True)
    level = levels_of(c)
    top = level >= top_level
    words, counts = _merged(table, False)
    lists = pa.list_(pa.int64())
    return pa.table({"at": pa.array([at], pa.int64()), "bits": pa.array([LogBloom.build(keys, level, bits)], pa.binary()),
                     "top": pa.array([at << KEY_BITS | keys[top]], lists), "levels": pa.array([level[top]], lists),
                     "words": pa.array([words], lists), "counts": pa.array([counts], lists)})


class Model:
    """Exact totals, the table of word counts and the folder of segments; by size bound the frequent words and pairs."""

    def __init__(self, folder: str, words: DataFrame, buckets: int, n: int, v: int, least: int, frequent: tuple[np.ndarray, np.ndarray],
                 shared: bytes, top_level: int):
        self.folder, self.words, self.buckets, self.n, self.v, self.least = folder, words, buckets, n, v, least
        self.frequent, self.shared, self.top_level = frequent, shared, top_level


def fit(docs: DataFrame, share: float = SHARE, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Count the texts that are not held out and build the filter. Null text has no words, only its end."""
    spark = docs.sparkSession
    text = docs.where(~held_out(docs[id_col])).select(text_of(docs, text_col).alias("text"))
    # A token has a character or ends a text, so there are at most this many, and fewer than 1 / share have the least count.
    size = text.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)) + F.count("*")).first()[0]
    top_level = int(np.searchsorted(LEAST_OF, size * share, "left")) + 1
    least, buckets = int(LEAST_OF[top_level - 1]), -(-size // BUCKET) or 1
    folder = new_path(spark, "segments")
    with shuffles_freed(spark):
        text.mapInArrow(lambda batches: _count(batches, buckets), "bucket long, data binary, pairs boolean") \
            .groupBy("bucket").applyInArrow(lambda table: _segment(table, top_level, bits), SEGMENT) \
            .withColumn("file", F.floor(F.col("at") / READ_BUCKETS)).write.partitionBy("file").parquet(folder)
    segments = spark.read.schema(f"{SEGMENT}, file long").parquet(folder)
    words = segments.select(F.explode(F.arrays_zip("words", "counts")).alias("x")).select(
        F.col("x.words").alias("word"), F.col("x.counts").alias("c"))
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = words.where(F.col("c") >= least).toArrow()
    codes, counts = np.asarray(top["word"], np.int64).view(np.uint64), np.asarray(top["c"], np.int64)
    order = np.argsort(codes)
    pairs = segments.select(F.explode(F.arrays_zip("top", "levels")).alias("x")).select(
        F.col("x.top").alias("key"), F.col("x.levels").alias("level")).toArrow()
    shared = LogBloom.build(np.asarray(pairs["key"], np.int64), np.asarray(pairs["level"], np.int64) - (top_level - 1), 2 * bits)
    return Model(folder, words, buckets, n, v, least, (codes[order], counts[order]), shared, top_level)


def _look_up(words: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts of words, 0 for those that are not among the ascending codes."""
    if not len(codes):
        return np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(codes, words), len(codes) - 1)
    return np.where(codes[at] == words, counts[at], 0)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The rows of each batch by file and range of rows."""
    for batch in batches:
        for file, rows in beside.by_file(batch):
            chunk = np.asarray(rows.column(1)) // VOCABULARY_ROWS
            edges = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            for a, b in zip(edges, edges[1:]):
                yield file, int(chunk[a]), rows.slice(a, b - a)


def _vocabulary(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """The words of each range of rows that are not frequent."""
    frequent = shared.value[0]
    place, held = None, []

    def out() -> pa.RecordBatch:
        words = np.unique(np.concatenate(held))
        words = words[_look_up(words, frequent, np.ones(len(frequent), np.int64)) == 0]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([place[0]]), pa.array([place[1] * VOCABULARY_ROWS], pa.int64()),
                                           pa.array([words.view(np.int64)], pa.list_(pa.int64()))], names=["file", "at", "words"])

    for file, chunk, rows in _ranges(batches):
        if (file, chunk) != place and held:
            yield out()
        place = (file, chunk)
        for _, texts in _pieces(rows.column(2)):
            held.append(np.unique(tokens_of(texts)[0]))
    if held:
        yield out()


ASKED = ["bucket", "block", "data", "row", "doc_id", "n_tokens", "n_known", "base", "gain"]


def _ask(batches: Iterator[pa.RecordBatch], shared, folder: str, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Blocks of texts: packed rows of the pairs to ask for by segment, and a row per text, dealt to any segment below 0."""
    codes, counts, (n, v, buckets, top_level, bits) = shared.value
    bloom = LogBloom(bits)
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), kind, pa.int64(), pa.int64(), pa.float64(), pa.int64()]
    asked, texts_of, size, place, known = [], [], 0, None, (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def out() -> Iterator[pa.RecordBatch]:
        nonlocal asked, texts_of, size
        block = texts_of[0][0][0].as_py()
        # Blocks begin at multiples of high powers of two, so their numbers are mixed to spread them.
        dealt = -1 - READ_BUCKETS * int(_mix(np.array([block]))[0] % np.uint64(1 << 31))
        for row, doc_id, n_tokens, n_known, base, gain in texts_of:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), dealt)), pa.array(np.full(len(row), block)),
                                              pa.nulls(len(row), pa.binary()), row, doc_id, *map(pa.array, (n_tokens, n_known, base, gain))], names=ASKED)
        if size:
            keys, ratio, most, times, rows = map(np.concatenate, zip(*asked))
            order = _by_bucket(keys >> KEY_BITS, buckets)
            at, data = _packed((keys >> KEY_BITS)[order], (keys & _KEY)[order], ratio[order], most[order], times[order], rows[order])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), block)), data,
                                              *[pa.nulls(len(at), t) for t in types[3:]]], names=ASKED)
        asked, texts_of, size = [], [], 0

    for file, chunk, part in _ranges(batches):
        if (file, chunk) != place:
            place, at = (file, chunk), chunk * VOCABULARY_ROWS
            tables = beside.read(folder, file, at, at, VOCABULARY_ROWS)
            words = np.concatenate([np.zeros(0, np.int64), *[np.asarray(t["word"]) for t in tables]]).view(np.uint64)
            order = np.argsort(words)
            known = words[order], np.concatenate([np.zeros(0, np.int64), *[np.asarray(t["c"]) for t in tables]])[order]
        for start, texts in _pieces(part.column(2)):
            rows, doc_id = part.column(4).slice(start, len(texts)), part.column(3).slice(start, len(texts))
            ids, sizes = tokens_of(texts)
            words, back = np.unique(ids, return_inverse=True)
            c_word = np.maximum(_look_up(words, codes, counts), _look_up(words, *known))
            # Of each word once, then of each token.
            logs, level_word = np.log10(np.maximum(c_word, 1)), levels_of(c_word)
            c = c_word[back]
            doc, last = np.repeat(np.arange(len(texts)), sizes), np.cumsum(sizes) - 1
            base = np.log10((c_word + 1.0) / (n + v + 1))[back]
            back_before = np.concatenate((back[last[:1]], back[:-1]))
            c_before = c_word[back_before]
            gain = np.where(c_before > 0, round(UNSEEN * FIXED), 0)
            some = np.flatnonzero((c_before > 0) & (c > 0))
            key = pair_keys(_before(ids)[some], ids[some], buckets)
            # Each pair once per text.
            which, times = _once(key, doc[some], len(texts), buckets)
            some, key = some[which], key[which]
            most = np.minimum(level_word[back_before[some]], level_word[back[some]])
            ratio = np.rint((math.log10(DISCOUNT) - UNSEEN - logs[back_before[some]] - base[some]) * FIXED).astype(np.int64)
            level = bloom.levels(key, most - (top_level - 1))
            seen = level > 0
            texts_gain = np.bincount(doc, gain, len(texts)) + np.bincount(
                doc[some[seen]], times[seen] * gain_of(ratio[seen], level[seen] + top_level - 1), len(texts))
            texts_of.append((rows, doc_id, sizes, np.bincount(doc, c > 0, len(texts)).astype(np.int64),
                             np.bincount(doc, base, len(texts)), texts_gain.astype(np.int64)))
            asked.append([x[~seen] for x in (key, ratio, most, times, np.asarray(rows)[doc[some]])])
            size += len(asked[-1][0])
            if size >= ASKED_FOR:
                yield from out()
    if texts_of:
        yield from out()


def gain_of(ratio: np.ndarray, level: np.ndarray) -> np.ndarray:
    """What a seen pair gains over one that was not seen, in units of 1 / ``FIXED``."""
    return np.rint(np.log10(1 + LEAST_OF[level - 1] * 10 ** (ratio / FIXED)) * FIXED).astype(np.int64)


@functools.lru_cache(maxsize=1)
def _file(folder: str, file: int) -> dict[int, bytes]:
    """The filters of the segments in a file."""
    system, inner = locate(f"{folder}/file={file}")
    if system.get_file_info(inner).type == fs.FileType.NotFound:
        return {}
    table = pq.read_table(inner, columns=["at", "bits"], filesystem=system, partitioning=None)
    return dict(zip(table["at"].to_pylist(), table["bits"].to_pylist()))


def _answer(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """What the pairs of each packed row gain, by text; rows of texts go on as they are. Rows come segment by segment."""
    for batch in batches:
        bucket = np.asarray(batch.column(0))
        edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        for a, b in zip(edges, edges[1:]):
            part = batch.slice(a, b - a)
            if bucket[a] < 0:
                yield part
                continue
            (key, ratio, most, times, rows), sizes = _entries(part.column(2).to_pylist(), 5)
            level = LogBloom(_file(folder, int(bucket[a]) // READ_BUCKETS).get(int(bucket[a]), b"")).levels(key, most)
            seen = level > 0
            of = np.repeat(np.arange(len(sizes)), sizes)[seen]
            rows, gain = rows[seen], times[seen] * gain_of(ratio[seen], level[seen])
            first = np.flatnonzero(np.append(True, (np.diff(rows) != 0) | (np.diff(of) != 0))[:len(rows)])
            if len(first):
                at, data = _packed(of[first], np.add.reduceat(gain, first), rows[first])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at)), part.column(1).take(pa.array(at)), data,
                                                  *[pa.nulls(len(at), x.type) for x in part.columns[3:]]], names=ASKED)


def _totals(table: pa.Table) -> pa.Table:
    """The rows of the texts of a block with all they gain."""
    packed = [x for x in table["data"].to_pylist() if x is not None]
    texts = table.filter(pc.is_null(table["data"])).sort_by("row")
    (gain, rows), _ = _entries(packed, 2)
    at = np.searchsorted(np.asarray(texts["row"]), rows)
    total = np.asarray(texts["gain"]) / FIXED + np.bincount(at, gain, texts.num_rows) / FIXED
    return texts.select(["doc_id", "n_tokens", "n_known", "base"]).append_column("gain", pa.array(total, pa.float64()))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Null text is empty text: its only token is the end. Repeated rows are scored one by one, and so is each text as a whole, whatever
    its length. With nothing to learn from each token has the probability 1 of a model without words. An empty table gives no rows.
    """
    spark = docs.sparkSession
    place = beside.Located(docs)
    kind = place.docs.schema[id_col].dataType
    text, doc_id = text_of(place.docs, text_col).alias("text"), place.docs[id_col].alias("doc_id")
    shared = spark.sparkContext.broadcast((*model.frequent, (model.n, model.v, model.buckets, model.top_level, model.shared)))
    words = place.rows(text).mapInArrow(lambda batches: _vocabulary(batches, shared), "file string, at long, words array<long>") \
        .select("file", "at", F.explode("words").alias("word"))
    with shuffles_freed(spark):
        vocabulary = beside.put(words.join(model.words.where(F.col("c") < model.least), "word"), "vocabulary", VOCABULARY_ROWS)
    arrow, folder = to_arrow_type(kind), model.folder
    schema = f"bucket long, block long, data binary, row long, doc_id {kind.simpleString()}, n_tokens long, n_known long, base double, gain long"
    asked = place.rows(text, doc_id, F.monotonically_increasing_id().alias("row")).mapInArrow(
        lambda batches: _ask(batches, shared, vocabulary, arrow), schema)
    answered = asked.repartition(F.floor(F.col("bucket") / READ_BUCKETS)).sortWithinPartitions("bucket") \
        .mapInArrow(lambda batches: _answer(batches, folder), schema)
    every = answered.groupBy("block").applyInArrow(_totals, f"doc_id {kind.simpleString()}, n_tokens long, n_known long, base double, gain double")
    return every.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("base") + F.col("gain")).alias("score"))
