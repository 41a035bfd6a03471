"""Near-duplicates by SetSketch registers.

A document is the set of its word shingles. A register keeps the least of exponential random numbers of the
elements, truncated to powers of ``B``: sketches of two sets merge by the larger register, and equal registers
are the likelier the more alike the sets are. Bands of registers are buckets; two documents meet if a band
is equal. Met pairs are estimated from their registers (by the likelihood of the numbers of larger, smaller and
equal ones, given both set sizes) and, unless far below the limit, verified on the full sets.

Equal sets are one class, so copies cost nothing. Within a bucket the pairs with its least class are looked at first; links
found make components, and only pairs of different components are looked at further. So a large group of near
copies needs one pair per member, and still no link that meets in a bucket is lost. Members that stay apart are verified
against each other inside blocks of their buckets, which only give out links between components: what is written grows with the
members, not with their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from flowlens.llm import beside
from flowlens.llm.common import find_words, forget_pieces, lean, lower_ascii, text_of
from flowlens.llm.components import components, relabel
from flowlens.session import stage

BANDS, ROWS = 24, 5  # at similarity 0.85 a pair misses all bands with probability 1e-6
REGISTERS = BANDS * ROWS
B, A, Q = 1.001, 20.0, (1 << 16) - 2  # base, rate and largest exponent of the registers
ERRORS = 4.5  # standard errors below the limit up to which a pair is verified
BASE_BLOCK, QUERY_BLOCK = 2048, 512  # members of a bucket compared in one task
BASE_ELEMENTS, QUERY_ELEMENTS = 1 << 20, 1 << 18  # and elements of their sets, on average
VERIFIED_AT_ONCE = 64  # sets compared with one other in a call
MOST_KEPT = 100_000  # words a task remembers

_RNG = np.random.Generator(np.random.PCG64(811))
_FACTOR = _RNG.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RNG.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
_WORD = np.uint64(0x9FB21C651E98DF25)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of the input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MOST_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def shingles(text: str, width: int) -> np.ndarray:
    """The distinct shingles of ``width`` words as ascending 64-bit hashes; of fewer words, all as one."""
    words = find_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    size = min(width, len(codes))
    value = np.full(len(codes) - size + 1, size, np.uint64)
    for k in range(size):
        value = _mix(value * _WORD + codes[k:len(codes) - size + 1 + k])
    return np.unique(value)


def registers(found: np.ndarray) -> np.ndarray:
    """The sketch of a set of 64-bit hashes."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 512):
        draws = found[at:at + 512, None] * _FACTOR + _SHIFT
        draws ^= draws >> np.uint64(32)
        np.minimum(least, draws.min(axis=0), out=least)
    # The least of the uniform numbers gives the least of the exponential ones.
    smallest = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0 ** 64) / A
    return np.clip(np.floor(1 - np.log(smallest) / math.log(B)), 0, Q + 1).astype("<u2")


def merge(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(first, second)


def buckets(sketches: np.ndarray) -> np.ndarray:
    """A 64-bit bucket per band of each sketch."""
    value = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sketches), 1))
    for row in range(ROWS):
        value = _mix(value * _WORD + sketches[:, row::ROWS].astype(np.uint64) + np.uint64(1))
    return value


def estimate(first: np.ndarray, second: np.ndarray, n_first: np.ndarray, n_second: np.ndarray) -> np.ndarray:
    """Most likely similarity of pairs of sketches, on a grid, given the set sizes."""
    out = np.empty(len(first))
    for at in range(0, len(first), 4096):
        some = slice(at, at + 4096)
        larger = (first[some] > second[some]).sum(1)[:, None]
        smaller = (first[some] < second[some]).sum(1)[:, None]
        equal = REGISTERS - larger - smaller
        u = (n_first[some] / (n_first[some] + n_second[some]))[:, None]
        v = 1 - u
        grid = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)

        def chance(x: np.ndarray) -> np.ndarray:
            """That one register exceeds the other, for an exclusive share x of the union."""
            return np.clip(-np.log1p(-np.maximum(x, 0) * (B - 1) / B) / math.log(B), 1e-12, 1)

        more, less = chance(u - v * grid), chance(v - u * grid)
        likely = larger * np.log(more) + smaller * np.log(less) + equal * np.log(np.maximum(1 - more - less, 1e-12))
        out[some] = np.take_along_axis(grid, likely.argmax(1)[:, None], 1)[:, 0]
    return out


def _least_estimate(percent: int) -> float:
    limit = percent / 100
    return limit - ERRORS * math.sqrt(limit * (1 - limit) / REGISTERS)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


@lean
def _sign(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    forget_pieces()
    for batch in batches:
        sizes, keys, sketches = [], [], []
        for text in batch.column(1):
            found = shingles(text.as_py(), width)
            sizes.append(len(found))
            keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            sketches.append(registers(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sketches, pa.binary()), *batch.columns[2:]],
            names=["doc_id", "n_shingles", "key", "sketch", *batch.schema.names[2:]])
    _hashes.clear()  # workers are used again by other steps, which need the memory


@lean
def _band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = buckets(_matrix(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.ravel().view(np.int64)), pa.array(np.repeat(np.asarray(batch.column(0)), BANDS))],
            names=["bucket", "cls"])


@lean
def _estimated(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        value = estimate(_matrix(batch.column(2)), _matrix(batch.column(3)), np.asarray(batch.column(4)), np.asarray(batch.column(5)))
        keep = np.flatnonzero(value >= least)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)), pa.array(value[keep])],
            names=["a", "b", "similarity"])


def shared_sizes(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements an ascending set shares with each of others (none of them empty)."""
    ends = np.cumsum([len(x) for x in others])
    whole = np.concatenate(others)
    hit = one[np.minimum(np.searchsorted(one, whole), len(one) - 1)] == whole
    return np.add.reduceat(hit, np.r_[0, ends[:-1]], dtype=np.int64)


@lean
def _meet(batches: Iterator[pa.RecordBatch], least: float, percent: int) -> Iterator[pa.RecordBatch]:
    """Links between components in blocks of buckets; the rows of a block come one after another.

    Pairs of different components are looked at by falling estimate and verified on the full sets on the spot. A link joins two
    components for the rest of the block, so at most one link less than there are components comes out of it, however many
    pairs it holds.
    """
    def pairs(rows: pa.Table) -> pa.RecordBatch:
        sketch, n = _matrix(rows["sketch"]), np.asarray(rows["n"])
        names, label = np.unique(np.asarray(rows["label"]), return_inverse=True)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["found"]]
        query = np.asarray(rows["query"])
        base = np.flatnonzero(query == 0)
        joined = np.arange(len(names))  # component of each label, as far as this block knows
        # A pair that shares several buckets is looked at in the first of them only: there it is, or it is settled.
        own, here = buckets(sketch), np.uint64(np.int64(rows["bucket"][0].as_py()).view(np.uint64))
        left, right = [], []
        for q in np.flatnonzero(query == 1).tolist():
            near = base[(joined[label[base]] != joined[label[q]]) & (100 * np.minimum(n[base], n[q]) >= percent * np.maximum(n[base], n[q]))]
            if len(near):
                near = near[own[q][(own[near] == own[q]).argmax(1)] == here]
            if len(near):
                value = estimate(np.broadcast_to(sketch[q], (len(near), REGISTERS)), sketch[near], np.full(len(near), n[q]), n[near])
                near = near[np.argsort(-value, kind="stable")[:int((value >= least).sum())]]
            while len(near):
                some, near = near[:VERIFIED_AT_ONCE], near[VERIFIED_AT_ONCE:]
                both = shared_sizes(sets[q], [sets[i] for i in some.tolist()])
                for i in some[100 * both >= percent * (n[q] + n[some] - both)].tolist():
                    one, other = joined[label[q]], joined[label[i]]
                    if one != other:
                        left.append(names[label[q]])
                        right.append(names[label[i]])
                        joined[joined == other] = one
                near = near[joined[label[near]] != joined[label[q]]]
        return pa.RecordBatch.from_arrays([pa.array(np.array(left, np.int64)), pa.array(np.array(right, np.int64))], names=["a", "b"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        # All but the last block of a batch are whole; that one may go on in the next batch.
        block = np.stack([np.asarray(batch[name]) for name in ("bucket", "base_no", "query_no")], 1)
        edges = np.flatnonzero((block[1:] != block[:-1]).any(1)) + 1
        if held:
            last = held[-1]
            if len(block) and tuple(block[0]) != tuple(last[name][-1].as_py() for name in ("bucket", "base_no", "query_no")):
                yield pairs(pa.Table.from_batches(held))
                held = []
        start = 0
        for end in edges.tolist():
            held.append(batch.slice(start, end - start))
            yield pairs(pa.Table.from_batches(held))
            held, start = [], end
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield pairs(pa.Table.from_batches(held))


@lean
def _full_sets(batches: Iterator[pa.RecordBatch], folder: str, width: int) -> Iterator[pa.RecordBatch]:
    """The sets of the rows that are wanted, found where they lie."""
    for batch in batches:
        for file, rows in beside.by_file(batch):
            at = np.asarray(rows.column(1))
            for wanted in beside.read(folder, file, int(at.min()), int(at.max())):
                places = np.asarray(wanted["at"])
                where = np.flatnonzero(np.isin(at, places))
                order = np.searchsorted(places, at[where])
                sets = [shingles(rows.column(2)[i].as_py(), width).tobytes() for i in where.tolist()]
                yield pa.RecordBatch.from_arrays([wanted["cls"].combine_chunks().take(pa.array(order)), pa.array(sets, pa.binary())],
                                                 names=["cls", "found"])
    _hashes.clear()


@lean
def _verify(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = int(shared_sizes(y, [x])[0])
            if 100 * both >= percent * (len(x) + len(y) - both):
                keep.append(i)
        yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))


class NearDuplicates:
    """One run over a table; the steps are written tables."""

    def __init__(self, docs: DataFrame, width: int, percent: int, id_col: str, text_col: str, by_row: bool = False):
        self._width, self._percent = width, percent
        self.place = beside.Located(docs)
        doc_id = self.place.docs[id_col]
        self._text = lower_ascii(text_of(self.place.docs, text_col)).alias("text")
        self._least = _least_estimate(percent)
        rows = self.place.rows(doc_id.alias("doc_id"), self._text)
        # Where ids alone do not do, a row is named by id and place; null ids come last.
        name = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "at") if by_row else F.col("doc_id")
        named = rows.select(name.alias("doc_id"), "text", "file", "at")
        kind = named.schema["doc_id"].dataType.simpleString()
        self.signatures = stage(named.mapInArrow(
            lambda batches: _sign(batches, width),
            f"doc_id {kind}, n_shingles long, key binary, sketch binary, file string, at long"), "signatures")
        # Copies are one class from here on; one of its rows stands for it.
        self.classes = stage(self.signatures.where("key is not null").groupBy("key").agg(
            F.min("doc_id").alias("smallest"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"),
            F.min(F.struct("file", "at")).alias("row"))
            .withColumn("cls", F.monotonically_increasing_id()), "classes")

    def _sketched(self, pairs: DataFrame) -> DataFrame:
        """Pairs (``a``, ``b``) whose set sizes allow the limit and whose estimate is not far below it."""
        narrow = self.classes.select("cls", "n")
        sized = pairs.join(narrow.select(F.col("cls").alias("a"), F.col("n").alias("na")), "a") \
            .join(narrow.select(F.col("cls").alias("b"), F.col("n").alias("nb")), "b") \
            .where(100 * F.least("na", "nb") >= self._percent * F.greatest("na", "nb"))
        wide = self.classes.select("cls", "sketch")
        joined = sized.join(wide.select(F.col("cls").alias("a"), F.col("sketch").alias("sa")), "a") \
            .join(wide.select(F.col("cls").alias("b"), F.col("sketch").alias("sb")), "b")
        least = self._least
        return joined.select("a", "b", "sa", "sb", "na", "nb").mapInArrow(
            lambda batches: _estimated(batches, least), "a long, b long, similarity double")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full sets are similar enough."""
        percent = self._percent
        pairs = stage(pairs.select("a", "b"), "pairs")
        used = pairs.select(F.col("a").alias("cls")).unionAll(pairs.select("b")).distinct()
        sets = self._sets(used)
        return pairs.join(sets.select(F.col("cls").alias("a"), F.col("found").alias("fa")), "a") \
            .join(sets.select(F.col("cls").alias("b"), F.col("found").alias("fb")), "b") \
            .select("a", "b", "fa", "fb").mapInArrow(lambda batches: _verify(batches, percent), "a long, b long")

    @staticmethod
    def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs with the labels of both (a class without one is its own label), where these differ."""
        return pairs.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left") \
            .join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left") \
            .withColumns({"la": F.coalesce("la", "a"), "lb": F.coalesce("lb", "b")}).where("la <> lb")

    def _joined(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """``labels`` after the pairs that pass verification were linked."""
        found = self._labelled(self._verified(pairs), labels).select(F.col("la").alias("a"), F.col("lb").alias("b"))
        return relabel(labels, components(found))

    def labels(self) -> DataFrame:
        """``node`` (a class) and ``label``: equal labels mean connected by verified links."""
        bands = stage(self.classes.select("cls", "sketch").mapInArrow(_band, "bucket long, cls long"), "bands")
        shared = stage(bands.groupBy("bucket").agg(F.min("cls").alias("pivot"), F.count("*").alias("n"))
                       .where("n > 1"), "buckets")
        members = stage(bands.join(shared, "bucket").where("cls <> pivot").select("bucket", "cls", "pivot", "n"), "members")
        # Bands that a class shares with a pivot say without a sketch which pivot is likeliest: it is asked first, then the
        # others that are still apart.
        star = stage(members.groupBy(F.col("pivot").alias("a"), F.col("cls").alias("b")).agg(F.count("*").alias("shared")), "star")
        first = star.groupBy("b").agg(F.max_by("a", F.struct("shared", (-F.col("a")).alias("low"))).alias("a"))
        labels = components(self._verified(self._sketched(first)))
        open_pairs = stage(self._labelled(star, labels).select("a", "b"), "open")
        labels = self._joined(self._sketched(open_pairs), labels)
        return relabel(labels, components(self._apart(members, labels)))

    def _sets(self, classes: DataFrame) -> DataFrame:
        """``cls`` and ``found``, the full sets of the given classes, read where their texts lie; staged."""
        width = self._width
        wanted = beside.put(self.classes.join(classes, "cls", "left_semi").select("row.file", "row.at", "cls"), "wanted")
        return stage(self.place.rows(self._text).mapInArrow(
            lambda batches: _full_sets(batches, wanted, width), "cls long, found binary"), "sets")

    def _apart(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        """Verified links (``a``, ``b``) between components that still share a bucket.

        Pairs with the pivot of a bucket are settled. Per bucket the members of one component are only compared with the others. A
        large bucket is dealt to blocks, each of them one unit of work of bounded size, so neither its size nor a bound on it matters.
        """
        least, percent = self._least, self._percent
        named = members.where("n > 2").join(labels.withColumnRenamed("node", "cls"), "cls", "left") \
            .select("bucket", "cls", F.coalesce("label", "cls").alias("label")).join(self.classes.select("cls", F.col("n").alias("size")), "cls")
        named = stage(named, "labelled")
        # The component with the least label is the base; of several components there must be another.
        mixed = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"),
                                            F.sum("size").alias("elements")) \
            .where("low <> high").select("bucket", "low", "n", "elements")
        mixed = stage(mixed, "mixed")
        asked = stage(named.join(mixed.select("bucket", "low"), "bucket").where("label <> low").groupBy("bucket").agg(
            F.count("*").alias("asks"), F.sum("size").alias("asked")), "asked")
        blocks = stage(mixed.join(asked, "bucket").select(
            "bucket", "low",
            F.ceil(F.greatest(F.col("n") / BASE_BLOCK, F.col("elements") / BASE_ELEMENTS)).cast("int").alias("bases"),
            F.ceil(F.greatest(F.col("asks") / QUERY_BLOCK, F.col("asked") / QUERY_ELEMENTS)).cast("int").alias("queries")), "blocks")
        open_members = stage(named.join(blocks, "bucket").select("bucket", "low", "bases", "queries", "cls", "label"), "open")
        sets = self._sets(open_members.select("cls").distinct())
        open_members = open_members.join(self.classes.select("cls", "n", "sketch"), "cls").join(sets, "cls")
        hashed = F.xxhash64("cls")
        rest = ["cls", "label", "n", "sketch", "found"]
        as_base = open_members.select(
            "bucket", F.pmod(hashed, F.col("bases")).cast("int").alias("base_no"),
            F.explode(F.sequence(F.lit(0), F.col("queries") - 1)).alias("query_no"), F.lit(0).alias("query"), *rest)
        as_query = open_members.where("label <> low").select(
            "bucket", F.explode(F.sequence(F.lit(0), F.col("bases") - 1)).alias("base_no"),
            F.pmod(hashed, F.col("queries")).cast("int").alias("query_no"), F.lit(1).alias("query"), *rest)
        block = ["bucket", "base_no", "query_no"]
        return stage(as_base.unionAll(as_query).repartition(*block).sortWithinPartitions(*block)
                     .mapInArrow(lambda batches: _meet(batches, least, percent), "a long, b long").distinct(), "links")

    def _components(self) -> DataFrame:
        """``key`` and ``component_id`` of each class; staged."""
        named = self.classes.select("cls", "key", "smallest").join(
            self.labels().withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
        named = stage(named, "named")
        smallest = stage(named.groupBy("label").agg(F.min("smallest").alias("component_id")), "components")
        return stage(named.join(smallest, "label").select("key", "component_id"), "by_key")

    def result(self) -> DataFrame:
        """Per row: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``."""
        joined = self.signatures.join(self._components(), "key", "left")
        component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                             F.col("doc_id").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles`` (size of its set), ``component_id`` (the smallest id that links reach),
    ``kept`` (it has that id).

    Two documents are linked if 100 * intersection >= ``percent`` * union of their sets of ``width``-word shingles. Null
    and empty texts have no set, link to nothing and are kept. Null ids are no smallest id unless all are null. Rows that
    share an id and a text are all kept or none; an empty table gives no rows.
    """
    return NearDuplicates(docs, width, percent, id_col, text_col).result()


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each group of near-duplicates: one with the smallest id, null if there is no other.

    Decisions are about rows, so rows that share an id stand for themselves. Texts without a set all stay. Texts are read where they
    lie and never shuffled; names of other columns do not matter.
    """
    found = NearDuplicates(docs, width, percent, id_col, text_col, by_row=True)
    return beside.without(found.place, found.result().where("not kept").select("doc_id.file", "doc_id.at"))
