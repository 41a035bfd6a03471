"""Passages of words that recur in other documents, removed with automata.

A window is 50 consecutive words. Each window is named by the least hash of its 8-word phrases; windows in a row that share
that phrase are one stretch of words, and equal windows lie in stretches with equal phrases. So of each document only the
stretches are compared, one per 22 words or so:

1. Phrases of one document only are dropped. Where all stretches of a phrase are equal they recur as a whole; the others are
   confirmed window by window. What is confirmed has the smallest id of the documents it starts in.
2. Confirmed passages are a dictionary of words. A range of rows (a shard) gets those that occur in it, as texts, and compiles
   them to Aho-Corasick automata over word numbers, of bounded size each.
3. All documents are streamed through the automata of their shard, which locate every occurrence. Words that an occurrence
   covers go, if the passage starts in a document with a smaller id.

Documents are read three times and never shuffled: hashes are, and the texts of confirmed passages, once each and shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from flowlens.llm import beside
from flowlens.llm.common import text_of, utf8_slices
from flowlens.session import stage

WINDOW = 50  # words of a passage at least
GRAM = 8  # words of the phrase that names a window
SHARD_ROWS = 512  # rows that share a dictionary
MOST_WORDS = 1_000_000  # words of the passages compiled into one automaton; a shard may have several
SHARDS_READ = 8  # dictionaries that lie in one file
NO_ID = (1 << 63) - 1  # stands for a null id, which is above all others

_FIRST, _SECOND = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


BLOCK = 1 << 18  # bytes of text hashed at once
_POWERS = np.cumprod(np.r_[np.uint64(1), np.full(BLOCK, _FIRST)])
_INVERSES = np.cumprod(np.r_[np.uint64(1), np.full(BLOCK, np.uint64(pow(int(_FIRST), -1, 1 << 64)))])


def _mix(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(32))) * _SECOND
    return value ^ (value >> np.uint64(29))


def _sums(values: np.ndarray) -> np.ndarray:
    """Running sums of the values times powers of an odd factor: differences of them, scaled back, are hashes of stretches."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _POWERS[:len(values)], out=out[1:])
    return out


def word_codes(joined: bytes) -> np.ndarray:
    """A 64-bit code of each word; the words are joined by one space."""
    data = np.frombuffer(joined, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    ends = np.r_[np.flatnonzero(data == 32), len(data)]
    starts = np.r_[0, ends[:-1] + 1]
    out = np.empty(len(ends), np.uint64)
    k = 0
    while k < len(ends):
        base = int(starts[k])
        stop = int(np.searchsorted(ends, base + BLOCK, "right"))
        if stop <= k:  # a word longer than a block
            out[k] = xxhash.xxh3_64_intdigest(joined[base:int(ends[k])])
            k += 1
            continue
        sums = _sums(data[base:int(ends[stop - 1])].astype(np.uint64) + np.uint64(1))
        first, last = starts[k:stop] - base, ends[k:stop] - base
        out[k:stop] = _mix((sums[last] - sums[first]) * _INVERSES[first])
        k = stop
    return out


def codes_of(texts: list[bytes]) -> list[np.ndarray]:
    """The word codes of each text of words joined by one space; many texts at a time."""
    whole = word_codes(b" ".join([t for t in texts if t]))
    ends = np.cumsum([t.count(b" ") + 1 if t else 0 for t in texts])
    return np.split(whole, ends[:-1]) if texts else []


def _joined(left: np.ndarray, right: np.ndarray, factor: np.uint64) -> np.ndarray:
    value = (left * factor + right) * factor
    value ^= value >> np.uint64(32)
    return value * factor


def stretch_hashes(codes: np.ndarray, size: int, factor: np.uint64 = _FIRST) -> np.ndarray:
    """A hash of each ``size`` consecutive codes, put together from those of powers of two."""
    done, width, value, out = 0, 1, codes, None
    while True:
        if size & width:
            part = value[done:]
            out = part if out is None else _joined(out[:len(part)], part, factor)
            done += width
        width *= 2
        if width > size:
            return out[:max(0, len(codes) - size + 1)]
        half = width // 2
        value = _joined(value[:-half], value[half:], factor) if len(value) > half else value[:0]


def stretches(codes: np.ndarray, sizes: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``anchor`` (hash of the naming phrase), ``key`` (hash of all words), first window and number of windows of each stretch.

    ``codes`` are those of one text, or of several one after another with ``sizes`` words each; no window crosses texts.
    """
    windows = len(codes) - WINDOW + 1
    if windows < 1:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none
    grams = stretch_hashes(codes, GRAM)
    named = leftmost_least(grams, WINDOW - GRAM + 1)
    if sizes is not None and len(sizes) > 1:
        text = np.repeat(np.arange(len(sizes)), sizes)
        named[text[:windows] != text[WINDOW - 1:]] = -1
    first = np.flatnonzero(np.r_[True, named[1:] != named[:-1]])
    many = np.diff(np.r_[first, windows])
    inside = named[first] >= 0
    first, many = first[inside], many[inside]
    keys = np.empty(len(first), np.uint64)
    step = BLOCK - 2 * WINDOW
    for at in range(0, windows, step):  # the stretches that begin in a block of words
        some = slice(*np.searchsorted(first, [at, at + step]).tolist())
        begin, end = first[some] - at, first[some] + many[some] + (WINDOW - 1 - at)
        sums = _sums(codes[at:at + BLOCK])
        keys[some] = _mix((sums[end] - sums[begin]) * _INVERSES[begin] + many[some].astype(np.uint64))
    return grams[named[first]], keys, first, many


def leftmost_least(values: np.ndarray, size: int) -> np.ndarray:
    """The place of the least of each ``size`` consecutive values, the first of equal ones; by doubling."""
    place, width = np.arange(len(values)), 1
    while True:
        step = min(width, size - width)
        if not step:
            return place
        closer = values[step:] < values[:-step]
        values = np.where(closer, values[step:], values[:-step])
        place = np.where(closer, place[step:], place[:-step])
        width += step


def _normal(column: pa.Array) -> list[bytes]:
    """The words of each text, joined by one space. Splitting bytes parts at the six ASCII white spaces and no others."""
    return [b" ".join(bytes(raw).split()) for raw in utf8_slices(column)]


def _slices(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a batch, some at a time, with the place of the first."""
    for at in range(0, len(column), 256):
        yield at, _normal(column.slice(at, 256))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, anchors, keys = [0], [], []
        for _, texts in _slices(batch.column(3)):
            parts = codes_of(texts)
            counts = [len(p) for p in parts]
            anchor, key, first, _ = stretches(np.concatenate(parts), counts)
            # Each once per text; they come text by text.
            text = np.searchsorted(np.cumsum(counts), first, "right")
            once = np.sort(np.unique(_mix(key ^ anchor) + text.astype(np.uint64) * _FIRST, return_index=True)[1])
            anchors.append(anchor[once])
            keys.append(key[once])
            sizes += (sizes[-1] + np.cumsum(np.bincount(text[once], minlength=len(texts)))).tolist()
        found = pa.StructArray.from_arrays([pa.array(np.concatenate(x).view(np.int64)) if x else pa.array([], pa.int64())
                                            for x in (anchors, keys)], names=["anchor", "key"])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), found)],
                                         names=["file", "at", "doc", "found"])


def _confirm(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """The words of wanted stretches, and of contested ones the hashes of their windows."""
    for batch in batches:
        for file, rows in beside.by_file(batch):
            at = np.asarray(rows.column(1))
            for wanted in beside.read(folder, file, int(at.min()), int(at.max())):
                places = np.asarray(wanted["at"])
                first_of, last_of = np.searchsorted(places, at, "left"), np.searchsorted(places, at, "right")
                here = np.flatnonzero(last_of > first_of)
                for begin in range(0, len(here), 256):
                    some = here[begin:begin + 256]
                    texts = _normal(rows.column(2).take(pa.array(some)))
                    out: list[tuple] = []
                    for i, text, codes in zip(some.tolist(), texts, codes_of(texts)):
                        out += _wanted_stretches(text, codes, wanted.slice(first_of[i], last_of[i] - first_of[i]).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[c] for r in out], kind) for c, kind in enumerate(
                            [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("one", pa.int64()), ("two", pa.int64())]))])],
                        names=["anchor", "key", "lo", "hi", "words", "windows"])


def _wanted_stretches(text: bytes, codes: np.ndarray, wanted: list[dict]) -> Iterator[tuple]:
    words = text.split(b" ")
    anchor, key, first, many = stretches(codes)
    # Of equal stretches any will do.
    place = {pair: k for k, pair in enumerate(zip(anchor.view(np.int64).tolist(), key.view(np.int64).tolist()))}
    one = two = None
    for row in wanted:
        k = place[row["anchor"], row["key"]]
        s, m = int(first[k]), int(many[k])
        windows = None
        if row["contested"]:
            if one is None:
                one, two = (stretch_hashes(codes, WINDOW, f).view(np.int64) for f in (_FIRST, _SECOND))
            windows = [{"one": a, "two": b} for a, b in zip(one[s:s + m].tolist(), two[s:s + m].tolist())]
        yield row["anchor"], row["key"], row["lo"], row["hi"], b" ".join(words[s:s + m + WINDOW - 1]).decode(), windows


class PhraseAutomata:
    """Automata over word numbers for passages (word codes and a smallest id), of at most ``most_words`` words each, or one passage."""

    def __init__(self, passages: list[tuple[np.ndarray, int]], most_words: int = MOST_WORDS):
        self._parts: list[tuple[ahocorasick.Automaton, np.ndarray]] = []
        self._least = min((len(codes) for codes, _ in passages), default=1)
        begin, size = 0, 0
        for end, (codes, _) in enumerate(passages, 1):
            size += len(codes)
            if size >= most_words or end == len(passages):
                self._parts.append(self._compile(passages[begin:end]))
                begin, size = end, 0

    @staticmethod
    def _compile(passages: list[tuple[np.ndarray, int]]) -> tuple[ahocorasick.Automaton, np.ndarray]:
        machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        known, numbers = np.unique(np.concatenate([codes for codes, _ in passages]), return_inverse=True)
        numbers, at = (numbers.ravel() + 1).tolist(), 0  # 0 is any other word
        for codes, smallest in passages:
            machine.add_word(tuple(numbers[at:at + len(codes)]), (len(codes), smallest))
            at += len(codes)
        machine.make_automaton()
        return machine, known

    def occurrences(self, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``start``, ``end`` and the smallest id of each passage that occurs among the words."""
        for machine, known in self._parts:
            numbers = np.minimum(np.searchsorted(known, codes), len(known) - 1)
            other = np.flatnonzero(known[numbers] != codes)
            # No passage holds another word, so what lies between two of them is streamed, if it is long enough.
            edges = np.r_[-1, other, len(codes)]
            for gap in np.flatnonzero(np.diff(edges) > self._least).tolist():
                start, end = int(edges[gap]) + 1, int(edges[gap + 1])
                for last, (size, smallest) in machine.iter(tuple((numbers[start:end] + 1).tolist())):
                    yield start + last + 1 - size, start + last + 1, smallest


def passages_of(codes: np.ndarray, lo: int, marks: list[dict] | None) -> Iterator[tuple[np.ndarray, int]]:
    """The passages of a stretch: all of it, or the windows in a row of one smallest id."""
    if marks is None:
        yield codes, lo
        return
    k = 0
    while k < len(marks):
        first, smallest = marks[k]["j"], marks[k]["smallest"]
        end = k + 1
        while end < len(marks) and marks[end]["j"] == first + end - k and marks[end]["smallest"] == smallest:
            end += 1
        yield codes[first:first + end - k + WINDOW - 1], smallest
        k = end


def covered(codes: np.ndarray, doc: int, automata: PhraseAutomata | None) -> list[tuple[int, int]]:
    """The stretches of words that go, in order and apart: those in passages that start in a document with a smaller id."""
    if automata is None or len(codes) < WINDOW:
        return []
    spans: list[list[int]] = []
    for start, end in sorted((start, end) for start, end, smallest in automata.occurrences(codes) if smallest < doc):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return [(start, end) for start, end in spans]


def _dictionary(folder: str, file: str, shard: int, most_words: int) -> PhraseAutomata | None:
    """The automata of a shard, if any passage occurs in it."""
    passages: list[tuple[np.ndarray, int]] = []
    for piece in beside.read(folder, file, shard, shard, SHARDS_READ):
        for codes, lo, marks in zip(codes_of([w.encode() for w in piece["words"].to_pylist()]), piece["lo"].to_pylist(), piece["marks"].to_pylist()):
            passages += passages_of(codes, lo, marks)
    return PhraseAutomata(passages, most_words) if passages else None


def _remove(batches: Iterator[pa.RecordBatch], folder: str, shard_rows: int, most_words: int) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    named, automata = None, None
    for whole in batches:
        for begin, texts in _slices(whole.column(3)):
            batch = whole.slice(begin, len(texts))
            sizes, spans, kept = [], [], []
            for file, at, doc, text, codes in zip(*(batch.column(c).to_pylist() for c in range(3)), texts, codes_of(texts)):
                shard = (file, at // shard_rows)
                if shard != named:
                    named, automata = shard, _dictionary(folder, file, shard[1], most_words)
                gone = covered(codes, doc, automata)
                sizes.append(len(codes))
                spans.append([{"start": s, "end": e} for s, e in gone])
                if gone:
                    words, inner = text.split(b" "), [0, *[x for pair in gone for x in pair], len(codes)]
                    text = b" ".join([w for s, e in zip(inner[::2], inner[1::2]) for w in words[s:e]])
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(4), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "spans", "kept_text"])


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = SHARD_ROWS,
                 most_words: int = MOST_WORDS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``spans`` (stretches of words that go: ``start``, ``end``, in order and apart)
    and ``kept_text`` (the other words, joined by one space).

    A word goes if a window of 50 words covers it that also starts in a document with a smaller id. Ids are whole numbers. A null id
    is above all others; rows that share an id (or have none) do not take each other's words. Windows are those of the input, so a
    passage that its first holder loses to a still smaller id goes from all others as well. Texts under 50 words, null and empty
    ones lose nothing. A text is handled whole in one task, whatever its length. Other columns of ``docs`` are not looked at.
    An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    place = beside.Located(docs)
    text = text_of(place.docs, text_col).alias("text")
    doc = F.coalesce(place.docs[id_col].cast("long"), F.lit(NO_ID)).alias("doc")
    scanned = stage(place.rows(doc, text).mapInArrow(_scan, "file string, at long, doc long, found array<struct<anchor:long,key:long>>")
                    .withColumn("row", F.monotonically_increasing_id()), "stretches")
    found = scanned.select("row", "doc", F.explode("found").alias("f")).select("row", "doc", "f.anchor", "f.key")
    # Phrases of several documents; a phrase is contested if its stretches differ.
    recurring = stage(found.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"),
                                                  F.min("key").alias("one"), F.max("key").alias("other"))
                      .where("lo < hi").select("anchor", (F.col("one") != F.col("other")).alias("contested")), "phrases")
    held = stage(found.join(recurring, "anchor"), "held")
    where = scanned.select("row", "file", "at")
    keyed = held.groupBy("anchor", "key").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.min("row").alias("row"),
                                              F.max("contested").alias("contested"))
    wanted = beside.put(keyed.join(where, "row").drop("row"), "wanted")
    confirmed = stage(place.rows(text).mapInArrow(
        lambda batches: _confirm(batches, wanted),
        "anchor long, key long, lo long, hi long, words string, windows array<struct<one:long,two:long>>"), "confirmed")
    # Windows of contested stretches, and the smallest id of those that recur.
    windows = confirmed.select("anchor", "key", "lo", "hi", F.posexplode("windows").alias("j", "w")) \
        .select("anchor", "key", "lo", "hi", "j", "w.one", "w.two")
    again = stage(windows.groupBy("one", "two").agg(F.min("lo").alias("smallest"), F.max("hi").alias("largest"))
                  .where("smallest < largest").drop("largest"), "windows")
    marks = windows.join(again, ["one", "two"]).groupBy("anchor", "key").agg(
        F.sort_array(F.collect_list(F.struct("j", "smallest"))).alias("marks"))
    whole = confirmed.where("windows is null").select("anchor", "key", "words", "lo")
    none = F.lit(None).cast("array<struct<j:int,smallest:long>>")
    units = stage(whole.withColumn("marks", none).unionByName(
        confirmed.where("windows is not null").join(marks, ["anchor", "key"]).select("anchor", "key", "words", "lo", "marks")), "passages")
    shards = held.select("anchor", "key", "row").join(where, "row") \
        .select("anchor", "key", "file", F.floor(F.col("at") / shard_rows).alias("at")).distinct()
    dictionary = beside.put(shards.join(units, ["anchor", "key"]).select("file", "at", "words", "lo", "marks"), "dictionary", SHARDS_READ)
    return place.rows(doc, text, place.docs[id_col].alias("doc_id")).mapInArrow(
        lambda batches: _remove(batches, dictionary, shard_rows, most_words),
        f"doc_id {kind}, n_words long, spans array<struct<start:long,end:long>>, kept_text string")
