"""Exact dedup by content-defined chunk recipes.

A text is cut where a rolling hash of its last bytes has a pattern, so equal texts are cut alike. Each
chunk gets a short identifier, which is verified: all chunks of one identifier must have one SHA-256,
else they get variants of it. A document is then the ordered list of its identifiers, some bytes per
4 KB of text, and only these lists are shuffled. Texts are read once and never moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from flowlens.llm import beside
from flowlens.llm.common import lean, text_of, utf8_slices
from flowlens.session import stage

WINDOW = 32  # bytes the rolling hash looks at
SMALLEST, USUAL, LARGEST = 1024, 4096, 16384  # bytes of a chunk; USUAL is a power of two
BLOCK = 1 << 20  # bytes hashed at once, so long texts need no more memory

_GEAR = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of the (at most) ``WINDOW`` bytes that end there."""
    value = _GEAR[data]
    width = 1
    while width < WINDOW:
        # A window of 2w is the window of w, plus the one before it shifted by w.
        value[width:] += value[:-width] << np.uint32(width)
        width *= 2
    return value


def cuts(data: memoryview) -> list[int]:
    """Ends of the chunks of a text, the last one its length; an empty text has one empty chunk."""
    size = len(data)
    if size <= SMALLEST:
        return [size]
    found = []
    mask = np.uint32((USUAL - 1) << 20)
    whole = np.frombuffer(data, np.uint8)
    for at in range(0, size, BLOCK):
        before = min(at, WINDOW - 1)
        value = rolling_hash(whole[at - before:at + BLOCK])[before:]
        found.append(np.flatnonzero((value & mask) == 0) + (at + 1))
    ends, start = [], 0
    for end in np.concatenate(found).tolist():
        while end - start > LARGEST:
            start += LARGEST
            ends.append(start)
        if end - start >= SMALLEST:
            ends.append(end)
            start = end
    while size - start > LARGEST:
        start += LARGEST
        ends.append(start)
    if start < size:
        ends.append(size)
    return ends


@lean
def _recipe_batches(batches: Iterator[pa.RecordBatch], id_bits: int) -> Iterator[pa.RecordBatch]:
    mask = (1 << id_bits) - 1
    for batch in batches:
        whole, sizes, ids, proofs, offsets = [], [], [], [], [0]
        for raw in utf8_slices(batch.column(1)):
            text = bytes(raw).lower()  # of bytes, this changes A-Z only
            view, start = memoryview(text), 0
            for end in cuts(view):
                piece = view[start:end]
                ids.append(xxhash.xxh3_64_intdigest(piece) & mask)
                proofs.append(hashlib.sha256(piece).digest())
                start = end
            offsets.append(len(ids))
            sizes.append(len(text))
            whole.append(proofs[-1].hex() if offsets[-1] - offsets[-2] == 1
                         else hashlib.sha256(text).hexdigest())
        at = pa.array(offsets, pa.int32())
        short = pa.array(np.array(ids, np.uint64).view(np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(whole, pa.string()), pa.array(sizes, pa.int64()),
             pa.ListArray.from_arrays(at, short),
             pa.ListArray.from_arrays(at, pa.array(proofs, pa.binary()))],
            names=["id", "text_sha256", "n_bytes", "chunk_ids", "proofs"])


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", id_bits: int = 64) -> DataFrame:
    """A staged row per document: ``id``, ``text_sha256``, ``n_bytes`` of the text with A-Z lower-cased,
    ``chunk_ids`` in order, ``variants`` (of those identifiers that name several contents: position and
    variant) and ``row``. Two texts are equal if and only if ``chunk_ids`` and ``variants`` are.

    Null text is empty text. ``id_bits`` shortens the identifiers, for tests of the verification.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).cast("binary").alias("text"))
    cut = plain.mapInArrow(
        lambda batches: _recipe_batches(batches, id_bits),
        f"id {kind}, text_sha256 string, n_bytes long, chunk_ids array<long>, proofs array<binary>")
    cut = stage(cut.withColumn("row", F.monotonically_increasing_id()), "recipes")
    uses = cut.select("row", F.posexplode(F.arrays_zip("chunk_ids", "proofs")).alias("at", "chunk")) \
        .select("row", "at", F.col("chunk.chunk_ids").alias("chunk_id"), F.col("chunk.proofs").alias("proof"))
    # Verification: an identifier stands for one content, or its contents are numbered.
    disputed = stage(uses.groupBy("chunk_id").agg(F.min("proof").alias("lo"), F.max("proof").alias("hi"))
                     .where("lo <> hi").select("chunk_id"), "disputed")
    numbered = stage(
        uses.join(disputed, "chunk_id").select("chunk_id", "proof").distinct()
        .withColumn("variant", F.row_number().over(Window.partitionBy("chunk_id").orderBy("proof")))
        .where("variant > 1"), "numbered")
    fixes = stage(uses.join(numbered, ["chunk_id", "proof"]).groupBy("row")
                  .agg(F.sort_array(F.collect_list(F.struct("at", "variant"))).alias("variants")), "variants")
    none = F.array().cast("array<struct<at:int,variant:int>>")
    return cut.drop("proofs").join(fixes, "row", "left") \
        .withColumn("variants", F.coalesce("variants", none))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", id_bits: int = 64) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``n_chunks``.

    Of rows with equal texts (A-Z lower-cased; null is empty) the one with the largest id stays. Of rows that
    share text and id one stays; a null id is below all others. An empty table gives no rows.
    """
    rows = recipes(docs, id_col, text_col, id_bits)
    key = ["chunk_ids", "variants"]
    # Only groups of several rows; counted before the shuffle, so a large group is one row per task.
    groups = stage(rows.groupBy(*key).agg(F.max(F.struct("id", "row")).alias("keep"),
                                          F.count("*").alias("group_size"))
                   .where("group_size > 1"), "groups")
    # Both sides are plain files: a small one is broadcast by its size, a hot key of a large one is split.
    return rows.join(groups, key, "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("keep").isNull(), F.col("id")).otherwise(F.col("keep.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256", F.size("chunk_ids").alias("n_chunks"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that ``dedup`` does not keep.

    Of rows that share id and text one stays, if any does. Decisions are read beside the rows, so no text is shuffled; names of
    other columns do not matter.
    """
    place = beside.Located(docs)
    # A row is its id and place, so each decision is about one row.
    named = place.rows(place.docs[id_col].alias("doc_id"), text_of(place.docs, text_col).alias("text")) \
        .select(F.struct("doc_id", beside.FILE, beside.AT).alias("id"), "text")
    gone = dedup(named, "id", "text").where("not kept").select("doc_id.file", "doc_id.at")
    return beside.without(place, gone)
