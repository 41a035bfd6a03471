"""Column helpers the text operators share."""

from __future__ import annotations

import ctypes
import functools
import re
import string
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SPACE_CLASS = r"\x20\x09-\x0D"
WORD_PATTERN = rf"[^{SPACE_CLASS}]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

find_words = re.compile(WORD_PATTERN).findall


def text_of(docs: DataFrame, text: str = "text") -> Column:
    """The text column with null as empty text."""
    return F.coalesce(docs[text].cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def words_of(column: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(F.split(column, rf"[{SPACE_CLASS}]+"), "")


def forget_pieces() -> None:
    """Let go of the pieces that an earlier step of this worker encoded; workers are used again by steps that need the memory."""
    tokens = sys.modules.get("flowlens.llm.tokens")
    if tokens is not None:
        tokens.encoder.cache_clear()


def give_back(trim: bool = True) -> None:
    """Give memory that this worker's allocators keep for nothing back to the system."""
    pa.default_memory_pool().release_unused()
    trimmed = getattr(ctypes.CDLL(None), "malloc_trim", None) if trim else None
    if trimmed is not None:
        trimmed(0)


def lean(step: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A step over batches that leaves no freed memory with its worker; workers are used again, beside the JVM and each other."""
    @functools.wraps(step)
    def run(*args, **named) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in step(*args, **named):
            yield batch
            del batch
            give_back(trim=False)
        give_back()
    return run


def parallel(df: DataFrame) -> int:
    """Partitions for work over few but heavy rows (file names, filter segments)."""
    return 4 * df.sparkSession.sparkContext.defaultParallelism


def utf8_slices(column: pa.Array) -> list[memoryview]:
    """The bytes of each text of a column without nulls, not copied."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if not len(column):
        return []
    offsets = memoryview(column.buffers()[1]).cast("q")[column.offset:column.offset + len(column) + 1]
    data = memoryview(column.buffers()[2] or b"")
    return [data[offsets[i]:offsets[i + 1]] for i in range(len(column))]
