"""Sets of ports as bitmaps.

A set is kept as words of 64 bits, only those that have a bit: few ports take a few words, and all 65,536 take 1,024. Sets
of parts of a table are merged by OR, before the shuffle too, so a source brings at most one row per task and word,
however many packets it has. The same words are the state of a stream, merged from batch to batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowlens.functions.values import named


def _word(port: str) -> Column:
    return F.shiftright(named(port).cast("int"), 6)


def port_words(rows: DataFrame, keys: list, port: str = "dst_port") -> DataFrame:
    """``keys``, ``word`` and ``bits``: the ports of each key, those with a null port left out. Works on batch and stream input."""
    bit = F.expr(f"shiftleft(1L, cast(`{port}` as int) & 63)")
    return rows.where(named(port).isNotNull()).groupBy(*keys, _word(port).alias("word")).agg(F.bit_or(bit).alias("bits"))


def merge_words(words: DataFrame, keys: list) -> DataFrame:
    """One set per key from several (``unionAll`` of them)."""
    return words.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))


def count_ports(words: DataFrame, keys: list) -> DataFrame:
    """``keys`` and ``ports``, the number of distinct ports; ``words`` has one row per key and word."""
    return words.groupBy(*keys).agg(F.sum(F.bit_count("bits").cast("bigint")).alias("ports"))


def distinct_ports(rows: DataFrame, keys: list[str], port: str = "dst_port") -> DataFrame:
    """``keys`` and ``ports`` of a table."""
    by = [named(k) for k in keys]
    return count_ports(port_words(rows, by, port), by)
