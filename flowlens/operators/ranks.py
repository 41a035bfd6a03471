"""Exact order statistics of many groups and columns, selected together.

A sketch counts values in log buckets: sign and rounded logarithm. It merges by adding counts, is built before
the shuffle, and brackets every wanted rank: the bucket in which it must lie, with the values below counted. Brackets with too many
rows are cut into equal parts, all in one scan, until what is left of each fits a task; those rows are then
ranked exactly. The number of scans depends neither on the number of columns nor on that of groups.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlens.functions.values import named
from flowlens.operators.scale import bounded
from flowlens.session import stage

GAMMA = 1.001  # upper end of a bucket to its lower end
PARTS = 4096  # parts a bracket is cut into
DIRECT_ROWS = 500_000  # rows of a bracket that one task ranks
_BEYOND = 800_000  # above the number of buckets of either sign: log of the least double is -745


def log_bucket(value: Column) -> Column:
    """Signed bucket of a double, rising with the value; equal values share one, zero has its own."""
    size = F.ceil(F.least(F.ln(F.abs(value)) / math.log(GAMMA), F.lit(_BEYOND - 1.0))) + _BEYOND  # infinity above all others
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value).cast("bigint") * size)


def rank_sketch(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys``, ``bucket``, ``n``, ``lo`` and ``hi``: how many values a bucket has, its least and largest. Sketches of parts of a
    table are merged by ``merge_sketches``."""
    v = named(value)
    return rows.groupBy(*[named(k) for k in keys], log_bucket(v).alias("bucket")).agg(
        F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """One sketch from several (``unionAll`` of them)."""
    return sketches.groupBy(*[named(k) for k in keys], "bucket").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _brackets(sketch: DataFrame, keys: list[str], ranks: DataFrame) -> DataFrame:
    """``keys``, ``rank``, ``lo``, ``hi``, ``below`` and ``n`` of the bucket that holds each rank."""
    upto = Window.partitionBy(*[named(k) for k in keys]).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = sketch.withColumn("upto", F.sum("n").over(upto))
    held = counted.select(*[named(k) for k in keys], "lo", "hi", "n", (F.col("upto") - F.col("n")).alias("below"))
    return held.join(bounded(ranks), keys).where(
        (F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("n")))


def _inside(rows: DataFrame, keys: list[str], value: str, brackets: DataFrame) -> DataFrame:
    """Rows with the bracket they lie in; ranks that share a bracket count its rows once."""
    distinct = brackets.select(*[named(k) for k in keys], "lo", "hi", "below").distinct()
    v = named(value)
    return rows.join(bounded(distinct), keys).where((v >= F.col("lo")) & (v <= F.col("hi")))


def select_ranks(rows: DataFrame, keys: list[str], value: str, ranks: DataFrame, direct_rows: int = DIRECT_ROWS,
                 parts: int = PARTS, sketch: DataFrame | None = None) -> DataFrame:
    """``keys``, ``rank``, ``value``: the value of each rank (from 0) of its group.

    ``rows`` hold ``keys`` (none of them null) and a double that is neither null nor NaN; pass a written table, each
    round scans it. ``ranks`` hold ``keys`` and ``rank``; ranks that a group does not have give no row. ``sketch`` is that of ``rows``,
    if it is at hand. Equal values in any number close a bracket by themselves.
    """
    by = [named(k) for k in keys]
    found = stage(_brackets(rank_sketch(rows, keys, value) if sketch is None else sketch, keys, ranks), "brackets")
    done = []
    while True:
        done.append(found.where("lo = hi").select(*by, "rank", F.col("lo").alias("value")))
        wide = found.where("lo < hi")
        large = wide.where(F.col("n") > direct_rows)
        done.append(_ranked(rows, keys, value, wide.where(F.col("n") <= direct_rows)))
        if large.isEmpty():
            break
        # Buckets have one sign and a bounded ratio, so the width of a bracket is finite; its ends fall into different parts.
        share = (named(value) - F.col("lo")) / (F.col("hi") - F.col("lo"))
        part = F.least(F.lit(parts - 1), F.floor(share * parts))
        cut = _inside(rows, keys, value, large).groupBy(*by, F.col("lo").alias("low"), F.col("below").alias("base"), part.alias("part")).agg(
            F.count("*").alias("n"), F.min(named(value)).alias("lo"), F.max(named(value)).alias("hi"))
        upto = Window.partitionBy(*by, "low").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        cut = cut.withColumn("below", F.col("base") + F.coalesce(F.sum("n").over(upto), F.lit(0)))
        asked = large.select(*by, "rank", F.col("lo").alias("low"))
        found = stage(cut.join(asked, [*keys, "low"]).where(
            (F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("n"))).select(
            *by, "rank", "lo", "hi", "below", "n"), "brackets")
    out = done[0]
    for some in done[1:]:
        out = out.unionByName(some)
    return out


def _ranked(rows: DataFrame, keys: list[str], value: str, brackets: DataFrame) -> DataFrame:
    """The ranks of brackets whose rows fit a task."""
    by = [named(k) for k in keys]
    counted = _inside(rows, keys, value, brackets).groupBy(*by, F.col("lo"), F.col("below"), named(value).alias("value")).agg(
        F.count("*").alias("n"))
    upto = Window.partitionBy(*by, "lo").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = counted.withColumn("last", F.col("below") + F.sum("n").over(upto))
    asked = brackets.select(*by, "lo", "rank")
    return last.join(asked, [*keys, "lo"]).where(
        (F.col("last") > F.col("rank")) & (F.col("last") - F.col("n") <= F.col("rank"))).select(*by, "rank", "value")


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: Column, direct_rows: int = DIRECT_ROWS,
              parts: int = PARTS) -> DataFrame:
    """``keys`` and ``value``: a quantile of each group, interpolated between the exact values of two ranks.

    ``shares`` is the wanted share of a group, an expression on its keys. Null and NaN do not count; a group without values has no row.
    """
    by = [named(k) for k in keys]
    v = named(value).cast("double")
    held = stage(rows.select(*by, v.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value")), "values")
    sketch = stage(rank_sketch(held, keys, "value"), "sketch")
    position = sketch.groupBy(*by).agg(F.sum("n").alias("size")).withColumn("position", (F.col("size") - 1) * shares).select(
        *by, F.floor("position").alias("low"), F.least(F.floor("position") + 1, F.col("size") - 1).alias("high"),
        (F.col("position") - F.floor("position")).alias("share"))
    position = stage(position, "positions")
    ranks = position.select(*by, F.explode(F.array("low", "high")).alias("rank")).distinct()
    at = stage(select_ranks(held, keys, "value", ranks, direct_rows, parts, sketch), "ranks")
    lower = at.select(*by, F.col("rank").alias("low"), F.col("value").alias("v0"))
    upper = at.select(*by, F.col("rank").alias("high"), F.col("value").alias("v1"))
    return position.join(lower, [*keys, "low"]).join(upper, [*keys, "high"]).select(
        *by, ((1 - F.col("share")) * F.col("v0") + F.col("share") * F.col("v1")).alias("value"))
