"""Mixing sources to target weights; DataFrame functions only.

Words are summed per source, targets and repetition rates derived, and each document is taken floor(rate) times,
plus once more if a hash of its id and the seed falls below the rest of the rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlens.llm.common import text_of, words_of
from flowlens.session import stage

MOST_REPEATS = 3  # a source's target is at most this many times its size
CYCLE = 3  # weights 1, 2, 3, 1, ... by rank of the source
SEED = "mix-1"


def draw(key: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the key and the seed only."""
    digest = F.md5(F.concat_ws("/", F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16 ** 13)


def targets(sizes: DataFrame, most: int = MOST_REPEATS, cycle: int = CYCLE) -> DataFrame:
    """``source``, ``source_size``, ``target`` and ``rate`` of each source of (``source``, ``size``).

    Sources by code point, null last, weigh 1, 2, ... ``cycle``, repeating. Shares by weight that exceed ``most``
    times the size are cut to it and the excess goes to the others by weight, until none is above. That ends
    with target = min(cap, level x weight) for one level, and the sources under their cap are those with the
    largest cap for their weight: so one pass in that order finds the level. The table has a row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = per_source.withColumn("weight", (F.pmod(rank - 1, F.lit(cycle)) + 1).cast("double")) \
        .withColumn("cap", (most * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordered = weighed.select(
        "*", F.sum("source_size").over(every).cast("double").alias("total"), F.sum("weight").over(every).alias("weights"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("caps_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("weights_before"))
    # What a unit of weight would get if all sources before this one were cut to their caps.
    level = (F.col("total") - F.col("caps_before")) / (F.col("weights") - F.col("weights_before"))
    # The first source that would not reach its cap then has the level; those after it do not either.
    found = ordered.withColumn("open", F.when(F.col("cap") > level * F.col("weight"), level)) \
        .withColumn("level", F.first("open", ignorenulls=True).over(every))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return found.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))


def copies(rate: Column, key: Column, seed: str = SEED) -> Column:
    """How often a document is taken: floor(rate), and once more with the rest as probability."""
    whole = F.floor(rate)
    return (whole + F.when(draw(key, seed) < rate - whole, 1).otherwise(0)).cast("long")


def sized(docs: DataFrame, text_col: str = "text") -> Column:
    """Words of a document."""
    return F.size(words_of(text_of(docs, text_col))).cast("long")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         seed: str = SEED) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``n_copies``, ``taken``.

    Null text has size 0; a null source is a source of its own; rows that share an id share its draw. An empty
    table gives no rows.
    """
    sizes = stage(docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"),
                              sized(docs, text_col).alias("size")), "sizes")
    rates = stage(targets(sizes), "targets").withColumnRenamed("source", "t_source")
    return sizes.join(rates, sizes["source"].eqNullSafe(rates["t_source"])) \
        .withColumn("n_copies", copies(F.col("rate"), F.col("doc_id"), seed)) \
        .select("doc_id", "source", "size", "source_size", "target", "n_copies",
                (F.col("n_copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = SEED) -> DataFrame:
    """The mixed table: each row of ``docs``, all columns, whatever their names, as often as ``plan`` says."""
    rates = stage(targets(docs.select(docs[source_col].alias("source"), sized(docs, text_col).alias("size"))), "targets")
    joined = docs.join(rates, docs[source_col].eqNullSafe(rates["source"]))
    times = F.array_repeat(F.lit(0), copies(rates["rate"], docs[id_col], seed).cast("int"))
    return joined.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.explode(times).alias("copy")).select("row.*")
