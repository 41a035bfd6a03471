"""Quality rules with adaptive thresholds per language and source; DataFrame functions only.

Each text gives four ratios. Their distribution in a group (language, source) is kept as a quantile sketch with
logarithmic buckets: a row per bucket with a count, so sketches merge by adding counts, whatever the order, and
every quantile is exact to ``GAMMA`` - 1. The limits of a group follow from its quartiles (outer fences), and a
text beyond a limit of its own group is dropped. Groups with few documents use the sketch of their language, or of
all documents: the same buckets, added up.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlens.llm.common import SPACE_CHARS, text_of, words_of
from flowlens.session import stage

SYMBOLS = "#*$%&|<>"
GRAM = 5
LEAST_WORDS, MOST_REPEAT_PERCENT = 10, 20  # the base rules
GAMMA = 1.02
FENCE = 3.0  # quartile distances beyond the quartile
LEAST_DOCS = 100  # a group with fewer takes the limits of the level above
# Per ratio the least quartile distance: differences below it are no difference in quality.
SPREAD = {"word_length": 0.5, "symbol_ratio": 0.05, "dup_line_ratio": 0.15, "repeat_ratio": 0.07}
BELOW = ("word_length",)  # ratios with a lower limit as well


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(starts: Column) -> Column:
    """Words inside the windows that begin at ``starts``, which ascend."""
    return F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-GRAM).alias("at")),
        lambda acc, s: F.struct((acc["n"] + F.least(F.lit(GRAM), s - acc["at"])).alias("n"), s.alias("at")),
        lambda acc: acc["n"])


def _again(ordered: Column) -> Column:
    """Places of the windows that have an equal neighbour in sorted order."""
    found = F.filter(ordered, lambda x, i: (x["g"] == F.get(ordered, i - 1)["g"]) | F.coalesce(
        x["g"] == F.get(ordered, i + 1)["g"], F.lit(False)))
    return F.sort_array(F.transform(found, lambda x: x["i"]))


def _repeat_words(words: Column) -> Column:
    """Words inside ``GRAM``-word windows that occur twice or more in the text."""
    def windows(codes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(codes) - GRAM),
                           lambda i: F.xxhash64(*[F.get(codes, i + k) for k in range(GRAM)]))

    def count(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")) \
            .otherwise(_covered(_let(ordered, _again)))

    codes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < GRAM, F.lit(0).cast("long")).otherwise(_let(codes, lambda c: _let(windows(c), count)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source") -> DataFrame:
    """A staged row per document: ``doc_id``, ``lang``, ``source``, the counts of words, characters in words,
    symbols, lines with a word, lines equal to an earlier one and repeated words, and ``base_failed``.

    Null text has no words. Words are runs of anything but ASCII white space.
    """
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(SPACE_CHARS))) > 0)
    plain = docs.select(docs[id_col].alias("doc_id"), docs[lang_col].alias("lang"), docs[source_col].alias("source"),
                        text_of(docs, text_col).alias("text"))
    counted = plain.select(
        "doc_id", "lang", "source",
        F.length(F.translate(text, SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                       (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
        _let(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("again")))
        .alias("words"))
    counted = counted.select(
        "doc_id", "lang", "source", F.col("words.n").alias("n_words"), "word_chars", "n_symbols",
        F.col("lines.n").alias("n_lines"), F.col("lines.dup").alias("n_dup_lines"),
        F.col("words.again").alias("n_repeat_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    return stage(counted.withColumn("base_failed", failed), "measures")


RATIOS = {"word_length": ("word_chars", "n_words"), "symbol_ratio": ("n_symbols", "n_words"),
          "dup_line_ratio": ("n_dup_lines", "n_lines"), "repeat_ratio": ("n_repeat_words", "n_words")}


def _ratio(name: str) -> Column:
    above, below = RATIOS[name]
    return F.col(above).cast("double") / F.greatest(F.col(below), F.lit(1)).cast("double")


def sketches(measured: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``ratio``, ``bucket``, ``n``: mergeable quantile sketches of the ratios over the
    documents that pass the base rules. A zero is in the null bucket, which is the lowest."""
    values = measured.where("not base_failed").select("lang", "source", F.explode(F.array(*[
        F.struct(F.lit(name).alias("ratio"), _ratio(name).alias("value")) for name in RATIOS])).alias("x"))
    bucket = F.when(F.col("x.value") > 0, F.ceil(F.log(F.col("x.value")) / F.lit(math.log(GAMMA))))
    return values.groupBy("lang", "source", F.col("x.ratio").alias("ratio"), bucket.alias("bucket")) \
        .agg(F.count("*").alias("n"))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Number of documents, ``q1`` and ``q3`` of each ratio by ``keys``."""
    merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "ratio")
    upto = group.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    # A bucket ends at GAMMA ** bucket; this point of it is within the accuracy of both its ends.
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(
        2 * F.pow(F.lit(GAMMA), F.col("bucket").cast("double")) / (GAMMA + 1))
    ranked = merged.select(*keys, "ratio", value.alias("value"), F.sum("n").over(upto).alias("upto"),
                           F.sum("n").over(group).alias("docs"))
    at = {"q1": 1, "q3": 3}
    return ranked.groupBy(*keys, "ratio").agg(F.max("docs").alias("docs"), *[
        F.min(F.when(4 * F.col("upto") >= k * F.col("docs"), F.col("value"))).alias(q) for q, k in at.items()])


def thresholds(sketch: DataFrame) -> DataFrame:
    """A row per (``lang``, ``source``) with ``<ratio>_high`` of each ratio, and ``<ratio>_low`` of some.

    The limits are ``FENCE`` quartile distances beyond the quartiles of the group, if it has ``LEAST_DOCS``
    documents, else of its language, if that has as many, else of all documents.
    """
    own = _quartiles(sketch, ["lang", "source"])
    lang = _quartiles(sketch, ["lang"]).select(F.col("lang").alias("l_lang"), F.col("ratio").alias("l_ratio"),
                                               F.col("docs").alias("l_docs"), F.col("q1").alias("l_q1"), F.col("q3").alias("l_q3"))
    every = _quartiles(sketch, []).select(F.col("ratio").alias("e_ratio"), F.col("q1").alias("e_q1"), F.col("q3").alias("e_q3"))
    levels = own.join(lang, own["lang"].eqNullSafe(lang["l_lang"]) & (own["ratio"] == lang["l_ratio"])) \
        .join(every, F.col("ratio") == F.col("e_ratio"))

    def pick(q: str) -> Column:
        return F.when(F.col("docs") >= LEAST_DOCS, F.col(q)).when(F.col("l_docs") >= LEAST_DOCS, F.col(f"l_{q}")) \
            .otherwise(F.col(f"e_{q}"))

    chosen = levels.select("lang", "source", "ratio", pick("q1").alias("q1"), pick("q3").alias("q3"))

    def limit(name: str, high: bool) -> Column:
        reach = FENCE * F.greatest(F.col("q3") - F.col("q1"), F.lit(SPREAD[name]))
        return F.max(F.when(F.col("ratio") == name, F.col("q3") + reach if high else F.col("q1") - reach))

    return chosen.groupBy("lang", "source").agg(
        *[limit(name, True).alias(f"{name}_high") for name in RATIOS],
        *[limit(name, False).alias(f"{name}_low") for name in BELOW])


def verdicts(docs: DataFrame, **columns: str) -> DataFrame:
    """``measures`` with ``kept``: the base rules passed and no ratio beyond a limit of the document's group.

    A null language or source is a group of its own. Repeated rows are judged, and counted, one by one. An empty
    table gives no rows; texts without words fail the base rules.
    """
    measured = measures(docs, **columns)
    limits = stage(thresholds(stage(sketches(measured), "sketches")), "thresholds").withColumnsRenamed(
        {"lang": "t_lang", "source": "t_source"})
    # The limits are a plain file: broadcast if small, else joined by sort with hot groups split.
    joined = measured.join(limits, measured["lang"].eqNullSafe(limits["t_lang"])
                           & measured["source"].eqNullSafe(limits["t_source"]), "left")
    beyond = F.lit(False)
    for name in RATIOS:
        beyond = beyond | F.coalesce(_ratio(name) > F.col(f"{name}_high"), F.lit(False))
    for name in BELOW:
        beyond = beyond | F.coalesce(_ratio(name) < F.col(f"{name}_low"), F.lit(False))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", (~F.col("base_failed") & ~beyond).alias("kept"))
