"""Cleaning, encoding, selection, scaling and splitting of training tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from flowlens import settings
from flowlens.functions.values import columns_of, named
from flowlens.operators.scale import bounded, exact_quantiles, group_size, rank_in_group, running_total
from flowlens.session import stage


def _missing(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    c = named(name)
    return c.isNull() | F.isnan(c) if isinstance(kind, (T.DoubleType, T.FloatType)) else c.isNull()


def column_kinds(df: DataFrame) -> dict[str, list[str]]:
    return {kind: columns_of(df, kind) for kind in ("numeric", "text")}


def quality_counts(df: DataFrame) -> DataFrame:
    """One row: rows, missing cells and rows that repeat an earlier one."""
    names = [named(c) for c in df.columns]
    gaps = sum((_missing(df, c).cast("int") for c in df.columns), F.lit(0))
    return df.groupBy(*names, gaps.alias("_gaps")).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_n") * F.col("_gaps")), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    return exact_quantiles(df, {c: 0.5 for c in columns})


def modes(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent text per column, the smallest one on a tie; ``unknown`` without any.

    Values are counted before they are compared, so no task holds the vocabulary of a column.
    """
    if not columns:
        return {}
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), named(c).alias("value")) for c in columns])))
    counted = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count("*").alias("n"))
    best = counted.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias("value")).collect()
    return {c: "unknown" for c in columns} | {r["column"]: r["value"] for r in best}


def columns_with_gaps(df: DataFrame) -> list[str]:
    row = df.agg(*[F.coalesce(F.bool_or(_missing(df, c)), F.lit(False)).alias(f"c{i}")
                   for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if row[i]]


def fit_fills(df: DataFrame, columns: list[str] | None = None) -> dict[str, float | str]:
    """Median per numeric and mode per text column; by default of the columns with gaps."""
    wanted = columns_with_gaps(df) if columns is None else columns
    numeric = [c for c in columns_of(df, "numeric") if c in wanted]
    text = [c for c in columns_of(df, "text") if c in wanted]
    fills = {**medians(df, numeric), **modes(df, text)}
    return {c: v for c, v in fills.items() if v is not None}


def fill(df: DataFrame, fills: dict[str, float | str]) -> DataFrame:
    """Missing cells replaced; a numeric column with a fill becomes DOUBLE."""
    def filled(name: str) -> Column:
        value = fills.get(name)
        if value is None:
            return named(name)
        if isinstance(value, str):
            return F.coalesce(named(name), F.lit(value)).alias(name)
        return F.when(_missing(df, name), F.lit(float(value))).otherwise(
            named(name).cast("double")).alias(name)
    return df.select(*[filled(c) for c in df.columns])


def clean(df: DataFrame) -> DataFrame:
    """Distinct rows with medians and modes in the gaps."""
    distinct = stage(df.dropDuplicates(), "distinct")
    return fill(distinct, fit_fills(distinct))


def fit_codes(df: DataFrame, columns: list[str], rows_per_part: int = 1_000_000) -> DataFrame:
    """Code table (column, value, code): 0..k-1 per column in sorted text order.

    The vocabulary stays a table. A large one is range-partitioned and numbered part by part.
    """
    values = stage(df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("value"))
        for c in columns]))).where(F.col("value").isNotNull()).distinct(), "vocabulary")
    parts = math.ceil(values.count() / rows_per_part)
    if parts <= 1:
        order = Window.partitionBy("column").orderBy("value")
        return values.withColumn("code", (F.row_number().over(order) - 1).cast("bigint"))
    held = stage(values.repartitionByRange(parts, "column", "value").withColumn(
        "part", F.spark_partition_id()).withColumn("one", F.lit(1)), "vocabulary")
    numbered = running_total(held, ["column"], "part", "value", {"upto": "one"})
    return numbered.select("column", "value", (F.col("upto") - 1).alias("code"))


def encode(df: DataFrame, codes: DataFrame, columns: list[str]) -> DataFrame:
    """Columns replaced by their codes. A value without a code is an error."""
    out = df
    for i, c in enumerate(columns):
        part = bounded(codes.where(F.col("column") == c).select(
            F.col("value").alias(f"_v{i}"), F.col("code").alias(f"_c{i}")))
        out = out.join(part, named(c).cast("string") == F.col(f"_v{i}"), "left")

    def coded(i: int, c: str) -> Column:
        text = F.concat(F.lit(f"no code for {c} = "), F.coalesce(named(c).cast("string"), F.lit("null")))
        return F.when(F.col(f"_c{i}").isNull(), F.raise_error(text)).otherwise(F.col(f"_c{i}")).alias(c)

    place = {c: i for i, c in enumerate(columns)}
    return out.select(*[coded(place[c], c) if c in place else named(c) for c in df.columns])


def constant_flags(df: DataFrame) -> DataFrame:
    """Per column whether it has at most one distinct value. One pass, no distinct."""
    def same(c: str) -> Column:
        usable = F.when(~_missing(df, c), named(c))
        return F.min(usable).eqNullSafe(F.max(usable))
    row = df.agg(*[F.struct(F.lit(c).alias("column"), same(c).alias("is_constant")).alias(f"c{i}")
                   for i, c in enumerate(df.columns)])
    return row.select(F.inline(F.array(*row.columns)))


def constant_columns(df: DataFrame) -> list[str]:
    return [r["column"] for r in constant_flags(df).where("is_constant").collect()]


def select_features(df: DataFrame, target: str | None = None) -> tuple[DataFrame, list[str]]:
    """Without identifier and constant columns; also the feature names that are left."""
    kept = df.drop(*[named(c) for c in settings.IDENTIFIER_COLUMNS])
    constant = constant_columns(kept)
    if target in constant:
        raise ValueError(f"target column {target} has a single value")
    names = [c for c in kept.columns if c not in constant]
    return kept.select(*[named(c) for c in names]), [c for c in names if c != target]


def fit_scaler(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, from one aggregate."""
    usable = {c: F.when(~_missing(df, c), named(c).cast("double")) for c in columns}
    row = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(usable.values())],
                 *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(usable.values())]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)
            if row[f"m{i}"] is not None}


def scale(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    """Columns to mean 0, deviation 1; a column without spread becomes its distance to the mean."""
    def scaled(c: str) -> Column:
        mean, std = scaler[c]
        return ((named(c).cast("double") - mean) / (std or 1.0)).alias(c)
    return df.select(*[scaled(c) if c in scaler else named(c) for c in df.columns])


def normalise_flows(flows: DataFrame) -> DataFrame:
    """Flow columns scaled over the whole table, and a code for the protocol class."""
    columns = [c for c in settings.NORMALISED_COLUMNS if c in flows.columns]
    out = scale(flows, fit_scaler(flows, columns))
    if "protocol_type" in flows.columns:
        codes = fit_codes(flows, ["protocol_type"])
        both = out.withColumn("protocol_type_encoded", F.col("protocol_type"))
        out = encode(both, codes.withColumn("column", F.lit("protocol_type_encoded")),
                     ["protocol_type_encoded"])
    return out


def fill_for_scoring(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing numbers as 0."""
    return df.na.fill(0, columns or columns_of(df, "numeric"))


def scoring_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in settings.UNSCORED_COLUMNS]


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(named(label)).agg(F.count("*").alias("rows"))


def _ordered(df: DataFrame, order: str | None, seed: int) -> tuple[DataFrame, list[str]]:
    """The table with ``_order``: the given column, or a hash of the row that no layout changes."""
    if order is not None:
        return df.withColumn("_order", named(order)), df.columns
    return df.withColumn("_order", F.xxhash64(*[named(c) for c in df.columns], F.lit(seed))), df.columns


def mark_test_rows(df: DataFrame, label: str, share: float = settings.TEST_SHARE,
                   seed: int = settings.SEED, order: str | None = None, **scale_args) -> DataFrame:
    """Adds ``is_test``: of each label exactly ``round(share * rows)`` rows, the first by ``order``."""
    ordered, ties = _ordered(df, order, seed)
    ranked = group_size(rank_in_group(ordered, [label], "_order", ties, "_rank", **scale_args),
                        [label], "_rows")
    wanted = F.floor(F.col("_rows") * share + 0.5)
    return ranked.withColumn("is_test", F.col("_rank") <= wanted).drop("_order", "_rank", "_rows")


def stratified_split(df: DataFrame, label: str, share: float = settings.TEST_SHARE,
                     seed: int = settings.SEED, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test). The marked table is written once, both parts read it."""
    marked = stage(mark_test_rows(df, label, share, seed, order), "split")
    return (marked.where(~F.col("is_test")).drop("is_test"),
            marked.where("is_test").drop("is_test"))


def mark_folds(df: DataFrame, label: str, k: int = settings.FOLDS, seed: int = settings.SEED,
               order: str | None = None, **scale_args) -> DataFrame:
    """Adds ``fold`` 0..k-1: k runs of nearly equal length per label, the longer ones first."""
    ordered, ties = _ordered(df, order, seed)
    ranked = group_size(rank_in_group(ordered, [label], "_order", ties, "_rank", **scale_args),
                        [label], "_rows")
    place, base = F.col("_rank") - 1, F.floor(F.col("_rows") / k)
    longer = F.col("_rows") % k
    edge = longer * (base + 1)
    fold = F.when(place < edge, F.floor(place / (base + 1))).otherwise(
        longer + F.floor((place - edge) / F.greatest(base, F.lit(1))))
    return ranked.withColumn("fold", fold.cast("int")).drop("_order", "_rank", "_rows")
