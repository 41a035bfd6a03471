"""Order statistics and running totals that never put a whole group into one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlens.functions.values import named

DIRECT_ROWS = 2_000_000
BROADCAST_ROWS = 100_000


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A derived table for the small side of a join: broadcast if it has at most ``rows`` rows,
    which is checked, else left to the planner."""
    head = df.limit(rows + 1).collect()
    if len(head) > rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(head, df.schema))


def exact_quantiles(df: DataFrame, wanted: dict[str, float], direct_rows: int = DIRECT_ROWS,
                    accuracy: int = 4096) -> dict[str, float | None]:
    """Exact quantiles with linear interpolation; NULL and NaN do not count.

    A table with up to ``direct_rows`` rows uses the built-in ``percentile``, all columns in one aggregate. In a larger
    one the ranks of all columns are selected together, see ``ranks``: the number of scans does not
    depend on the number of columns. ``accuracy`` is the number of parts a bracket is cut into. Only scalars
    reach the driver.
    """
    from flowlens.operators.ranks import quantiles

    if not wanted:
        return {}
    result: dict[str, float | None] = {c: None for c in wanted}
    names = {f"c{i}": c for i, c in enumerate(wanted)}
    if df.count() <= direct_rows:
        values = df.select(*[F.nanvl(named(c).cast("double"), F.lit(None).cast("double")).alias(k) for k, c in names.items()])
        row = values.agg(*[F.percentile(k, F.lit(float(wanted[c]))).alias(k) for k, c in names.items()]).first()
        return result | {c: row[k] for k, c in names.items()}
    long = df.select(F.inline(F.array(*[F.struct(F.lit(k).alias("column"), named(c).cast("double").alias("value"))
                                        for k, c in names.items()])))
    share = F.create_map(*[F.lit(x) for k, c in names.items() for x in (k, float(wanted[c]))])[F.col("column")]
    found = quantiles(long, ["column"], "value", share, direct_rows, accuracy).collect()
    return result | {names[r["column"]]: r["value"] for r in found}


def cut_points(df: DataFrame, order: str, rows_per_bucket: int = DIRECT_ROWS,
               most: int = 4096) -> list[float]:
    """Values that cut a numeric column into buckets of about ``rows_per_bucket`` rows.

    They only balance the work; any list gives the same results.
    """
    n = df.count()
    buckets = min(most, math.ceil(n / rows_per_bucket))
    if buckets <= 1:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(F.col(order).cast("double"), shares,
                                     max(10_000, 4 * buckets)).alias("p")).first()
    return sorted(set(row["p"] or []))


def bucket_of(order: Column, cuts: list[float]) -> Column:
    """Number of cut points at or below the value: equal values share a bucket."""
    points = F.array(*[F.lit(float(v)) for v in cuts])
    above = order.cast("double")
    return F.when(order.isNull(), F.lit(0)).otherwise(
        F.size(F.filter(points, lambda p: p <= above)))


def split_total(df: DataFrame, keys: list[str], order: str, values: dict[str, str],
                ties: list[str] | None = None, rows_per_bucket: int = DIRECT_ROWS) -> DataFrame:
    """``running_total`` with buckets of about ``rows_per_bucket`` rows cut from the data."""
    cuts = cut_points(df, order, rows_per_bucket)
    if not cuts:
        return running_total(df, keys, None, order, values, ties)
    split = df.withColumn("_bucket", bucket_of(named(order), cuts))
    return running_total(split, keys, "_bucket", order, values, ties).drop("_bucket")


def running_total(df: DataFrame, keys: list[str], bucket: str | None, order: str,
                  values: dict[str, str], ties: list[str] | None = None) -> DataFrame:
    """Running totals up to and including the current ``order`` value, per ``keys``.

    ``values`` maps output to input columns. ``bucket`` must rise with ``order`` and bound the
    rows that one task sorts: totals per bucket are summed first, the sum of the earlier
    buckets enters each bucket as one extra leading row, and the window then runs per
    (keys, bucket). A key with a third of all rows is spread over all its buckets. Without a
    bucket the window runs per key, for tables known to be small.
    Equal ``order`` values share their total; with ``ties`` rows count one by one in that order.
    """
    part = [*keys, bucket] if bucket else keys
    sort = [named(order), *[named(t) for t in ties or []]]
    within = Window.partitionBy(*[named(p) for p in part])
    bounds = (Window.unboundedPreceding, Window.currentRow)
    if not bucket:
        frame = within.orderBy(*sort)
        frame = frame.rowsBetween(*bounds) if ties else frame.rangeBetween(*bounds)
        return df.select("*", *[F.sum(named(v)).over(frame).alias(o) for o, v in values.items()])
    frame = within.orderBy(F.desc("_head"), *sort)
    frame = frame.rowsBetween(*bounds) if ties else frame.rangeBetween(*bounds)
    totals = df.groupBy(*[named(p) for p in part]).agg(
        *[F.sum(named(v)).alias(f"_t_{o}") for o, v in values.items()])
    earlier = Window.partitionBy(*[named(k) for k in keys]).orderBy(named(bucket)).rowsBetween(
        Window.unboundedPreceding, -1)
    heads = totals.select(
        *[named(p) for p in part],
        *[F.coalesce(F.sum(f"_t_{o}").over(earlier), F.lit(0)).alias(f"_s_{o}") for o in values],
        F.lit(True).alias("_head"))
    rows = df.select("*", *[named(v).alias(f"_s_{o}") for o, v in values.items()],
                     F.lit(False).alias("_head"))
    both = rows.unionByName(heads, allowMissingColumns=True)
    summed = both.select(*[named(c) for c in df.columns], "_head",
                         *[F.sum(f"_s_{o}").over(frame).alias(o) for o in values])
    return summed.where(~F.col("_head")).drop("_head")


def rank_in_group(df: DataFrame, keys: list[str], order: str, ties: list[str],
                  out: str = "rank", rows_per_bucket: int = DIRECT_ROWS) -> DataFrame:
    """``row_number`` per group by a numeric column, split as in ``running_total``."""
    ones = df.withColumn("_one", F.lit(1))
    return split_total(ones, keys, order, {out: "_one"}, ties, rows_per_bucket).drop("_one")


def group_size(df: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Adds the rows per group."""
    sizes = (df.groupBy(*[named(k) for k in keys]).agg(F.count("*").alias(out))
             .select(*[named(k).alias(f"_g{i}") for i, k in enumerate(keys)], out))
    same = [named(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)]
    return df.join(bounded(sizes), same, "left").drop(*[f"_g{i}" for i in range(len(keys))])
