"""Synthetic minority rows from exact nearest neighbours.

Neighbours are found with pivot cells (Lu, Shen, Chen, Ooi: Efficient processing of k nearest
neighbor joins using MapReduce, 2012): points go to the cell of their nearest pivot, each point
first searches its own cell, and the k-th distance found there rules out most other cells by
the triangle inequality. Only the remaining cells are visited. Equal points are one point with a
weight, and a cell is cut into chunks, so no task holds more than ``cell_rows`` points at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from flowlens import settings
from flowlens.functions.values import named
from flowlens.operators.scale import split_total
from flowlens.session import stage

MOST_PIVOTS = 20_000
COPIES_PER_ROW = 100_000


def _squared(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    out = np.zeros((len(queries), len(points)))
    for j in range(queries.shape[1]):
        out += (queries[:, j, None] - points[None, :, j]) ** 2
    return out


def _blocks(n: int, width: int) -> Iterator[slice]:
    step = max(1, 4_000_000 // max(1, width))
    for i in range(0, n, step):
        yield slice(i, i + step)


def _nearest(queries: np.ndarray, points: np.ndarray, weights: np.ndarray, k: int) -> list[list]:
    """Per query up to k (squared distance, point, weight), nearest first, without the query itself."""
    order = np.lexsort(points.T[::-1])
    points, weights = points[order], weights[order]
    found: list[list] = []
    for block in _blocks(len(queries), len(points)):
        dist = _squared(queries[block], points)
        dist[dist == 0] = np.inf  # points are distinct, so distance 0 is the query itself
        take = min(k, len(points))
        # All points up to the k-th distance, so that ties are cut in point order.
        edge = np.partition(dist, take - 1, axis=1)[:, take - 1]
        for d, e in zip(dist, edge):
            near = np.flatnonzero((d <= e) & np.isfinite(d))
            near = near[np.argsort(d[near], kind="stable")][:k]
            found.append([(float(d[i]), points[i].tolist(), int(weights[i])) for i in near])
    return found


NEAR = "array<struct<dist2: double, vec: array<double>, w: bigint>>"


def neighbours(points: DataFrame, k: int = settings.NEIGHBOURS, cell_rows: int = 20_000,
               seed: int = settings.SEED) -> DataFrame:
    """Exact neighbours of distinct points (label, vec, w): adds ``near``, the k nearest others.

    Fewer are listed only where the label has fewer points.
    """
    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        vecs = np.stack(pdf["vec"].to_numpy())
        near = _nearest(vecs, vecs, pdf["w"].to_numpy(), k)
        return pdf.assign(near=near)

    spark = points.sparkSession
    sizes = {r["label"]: r["n"] for r in points.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if max(sizes.values(), default=0) <= cell_rows:  # one cell per label
        return points.select("label", "vec", "w").groupBy("label").applyInPandas(
            own, f"label string, vec array<double>, w bigint, near {NEAR}")
    share = min(1.0, MOST_PIVOTS * cell_rows / max(1, sum(sizes.values())))
    pivots: dict[str, np.ndarray] = {}
    for label, n in sizes.items():
        wanted = max(1, math.ceil(n * share / cell_rows))
        rows = (points.where(F.col("label") == label)
                .orderBy(F.xxhash64("vec", F.lit(seed)), "vec").limit(wanted).select("vec").collect())
        pivots[label] = np.array([r["vec"] for r in rows])
    shared = spark.sparkContext.broadcast(pivots)  # at most MOST_PIVOTS points and one per label

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cell, reach = np.zeros(len(pdf), dtype=np.int32), np.zeros(len(pdf))
            for label, at in pdf.groupby("label").indices.items():
                vecs = np.stack(pdf["vec"].to_numpy()[at])
                centres = shared.value[label]
                for block in _blocks(len(at), len(centres)):
                    dist = _squared(vecs[block], centres)
                    near = dist.argmin(axis=1)
                    cell[at[block]] = near
                    reach[at[block]] = np.sqrt(dist[np.arange(len(near)), near])
            yield pdf.assign(cell=cell, reach=reach)

    placed = stage(points.select("label", "vec", "w").mapInPandas(
        assign, "label string, vec array<double>, w bigint, cell int, reach double"), "cells")
    cells = {(r["label"], r["cell"]): (r["lo"], r["hi"], math.ceil(r["n"] / cell_rows), r["n"])
             for r in placed.groupBy("label", "cell").agg(
                 F.min("reach").alias("lo"), F.max("reach").alias("hi"),
                 F.count("*").alias("n")).collect()}
    chunks = spark.createDataFrame([(*key, c[2]) for key, c in cells.items()],
                                   "label string, cell int, chunks int")
    # One row per pivot.
    held = stage(placed.join(F.broadcast(chunks), ["label", "cell"]).withColumn(
        "chunk", F.pmod(F.xxhash64("vec", F.lit(seed + 1)), F.col("chunks")).cast("int")).select(
        "label", "vec", "w", "cell", "chunk", "reach"), "chunks")

    first = held.groupBy("label", "cell", "chunk").applyInPandas(
        own, f"label string, vec array<double>, w bigint, cell int, chunk int, reach double, near {NEAR}")
    first = stage(first, "near")
    layout = spark.sparkContext.broadcast(cells)  # four numbers per pivot

    def routes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[str, tuple] = {}
        for label in shared.value:
            of = [(c, *v) for (lab, c), v in layout.value.items() if lab == label]
            tables[label] = tuple(np.array(x) for x in zip(*of))
        for pdf in batches:
            for label, at in pdf.groupby("label").indices.items():
                ids, lo, hi, count, size = tables[label]
                vecs = np.stack(pdf["vec"].to_numpy()[at])
                found = np.sqrt([n[-1]["dist2"] if len(n) >= k else np.inf
                                 for n in pdf["near"].to_numpy()[at]])
                home, homechunk = pdf["cell"].to_numpy()[at], pdf["chunk"].to_numpy()[at]
                reach = pdf["reach"].to_numpy()[at]
                for block in _blocks(len(at), 10 * len(ids)):
                    d = np.sqrt(_squared(vecs[block], shared.value[label][ids]))
                    # The cells that hold k others in all bound the k-th distance too.
                    order = np.argsort(d + hi, axis=1)
                    enough = (np.cumsum(size[order], axis=1) > k).argmax(axis=1)
                    rows = np.arange(len(d))
                    whole = np.where(size.sum() > k, (d + hi)[rows, order[rows, enough]], np.inf)
                    bound = np.minimum(found[block], whole)[:, None] * (1 + 1e-9)
                    # A little slack keeps rounding from hiding an equal distance.
                    least = np.maximum(np.maximum(d - hi, lo - d), (d - reach[block, None]) / 2)
                    out = [(label, int(ids[c]), chunk, vecs[block.start + q])
                           for q, c in zip(*np.nonzero(least <= bound)) for chunk in range(count[c])
                           if ids[c] != home[block.start + q] or chunk != homechunk[block.start + q]]
                    yield pd.DataFrame(out, columns=["label", "cell", "chunk", "query"])

    visits = stage(first.select("label", "vec", "cell", "chunk", "reach", "near").mapInPandas(
        routes, "label string, cell int, chunk int, query array<double>"), "visits")
    turns = [(*r[:3], math.ceil(r["n"] / cell_rows)) for r in visits.groupBy(
        "label", "cell", "chunk").agg(F.count("*").alias("n")).collect()]

    def crowd() -> DataFrame:
        # One row per chunk.
        return F.broadcast(spark.createDataFrame(
            turns, "label string, cell int, chunk int, turns int"))

    # Queries take turns at a chunk, which is repeated per turn.
    where = ["label", "cell", "chunk", "turn"]
    at_turn = visits.join(crowd(), where[:3]).withColumn(
        "turn", F.pmod(F.xxhash64("query", F.lit(seed + 2)), F.col("turns")).cast("int"))
    data = held.join(crowd(), where[:3]).withColumn(
        "turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))

    def visit(points_: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if points_.empty or queries.empty:
            return pd.DataFrame(columns=["label", "vec", "near"])
        vecs = np.stack(queries["query"].to_numpy())
        near = _nearest(vecs, np.stack(points_["vec"].to_numpy()), points_["w"].to_numpy(), k)
        return pd.DataFrame({"label": queries["label"], "vec": queries["query"], "near": near})

    visited = data.groupBy(*where).cogroup(at_turn.groupBy(*where)).applyInPandas(
        visit, f"label string, vec array<double>, near {NEAR}")
    both = first.select("label", "vec", "w", "near").unionByName(
        visited.withColumn("w", F.lit(0).cast("bigint")))
    return both.groupBy("label", "vec").agg(
        F.max("w").alias("w"), F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k).alias("near"))


def oversample(df: DataFrame, label: str, features: list[str], k: int = settings.NEIGHBOURS,
               seed: int = settings.SEED, cell_rows: int = 20_000) -> DataFrame:
    """The rows plus synthetic ones until every class is as large as the largest.

    A synthetic row lies between a row and one of its k nearest rows of the same class. The rows
    of a class take turns as the starting point; the neighbour and the place in between come from
    a hash, so the result does not depend on the layout. With one class nothing is added.
    """
    vec = F.array(*[named(f).cast("double") for f in features])
    kind = df.schema[label].dataType
    rows = df.select(named(label).cast("string").alias("label"), vec.alias("vec"))
    points = stage(rows.groupBy("label", "vec").agg(F.count("*").alias("w")), "points")
    sizes = {r["label"]: r["n"] for r in points.groupBy("label").agg(F.sum("w").alias("n")).collect()}
    plain = df.select(named(label), *[named(f).cast("double").alias(f) for f in features])
    most = max(sizes.values(), default=0)
    lacking = {c: most - n for c, n in sizes.items() if n < most}
    if len(sizes) < 2 or not lacking:
        return plain
    small = [c for c in lacking if sizes[c] <= k]
    if small:
        raise ValueError(f"classes with {k} rows or fewer cannot be oversampled: {small}")
    minority = points.where(F.col("label").isin(*lacking))
    near = neighbours(minority, k, cell_rows, seed)
    # The slots 1..k of a row: its own copies first, then its neighbours with their copies.
    own = F.array_repeat("vec", F.least(F.col("w") - 1, F.lit(k)).cast("int"))
    others = F.flatten(F.transform("near", lambda n: F.array_repeat(
        n["vec"], F.least(n["w"], F.lit(k)).cast("int"))))
    slotted = near.select("label", "vec", "w", F.slice(F.concat(own, others), 1, k).alias("slots"),
                          F.xxhash64("vec", F.lit(seed)).alias("_order"))
    slotted = stage(slotted, "slots")
    shares = df.sparkSession.createDataFrame(
        [(c, lacking[c], sizes[c]) for c in lacking], "label string, lacking bigint, size bigint")
    running = split_total(slotted, ["label"], "_order", {"upto": "w"}, ties=["vec"])
    # One row per class. A row with weight w takes its part of the lacking rows, exactly.
    counted = running.join(F.broadcast(shares), "label")

    def part(rows_so_far):
        exact = rows_so_far.cast("decimal(19,0)") * F.col("lacking").cast("decimal(19,0)")
        return F.floor(exact / F.col("size").cast("decimal(19,0)")).cast("bigint")

    counted = counted.withColumn("copies", part(F.col("upto")) - part(F.col("upto") - F.col("w")))
    runs = counted.where(F.col("copies") > 0).select(
        "label", "vec", "slots", "copies", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES_PER_ROW).cast("bigint"))).alias("start"))
    if most > COPIES_PER_ROW:
        runs = runs.repartition("label", "vec", "start")  # a heavy row spreads over its runs
    made = runs.withColumn("j", F.explode(F.sequence(
        F.col("start"), F.least(F.col("start") + COPIES_PER_ROW, F.col("copies")) - 1)))
    u = F.pmod(F.xxhash64("vec", "j", F.lit(seed + 3)), F.lit(1 << 53)) / float(1 << 53)
    slot = F.pmod(F.xxhash64("vec", "j", F.lit(seed + 4)), F.size("slots")).cast("int")
    mixed = made.select("label", "vec", F.get("slots", slot).alias("to"), u.alias("u")).select(
        "label", F.zip_with("vec", "to", lambda a, b: a + F.col("u") * (b - a)).alias("vec"))
    synthetic = mixed.select(F.col("label").cast(kind).alias(label),
                             *[F.get("vec", F.lit(i)).alias(f) for i, f in enumerate(features)])
    return plain.unionByName(synthetic)
