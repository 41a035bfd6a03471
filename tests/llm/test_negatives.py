"""Hard negatives next to all products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.llm import covertree, queries
from flowlens.llm.covertree import CoverTree


def brute_search(vectors, labels, question, k, label, same, skip, window):
    scores = vectors @ question
    fit = (labels == label) == same
    if 0 <= skip:
        fit[skip] = False
    if window:
        fit &= (scores >= window[0]) & (scores <= window[1])
    at = np.flatnonzero(fit)
    at = at[np.lexsort((at, -scores[at]))][:k]
    return [(int(scores[i]), int(i)) for i in at]


@pytest.mark.parametrize("kind", ["clusters", "noise", "copies", "coarse", "zeros", "one"])
def test_tree_equals_all_products(kind):
    rng = np.random.default_rng(7)
    n, d = (1, 5) if kind == "one" else (1500, 12)
    labels = rng.integers(-1, 3, n)
    vectors = np.floor(rng.normal(0, 100, (n, d)) + (kind == "clusters") * 300 * rng.normal(0, 1, (3, d))[labels]).astype(np.int64)
    if kind == "copies":
        vectors[:900] = vectors[0]
    if kind == "coarse":
        vectors //= 90
    if kind == "zeros":
        vectors[:] = 0
    tree = CoverTree(vectors, labels, leaf=8)
    for i in range(0, n, 50):
        scores = vectors @ vectors[i]
        for same in (True, False):
            for window in (None, (int(scores.mean()), int(scores.max() // 2)), (5, 4)):
                for k in (1, 10):
                    asked = (k, int(labels[i]), same, i, window)
                    assert tree.search(vectors[i], *asked) == brute_search(vectors, labels, vectors[i], *asked)


def test_tree_covers_and_passes_over_nodes():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 2000, (20, 16))
    vectors = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(0, 20, (4000, 16))).astype(np.int64)
    tree = CoverTree(vectors, np.zeros(4000, np.int64), leaf=16)
    plain = tree.points.astype(float)
    lift = np.c_[plain, np.sqrt(np.maximum(tree.norm ** 2 - (plain ** 2).sum(1), 0))]

    def below(node):
        some = tree.below[node]
        return np.arange(len(plain))[some] if some is not None else np.concatenate([below(c) for c in tree.children[node]])

    assert sorted(below(0).tolist()) == list(range(len(plain)))
    for node in range(len(tree.centre)):
        assert (np.sqrt(((lift[below(node)] - lift[tree.centre[node]]) ** 2).sum(1)) <= tree.radius[node]).all()
    reached = []
    held = tree.below
    tree.below = type("Seen", (list,), {"__getitem__": lambda s, i: (reached.append(i), list.__getitem__(s, i))[1]})(held)
    tree.search(vectors[0], 10, 0, True)
    assert len(reached) < 0.3 * len(held)


def brute_negatives(rows, anchors, label_of, positives=5, negatives=10):
    usable = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(256 * x) for x in v], label_of(i, label)))
    out = []
    for n, (i, v, label) in enumerate(usable):
        if not anchors(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, other, m) for m, (j, w, other) in enumerate(usable)))
        for score, j, *_ in [s for s in scored if s[2] == label and s[3] != n][:positives]:
            fit = [s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score][:negatives]
            out += [(i, j, k + 1, s[1], -score, -s[0]) for k, s in enumerate(fit)]
    return sorted(out)


def shown(found):
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def test_query_equals_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute_negatives(rows, lambda i: i % 100 == 0, lambda i, x: (x + 1) % 10 if i % 7 == 0 else x)
    assert want and shown(queries.op11_cover_tree_negatives(spark, sf)) == want


def test_many_trees_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(covertree, "LEAST_ROWS", 40)
    monkeypatch.setattr(covertree, "QUESTIONS", 5)
    rng = np.random.default_rng(11)
    nan, inf = float("nan"), float("inf")
    rows = [(int(i), [round(float(x), 2) for x in rng.normal(0, 1, 4)], int(rng.integers(0, 3))) for i in range(300)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5], i % 2) for i in range(300, 420)]  # one vector, many times
    rows += [(500, None, 1), (None, [1.0] * 4, 1), (600, [1.0] * 4, None), (700, [nan, 1.0, 1.0, 1.0], 0), (800, [inf, 1.0, 1.0, 1.0], 0),
             (900, [None, 1.0, 1.0, 1.0], 0), (1000, [0.0] * 4, 1), (1100, [], 1), (1200, [2.0, 2.0], 0), (40, [1.0] * 4, 2), (40, [1.0] * 4, 2)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("row", F.lit("clash")) \
        .withColumn("score", F.lit(1)).repartition(3)
    got = shown(covertree.hard_negatives(vectors, F.col("vec_id") % 20 == 0))
    assert got == brute_negatives(rows, lambda i: i % 20 == 0, lambda i, x: x)
    assert covertree.hard_negatives(vectors.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert covertree.hard_negatives(vectors, F.lit(False)).count() == 0


def test_products_that_floats_cannot_hold():
    vectors = np.array([[1 << 30, 1], [1 << 30, 3], [-(1 << 30), 1]], np.int64)
    tree = CoverTree(vectors, np.zeros(3, np.int64))
    assert [tuple(x) for x in tree.search(vectors[0], 3, 0, True)] == [((1 << 60) + 3, 1), ((1 << 60) + 1, 0), (1 - (1 << 60), 2)]
    with pytest.raises(ValueError):
        covertree.exact_products(np.array([[1 << 40]], np.int64), np.array([1 << 40], np.int64))
