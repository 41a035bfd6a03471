"""The split ways must give the numbers of the plain ones."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowlens.operators import blocks, detect, features as ft, logs, scale, smote


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(7)
    v = rng.normal(size=4000).round(2)
    v[:1400] = 0.25  # a third is one value
    g = rng.choice(["a", "b", "c"], size=4000, p=[0.8, 0.15, 0.05])
    return pd.DataFrame({"id": range(4000), "g": g, "v": v})


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.9, 0.95, 0.999, 1.0])
def test_narrowed_quantile(spark, numbers, q):
    df = spark.createDataFrame(numbers)
    got = scale.exact_quantiles(df, {"v": q}, direct_rows=50, accuracy=50)["v"]
    assert got == pytest.approx(numbers["v"].quantile(q), abs=1e-12)


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (2.0, None)], "a double, b double")
    assert scale.exact_quantiles(df, {"a": 0.5, "b": 0.5}) == {"a": 1.5, "b": None}


def test_rank_in_group(spark, numbers):
    df = spark.createDataFrame(numbers)
    got = scale.rank_in_group(df, ["g"], "v", ["id"], rows_per_bucket=100).toPandas().set_index("id")["rank"]
    want = numbers.sort_values(["v", "id"]).groupby("g").cumcount() + 1
    assert (got.sort_index() == want.sort_index()).all()


@pytest.mark.parametrize("ties", [None, ["id"]])
def test_split_total(spark, numbers, ties):
    df = spark.createDataFrame(numbers.assign(one=1))
    a = scale.split_total(df, ["g"], "v", {"upto": "one"}, ties, rows_per_bucket=100)
    b = scale.split_total(df, ["g"], "v", {"upto": "one"}, ties)
    cols = ["id", "g", "v", "upto"]
    assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def brute_trailing(rows, window):
    out = {}
    for k, t in rows:
        out.setdefault((k, t), [0, sum(1 for k2, t2 in rows if k2 == k and t - window < t2 <= t)])[0] += 1
    return [(k, t, n, r) for (k, t), (n, r) in out.items()]


@pytest.mark.parametrize("hot_rows", [1, 40, 10_000])
def test_trailing_counts(spark, hot_rows):
    rng = np.random.default_rng(3)
    rows = [("x" if i % 3 else "y", int(t)) for i, t in enumerate(rng.integers(0, 5_000_000, size=300))]
    rows += [("x", 0), ("x", 2_000_000), ("x", 2_000_000), (None, 5), (None, 6)]
    df = spark.createDataFrame(rows, "k string, ts_us bigint")
    got = detect.trailing_counts(df, ["k"], window_us=2_000_000, hot_rows=hot_rows).collect()
    want = brute_trailing(rows, 2_000_000)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_event_exactly_one_window_old_is_out(spark):
    df = spark.createDataFrame([("a", 0), ("a", 59_999_999), ("a", 60_000_000)], "k string, ts_us bigint")
    for hot in (1, 100):
        got = detect.trailing_counts(df, ["k"], hot_rows=hot).orderBy("ts_us").collect()
        assert [r["recent"] for r in got] == [1, 2, 2]


def brute_blocks(rows, span):
    out = []
    for ip in {r[0] for r in rows}:
        last = None
        for t in sorted({t for i, t in rows if i == ip}):
            if last is None or t - last > span:
                out.append((ip, t))
                last = t
    return sorted(out)


@pytest.mark.parametrize("per_part,spread", [(10_000, 40), (60, 40), (60, 2_000), (25, 15), (40, 400)])
def test_block_timeline(spark, per_part, spread):
    rng = np.random.default_rng(per_part + spread)
    times = rng.integers(0, spread * 1_000_000, size=600)
    rows = [("hot" if i % 3 else f"ip{i % 11}", int(t)) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "src_ip string, ts_us bigint")
    got = blocks.block_timeline(df, duration=10, rows_per_part=per_part).select("ip", "ts_us")
    assert sorted(map(tuple, got.collect())) == brute_blocks(rows, 10_000_000)


@pytest.mark.parametrize("seed", [1, 2])
def test_block_timeline_with_a_fixed_beat(spark, seed):
    """Evenly spaced events: chains never meet, so each part has to wait for the one before."""
    rows = [("hot", i * 3_000_000 + seed) for i in range(300)] + [("cold", 5)]
    df = spark.createDataFrame(rows, "src_ip string, ts_us bigint")
    got = blocks.block_timeline(df, duration=10, rows_per_part=30).select("ip", "ts_us")
    assert sorted(map(tuple, got.collect())) == brute_blocks(rows, 10_000_000)


@pytest.mark.parametrize("gap,span", [(1, 10), (3, 10), (7, 2), (1, 5_000)])
def test_block_timeline_of_one_key(spark, gap, span):
    """All events have one key: parts shorter and longer than a block, and gaps."""
    rng = np.random.default_rng(gap + span)
    times = np.cumsum(rng.integers(1, 2 * gap * 1_000_000, size=2000)) + (np.arange(2000) > 1200) * 50_000_000
    rows = [("hot", int(t)) for t in times] + [("hot", int(times[7]))]
    df = spark.createDataFrame(rows, "src_ip string, ts_us bigint")
    got = blocks.block_timeline(df, duration=span, rows_per_part=100).select("ip", "ts_us")
    assert sorted(map(tuple, got.collect())) == brute_blocks(rows, span * 1_000_000)


def test_hot_join_keys(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(["a", "a", "b", "c", None])], "k string, l int")
    right = spark.createDataFrame([("a", i) for i in range(40)] + [("b", 1), (None, 2), ("z", 3)], "k string, r int")
    plain = logs.left_join_on_keys(left, right, ["k"], "_r").collect()
    split = logs.left_join_on_keys(left, right, ["k"], "_r", hot_rows=5).collect()
    assert sorted(plain, key=repr) == sorted(split, key=repr)
    assert len(plain) == 2 * 40 + 1 + 1 + 1


def test_codes_in_parts(spark):
    rows = [(f"v{i * 7919 % 500}", f"w{i % 30}") for i in range(900)]
    df = spark.createDataFrame(rows, "a string, b string")
    small = ft.fit_codes(df, ["a", "b"]).collect()
    parts = ft.fit_codes(df, ["a", "b"], rows_per_part=60).collect()
    key = lambda r: (r["column"], r["value"], r["code"])
    assert sorted(map(key, small)) == sorted(map(key, parts))
    assert [r["code"] for r in sorted(small, key=key) if r["column"] == "b"] == list(range(30))


def brute_neighbours(points, k):
    out = {}
    for label in {p[0] for p in points}:
        of = [p for p in points if p[0] == label]
        for _, v, _ in of:
            far = sorted((sum((a - b) ** 2 for a, b in zip(v, u)), tuple(u)) for _, u, _ in of if tuple(u) != tuple(v))
            out[(label, tuple(v))] = [d for d, _ in far[:k]]
    return out


@pytest.mark.parametrize("cell_rows", [10_000, 25])
def test_neighbours_are_exact(spark, cell_rows):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(150, 3)), rng.normal(5, 0.1, size=(150, 3))])
    points = [("m" if i % 4 else "n", [float(c) for c in v], 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(points, "label string, vec array<double>, w bigint")
    got = {(r["label"], tuple(r["vec"])): [n["dist2"] for n in r["near"]]
           for r in smote.neighbours(df, 5, cell_rows).collect()}
    want = brute_neighbours(points, 5)
    assert got.keys() == want.keys()
    assert all(np.allclose(got[key], want[key]) for key in want)


def test_oversampling(spark):
    rng = np.random.default_rng(11)
    rows = [("big", float(a), float(b)) for a, b in rng.normal(size=(200, 2))]
    small = [("small", float(a), float(b)) for a, b in rng.normal(9, 1, size=(30, 2))]
    copies = [("copies", 1.0, 2.0)] * 50 + [("copies", 3.0, 4.0)]
    df = spark.createDataFrame(rows + small + copies, "label string, a double, b double")
    out = smote.oversample(df, "label", ["a", "b"], cell_rows=12).collect()
    counts = {}
    for r in out:
        counts[r["label"]] = counts.get(r["label"], 0) + 1
    assert counts == {"big": 200, "small": 200, "copies": 200}
    made = [(r["a"], r["b"]) for r in out if r["label"] == "small"]
    base = [(a, b) for _, a, b in small]
    assert set(base) <= set(made)
    for a, b in set(made) - set(base):
        assert any(abs((a - p[0]) * (q[1] - p[1]) - (b - p[1]) * (q[0] - p[0])) < 1e-9
                   and min(p[0], q[0]) - 1e-9 <= a <= max(p[0], q[0]) + 1e-9
                   for p in base for q in base if p != q)
    again = smote.oversample(df.repartition(5), "label", ["a", "b"], cell_rows=12)
    assert sorted(map(tuple, out)) == sorted(map(tuple, again.collect()))
    with pytest.raises(ValueError, match="tiny"):
        smote.oversample(df.unionByName(df.limit(3).withColumn("label", F.lit("tiny"))), "label", ["a", "b"])


def test_split_and_folds_in_buckets(spark, numbers):
    df = spark.createDataFrame(numbers)
    marked = ft.mark_test_rows(df, "g", order="id", rows_per_bucket=300).toPandas()
    for g, part in marked.groupby("g"):
        wanted = int(len(part) * 0.2 + 0.5)
        assert set(part[part["is_test"]]["id"]) == set(sorted(part["id"])[:wanted])
    by_hash = ft.mark_test_rows(df, "g", rows_per_bucket=300).toPandas()
    same = ft.mark_test_rows(df.repartition(7), "g").toPandas()
    assert set(by_hash[by_hash["is_test"]]["id"]) == set(same[same["is_test"]]["id"])
    folds = ft.mark_folds(df, "g", 5, order="id", rows_per_bucket=300).toPandas()
    for g, part in folds.groupby("g"):
        sizes = part.groupby("fold").size()
        assert len(sizes) == 5 and sizes.max() - sizes.min() <= 1 and sizes.is_monotonic_decreasing
