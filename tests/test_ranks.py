"""Shared selection of ranks and port bitmaps next to brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlens.operators import detect, ports, ranks, scale


def groups():
    rng = np.random.default_rng(9)
    rows = [("ties", float(v)) for v in rng.integers(0, 3, 400)]
    rows += [("wide", float(v)) for v in np.exp(rng.normal(0, 20, 300)) * rng.choice([-1, 1], 300)]
    rows += [("near", 1.0 + float(v) * 1e-12) for v in rng.integers(0, 10_000, 500)]
    rows += [("odd", v) for v in (0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf"), float("-inf"))]
    return rows + [("one", 4.5), ("same", 2.0), ("same", 2.0)]


@pytest.mark.parametrize("direct_rows,parts", [(1, 2), (10, 4), (100_000, 4096)])
def test_every_rank(spark, direct_rows, parts):
    rows = groups()
    by = {}
    for k, v in rows:
        by.setdefault(k, []).append(v)
    wanted = [(k, r) for k, vs in by.items() for r in {0, len(vs) // 3, len(vs) // 2, len(vs) - 1, len(vs)}]
    table = spark.createDataFrame(rows, "k string, v double")
    got = ranks.select_ranks(table, ["k"], "v", spark.createDataFrame(wanted, "k string, rank bigint"), direct_rows, parts).collect()
    assert {(r.k, r["rank"]): r.value for r in got} == {(k, r): sorted(by[k])[r] for k, r in wanted if r < len(by[k])}
    assert len(got) == len({(r.k, r["rank"]) for r in got})


def test_quantiles_of_groups(spark):
    rng = np.random.default_rng(1)
    rows = [("a" if i % 3 else "b", float(v)) for i, v in enumerate(rng.normal(size=900).round(2))]
    table = spark.createDataFrame(rows + [("a", None), ("b", float("nan")), ("c", None)], "k string, v double")
    share = F.when(F.col("k") == "a", 0.95).otherwise(0.5)
    got = {r.k: r.value for r in ranks.quantiles(table, ["k"], "v", share, direct_rows=20, parts=3).collect()}
    of = {k: [v for n, v in rows if n == k] for k in "ab"}
    assert got == {"a": pytest.approx(np.quantile(of["a"], 0.95)), "b": pytest.approx(np.quantile(of["b"], 0.5))}


def test_sketches_merge(spark):
    table = spark.createDataFrame(groups(), "k string, v double")
    whole = ranks.rank_sketch(table, ["k"], "v")
    halves = [ranks.rank_sketch(table.where(F.xxhash64("k", "v") % 2 == i), ["k"], "v") for i in (0, 1)]
    halves += [ranks.rank_sketch(table.where(F.xxhash64("k", "v") % 2 == -1), ["k"], "v")]
    merged = ranks.merge_sketches(halves[0].unionAll(halves[1]).unionAll(halves[2]), ["k"])
    columns = ["k", "bucket", "n", "lo", "hi"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, merged.select(columns).collect()))


def test_scans_do_not_grow_with_columns(spark, tmp_path):
    """Selecting the medians of six columns takes as many jobs as that of one."""
    table = spark.range(3000).select(*[((F.col("id") * (7 + i)) % 1009).cast("double").alias(f"c{i}") for i in range(6)])
    table.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for n in (1, 6):
        spark.sparkContext.setJobGroup(f"columns-{n}", "")
        found = scale.exact_quantiles(table, {f"c{i}": 0.5 for i in range(n)}, direct_rows=300, accuracy=8)
        jobs.append(len(tracker.getJobIdsForGroup(f"columns-{n}")))
        frame = table.toPandas()
        assert found == {f"c{i}": frame[f"c{i}"].median() for i in range(n)}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 4


def test_port_bitmaps(spark):
    rng = np.random.default_rng(2)
    rows = [("all", p) for p in range(65_536)] + [("few", int(p)) for p in rng.integers(0, 65_536, 40)] * 3
    rows += [("ends", p) for p in (0, 63, 64, 32_767, 32_768, 65_535)] + [("none", None)]
    table = spark.createDataFrame(rows, "src_ip string, dst_port int").repartition(5)
    want = {k: len({p for n, p in rows if n == k and p is not None}) for k in ("all", "few", "ends")}
    assert {r.src_ip: r.ports for r in ports.distinct_ports(table, ["src_ip"]).collect()} == want
    words = ports.port_words(table, ["src_ip"])
    assert words.groupBy("src_ip").count().where("src_ip = 'all'").first()[1] == 1024
    twice = ports.merge_words(words.unionAll(words), ["src_ip"])
    assert {r.src_ip: r.ports for r in ports.count_ports(twice, ["src_ip"]).collect()} == want
    assert [r.src_ip for r in detect.port_scans(table).collect()] == ["all"]
