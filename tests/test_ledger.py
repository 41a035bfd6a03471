"""The ledger of batches next to a dictionary."""

from __future__ import annotations

import os
import random

import pytest

from flowlens.functions.timing import from_micros
from flowlens.operators import blocks
from flowlens.plans.q_blocks import LEDGER_AS_OF, order_ledger
from flowlens.sources.ledger import LedgerTable
from pyspark.sql import functions as F


def rows(spark, items):
    return spark.createDataFrame([(ip, t, f"r{t}", 300) for ip, t in items], "ip string, t bigint, reason string, duration int").select(
        "ip", from_micros(F.col("t") * 1_000_000).alias("block_time"), "reason", "duration")


def shown(table):
    return {r.ip: int(r.reason[1:]) for r in table.read().collect()}


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_batches_equal_a_dictionary(spark, tmp_path):
    rng, want, path = random.Random(3), {}, str(tmp_path / "ledger")
    table = LedgerTable(spark, path, buckets=4)
    assert shown(table) == {} and table.compact() == []
    for number in range(0, 12, 2):
        blocked = [(f"ip{rng.randrange(30)}", number * 100 + k) for k in range(rng.randrange(1, 9))]
        removed = [f"ip{rng.randrange(40)}" for _ in range(rng.randrange(4))]
        assert table.commit(number, rows(spark, blocked), spark.createDataFrame([(i,) for i in removed], "ip string"))
        for ip, t in blocked:
            want[ip] = max(t, want.get(ip, 0))
        for ip in removed:
            want.pop(ip, None)
        before = files(path)
        assert not table.commit(number, rows(spark, [("other", 1)]))  # sent again
        assert shown(table) == want and files(path) == before
        if number == 6:
            table.compact()
            assert shown(table) == want
        if number == 8:
            held = table.read()
            table.compact()
            assert {r.ip for r in held.collect()} == set(want)  # what was read before still reads
            table.retire()
            assert shown(table) == want and not table.commit(2, rows(spark, [("other", 1)]))
    assert shown(LedgerTable(spark, path, buckets=9)) == want


def test_a_batch_writes_its_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "ledger")
    table = LedgerTable(spark, path)
    table.commit(1, rows(spark, [(f"ip{i}", i) for i in range(500)]))
    table.compact()
    before = files(path)
    table.commit(2, rows(spark, [("ip7", 9999)]))
    new = files(path) - before
    assert spark.read.parquet(*new).count() == 1
    touched = table.compact()
    assert len(touched) == 1 and shown(table)["ip7"] == 9999 and len(shown(table)) == 500
    # Only the bucket of that ip was rewritten.
    assert len({os.path.dirname(f) for f in files(f"{path}/base/2")}) == 1


def test_a_failed_writer_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "ledger")
    table = LedgerTable(spark, path)
    table.commit(0, rows(spark, [("a", 1)]))
    # Rows without a marker: the attempt ended before it was committed.
    rows(spark, [("a", 5), ("b", 5)]).withColumn("removed", F.lit(False)).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{path}/deltas/1")
    assert shown(table) == {"a": 1}
    table.commit(1, rows(spark, [("c", 6)]))
    assert shown(table) == {"a": 1, "c": 6}
    with pytest.raises(ValueError):
        table.commit(-1)


def test_cleaning_equals_the_plain_ledger(spark, sf, tmp_path):
    ledger = order_ledger(spark, sf)
    table = LedgerTable(spark, str(tmp_path / "ledger"))
    table.commit(0, ledger)
    table.clean(1, LEDGER_AS_OF)
    plain = blocks.cleanup(ledger, LEDGER_AS_OF)
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, plain.select(*blocks.LEDGER).collect()))
