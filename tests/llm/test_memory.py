"""What steps leave with workers that are used again."""

from __future__ import annotations

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowlens.session import BATCH_BYTES

# Peak and rest of a fresh process that signs 53 MB of texts, as a worker does.
SIGN = """
import re
import pyarrow as pa
from flowlens.llm import setsketch

def held():
    with open("/proc/self/smaps_rollup") as file:
        return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", file.read()))) / 1024

def batches():
    for k in range(2):
        words = [f"w{i}" for i in range(600)]
        texts = [" ".join(words[i % 300:] + [f"d{k}x{i}"] * 200) for i in range(7000)]
        yield pa.RecordBatch.from_arrays([pa.array(range(7000)), pa.array(texts)], names=["doc_id", "text"])

before = held()
for _ in setsketch._sign(batches(), 5):
    del _
print(held() - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_steps_leave_no_freed_memory():
    grown = float(subprocess.run([sys.executable, "-c", SIGN], capture_output=True, text=True, check=True).stdout)
    assert grown < 30


def test_stages_bound_the_batches_of_wide_rows(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a few words "), 40_000).alias("text")).coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        corpus_pipeline.drop_exact_copies(spark, docs, "")
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == BATCH_BYTES
        sizes = [r.n for r in docs.mapInArrow(_bytes, "n long").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)
    assert len(sizes) > 1 and max(sizes) < 8 << 20


def _bytes(batches):
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})
