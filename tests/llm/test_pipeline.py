"""The stages one after another, each next to brute force over its own input."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from flowlens.llm import mixing, toxicity
from flowlens.session import stage
from tests.llm.conftest import lower
from tests.llm.test_copies import brute_components


def test_stages(spark, sf, documents, texts):
    docs, kept = documents, {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, sf), "test")
        assert docs.columns == documents.columns
        kept[name] = Counter(r.doc_id for r in docs.select("doc_id").collect())
    model = toxicity.fit(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    clean = {r.doc_id for r in toxicity.score(documents, model).where("score < 0.7").collect()}
    assert set(kept["toxicity"]) == clean
    last = {lower(texts[i]): i for i in sorted(clean)}
    assert set(kept["exact_dedup"]) == set(last.values())
    _, roots = brute_components({i: texts[i] for i in last.values()}, 5, 80)
    assert set(kept["near_dedup"]) == {i for i, root in roots.items() if i == root}
    assert set(kept["mixing"]) <= set(kept["near_dedup"]) and max(kept["mixing"].values()) <= mixing.MOST_REPEATS
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    starts = packed.where("start = 0").groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert Counter({r.doc_id: r.n for r in starts}) == kept["mixing"]


def test_empty_documents(spark, sf, documents):
    docs = documents.where("false")
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, sf)
    assert docs.count() == 0
