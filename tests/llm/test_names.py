"""Columns of a caller whose names operators use themselves are kept as they are."""

from __future__ import annotations

from collections import Counter

from flowlens.llm import chunks, mixing, setsketch

NAMES = ("file", "at", "source_size", "rate", "row", "copy", "_mix_rate", "_text_sha", "doc", "size", "target", "id", "key", "cls", "chunk")


def named(spark, rows):
    schema = "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in NAMES)
    full = [(*r, *[f"{n}{i}" for n in NAMES]) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, schema).repartition(3), {tuple(r) for r in full}


def test_rows_keep_their_columns(spark):
    text = " ".join(f"w{i}" for i in range(100))
    docs, full = named(spark, [(1, text, "a"), (2, text, "a"), (3, text + " more", None), (4, None, "b"), (None, "x y", "b")])
    for step, ids in ((chunks.drop_copies, {2, 3, 4, None}), (setsketch.drop_near_copies, {1, 4, None})):
        kept = step(docs)
        assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
        got = kept.collect()
        assert {r.doc_id for r in got} == ids and {tuple(r) for r in got} <= full and len(got) == len(ids)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = {r.doc_id: r.n_copies for r in mixing.plan(docs).collect() if r.n_copies}
    assert Counter(r.doc_id for r in mixed.collect()) == want and {tuple(r) for r in mixed.collect()} <= full
