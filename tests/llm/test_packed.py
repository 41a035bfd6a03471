"""Packed rows of the language model, and pairs of a text."""

from __future__ import annotations

import numpy as np

from flowlens.llm import bloom_lm


def test_packed_rows_come_back_and_hold_no_more_than_they_need():
    bucket = np.repeat([1, 2, 5], [3, 1, 700])
    rng = np.random.default_rng(5)
    odd = np.concatenate(([-1, -2 ** 63, 2 ** 63 - 1, 0], rng.integers(-9, 9, 700)))
    rows = np.concatenate(([2 ** 63 - 1, -2 ** 63, 3, 9], np.sort(rng.integers(0, 1 << 36, 700))))
    at, data = bloom_lm._packed(bucket, odd, rows)
    found, sizes = bloom_lm._entries(data.to_pylist(), 2)
    assert at.tolist() == [1, 2, 5, 5] and sizes.tolist() == [3, 1, 512, 188]
    assert all((a == b).all() for a, b in zip(found, (odd, rows)))
    assert all(x.flags.c_contiguous for x in found)
    # Large segments of long tables: few entries a row, with large row numbers.
    few = np.arange(200)
    _, data = bloom_lm._packed(few, few + 3, few + (5 << 33))
    assert max(map(len, data.to_pylist())) < 30
    assert not bloom_lm._entries([], 2)[0][0].size


def test_pairs_of_a_text_once():
    rng = np.random.default_rng(6)
    for buckets in (1, 300, 1 << 62 - bloom_lm.KEY_BITS):  # the last one is too wide for one number
        key, doc = rng.integers(0, 30, 500) << 30, np.sort(rng.integers(0, 9, 500))
        which, times = bloom_lm._once(key, doc, 9, buckets)
        seen: dict = {}
        for i, x in enumerate(zip(doc.tolist(), key.tolist())):
            seen.setdefault(x, []).append(i)
        assert which.tolist() == [seen[x][0] for x in sorted(seen)] and times.tolist() == [len(seen[x]) for x in sorted(seen)]
    assert [len(x) for x in bloom_lm._once(key[:0], doc[:0], 0, 3)] == [0, 0]
