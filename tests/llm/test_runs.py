"""Periodic runs next to brute force over all periods."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from flowlens.llm import queries, runs
from tests.llm.conftest import ROWS, find


def brute(words):
    """(start, length, period) of the runs, by start, then period."""
    found = {}
    for q in range(1, len(words) // 4 + 1 if len(words) > 3 else 0):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)  # smaller periods come first
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


blocks = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 9))
periodic = st.lists(blocks, max_size=6).map(lambda bs: [x for b, k in bs for x in b * k])


@settings(max_examples=400, deadline=None)
@given(st.lists(periodic, min_size=1, max_size=4))
def test_runs_equal_brute_force(texts):
    assert runs.find_runs([np.array(t, np.uint64) for t in texts]) == [brute(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=200))
def test_suffix_and_lcp_arrays(words):
    codes = np.array([w + 1 for w in words] + [0])
    order, ranks = runs.suffixes(codes)
    tail = [tuple(codes[i:]) for i in order]
    assert tail == sorted(tail)
    shared = runs.common_prefixes(order, ranks)
    for k in range(1, len(tail)):
        n = next(i for i, (a, b) in enumerate(zip(tail[k - 1], tail[k])) if a != b)
        assert shared[k] == n


def test_long_texts():
    for period in (1, 2, 1000):
        text = np.tile(np.arange(period, dtype=np.uint64), 100_000 // period)
        assert runs.find_runs([text]) == [[(0, 100_000, period)]]
    # A phrase that is there often, never in a row.
    text = [w for i in range(20_000) for w in (1, 2, 3, 4, 5, 6, 100 + i)]
    assert runs.find_runs([np.array(text, np.uint64)]) == [[]]


def planted(doc_id, text):
    words = find(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_equals_brute_force(spark, sf, texts):
    got = queries.op13_maximal_pair_runs(spark, sf).collect()
    assert len(got) == len(texts)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in got:
        words = planted(r.doc_id, texts[r.doc_id])
        found = brute(words)
        best = min(found, key=lambda f: (-f[1], f[0], f[2]), default=(None, None, None))
        assert r.n_runs == len(found) and (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r.collapsed_sha256 == sha(collapsed(words, found))
    assert sum(r.n_runs > 0 for r in got) > 0.05 * len(got)


def test_odd_rows(odd, none, spark):
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(odd).collect()), key=repr)
    want = []
    for doc_id, text, *_ in ROWS:
        words = find(text or "")
        want.append((doc_id, len(words), brute(words), collapsed(words, brute(words))))
    assert got == sorted(want, key=repr)
    assert runs.periodic_runs(none).count() == 0
    clash = spark.createDataFrame([(1, "a a a a a a a", "x", 3)], "doc_id long, text string, runs string, n_words int")
    row = runs.periodic_runs(clash).first()
    assert [tuple(x) for x in row.runs] == [(0, 7, 1)] and row.collapsed == "a"
