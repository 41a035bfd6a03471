"""Exact and near copies next to brute force."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowlens.llm import chunks, components, setsketch
from tests.llm.conftest import ROWS, find, lower


def expected_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower(text or "")].append(doc_id)
    return groups


@pytest.mark.parametrize("id_bits", [64, 3])  # with 3 bits most identifiers name several contents
def test_dedup_is_equality_of_texts(documents, texts, id_bits):
    groups = expected_groups(texts.items())
    got = {r.doc_id: r for r in chunks.dedup(documents, id_bits=id_bits).collect()}
    assert len(got) == len(texts)
    for text, ids in groups.items():
        for i in ids:
            r = got[i]
            assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), i == max(ids))
            assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_dedup_odd_rows(odd, none):
    rows = chunks.dedup(odd).collect()
    groups = expected_groups((r[0], r[1]) for r in ROWS)
    assert len(rows) == len(ROWS)
    assert sum(r.kept for r in rows) == len(groups)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in rows:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    assert chunks.dedup(none).count() == 0
    kept = chunks.drop_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    assert chunks.drop_copies(none).count() == 0


def test_cuts_follow_content():
    data = np.random.default_rng(1).integers(97, 123, 3_000_000, dtype=np.uint8).tobytes()
    ends = chunks.cuts(memoryview(data))
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= chunks.LARGEST and (sizes[:-1] >= chunks.SMALLEST).all()
    pieces = [data[a:b] for a, b in zip([0, *ends], ends)]
    moved = b"inserted" + data
    moved_ends = chunks.cuts(memoryview(moved))
    shared = set(pieces) & {moved[a:b] for a, b in zip([0, *moved_ends], moved_ends)}
    assert len(shared) > 0.95 * len(pieces)


def brute_components(texts, width, percent):
    sets = {}
    for i, text in texts.items():
        w = find(lower(text))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    holders, parent = defaultdict(list), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in holders[x]).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for x in s:
            holders[x].append(i)
    return sets, {i: root(i) for i in sets}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(documents, texts, width, percent):
    sets, roots = brute_components(texts, width, percent)
    got = setsketch.near_duplicates(documents, width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (len(sets[i]), roots[i], roots[i] == i) for i in sets}


def test_chains_and_large_groups(spark, monkeypatch):
    """Neighbours in a chain are linked, its ends are not; blocks are so small that a bucket has many."""
    monkeypatch.setattr(setsketch, "BASE_BLOCK", 8)
    monkeypatch.setattr(setsketch, "QUERY_BLOCK", 4)
    words = [f"k{i}" for i in range(400)]
    rows = [(i, " ".join(words[2 * i:2 * i + 120])) for i in range(60)]
    rows += [(1000 + i, " ".join(f"z{j}" for j in range(150)) + f" end{i}") for i in range(120)]
    texts = dict(rows)
    _, roots = brute_components(texts, 3, 85)
    got = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == roots


def test_near_duplicates_odd_rows(odd, none):
    rows = setsketch.near_duplicates(odd, 3, 85).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[6].component_id == by_id[7].component_id == 5 and by_id[11].component_id == 10
    assert by_id[3].kept and by_id[4].kept and by_id[12].n_shingles == 0 and by_id[2].component_id == 1
    assert sorted(r.component_id or 0 for r in rows if r.doc_id is None) == [0, 1]
    assert setsketch.near_duplicates(none).count() == 0
    kept = setsketch.drop_near_copies(odd)
    assert kept.columns == odd.columns and {5} == {r.doc_id for r in kept.collect()} & {5, 6, 7}
    assert setsketch.drop_near_copies(none).count() == 0


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    a, b = x[:3000], x[600:]  # similarity 0.6
    ra, rb = setsketch.registers(a), setsketch.registers(b)
    assert (setsketch.merge(ra, rb) == setsketch.registers(x)).all()
    found = setsketch.estimate(ra[None], rb[None], np.array([3000]), np.array([3400]))[0]
    assert abs(found - 0.6) < 0.2


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 40) if i != 20] + [(50, 50)], "a long, b long")
    got = {r.node: r.label for r in components.components(edges).collect()}
    assert got == {i: 0 if i <= 20 else 21 for i in range(41)}


def test_drop_near_copies_decides_per_row(spark):
    """Null and repeated ids with different texts: of each group of near copies one row stays, whatever the ids."""
    def text(k, tail=""):
        return " ".join(f"g{k}w{i}" for i in range(200)) + tail

    rows = [(1, text(0)), (None, text(0, " x")), (None, text(1)), (None, text(1, " y")), (None, text(2)),  # no id
            (2, text(3)), (2, text(4)), (3, text(4, " z")), (0, text(3, " z")),  # one id, two texts
            (4, text(5)), (4, text(5)), (4, text(5).upper()), (5, text(6)), (5, text(6, " x")),  # repeated rows
            (6, None), (6, ""), (None, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = setsketch.drop_near_copies(docs).collect()
    stay = defaultdict(list)
    for r in kept:
        stay[r.text.split("w")[0].lower() if r.text else ""].append(r.doc_id)
    assert {k: v for k, v in stay.items() if k} == {"g0": [1], "g1": [None], "g2": [None], "g3": [0], "g4": [2], "g5": [4], "g6": [5]}
    assert sorted(stay[""], key=str) == [6, 6, None, None]
