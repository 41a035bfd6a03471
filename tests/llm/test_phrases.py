"""Passages that recur in other documents, next to brute force over all windows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from flowlens.llm import beside, phrases, queries
from tests.llm.conftest import ROWS, find

W = phrases.WINDOW


def brute(rows):
    """(id, words, removed, kept text) of each row, by all windows."""
    smallest: dict[tuple, float] = {}
    inf = float("inf")
    split = [(inf if i is None else i, find(t or "")) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - W + 1):
            window = tuple(words[k:k + W])
            smallest[window] = min(smallest.get(window, inf), i)
    out = []
    for (i, words), (doc_id, _) in zip(split, rows):
        gone = np.zeros(len(words), bool)
        for k in range(len(words) - W + 1):
            if smallest[tuple(words[k:k + W])] < i:
                gone[k:k + W] = True
        out.append((doc_id, len(words), int(gone.sum()), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def shown(found):
    return sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept_text) for r in found.collect()), key=repr)


def made(n, seed):
    """Documents of few words with passages of all lengths around a window, copies, edits, null and repeated ids."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    pool = [[word() for _ in range(rng.choice([16, 49, 50, 51, 60, 66, 100, 300]))] for _ in range(30)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 6)):
            words += rng.choice(pool) if rng.random() < 0.6 else [word() for _ in range(rng.randint(0, 80))]
            if rng.random() < 0.2 and words:
                words[rng.randrange(len(words))] = word()
        if rng.random() < 0.1:
            words += ["same"] * rng.randint(40, 130)
        if rng.random() < 0.1:
            words += ["a", "b", "c"] * rng.randint(10, 60)
        rows.append((rng.choice([None, i, i, i, i - 1]), " ".join(words)))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = made(150, seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    # Small shards and automata, so there are many.
    assert shown(phrases.drop_repeats(docs, shard_rows=7, most_words=500)) == sorted(brute(rows), key=repr)


def test_query_equals_brute_force(spark, sf, texts):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op12_phrase_automata(spark, sf).collect()}
    assert got == {i: (n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in brute(sorted(texts.items()))}
    assert any(gone for _, gone, _ in got.values())


def test_odd_rows(odd, none):
    assert shown(phrases.drop_repeats(odd)) == sorted(brute([r[:2] for r in ROWS]), key=repr)
    assert phrases.drop_repeats(none).count() == 0


def test_clashing_names(spark):
    rows = [(i, " ".join(f"k{j}" for j in range(60)), "x", 1, "y") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, file string, at int, _metadata string")
    assert shown(phrases.drop_repeats(docs)) == brute([r[:2] for r in rows])


def test_stretches_depend_on_content_only():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for size in (1, 2, 16, 49, 50):
        found = phrases.stretch_hashes(codes, size)
        assert len(found) == 401 - size and (phrases.stretch_hashes(codes[37:], size) == found[37:]).all()
    anchor, key, first, many = phrases.stretches(codes)
    assert many.sum() == 351 and (first == np.cumsum(many) - many).all()
    moved = phrases.stretches(codes[20:])
    assert set(key[first >= first[first > 20].min()][1:]) <= set(moved[1])
    parts = [codes[:120], codes[:30], codes[:0], codes[200:]]
    alone = [phrases.stretches(p) for p in parts]
    whole = phrases.stretches(np.concatenate(parts), [len(p) for p in parts])
    assert (whole[1] == np.concatenate([x[1] for x in alone])).all() and (whole[3] == np.concatenate([x[3] for x in alone])).all()


def test_automata_find_overlaps():
    passages = [(phrases.word_codes(t), n) for t, n in ((b"a b c", 1), (b"b c d", 2), (b"c", 3))]
    for most in (1, 4, 100):
        found = phrases.PhraseAutomata(passages, most).occurrences(phrases.word_codes(b"x a b c d c"))
        assert sorted(found) == [(1, 4, 1), (2, 5, 2), (3, 4, 3), (5, 6, 3)]


def test_word_codes():
    rng = random.Random(4)
    words = ["".join(rng.choices("abé\x1c ß0", k=rng.randint(1, 9))).encode() for _ in range(3000)]
    words += [b"x" * (phrases.BLOCK - 1), b"x" * phrases.BLOCK, b"x" * (phrases.BLOCK + 1), b"y" * (3 * phrases.BLOCK)] + words[:100]
    words = [w for x in words for w in x.split()]
    codes = phrases.word_codes(b" ".join(words)).tolist()
    assert len(codes) == len(words) and len(set(zip(words, codes))) == len(set(words)) == len(set(codes))
    assert phrases.word_codes(words[7]).tolist() == [codes[7]]


def test_leftmost_least():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 6, 500)
    for size in (1, 2, 7, 16, 35, 500):
        assert (phrases.leftmost_least(values, size) == [k + values[k:k + size].argmin() for k in range(501 - size)]).all()


def test_pieces_beside_a_table(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    place = beside.Located(spark.read.parquet(str(tmp_path / "t")))
    rows = place.rows("id")
    folder = beside.put(rows.where("id % 3 = 0"), "test", 100)
    file = rows.first().file
    got = [i for t in beside.read(folder, file, 150, 420, 100) for i in t["id"].to_pylist()]
    assert got == [i for i in range(150, 421) if i % 3 == 0]
    assert beside.read(folder, file, 5000, 5001, 100) == []
