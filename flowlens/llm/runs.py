"""Periodic runs of words by enumeration of maximal pairs.

A maximal pair is two places of a text with the same words from there on, for ``L`` words, with another word (or an end of
the text) before and behind. If their distance ``q`` is at most ``L / 3``, the words from the first place on repeat with period
``q`` for ``L + q >= 4 q`` words, and nobody can extend that: the pair is the run, it needs no extension.

Pairs come from the tree of LCP intervals of a suffix array, bottom up. Each interval has its places in order, each of
them in the class of the word left of it; where two intervals meet, places of different classes at a bounded distance
are maximal pairs. Places so near each other form an arithmetic progression (its step is the period of their common words),
in which all but the first have the same left word. So at most the first place of a neighbourhood is in another class, and
it is found by bisection; no list of same-class places is walked.

Suffix and LCP arrays are made by doubling in numpy, for many texts at a time. Rows stay where they are, nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowlens.llm.common import find_words, text_of

LEAST_WORDS, LEAST_EXPONENT = 6, 4  # a run has max(LEAST_WORDS, LEAST_EXPONENT * period) words at least
LEAST_COMMON = LEAST_WORDS - 1  # words a maximal pair of a run shares at least (period 1)
WORDS_AT_ONCE = 250_000  # words of the texts whose suffixes are sorted together; a longer text goes alone

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffixes(codes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of ``codes`` and their ranks by their first 1, 2, 4, ... codes; the last code must be unique.

    A rank is the number of suffixes that are smaller by that many codes, so equal ranks mean equal codes. Only suffixes
    that still share a rank are sorted on.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    first = np.r_[True, codes[order][1:] != codes[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    ranks, width = [rank], 1
    while True:
        at = np.flatnonzero(~(first & np.r_[first[1:], True]))  # places in the order that share their rank
        if not len(at):
            return order, ranks
        held = order[at]
        # A shared rank never reaches beyond the last code, which is unique.
        key = rank[held] * n + rank[held + width]
        by = np.argsort(key, kind="stable")
        held, key = held[by], key[by]
        order[at] = held
        new = np.r_[True, key[1:] != key[:-1]]
        rank = rank.copy()
        rank[held] = np.maximum.accumulate(np.where(new, at, 0))
        first[at] = new
        ranks.append(rank)
        width *= 2


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """At each place of the suffix array the codes shared with the suffix before it (0 at the first)."""
    shared = np.zeros(len(order), np.int64)
    at = np.flatnonzero(ranks[0][order[1:]] == ranks[0][order[:-1]]) + 1
    a, b, found = order[at - 1].copy(), order[at].copy(), np.zeros(len(at), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        same = ranks[level][a] == ranks[level][b]
        step = np.where(same, 1 << level, 0)
        found += step
        a += step
        b += step
    shared[at] = found
    return shared


def maximal_pairs(order: list[int], shared: list[int], left: list[int]) -> Iterator[tuple[int, int, int]]:
    """``first``, ``second``, ``L`` of the maximal pairs with ``second - first <= L // 3`` below one interval.

    ``order`` are the places in the order of their suffixes, ``shared`` their common prefixes with the one before (the first is
    not looked at) and ``left`` the classes of the words before them, by place.
    """
    # Open intervals: least common prefix and places in ascending order. Each place is a leaf first.
    stack: list[tuple[int, list[int]]] = []

    def meet(one: list[int], other: list[int], length: int) -> list[int]:
        """Pairs between two intervals that share ``length`` words and no more; the places of both."""
        few, many = (one, other) if len(one) < len(other) else (other, one)
        reach = length // 3
        for x in few:
            k = bisect_left(many, x)
            mine = left[x]
            if k < len(many) and many[k] - x <= reach and left[many[k]] != mine:
                for y in many[k:bisect_right(many, x + reach, k)]:
                    found.append((x, y, length))
            if k and x - many[k - 1] <= reach:
                y = many[bisect_left(many, x - reach, 0, k)]
                if left[y] != mine:
                    found.append((y, x, length))
        for x in few:
            insort(many, x)
        return many

    found: list[tuple[int, int, int]] = []
    places = [order[0]]
    for k in range(1, len(order) + 1):
        now = shared[k] if k < len(order) else 0
        # Intervals deeper than what the next suffix shares are whole: they go up into their parents.
        while stack and stack[-1][0] >= now:
            length, before = stack.pop()
            places = meet(before, places, length)
        if k < len(order):
            stack.append((now, places))
            places = [order[k]]
    return iter(found)


def find_runs(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs (``start``, ``length``, ``period``) of each text of word codes, by start, then period.

    A run is a longest stretch with its smallest period, with max(6, 4 * period) words at least. Codes are compared by equality only.
    """
    sizes = [len(t) for t in texts]
    starts = np.cumsum([0] + [n + 1 for n in sizes])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not sum(sizes):
        return out
    # A text's words are its own, and what ends it is there once: suffixes of two texts share nothing.
    owner = np.repeat(np.arange(len(texts)), np.array(sizes) + 1)
    whole = np.zeros(starts[-1], np.uint64)
    ends = starts[1:] - 1
    inner = np.ones(len(whole), bool)
    inner[ends] = False
    whole[inner] = np.concatenate(texts)
    words = np.unique(whole[inner], return_inverse=True)[1] + 1
    codes = owner * np.int64(len(words) + 2)
    codes[inner] += words
    order, ranks = suffixes(codes)
    shared = common_prefixes(order, ranks)
    left = np.full(len(whole), -1, np.int64)
    left[1:] = codes[:-1]
    left[starts[:-1]] = -1
    # Intervals with enough in common; a run of k places between smaller values is one tree.
    enough = shared >= LEAST_COMMON
    edges = np.flatnonzero(np.diff(np.r_[False, enough, False].astype(np.int8)))
    best: dict[tuple[int, int], int] = {}
    lefts = left.tolist()
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        places = order[begin - 1:end]
        # Without two places near each other there is no run.
        reach = int(shared[begin:end].max()) // 3
        if int(np.diff(np.sort(places)).min()) > reach:
            continue
        for first, second, length in maximal_pairs(places.tolist(), shared[begin - 1:end].tolist(), lefts):
            stretch, period = (first, second + length), second - first
            # Multiples of the smallest period give the same stretch.
            if best.get(stretch, period) >= period:
                best[stretch] = period
    for (first, end), period in best.items():
        k = int(owner[first])
        out[k].append((first - int(starts[k]), end - first, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[str], found: Iterable[tuple[int, int, int]]) -> str:
    """The words, joined by one space, without those that a run has after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in found:
        keep[start + period:start + length] = False
    return " ".join(words if keep.all() else [words[i] for i in np.flatnonzero(keep).tolist()])


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        start = 0
        while start < len(texts):
            held, size, end = [], 0, start
            while end < len(texts) and (not held or size < WORDS_AT_ONCE):
                held.append(find_words(texts[end].as_py()))
                size += len(held[-1])
                end += 1
            codes: dict[str, int] = {}
            found = find_runs([np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.uint64, len(words)) for words in held])
            yield pa.RecordBatch.from_arrays(
                [ids.slice(start, end - start), pa.array([len(words) for words in held], pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found], pa.list_(RUN)),
                 pa.array([collapse(words, runs) for words, runs in zip(held, found)], pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])
            start = end


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` (``start``, ``length``, ``period``, by start, then period) and
    ``collapsed`` (the text without what its runs repeat, words joined by one space).

    Null and empty texts, and texts of white space, have no words, no runs and an empty ``collapsed``. Each row stands for itself,
    whatever its id: null and repeated ids and repeated rows are rows like others. Other columns of ``docs`` are not looked at.
    A long text is one unit of work in memory of about 100 bytes a word. An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    return plain.mapInArrow(
        _detect, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
