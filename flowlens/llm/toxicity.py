"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts and unlabelled texts train a linear classifier. The risk of the unlabelled texts counted as
clean contains that of the toxic ones among them, so the class prior times the latter is taken away, and where the
difference falls below zero the step goes the other way (the non-negative estimator). Scores are probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from flowlens.llm.common import lean, text_of

DIM_BITS = 20  # hashed features
STEMS = (4, 5)  # besides whole words, their first letters
MOST_POSITIVE, MOST_UNLABELLED = 6_000, 18_000  # texts to fit on, by the hash of their id
LEAST_TEXTS = 3  # toxic texts a feature must be in
LEAST_PART = 0.3  # part of the texts with a feature that must be toxic, by the class prior
STEPS, RATE, DECAY = 1500, 0.1, 1e-6
SEED = 11
MOST_KEPT = 100_000  # words a task remembers

_words = re.compile(r"[^\W\d_]+").findall


def _features(word: str) -> list[int]:
    mask = (1 << DIM_BITS) - 1
    found = [xxhash.xxh3_64_intdigest(f"w {word}") & mask]
    return found + [xxhash.xxh3_64_intdigest(f"s {word[:n]}") & mask for n in STEMS if len(word) > n]


def text_features(text: str) -> np.ndarray:
    """Hashed features of a text, each once, ascending."""
    found: set[int] = set()
    for word in set(_words(text.lower())):
        found.update(_features(word))
    return np.array(sorted(found), np.int32)


@lean
def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_features(t.as_py()).tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["positive", "features"])


class Model:
    """Weights of the hashed features and a bias."""

    def __init__(self, weights: np.ndarray, bias: float, prior: float):
        self.weights, self.bias, self.prior = weights, bias, prior


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = STEPS) -> Model:
    """Minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the logistic loss, by Adam.

    Only features get a weight that are clearly more frequent in toxic than in unlabelled texts and that, by the class
    prior, are in toxic texts mostly: others would add up in long texts. Without toxic texts the score is the prior.
    """
    weights = np.zeros(1 << DIM_BITS, np.float32)
    odds = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(weights, odds, prior)
    n_p, n_u = len(positive), len(unlabelled)
    in_p = np.bincount(np.concatenate(positive), minlength=len(weights))
    in_u = np.bincount(np.concatenate(unlabelled), minlength=len(weights))
    usual = n_p * (in_u + 1) / n_u  # toxic texts that would hold a feature if it said nothing
    toxic_part = prior * (in_p / n_p) / ((in_u + 1) / n_u)  # of the texts with a feature, by the class prior
    used = np.flatnonzero((in_p >= LEAST_TEXTS) & (in_p > usual + 4 * np.sqrt(usual) + 2) & (toxic_part >= LEAST_PART))
    if not len(used):
        return Model(weights, odds, prior)
    place = np.full(len(weights), -1, np.int64)
    place[used] = np.arange(len(used))

    def rows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        picked = [p[p >= 0] for p in (place[t] for t in texts)]
        return np.concatenate(picked), np.concatenate([[0], np.cumsum([len(p) for p in picked])])

    feats_p, at_p = rows(positive)
    feats_u, at_u = rows(unlabelled)
    theta = np.zeros(len(used) + 1)
    theta[-1] = odds
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    row_p, row_u = np.repeat(np.arange(n_p), np.diff(at_p)), np.repeat(np.arange(n_u), np.diff(at_u))

    def gradient(cols: np.ndarray, row: np.ndarray, pull: np.ndarray) -> np.ndarray:
        out = np.zeros_like(theta)
        out[:-1] = np.bincount(cols, pull[row], len(used))
        out[-1] = pull.sum()
        return out

    def scores(cols: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(row, theta[cols], n) + theta[-1]

    for step in range(1, steps + 1):
        zp, zu = scores(feats_p, row_p, n_p), scores(feats_u, row_u, n_u)
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        clean_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        clean_grad = gradient(feats_u, row_u, su / n_u) - prior * gradient(feats_p, row_p, sp / n_p)
        if clean_risk >= 0:
            grad = prior * gradient(feats_p, row_p, (sp - 1) / n_p) + clean_grad
        else:  # over-fitted: only undo that
            grad = -clean_grad
        grad[:-1] += DECAY * theta[:-1]
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        theta -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
        np.maximum(theta[:-1], 0, out=theta[:-1])  # no feature speaks for a clean text
    weights[used] = theta[:-1]
    return Model(weights, float(theta[-1]), prior)


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> Model:
    """Fit on toxic texts by the labels and on texts of any label, none of them held out.

    At most ``most_positive`` and ``most_unlabelled`` texts are used, those with the smallest hash of their id; only their
    features come to the driver. The class prior is the share of toxic labels that are not held out.
    Null ids join nothing, null labels are no labels, an id with several labels is toxic if one says so.
    """
    known = labels.select(labels[id_col].alias("id"), labels[label_col].alias("toxic")).where("toxic is not null") \
        .where(~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count("*"), F.sum(F.col("toxic").cast("int"))).first()
    prior = min(max((toxic or 0) / n, 0.001), 0.5) if n else 0.01
    plain = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text")).where(~held_out(F.col("id")))
    order = F.xxhash64(F.lit(SEED), "id")
    # The ids are picked first, from two narrow columns; then only their texts are read and moved.
    ids = plain.select("id", order.alias("_o"))
    toxic_ids = known.where("toxic = 1").select("id", order.alias("_o")).orderBy("_o", "id").limit(most_positive)
    any_ids = ids.orderBy("_o", "id").limit(most_unlabelled)
    picked = toxic_ids.select("id", F.lit(True).alias("positive")).unionAll(any_ids.select("id", F.lit(False)))
    # At most most_positive + most_unlabelled ids: small by these bounds.
    sample = plain.join(F.broadcast(picked), "id").select("positive", "text")
    found = sample.mapInArrow(_feature_batches, "positive boolean, features binary").toArrow()
    groups: dict[bool, list[bytes]] = {True: [], False: []}
    for positive, features in zip(found["positive"].to_pylist(), found["features"].to_pylist()):
        groups[positive].append(features)
    parsed = {k: [np.frombuffer(x, np.int32) for x in sorted(v)] for k, v in groups.items()}
    return train(parsed[True], parsed[False], prior)


@lean
def _score_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    weights, bias = shared.value
    # A feature counts once in a text, as in training. Words alone would count a stem as often as it has words.
    # The words end with the task: workers are used again by other steps, which need the memory.
    known: dict[str, tuple[tuple[int, float], ...]] = {}
    for batch in batches:
        out = np.empty(batch.num_rows)
        for i, text in enumerate(batch.column(1)):
            found: dict[int, float] = {}
            for word in set(_words(text.as_py().lower())):
                pairs = known.get(word)
                if pairs is None:
                    if len(known) >= MOST_KEPT:
                        known.clear()
                    pairs = tuple((f, float(weights[f])) for f in _features(word) if weights[f])
                    known[word] = pairs
                if pairs:
                    found.update(pairs)
            out[i] = bias + sum(found[f] for f in sorted(found))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(out, -700, 700))))], names=["doc_id", "score"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` of each row, 0 to 1. Null text is empty text, whose score is that of the bias."""
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    # 2 ** DIM_BITS weights of 4 bytes: 4 MB, whatever the input.
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    return plain.mapInArrow(lambda batches: _score_batches(batches, shared), f"doc_id {kind}, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.7, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that score at least ``threshold``."""
    place = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def texts(batches: Iterator[pa.RecordBatch], held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held.append(batch)
            text = pc.fill_null(batch.column(place).cast(pa.string()), "")
            yield pa.RecordBatch.from_arrays([text, text], names=["doc_id", "text"])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for scored in _score_batches(texts(batches, held), shared):
            yield held.pop().filter(pa.array(np.asarray(scored.column(1)) < threshold))

    return docs.mapInArrow(clean, docs.schema)
