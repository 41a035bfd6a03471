"""Hard negatives by inner product, with cover trees.

Vectors are whole numbers: each component is ``floor(256 x)``. For a search by inner product all candidates of a block get one more
component that makes their norms equal, so nearest means largest inner product. A cover tree over them has centres at
levels with radii that shrink by half: each centre covers what lies below it, centres of a level are apart by more than its radius,
and each node keeps how far its farthest descendant really is; vectors without structure would need a centre each, so a node has at
most twice as many as leaves fit into it. With that radius ``r``, centre ``c`` and question ``q``, the product of
``q`` with all below lies within ``q c - |q| r`` and ``q c + |q| r``. A search goes down best first, passes over nodes that lie wholly
outside of the asked window of scores, and multiplies the vectors of the leaves it reaches exactly, in whole numbers.

Candidates are dealt to blocks of bounded size by a hash, one tree each; equal vectors are one point of a tree. Each block answers all
questions with its first rows, of which the first over all blocks are taken. So no block is pruned by mistake, identical vectors do
not gather in one task, and what is shuffled is a few rows per question and block.
"""

from __future__ import annotations

import heapq
import math
import pickle
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlens.llm.common import parallel
from flowlens.session import new_path, stage
from flowlens.sources.files import locate, open_input, publish

SCALE = 256  # a component x becomes floor(SCALE * x)
BLOCK_ROWS = 32_768  # candidates of a tree on average, if they are many
LEAST_ROWS = 8_192  # fewer candidates are not worth a tree of their own
QUESTIONS = 128  # questions a task answers from one tree, on average
MOST_TASKS = 20_000  # more pairs of a tree and a group share a task
LEAF = 512  # points of a leaf; their products are one call
EXACT_FLOAT = 2 ** 53

POSITIVES, NEGATIVES = 5, 10


class CoverTree:
    """A cover tree over whole-number vectors.

    ``points`` are the distinct vectors, ``members`` the row numbers of each in the order given, ``labels`` by row number.
    """

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, leaf: int = LEAF):
        self.points, member_of = np.unique(vectors, axis=0, return_inverse=True)
        order = np.argsort(member_of.ravel(), kind="stable")
        self.members = np.split(order, np.cumsum(np.bincount(member_of.ravel()))[:-1]) if len(vectors) else []
        self.labels = labels
        # The label of a point whose rows all have the same; points of several labels are looked into.
        self.single = np.array([labels[m[0]] for m in self.members], np.int64)
        self.mixed = np.array([bool((labels[m] != labels[m[0]]).any()) for m in self.members], bool)
        self.largest = int(np.abs(self.points).max()) if self.points.size else 0
        plain = self.points.astype(np.float64)
        squares = (plain ** 2).sum(1)
        self.norm = math.sqrt(squares.max()) if len(squares) else 0.0
        # The one component more: equal norms.
        self._lifted = np.concatenate([plain, np.sqrt(np.maximum(self.norm ** 2 - squares, 0))[:, None]], 1)
        self._leaf = leaf
        self.centre: list[int] = []  # a point, per node
        self.radius: list[float] = []  # farthest descendant
        self.children: list[list[int]] = []
        self.below: list = []  # points of a leaf
        if len(plain):
            self._grow(np.arange(len(plain)), 0)
        self._child_ids = [np.array(c, np.int64) for c in self.children]
        # Points in the order of the leaves, so each leaf is a slice.
        order = np.concatenate([b for b in self.below if b is not None]) if self.centre else np.zeros(0, np.int64)
        end = 0
        for node, some in enumerate(self.below):
            if some is not None:
                self.below[node] = slice(end, end + len(some))
                end += len(some)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.centre = place[self.centre].tolist()
        self.points, self.single, self.mixed = self.points[order], self.single[order], self.mixed[order]
        self.members = [self.members[i] for i in order.tolist()]
        self._first = np.array([m[0] for m in self.members], np.int64)
        self._plain = plain = plain[order]
        self.centre_rows = plain[self.centre] if self.centre else np.zeros((0, vectors.shape[1] if vectors.ndim > 1 else 0))
        # Distances in one more dimension bound inner products of a question whose added component is 0 as they do there.
        self.radii = np.array(self.radius)
        del self._lifted

    def _distances(self, some: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(((self._lifted[some] - self._lifted[centre]) ** 2).sum(1))

    def _grow(self, points: np.ndarray, root: int) -> None:
        """Nodes for ``points``, whose centre is ``points[root]``; level by level, without recursion."""
        waiting = [(points, int(points[root]), -1, self._distances(points, int(points[root])))]
        while waiting:
            some, centre, parent, far = waiting.pop()
            node = len(self.centre)
            self.centre.append(centre)
            # Rounding of the distances must not make a radius too small.
            self.radius.append(float(far.max()) * (1 + 1e-9) + 1e-6)
            self.children.append([])
            self.below.append(None)
            if parent >= 0:
                self.children[parent].append(node)
            if len(some) <= self._leaf or not far.max() > 0:  # components so large that floats do not part the points
                self.below[node] = some
                continue
            # Centres of the next level: the node's own, then what no centre covers yet. All lie more than ``cover`` apart.
            cover = far.max() / 2
            near = far.copy()
            nearest = np.full(len(some), centre)
            centres = [centre]
            while True:
                k = int(near.argmax())
                if near[k] <= cover:
                    break
                fresh = self._distances(some, int(some[k]))
                closer = fresh < near
                near[closer] = fresh[closer]
                nearest[closer] = some[k]
                centres.append(int(some[k]))
                # Vectors without structure need a centre each; such a node is cut by the centres it has.
                if len(centres) * self._leaf >= 2 * len(some):
                    break
            for c in centres:
                mine = nearest == c
                waiting.append((some[mine], c, node, near[mine]))

    def search(self, question: np.ndarray, k: int, label: int, same: bool, skip: int = -1,
               window: tuple[int, int] | None = None, products: np.ndarray | None = None,
               reached: dict[int, np.ndarray] | None = None) -> list[tuple[int, int]]:
        """The first ``k`` (``score``, row number) by falling score, then row number, of rows whose label is (``same``) or is not ``label``.

        ``skip`` is a row that does not count, ``window`` the least and largest score. ``products`` are those of the question with
        all centres, if they are at hand; ``reached`` keeps the scores of the leaves that were reached, for the same question in
        another window.
        """
        if not self.centre or k <= 0:
            return []
        low, high = window if window else (-math.inf, math.inf)
        plain = question.astype(np.float64)
        size = math.sqrt(float((plain ** 2).sum()))
        at_centre = self.centre_rows @ plain if products is None else products
        # What the ball of a node adds: by its distance to the question, or by the question's size, whichever is less.
        apart = np.sqrt(np.maximum(size ** 2 + self.norm ** 2 - 2 * at_centre, 0))
        error = 1e-9 * (np.abs(at_centre) + size * self.norm) + 1
        upper = at_centre + self.radii * np.where(apart > self.radii, np.minimum(size, apart - self.radii / 2), size) + error
        lower = at_centre - self.radii * np.minimum(size, apart + self.radii / 2) - error
        best: list[tuple[int, int]] = []  # a heap of the k best, worst first, as (score, -row)
        exact = self.largest * int(np.abs(question).max(initial=0)) * max(1, len(question)) < EXACT_FLOAT
        waiting = [(-upper[0], 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            # A node may hold an equal score with a smaller row number, so only lesser bounds end the search.
            if len(best) == k and min(-bound, high) < best[0][0]:
                break
            some = self.below[node]
            if some is None:
                ids = self._child_ids[node]
                worth = (upper[ids] >= low) & (lower[ids] <= high)
                if len(best) == k:
                    worth &= upper[ids] >= best[0][0]
                for child in ids[worth].tolist():
                    heapq.heappush(waiting, (-upper[child], child))
                continue
            scores = None if reached is None else reached.get(node)
            if scores is None:
                scores = (self._plain[some] @ plain).astype(np.int64) if exact else exact_products(self.points[some], question)
                if reached is not None:
                    reached[node] = scores
            fit = (scores >= low) & (scores <= high)
            fit &= self.mixed[some] | ((self.single[some] == label) == same)
            if len(best) == k:
                fit &= scores >= best[0][0]
            at = np.flatnonzero(fit)
            at = at[np.lexsort((self._first[some][at], -scores[at]))] if len(at) > 1 else at
            for j in at.tolist():
                score, rows = int(scores[j]), self.members[some.start + j]
                if len(best) == k and score < best[0][0]:
                    break
                rows = rows[((self.labels[rows] == label) == same) & (rows != skip)][:k]
                for row in rows.tolist():
                    entry = (score, -row)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                    else:
                        break
        return [(score, -row) for score, row in sorted(best, reverse=True)]


def exact_products(rows: np.ndarray, question: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers that floats cannot hold; beyond 63 bits an error."""
    found = rows.astype(object) @ question.astype(object)
    if any(abs(int(x)) >= 2 ** 63 for x in found):
        raise ValueError("an inner product does not fit a long")
    return found.astype(np.int64)


def whole(vector: Column) -> Column:
    """The components as whole numbers; null if one of them is null or not finite."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    plain = vector.cast("array<double>")
    return F.when(F.forall(plain, finite), F.transform(plain, lambda x: F.floor(x * SCALE)))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors as rows; shorter ones end with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(lists.value_lengths()) if len(lists) else np.zeros(0, np.int64)
    out = np.zeros((len(lists), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = np.asarray(lists.flatten())
    return out


def _build(key: tuple, rows: pa.Table, folder: str) -> pa.Table:
    rows = rows.sort_by([("vec_id", "ascending"), ("row", "ascending")])
    tree = CoverTree(_matrix(rows["vector"]), np.asarray(rows["label"], np.int64))
    path = f"{folder}/tree-{key[0].as_py()}"
    held = pickle.dumps((tree, np.asarray(rows["vec_id"]), np.asarray(rows["row"])), protocol=5)
    publish(path, lambda out: out.write(held))
    return pa.table({"path": [path]})


@lru_cache(maxsize=1)
def _tree(path: str) -> tuple[CoverTree, np.ndarray, np.ndarray]:
    """The tree of a block; the questions of a block come one group after another."""
    with open_input(path) as file:
        return pickle.loads(file.read())


def _keep(key: tuple, rows: pa.Table, folder: str) -> pa.Table:
    path = f"{folder}/asked-{key[0].as_py()}"
    publish(path, lambda out: _write_table(out, rows))
    return pa.table({"asked": [path]})


def _write_table(out, rows: pa.Table) -> None:
    with pa.ipc.new_stream(out, rows.schema) as writer:
        writer.write_table(rows)


def _answer(batches: Iterator[pa.RecordBatch], folder: str, k: int, same: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, group in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            asked = f"{folder}/asked-{group}"
            system, inner = locate(asked)
            if system.get_file_info(inner).type == fs.FileType.NotFound:
                continue  # no question fell into this group
            tree, ids, numbers = _tree(path)
            with open_input(asked) as file:
                rows = pa.ipc.open_stream(file.read()).read_all().sort_by("row")
            width = tree.points.shape[1]
            vectors = _matrix(rows["vector"])
            # Components that only one side has are zeros of the other.
            if vectors.shape[1] < width:
                vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
            vectors = vectors[:, :width]
            products = vectors.astype(np.float64) @ tree.centre_rows.T
            place = {int(n): i for i, n in enumerate(numbers.tolist())}
            out: list[tuple[int, int, int, int]] = []
            before, reached = None, {}
            windows = zip(rows["low"].to_pylist(), rows["high"].to_pylist())
            for i, (ask, row, label, (low, high)) in enumerate(zip(
                    rows["ask"].to_pylist(), rows["row"].to_pylist(), rows["label"].to_pylist(), windows)):
                if row != before:  # else it is the same vector in another window
                    before, reached = row, {}
                found = tree.search(vectors[i], k, label, same, place.get(row, -1), None if low is None else (low, high), products[i], reached)
                out += [(ask, score, int(ids[j]), int(numbers[j])) for score, j in found]
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["ask", "score", "vec_id", "row"])


class HardNegatives:
    """Trees over one table of vectors, and searches in them; the steps are written tables and files in the shared folder."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 label: Column | None = None):
        spark = vectors.sparkSession
        label = vectors[label_col] if label is None else label
        rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), label.cast("long").alias("label"),
                              whole(vectors[vector_col]).alias("vector"))
        self.rows = stage(rows.where("vec_id is not null and label is not null and vector is not null")
                          .withColumn("row", F.monotonically_increasing_id()), "vectors")
        self._folder = new_path(spark, "cover-trees")
        n = self.rows.count()
        self._blocks = max(1, math.ceil(n / BLOCK_ROWS), min(parallel(vectors), math.ceil(n / LEAST_ROWS)))
        folder = self._folder
        self.trees = stage(self.rows.groupBy(F.pmod(F.xxhash64("row"), F.lit(self._blocks)).alias("block"))
                           .applyInArrow(lambda key, found: _build(key, found, folder), "path string"), "trees")

    def first(self, asked: DataFrame, k: int, same: bool) -> DataFrame:
        """``ask``, ``score``, ``vec_id``, ``rank`` of the first ``k`` rows for each question, by falling score, then ``vec_id``.

        ``asked`` has ``ask`` (its number), ``row`` (one that does not count), ``label``, ``vector`` and ``low`` and ``high``, the window of
        scores, or nulls. Only rows that have the label (``same``), or another one, count.
        """
        folder = f"{self._folder}/{uuid.uuid4().hex}"
        asked = stage(asked.select("ask", "row", "label", "vector", *[F.col(c).cast("long").alias(c) for c in ("low", "high")]), "asked")
        groups = max(1, math.ceil(asked.count() / QUESTIONS))
        stage(asked.groupBy(F.pmod(F.xxhash64("ask"), F.lit(groups)).alias("group"))
              .applyInArrow(lambda key, rows: _keep(key, rows, folder), "asked string"), "groups")
        # Each tree answers each group of questions; the rows dealt out are a path and a number.
        pairs = self.trees.select("path", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
        found = pairs.repartitionByRange(min(MOST_TASKS, self._blocks * groups), "path", "group").sortWithinPartitions("path", "group") \
            .mapInArrow(lambda batches: _answer(batches, folder, k, same), "ask long, score long, vec_id long, row long")
        order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id", "row")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("row")


def hard_negatives(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least_percent: int = 30, most_percent: int = 90) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    A row's score is its inner product with the anchor in whole numbers (components ``floor(256 x)``); higher scores come first, ties
    by smaller id. An anchor's positives are its first ``positives`` other rows of its label. Per positive the negatives are the first
    ``negatives`` rows of other labels with ``least_percent * positive_score <= 100 * score <= most_percent * positive_score``.
    ``anchors`` is a condition on ``vec_id``; ``label`` takes the place of the column ``label_col``, which else is used.

    Rows with a null id, label or vector or with a component that is null or not finite take no part. Shorter vectors end with
    zeros; an empty one is all zeros. Repeated rows and ids are rows like others: an anchor that is there twice is answered twice. Fewer
    rows than asked for give as many as there are; an empty table, or one without anchors, gives no rows. Products beyond 63 bits are an error.
    """
    trees = HardNegatives(vectors, id_col, vector_col, label_col, label)
    none = F.lit(None).cast("long")
    asked = trees.rows.where(anchors).select(F.col("row").alias("ask"), "row", "vec_id", "label", "vector")
    best = trees.first(asked.select("ask", "row", "label", "vector", none.alias("low"), none.alias("high")), positives, True)
    positive = stage(best.select("ask", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id"),
                                 F.col("rank").alias("k")), "positives")
    score = F.col("positive_score")
    # Least and largest whole scores of the window; Spark's division of whole numbers cuts towards zero.
    low, high = F.ceil(least_percent * score.cast("decimal(38,0)") / 100), F.floor(most_percent * score.cast("decimal(38,0)") / 100)
    windows = stage(positive.join(asked, "ask").select(
        (F.col("ask") * positives + F.col("k") - 1).alias("question"), "row", F.col("vec_id").alias("anchor_id"), "positive_id", "positive_score",
        "label", "vector", low.cast("long").alias("low"), high.cast("long").alias("high")).where("low <= high"), "windows")
    found = trees.first(windows.withColumnRenamed("question", "ask"), negatives, False)
    return windows.select(F.col("question").alias("ask"), "anchor_id", "positive_id", "positive_score").join(found, "ask").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
