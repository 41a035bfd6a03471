"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A batch of changes becomes one signed delta per key and is written as a folder of its own, which appears in one
step under the name of the batch. Totals are the sum of the deltas: additive, so the order of batches does not
matter, and a batch that is sent again finds its folder and changes nothing. ``compact`` adds batches up.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlens.session import qualified

KEYS = ["source", "lang", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """The delta of a table of changes, a row per key that changes.

    ``changes``: ``op`` with ``source``, ``lang``, ``tokenizer``, ``n_tokens`` as they are after the change, and
    ``old_source``, ``old_lang``, ``old_tokenizer``, ``old_tokens`` as they were before it. ``insert`` adds what is new,
    ``delete`` takes away what was old, ``revise`` does both, so a document may change its key. Null keys are keys,
    null counts are 0, each row counts, other operations are an error.
    """
    new = F.struct(*[F.col(k) for k in KEYS], F.lit(1).alias("sign"), F.col("n_tokens").alias("n"))
    old = F.struct(*[F.col(f"old_{k}").alias(k) for k in KEYS], F.lit(-1).alias("sign"), F.col("old_tokens").alias("n"))
    sides = F.when(F.col("op") == "insert", F.array(new)).when(F.col("op") == "delete", F.array(old)) \
        .when(F.col("op") == "revise", F.array(old, new)) \
        .otherwise(F.raise_error(F.concat(F.lit("unknown operation "), F.coalesce("op", F.lit("null")))))
    return changes.select(F.explode(sides).alias("x")).groupBy(*[F.col(f"x.{k}").alias(k) for k in KEYS]).agg(
        F.sum("x.sign").cast("long").alias("n_docs"),
        F.sum(F.col("x.sign") * F.coalesce("x.n", F.lit(0))).cast("long").alias("n_tokens"))


class Rollup:
    """Totals below a shared folder. One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, qualified(spark, folder)
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self._folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, prefix: str) -> list[str]:
        where = self._path(self._folder)
        found = self._files.listStatus(where) if self._files.exists(where) else []
        return sorted(f.getPath().getName() for f in found if f.getPath().getName().startswith(prefix))

    def _appear(self, df: DataFrame, name: str) -> None:
        """Write ``df`` elsewhere, then let the whole folder appear under its name."""
        draft = f"{self._folder}/.draft-{uuid.uuid4().hex}"
        df.write.parquet(draft)
        if not self._files.rename(self._path(draft), self._path(f"{self._folder}/{name}")):
            raise RuntimeError(f"{name} could not be put in place")

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.schema(DELTA).parquet(f"{self._folder}/{name}")

    def _included(self) -> tuple[str | None, set[str]]:
        """The last compacted state and the batches in it."""
        states = self._names("state-")
        if not states:
            return None, set()
        rows = self._spark.read.schema("batch string").parquet(f"{self._folder}/included-{states[-1][6:]}").collect()
        return states[-1], {r.batch for r in rows}

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply the changes of a batch once; False if the batch was applied before."""
        name = f"batch-{quote(batch, safe='')}"
        if name in self._included()[1] or name in self._names("batch-"):
            return False
        self._appear(signed(changes).select("source", "lang", "tokenizer", "n_docs", "n_tokens"), name)
        return True

    def compact(self) -> None:
        """Add all batches up to one state. Their names are written first, so a state is never without its list."""
        _, before = self._included()
        names = set(self._names("batch-")) - before
        number = f"{len(self._names('state-')):06d}"
        ids = self._spark.createDataFrame([(n,) for n in sorted(before | names)], "batch string")
        left = self._path(f"{self._folder}/included-{number}")
        if self._files.exists(left):  # of a compaction that did not come to its state
            self._files.delete(left, True)
        self._appear(ids, f"included-{number}")
        self._appear(self.totals(), f"state-{number}")

    def totals(self) -> DataFrame:
        """``source``, ``lang``, ``tokenizer``, ``n_docs``, ``n_tokens`` of all keys that are not back at zero."""
        state, done = self._included()
        parts = [self._read(state)] if state else []
        parts += [self._read(n) for n in self._names("batch-") if n not in done]
        if not parts:
            return self._spark.createDataFrame([], DELTA)
        every = parts[0]
        for part in parts[1:]:
            every = every.unionAll(part)
        return every.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")) \
            .where("n_docs <> 0 or n_tokens <> 0")
