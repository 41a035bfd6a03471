"""The block ledger as files: batches of changes, merged when they are read.

A batch has a number and holds the rows it sets and the ips it removes. It is written to a folder of its own and counts once its
marker is there, so a writer that fails leaves nothing behind that readers see, and a batch that is sent again changes nothing.
For each ip the row of the latest batch counts. Rows are dealt to folders by a hash of their ip; compacting rewrites only the
folders that batches have touched and keeps the others as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowlens import schemas
from flowlens.operators.blocks import LEDGER, expired_blocks
from flowlens.session import qualified
from flowlens.sources.files import exists, locate, open_input, publish

BUCKETS = 64
STORED = f"{schemas.BLOCKS}, removed boolean"


class LedgerTable:
    """A ledger below ``path``. Batches are numbered by their writer, one writer at a time; readers may come at any time."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self._spark, self._path = spark, qualified(spark, path)
        about = f"{self._path}/about"
        if not exists(about):
            publish(about, lambda out: out.write(json.dumps({"buckets": buckets}).encode()))
        with open_input(about) as f:  # that of the first writer
            self.buckets = json.loads(f.read())["buckets"]

    def _numbers(self, kind: str) -> list[int]:
        system, inner = locate(f"{self._path}/{kind}")
        if system.get_file_info(inner).type == fs.FileType.NotFound:
            return []
        names = [x.base_name for x in system.get_file_info(fs.FileSelector(inner))]
        return sorted(int(n) for n in names if n.isdigit())

    def _base(self) -> tuple[int, dict[int, int]]:
        """Up to which batch the ledger is compacted, and for each bucket which compaction wrote it."""
        numbers = self._numbers("bases")
        if not numbers:
            return -1, {}
        with open_input(f"{self._path}/bases/{numbers[-1]}") as f:
            return numbers[-1], {int(b): n for b, n in json.loads(f.read()).items()}

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("ip"), F.lit(self.buckets)).cast("int").alias("bucket")

    def commit(self, number: int, blocked: DataFrame | None = None, removed: DataFrame | None = None) -> bool:
        """Set the rows of ``blocked`` and take out the ips of ``removed``; False if the batch was committed before.

        Of several rows of an ip the latest block counts; an ip that is both set and removed is removed. Only these rows are written.
        """
        if number < 0:
            raise ValueError("batches are numbered from 0")
        marker = f"{self._path}/commits/{number}"
        if exists(marker):
            return False
        rows = self._spark.createDataFrame([], STORED)
        if blocked is not None:
            rows = rows.unionByName(blocked.select(*LEDGER, F.lit(False).alias("removed")))
        if removed is not None:
            rows = rows.unionByName(removed.select("ip", F.lit(True).alias("removed")), allowMissingColumns=True)
        one = rows.groupBy("ip").agg(F.max_by(
            F.struct("block_time", "reason", "duration", "removed"), F.struct("removed", "block_time", "reason", "duration")).alias("row"))
        # A folder that a failed attempt left has no marker and is replaced.
        one.select("ip", "row.*", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self._path}/deltas/{number}")
        publish(marker, lambda out: out.write(b""))
        return True

    def _stored(self, paths: Iterable[str]) -> DataFrame:
        """Rows of bucket folders and delta folders with the number of the batch, -1 for compacted ones."""
        paths = list(paths)
        rows = self._spark.read.schema(STORED).parquet(*paths) if paths else self._spark.createDataFrame([], STORED)
        if not paths:
            return rows.withColumn("number", F.lit(-1).cast("bigint"))
        place = rows.metadataColumn("_metadata")["file_path"]
        number = F.regexp_extract(place, r"/deltas/(\d+)/bucket=\d+/[^/]*$", 1)
        return rows.withColumn("number", F.when(number == "", -1).otherwise(number.try_cast("bigint")))

    @staticmethod
    def _latest(rows: DataFrame) -> DataFrame:
        row = F.max_by(F.struct("block_time", "reason", "duration", "removed"), "number").alias("row")
        return rows.groupBy("ip").agg(row).select("ip", "row.*").where("not removed").drop("removed")

    def _bucket_folders(self, numbers: list[int]) -> dict[int, list[str]]:
        """For each bucket the folders that batches have written."""
        found: dict[int, list[str]] = {}
        for number in numbers:
            system, inner = locate(f"{self._path}/deltas/{number}")
            for x in system.get_file_info(fs.FileSelector(inner)):
                if x.base_name.startswith("bucket="):
                    found.setdefault(int(x.base_name[7:]), []).append(f"{self._path}/deltas/{number}/{x.base_name}")
        return found

    def read(self) -> DataFrame:
        """The ledger as it is now. Later batches do not change what was read."""
        upto, base = self._base()
        touched = self._bucket_folders([n for n in self._numbers("commits") if n > upto])
        paths = [f"{self._path}/base/{n}/bucket={b}" for b, n in base.items()] + [p for ps in touched.values() for p in ps]
        return self._latest(self._stored(paths)).select(*LEDGER)

    def compact(self) -> list[int]:
        """Merge the batches so far into the buckets they touch; these buckets. Reading gives the same before and after."""
        upto, base = self._base()
        numbers = [n for n in self._numbers("commits") if n > upto]
        touched = self._bucket_folders(numbers)
        if not touched:
            return []
        old = [f"{self._path}/base/{base[b]}/bucket={b}" for b in touched if b in base]
        folder = f"{self._path}/base/{numbers[-1]}"
        self._latest(self._stored([*old, *[p for ps in touched.values() for p in ps]])).withColumn("removed", F.lit(False)) \
            .select("*", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        system, inner = locate(folder)
        written = {int(x.base_name[7:]) for x in system.get_file_info(fs.FileSelector(inner)) if x.base_name.startswith("bucket=")}
        state = {b: n for b, n in base.items() if b not in touched} | {b: numbers[-1] for b in written}
        publish(f"{self._path}/bases/{numbers[-1]}", lambda out: out.write(json.dumps(state).encode()))
        return sorted(touched)

    def retire(self) -> None:
        """Delete the rows of batches that are compacted, and compactions that no bucket uses. Call it when no reader has
        begun before the last compaction. Markers of batches stay, so an old batch that is sent again still changes nothing."""
        upto, base = self._base()
        for kind, numbers in (("deltas", [n for n in self._numbers("deltas") if n <= upto]),
                              ("base", [n for n in self._numbers("base") if n <= upto and n not in base.values()])):
            for number in numbers:
                system, inner = locate(f"{self._path}/{kind}/{number}")
                system.delete_dir(inner)

    def clean(self, number: int, as_of=None) -> bool:
        """Take out blocks that are over, as a batch."""
        return self.commit(number, removed=expired_blocks(self.read(), as_of))
