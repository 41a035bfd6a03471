"""Tables that lie beside another one: what is to be known of a row is read by the task that scans it.

A row of a table of files is named by its file and its place in it. Decisions about rows are written in pieces by file and range
of places, so a second scan of the table reads the pieces of just the rows it meets. Texts stay where they are: neither
they nor the decisions are joined by a shuffle of the wide side.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from flowlens.llm.common import lean
from flowlens.session import new_path, stage
from flowlens.sources.files import locate

CHUNK_ROWS = 16_384  # places of a file whose decisions are read together
FILE, AT = "file", "at"


def _is_scan(docs: DataFrame) -> bool:
    """Whether each row of ``docs`` is a row of a file, and the same one whenever it is computed."""
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View") and node.deterministic():
        node = node.children().head()
    return node.nodeName().startswith("LogicalRelation") and "HadoopFsRelation" in node.relation().getClass().getName() \
        and "ParquetFileFormat" in node.relation().fileFormat().getClass().getName()


class Located:
    """A table whose rows have a place: ``file`` and ``at``. One that is not read from Parquet files is written to some first."""

    def __init__(self, docs: DataFrame):
        self.docs = docs if _is_scan(docs) else stage(docs, "located")

    def rows(self, *columns) -> DataFrame:
        """``file``, ``at`` and the given columns (expressions on ``docs``) of all rows."""
        place = self.docs.metadataColumn("_metadata")
        return self.docs.select(place["file_path"].alias(FILE), place["row_index"].alias(AT), *columns)


def _name(file: str) -> str:
    return hashlib.md5(file.encode()).hexdigest()


def put(rows: DataFrame, label: str, chunk_rows: int = CHUNK_ROWS) -> str:
    """Write ``rows`` (``file``, ``at`` and more) to a new folder, in pieces that ``read`` finds; the folder."""
    path = new_path(rows.sparkSession, label)
    rows.withColumns({"of_file": F.md5(FILE), "chunk": F.floor(F.col(AT) / chunk_rows)}).drop(FILE) \
        .repartition("of_file", "chunk").sortWithinPartitions("of_file", "chunk", AT).write.partitionBy("of_file", "chunk").parquet(path)
    return path


@functools.lru_cache(maxsize=1)
def _piece(folder: str, file: str, chunk: int) -> pa.Table | None:
    system, inner = locate(f"{folder}/of_file={_name(file)}/chunk={chunk}")
    if system.get_file_info(inner).type == fs.FileType.NotFound:
        return None
    return pq.read_table(inner, filesystem=system, partitioning=None).sort_by(AT)


def read(folder: str, file: str, low: int, high: int, chunk_rows: int = CHUNK_ROWS) -> list[pa.Table]:
    """What was put for the places from ``low`` to ``high`` of a file, by place; no table where there is nothing."""
    found = []
    for chunk in range(low // chunk_rows, high // chunk_rows + 1):
        piece = _piece(folder, file, chunk)
        if piece is not None:
            piece = piece.filter((pc.field(AT) >= low) & (pc.field(AT) <= high))
            if piece.num_rows:
                found.append(piece)
    return found


def by_file(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    """The rows of a batch (first column ``file``), file by file."""
    files = batch.column(0)
    ends = pc.run_end_encode(files)
    start = 0
    for end, file in zip(ends.run_ends.to_pylist(), ends.values.to_pylist()):
        yield file, batch.slice(start, end - start)
        start = end


@lean
def _without(batches: Iterator[pa.RecordBatch], folder: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, rows in by_file(batch):
            at = rows.column(1)
            gone = read(folder, file, pc.min(at).as_py(), pc.max(at).as_py())
            if gone:
                out = pa.concat_tables(gone)[AT].combine_chunks()
                rows = rows.filter(pc.invert(pc.is_in(at, value_set=out)))
            yield pa.RecordBatch.from_arrays(rows.columns[2:], names=names)


def without(place: Located, gone: DataFrame) -> DataFrame:
    """The table, all columns, without the rows that ``gone`` names (``file``, ``at``)."""
    folder = put(gone.select(FILE, AT), "gone")
    names, schema = place.docs.columns, place.docs.schema
    # Names of the table may clash with those of the place, so columns go by position.
    columns = [place.docs[name].alias(f"c{i}") for i, name in enumerate(names)]
    return place.rows(*columns).mapInArrow(lambda batches: _without(batches, folder, names), schema)
