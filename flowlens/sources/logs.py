"""Tab-separated protocol logs with a ``#fields`` header."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowlens.functions.values import named, trim_names
from flowlens.settings import STANDARD_LOGS
from flowlens.sources.files import open_input, publish

# Column types by the name in the ``#types`` line; sets and vectors of them are arrays, everything else stays text.
TYPES = {"port": "int", "count": "bigint", "int": "bigint", "double": "double",
         "interval": "double", "time": "double", "bool": "boolean"}
HEAD_BYTES = 256 * 1024  # of a file, in which its header must end


Paths = str | list[str]


class Header(NamedTuple):
    """What the ``#`` lines of a log say; types may be missing."""
    names: tuple[str, ...]
    types: tuple[str, ...] = ()
    separator: str = "\t"
    set_separator: str = ","
    empty: str = "(empty)"
    unset: str = "-"


def parse_header(text: str) -> Header | None:
    """The header at the top of a log; None without a ``#fields`` line."""
    lines = []
    for line in text.splitlines():
        if not line.startswith("#"):
            break
        lines.append(line[1:])
    separator = "\t"
    for line in lines:
        if line.startswith("separator "):
            separator = re.sub(r"\\x([0-9a-fA-F]{2})", lambda m: chr(int(m[1], 16)), line[len("separator "):])
    said = {name: rest for name, *rest in (line.split(separator) for line in lines)}
    if "fields" not in said:
        return None
    one = {key: said[name][0] for name, key in (("set_separator", "set_separator"), ("empty_field", "empty"), ("unset_field", "unset"))
           if said.get(name)}
    return Header(tuple(said["fields"]), tuple(said.get("types", ())), separator, **one)


def _read_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for path in batch.column(0).to_pylist():
            with open_input(path) as f:
                data = f.read(HEAD_BYTES)
            if data[:2] == b"\x1f\x8b":
                data = zlib.decompressobj(31).decompress(data, HEAD_BYTES)
            header = parse_header(data.decode("utf-8", "replace"))
            if header is not None:
                out.append({"file": path, **header._asdict()})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
            [("file", pa.string()), ("names", pa.list_(pa.string())), ("types", pa.list_(pa.string())),
             *[(n, pa.string()) for n in Header._fields[2:]]]))


def log_headers(spark: SparkSession, path: Paths) -> dict[Header, list[str]]:
    """The headers of the files, with the files that have each. Of a file only the top is read."""
    files = spark.read.format("binaryFile").load(path).select("path")
    heads = files.repartition(max(1, min(files.count(), 4 * spark.sparkContext.defaultParallelism))).mapInArrow(
        _read_heads, "file string, names array<string>, types array<string>, " + ", ".join(f"{n} string" for n in Header._fields[2:]))
    found: dict[Header, list[str]] = {}
    for row in sorted(heads.collect(), key=lambda r: r["file"]):
        header = Header(tuple(row["names"]), tuple(row["types"]), *row[3:])
        found.setdefault(header, []).append(row["file"])
    return found


def log_header(spark: SparkSession, path: Paths) -> tuple[list[str], list[str]]:
    """(names, types) of the first file with a header."""
    header = next(iter(log_headers(spark, path)), Header(()))
    return list(header.names), list(header.types)


def read_log(spark: SparkSession, path: Paths, typed: bool = False) -> DataFrame:
    """A log file, or a folder or list of files of one type, with the columns of their headers.

    Only lines that start with ``#`` are left out. Cells are text, unset ones included. With ``typed`` the columns that the
    header calls numbers or truth values are cast, sets and vectors become arrays, and cells that are none are NULL; separators
    and the words for empty and unset are those of the header.
    Files with other columns are read by their own header and united by name. Files without a
    header belong to the header of the others, if these have only one.
    """
    headers = log_headers(spark, path)
    if not headers:
        raise ValueError(f"no #fields line in {path}")
    if len(headers) == 1:
        return _read_with(spark, path, next(iter(headers)), typed)
    bare = spark.read.text(path).select(F.col("_metadata.file_path").alias("file")).distinct() \
        .where(~F.col("file").isin([f for files in headers.values() for f in files]))
    if not bare.isEmpty():
        raise ValueError(f"files without a #fields line next to different headers in {path}")
    every = [_read_with(spark, files, header, typed) for header, files in headers.items()]
    united = every[0]
    for one in every[1:]:
        united = united.unionByName(one, allowMissingColumns=True)
    return united


def _cast(cell: Column, kind: str) -> Column:
    if kind == "bool":
        return F.when(cell == "T", True).when(cell == "F", False)
    return cell.try_cast(TYPES[kind]) if kind in TYPES else cell


def _typed(name: str, kind: str, header: Header) -> Column:
    """A cell as its type says; text stays as it is, unset text too."""
    cell, inner = named(name), re.fullmatch(r"(?:set|vector)\[(.+)\]", kind)
    if not inner:
        return _cast(cell, kind).alias(name)
    items = F.transform(F.split(cell, re.escape(header.set_separator)),
                        lambda x: _cast(F.when(x != header.unset, x), inner[1]))
    none = F.slice(items, 1, 0)  # of the same type
    return F.when(cell == header.empty, none).when(cell != header.unset, items).alias(name)


def _read_with(spark: SparkSession, path: Paths, header: Header, typed: bool) -> DataFrame:
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in header.names)
    rows = (spark.read.schema(schema).option("sep", header.separator).option("comment", "#").option("quote", "")
            .option("emptyValue", "").csv(path))
    rows = trim_names(rows)
    if typed and header.types:
        kinds = dict(zip(rows.columns, header.types))
        rows = rows.select(*[_typed(c, kinds.get(c, "string"), header) for c in rows.columns])
    return rows


def log_files(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Log type to its paths, of any depth: the standard types first, in their order, then the others by name.

    The type is the name up to the first dot, so ``conn.2024-01-01.log`` is a ``conn`` log. Files of length 0
    are not listed."""
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.log").option("recursiveFileLookup", True)
               .load(folder).where("length > 0").select("path").collect())
    found: dict[str, list[str]] = {}
    for path in sorted(r["path"] for r in listing):
        found.setdefault(path.rsplit("/", 1)[1].split(".")[0], []).append(path)
    others = sorted(set(found) - set(STANDARD_LOGS))
    return {kind: found[kind] for kind in [*STANDARD_LOGS, *others] if kind in found}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_log_or_empty(spark: SparkSession, path: str, schema: str, typed: bool = False) -> DataFrame:
    """The log, or an empty table with ``schema`` when there is no such file or no header in it."""
    if not _exists(spark, path) or not log_header(spark, path)[0]:
        return spark.createDataFrame([], schema)
    return read_log(spark, path, typed)


def read_logs(spark: SparkSession, files: dict[str, Paths], typed: bool = False) -> dict[str, DataFrame]:
    """The logs that exist and have rows, by type, in the given order."""
    logs = {}
    for kind, path in files.items():
        path = [p for p in ([path] if isinstance(path, str) else path) if _exists(spark, p)]
        if not path or not log_headers(spark, path):
            continue
        log = read_log(spark, path, typed)
        if not log.isEmpty():
            logs[kind] = log
    return logs


def write_log(df: DataFrame, path: str, kind: str, types: dict[str, str] | None = None) -> None:
    """The table as log text below ``path``: a header file and one file per partition."""
    spark = df.sparkSession
    names = df.columns
    head = ["#separator \\x09", f"#path\t{kind}", "#fields\t" + "\t".join(names),
            "#types\t" + "\t".join((types or {}).get(n, "string") for n in names)]
    spark.createDataFrame([("\n".join(head),)], "value string").coalesce(1).write.text(path)
    line = F.concat_ws("\t", *[F.coalesce(named(n).cast("string"), F.lit("-")) for n in names])
    df.select(line.alias("value")).write.mode("append").text(path)


def write_log_files(df: DataFrame, folder: str, kind: str, types: dict[str, str] | None = None) -> DataFrame:
    """The table as log files ``<kind>.<number>.log`` in ``folder``, one with a header per partition; returns their paths.

    A repeated task writes the same file again.
    """
    names = df.columns
    head = "\n".join(["#separator \\x09", f"#path\t{kind}", "#fields\t" + "\t".join(names),
                      "#types\t" + "\t".join((types or {}).get(n, "string") for n in names), ""]).encode()
    line = F.concat_ws("\t", *[F.coalesce(named(n).cast("string"), F.lit("-")) for n in names])

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/{kind}.{TaskContext.get().partitionId():05d}.log"

        def write(out) -> None:
            out.write(head)
            for batch in batches:
                out.write("".join(f"{x}\n" for x in batch.column(0).to_pylist()).encode())

        publish(path, write)
        yield pa.RecordBatch.from_pylist([{"path": path}], schema=pa.schema([("path", pa.string())]))

    return df.select(line.alias("value")).mapInArrow(save, "path string")
