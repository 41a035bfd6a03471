"""WARC archives: one gzip member per record, and a sequential reader that checks the digests.

Pages with equal payloads are stored once: the one with the smallest id is a ``response``, the others are
``revisit`` records that name it. A file is read from front to back in small blocks; of a record only its own bytes are held.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from flowlens.llm.common import parallel
from flowlens.session import new_path, stage
from flowlens.sources.files import open_input, publish

FILE_BYTES = 32 << 20  # a file ends with the record that reaches this, compressed
BLOCK = 256 << 10
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: object) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> str | None:
    return record_id[len("<urn:page:"):-1] or None


def record(page_id: object, url: str | None, payload: bytes, refers_to: object = None, revisit: bool = False,
           date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record as one gzip member. A revisit has the HTTP head, with the size of the payload, but not the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}",
            f"WARC-Date: {date}", f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
            f"WARC-Block-Digest: sha1:{digest(block)}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush()


class Broken(ValueError):
    """An archive that breaks the format, or a digest that does not fit."""


class _Members:
    """The uncompressed bytes of a file of gzip members, member by member."""

    def __init__(self, file: BinaryIO):
        self._file, self._raw, self._out, self._plain, self._open = file, b"", None, bytearray(), False

    def next_member(self) -> bool:
        """Go to the next member; False at the end of the file."""
        if not self._raw:
            self._raw = self._file.read(BLOCK)
        if not self._raw:
            return False
        self._out, self._plain, self._open = zlib.decompressobj(31), bytearray(), True
        return True

    def _more(self) -> None:
        if not self._open:
            raise Broken("a record is longer than its gzip member")
        waiting = self._out.unconsumed_tail or self._raw
        if not self._out.unconsumed_tail:
            self._raw = b""
            if not waiting:
                waiting = self._file.read(BLOCK)
                if not waiting:
                    raise Broken("the file ends inside a gzip member")
        self._plain += self._out.decompress(waiting, 4 * BLOCK)
        if self._out.eof:
            self._raw, self._open = self._out.unused_data, False

    def line_end(self, mark: bytes) -> bytes:
        """The bytes up to and with ``mark``."""
        start = 0
        while (at := self._plain.find(mark, start)) < 0:
            start = max(0, len(self._plain) - len(mark))
            self._more()
        return self.take(at + len(mark))

    def take(self, size: int) -> bytes:
        """The next ``size`` bytes."""
        while len(self._plain) < size:
            self._more()
        out = bytes(memoryview(self._plain)[:size])
        del self._plain[:size]
        return out

    def finish(self) -> None:
        """Nothing may be left of the member; its checksum is checked on the way."""
        while self._open:
            self._more()
        if self._plain:
            raise Broken("a gzip member holds more than its record")


def read_records(file: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and block of each record, in order; raises ``Broken`` at the first fault."""
    members = _Members(file)
    while members.next_member():
        lines = members.line_end(b"\r\n\r\n").decode().split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise Broken("no WARC record")
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}
        block = members.take(int(head["content-length"]))
        if members.take(4) != b"\r\n\r\n":
            raise Broken("a record does not end where its length says")
        members.finish()
        if head["warc-block-digest"] != f"sha1:{digest(block)}":
            raise Broken(f"wrong block digest of {head['warc-record-id']}")
        yield head, block


def parse(head: dict[str, str], block: bytes) -> dict:
    """A record as a row; the payload digest of a response is checked."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(line.partition(b":")[2]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    kind, named = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != named):
        raise Broken(f"wrong payload of {head['warc-record-id']}")
    return {"page_id": _page_id(head["warc-record-id"]), "url": head["warc-target-uri"], "payload_bytes": size,
            "payload_digest": named, "record_type": kind,
            "refers_to": _page_id(head["warc-refers-to"]) if kind == "revisit" else None}


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

    def flush() -> pa.RecordBatch:
        nonlocal seq, held, size
        path, records = f"{folder}/part-{part:06d}-{seq:06d}.warc.gz", held
        publish(path, lambda out: out.write(b"".join(records)))
        row = {"path": [path], "n_records": [len(held)], "n_bytes": [size]}
        seq, held, size = seq + 1, [], 0
        return pa.RecordBatch.from_pydict(row)

    for batch in batches:
        ids, urls, refers = (batch.column(i).to_pylist() for i in (0, 1, 3))
        revisits = batch.column(4).to_pylist()
        for i, payload in enumerate(batch.column(2)):
            held.append(record(ids[i], urls[i], payload.as_py(), refers[i], revisits[i]))
            size += len(held[-1])
            if size >= FILE_BYTES:
                yield flush()
    if held:
        yield flush()


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per row to files below ``folder``; the staged manifest has ``path``, ``n_records``, ``n_bytes``.

    Null html is an empty payload, null url an empty one. Of equal payloads of at least ``least_bytes`` bytes all rows with
    the smallest id are responses and all others revisit that id; null ids are the largest. Smaller ones are responses.
    """
    spark = pages.sparkSession
    plain = pages.select(pages[id_col].alias("page_id"), pages[url_col].cast("string").alias("url"),
                         F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary").alias("payload"))
    keyed = plain.withColumn("key", F.sha2("payload", 256))
    # Key and id only: the payloads are not moved for this, and a group is one row per task.
    groups = stage(keyed.where(F.octet_length("payload") >= least_bytes).groupBy("key")
                   .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                   .where("n > 1 and first_id is not null").select("key", "first_id"), "payloads")
    linked = keyed.join(groups, "key", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    folder = folder or new_path(spark, "warc")
    return stage(linked.select("page_id", "url", "payload", F.when(revisit, F.col("first_id")).alias("refers_to"),
                               revisit.alias("revisit")).mapInArrow(
        lambda batches: _write(batches, folder), "path string, n_records long, n_bytes long"), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string())])
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows = []
            with open_input(path) as file:
                for head, block in read_records(file):
                    rows.append(parse(head, block))
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)


def read_archives(manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """A row per record of the files: ``page_id``, ``url``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``. A file is one task's work from front to back; a fault in it is an error."""
    found = manifest.select("path").repartition(parallel(manifest), "path").mapInArrow(
        _read, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})
