"""Binary files that tasks read and write, on any file system Arrow knows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import BinaryIO

from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a qualified path, under Spark's or Arrow's scheme names."""
    scheme, colon, rest = path.partition(":")
    if colon and scheme in ("s3a", "s3n"):
        path = f"s3:{rest}"
    elif colon and scheme in ("wasb", "wasbs"):
        raise ValueError(f"{scheme}: give the same folder as abfs:// or abfss://")
    elif colon and scheme == "file":
        path = "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


def open_input(path: str) -> BinaryIO:
    """A file opened for reading from its start."""
    system, inner = locate(path)
    return system.open_input_file(inner)


def exists(path: str) -> bool:
    system, inner = locate(path)
    return system.get_file_info(inner).type != fs.FileType.NotFound


def publish(path: str, write: Callable[[BinaryIO], None]) -> None:
    """Write a file under a name of this attempt and move it to ``path``.

    A task that is run again, or twice at a time, leaves one whole file: readers never see a part.
    """
    system, inner = locate(path)
    folder, _, name = inner.rpartition("/")
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    try:
        with system.open_output_stream(draft, compression=None) as out:
            write(out)
        system.move(draft, inner)
    except BaseException:
        if system.get_file_info(draft).type != fs.FileType.NotFound:
            system.delete_file(draft)
        raise
