"""Files that tasks write and read themselves, in any file system that pyarrow reaches by URI."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs


def at(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path; Hadoop's short form file:/x is taken too."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def whole_file(uri: str) -> Iterator[pa.NativeFile]:
    """A file that appears under its name when all of it is written; a repeated attempt replaces it by equal bytes."""
    fs, path = at(uri)
    folder = path.rsplit("/", 1)[0]
    fs.create_dir(folder, recursive=True)
    unfinished = f"{folder}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(unfinished) as file:
        yield file
    fs.move(unfinished, path)


def open_ranges(uri: str) -> pa.NativeFile:
    """For reads at any place of a file."""
    fs, path = at(uri)
    return fs.open_input_file(path)
