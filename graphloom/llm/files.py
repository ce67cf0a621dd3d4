"""Files that executors write and read in the shared folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs


def locate(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (file, hdfs, s3, gs) or of a plain path."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


@contextmanager
def new_file(folder: str, stem: str, suffix: str) -> Iterator[tuple[str, object]]:
    """A stream to a new file and its URI.

    Each attempt of a task writes a file of its own name; the table of files, written only by
    attempts that succeed, says which files count.
    """
    uri = f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"
    where, path = locate(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    with where.open_output_stream(path, compression=None) as out:
        yield uri, out


def read_file(uri: str):
    """A random-access stream of a file."""
    where, path = locate(uri)
    return where.open_input_file(path)
