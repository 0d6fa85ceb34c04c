"""Files in a shared folder, from tasks: written under a temporary name and
renamed when complete, listed by a manifest that only names complete files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs


def open_root(root: str) -> tuple[pafs.FileSystem, str]:
    """(file system, folder) of a URI or a plain path."""
    if "://" in root or root.startswith("file:"):
        return pafs.FileSystem.from_uri(root)
    return pafs.LocalFileSystem(), root


@contextmanager
def committed(root: str, name: str) -> Iterator:
    """An output stream for ``root/name`` that gets its name only when the
    block ends well. Attempts of one task write the same bytes, so whichever
    is renamed last changes nothing."""
    fs, folder = open_root(root)
    fs.create_dir(folder, recursive=True)
    temporary = f"{folder}/_tmp-{uuid.uuid4().hex}-{name}"
    with fs.open_output_stream(temporary, compression=None) as out:
        yield out
    fs.move(temporary, f"{folder}/{name}")
