"""Files in the shared folder, written by Python workers.

``file:`` paths are opened directly; other schemes through pyarrow's file systems. Every attempt of a
task writes files of its own name (:func:`own_name`) and reports them when they are whole, so a
repeated or speculative task never meets another's file, and no file has to be renamed.
"""

from __future__ import annotations

import contextlib
import io
import uuid
from collections.abc import Iterator
from typing import BinaryIO

from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:") or "://" not in uri:
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def own_name(folder: str, stem: str, suffix: str) -> str:
    """A path that no other attempt uses."""
    return f"{folder}/{stem}-{uuid.uuid4().hex}{suffix}"


@contextlib.contextmanager
def written(uri: str) -> Iterator[BinaryIO]:
    where, path = _at(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    with where.open_output_stream(path, compression=None) as f:
        yield f


@contextlib.contextmanager
def opened(uri: str) -> Iterator[BinaryIO]:
    """A seekable file."""
    where, path = _at(uri)
    with where.open_input_file(path) as f, io.BufferedReader(f, 1 << 18) as g:
        yield g


def removed(uri: str) -> None:
    where, path = _at(uri)
    where.delete_file(path)
