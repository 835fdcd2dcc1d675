"""Binary files in the shared folder, from inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import BinaryIO

from pyarrow import fs


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (file:, hdfs:, s3:, gs:, ...) or an absolute path."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1) if path.startswith("s3a:") else path)


def write_file(path: str, write: Callable[[BinaryIO], object]) -> object:
    """Write a file as a whole: under a name of this attempt, then moved to its own.

    A task that runs again writes the same file again; a reader never sees half of one.
    """
    store, target = _place(path)
    store.create_dir(target.rpartition("/")[0], recursive=True)
    own = f"{target}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(own) as out:
        result = write(out)
    store.move(own, target)
    return result


def open_file(path: str) -> BinaryIO:
    """A file for reading at any place."""
    store, target = _place(path)
    return store.open_input_file(target)
