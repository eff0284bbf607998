"""Binary files that tasks write to and read from the shared folder.

Paths are URIs of any store that pyarrow opens, or absolute local paths. A task gives each
file a name of its own; what a lost or repeated attempt leaves behind is in no manifest and
is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_input(path: str):
    """A seekable file, read as bytes are asked for."""
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def create_output(folder: str, suffix: str):
    """A new file below ``folder``: its path and the stream to write."""
    path = f"{folder}/{uuid.uuid4().hex}{suffix}"
    store, inner = fs.FileSystem.from_uri(path)
    store.create_dir(inner.rpartition("/")[0], recursive=True)
    return path, store.open_output_stream(inner, compression=None)
