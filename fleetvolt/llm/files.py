"""Files that Python tasks write to and read from the shared folder, whatever store it is in."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and the path in it of a URI or of a plain path."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def new_file(folder: str, suffix: str) -> tuple[str, object]:
    """A file of a name of its own, and its stream. Every attempt of a task writes files of its own; a
    table of the names that the successful tasks returned says which ones count."""
    store, path = opened(folder)
    store.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return f"{folder}/{name}", store.open_output_stream(f"{path}/{name}", compression=None)


def read_stream(uri: str):
    store, path = opened(uri)
    return store.open_input_stream(path, compression=None)


def read_file(uri: str):
    """With seek()."""
    store, path = opened(uri)
    return store.open_input_file(path)
