"""Binary files in the cluster's shared folder, written and read by tasks.

A ``file:`` address (a mounted shared folder) is opened in place and can be
memory-mapped; others go through Arrow's file systems.
"""

from __future__ import annotations

import os
from urllib.parse import unquote, urlparse

import numpy as np
from pyarrow import fs


def local_path(address: str) -> str | None:
    """The path of a local or mounted address, else None."""
    url = urlparse(address)
    if url.scheme in ("", "file"):
        return unquote(url.path) if url.scheme else address
    return None


def open_output(address: str):
    """A new file for writing bytes; folders on the way are made."""
    path = local_path(address)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    system, path = fs.FileSystem.from_uri(address)
    system.create_dir(os.path.dirname(path), recursive=True)
    return system.open_output_stream(path)


def open_input(address: str):
    """A file for reading with ``seek``, ``read`` and ``size()``-free use."""
    path = local_path(address)
    if path is not None:
        return open(path, "rb")
    system, path = fs.FileSystem.from_uri(address)
    return system.open_input_file(path)


def mapped(address: str, dtype) -> np.ndarray:
    """The file as an array: memory-mapped where the address allows, else read."""
    path = local_path(address)
    if path is not None:
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with open_input(address) as f:
        return np.frombuffer(f.read(), dtype)
