"""Binary files that tasks write to the shared folder, and how tasks read them.

A task writes under a name of its own and reports it in its output rows; what
counts is the staged table of names, so files of failed attempts are ignored.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid

import numpy as np
import pyarrow.fs as pafs


def _located(uri: str) -> tuple[pafs.FileSystem, str]:
    for theirs, ours in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if uri.startswith(theirs):
            uri = ours + uri.removeprefix(theirs)
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_file(folder: str, suffix: str, *parts: bytes | np.ndarray) -> str:
    """Write ``parts`` one after the other as a new file; returns its URI."""
    system, path = _located(folder)
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}.{suffix}"
    with system.open_output_stream(f"{path}/{name}") as stream:
        for part in parts:
            stream.write(memoryview(np.ascontiguousarray(part)).cast("B") if isinstance(part, np.ndarray) else part)
    return f"{folder.rstrip('/')}/{name}"


def mapped_file(uri: str) -> np.ndarray:
    """The bytes of a file, memory-mapped.

    A file of a mounted folder is mapped in place. From an object store it is
    fetched into an unnamed temporary file first, which goes with its mapping.
    """
    system, path = _located(uri)
    if isinstance(system, pafs.LocalFileSystem):
        if not os.path.getsize(path):
            return np.empty(0, np.uint8)
        return np.memmap(path, np.uint8, "r")
    with tempfile.TemporaryFile() as local, system.open_input_stream(path) as stream:
        while block := stream.read(1 << 22):
            local.write(block)
        if not local.tell():
            return np.empty(0, np.uint8)
        local.flush()
        return np.frombuffer(mmap.mmap(local.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)
