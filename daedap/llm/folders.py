"""Files that tasks write themselves, in the shared folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import SparkSession

from daedap.session import shared_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """The address of a new folder below the one that all executors share."""
    base = shared_dir(spark)
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + os.path.abspath(base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


def place(address: str) -> tuple[fs.FileSystem, str]:
    if address.startswith("file:"):
        return fs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(address)


@contextmanager
def create(address: str) -> Iterator:
    """An output stream for a file that must not exist yet, and its folder."""
    system, path = place(address)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path, compression=None) as out:
        yield out


@contextmanager
def reading(address: str) -> Iterator:
    """A seekable input file."""
    system, path = place(address)
    with system.open_input_file(path) as source:
        yield source
