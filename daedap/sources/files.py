"""Parts of files, read by tasks without the rest of them."""

from __future__ import annotations

from pyarrow import NativeFile, fs

# Addresses that tasks can read parts of; files elsewhere come whole, through Spark.
SCHEMES = ("file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")


def reads_parts(address: str) -> bool:
    return address.partition(":")[0] in SCHEMES


def open_file(address: str) -> NativeFile:
    """A file, for reading from any place in it."""
    if address.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + address.removeprefix("file:").lstrip("/"))
    system, path = fs.FileSystem.from_uri(address.replace("s3a://", "s3://", 1))
    return system.open_input_file(path)
