"""Files that tasks write to and read from the shared checkpoint folder."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from tablescope.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name below the session's checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of ``uri`` (a path, file:, hdfs:, s3: ...) and the
    path within it."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)
