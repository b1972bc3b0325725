"""What the Python workers of a session need: the package, and batches that
leave room for the task's own work."""

from __future__ import annotations

import ctypes
import os
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])

#: Arrow batches of whole texts are kept small: (setting, Spark's default, ours).
#: A session that states another value keeps it.
BATCHES = (
    ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"),
    ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"),
)


def show_workers(spark: SparkSession) -> SparkSession:
    """Let the session's Python workers import the package from where the
    driver did, and hand them smaller batches. Executors with the package
    installed, or sent along with ``--py-files``, do not need the former, and
    it does no harm there."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    for name, usual, ours in BATCHES:
        if spark.conf.get(name, None) == usual:
            spark.conf.set(name, ours)
    return spark


def rest() -> None:
    """Gives back memory that a task is done with, as its worker lives on: of
    Arrow's pool and, where the C library can, of the heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
