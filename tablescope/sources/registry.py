"""Registry of named report outputs: which exist under a folder, and
loading one back as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tablescope.plans.trip_report import OUTPUTS
from tablescope.sources.published import manifest, read_published


def _exists(spark: SparkSession, path: str) -> bool:
    """Path test through the Hadoop file system of the session (works for
    HDFS and object stores, not only local disks)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def available_outputs(spark: SparkSession, out_dir: str,
                      names: Mapping[str, tuple[str, str]] = OUTPUTS) -> dict[str, tuple[str, str]]:
    """Name -> (title, description) of every registered output present under
    ``out_dir``: one that is published, or a plain folder with Spark's
    ``_SUCCESS`` marker."""
    base = out_dir.rstrip("/")
    return {n: about for n, about in names.items()
            if manifest(spark, f"{base}/{n}") is not None or _exists(spark, f"{base}/{n}/_SUCCESS")}


def load_output(spark: SparkSession, out_dir: str, name: str, fmt: str = "csv") -> DataFrame:
    """One output, with the schema it was written with. ``fmt`` is for plain
    folders only, whose CSV types are inferred; a published output states both."""
    path = f"{out_dir.rstrip('/')}/{name}"
    if manifest(spark, path) is not None:
        return read_published(spark, path)
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.format(fmt).load(path)
