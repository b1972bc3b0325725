"""Spark session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "tablescope",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with adaptive execution on (partition coalescing, skew-join
    splitting) and the UI off. ``master`` None leaves it to spark-submit."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint directory of this session.

    Taken from the context, else from ``spark.checkpoint.dir``. Only a
    local-mode session (tests) without either gets a fresh temporary
    directory. On a cluster an unset directory is an error, and so is one on
    the driver's own disk, unless the cluster is of this machine only.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions: the server's conf applies
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the server") from None
        return folder
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if not _shared(conf_dir, sc.master):
            raise RuntimeError(f"{conf_dir} is a folder of this machine: set spark.checkpoint.dir to a shared one, or "
                               "write file:// and its full path if every executor sees it there")
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tablescope-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared (HDFS/object store) folder")
    return sc.getCheckpointDir()


# Where machines keep temporary files of their own.
_TEMPORARY = ("/tmp", "/var/tmp", "/dev/shm")


def _shared(folder: str, master: str) -> bool:
    """A folder of a local session, of a shared store, or stated in full as a
    mounted one (``file://``); a bare path or ``file:/tmp`` on a cluster is not."""
    if master.startswith("local"):
        return True
    if folder.startswith("file:"):
        # a folder for temporary files is each machine's own, whatever this driver's is set to
        path = os.path.normpath("/" + folder.removeprefix("file:").lstrip("/"))
        return folder.startswith("file://") and not any(
            path == t or path.startswith(t + "/") for t in (*_TEMPORARY, os.path.normpath(tempfile.gettempdir())))
    return "://" in folder


#: The paths made inside each open block, innermost last.
_scratch: ContextVar[tuple[list[str], ...]] = ContextVar("tablescope_scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables materialized inside the block are deleted when it ends, but for
    those made with ``keep``. For runs that write their results; DataFrames
    that read the deleted tables are of no use after."""
    made: list[str] = []
    token = _scratch.set((*_scratch.get(), made))
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in made:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def materialize(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write ``df`` once as a Parquet table under the session's checkpoint
    folder and read it back: the lineage is cut, later passes read the
    compressed columns they need, and lost executors cost nothing. Inside
    :func:`scratch` the table lives until the block ends, or with ``keep``
    (a result) until the block around it does, if there is one."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{uuid.uuid4().hex}"
    blocks = _scratch.get()[:-1] if keep else _scratch.get()
    if blocks:
        blocks[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_observed(df: DataFrame, **metrics) -> tuple[DataFrame, dict]:
    """:func:`materialize` that also returns aggregate ``metrics`` (name ->
    aggregate column) of the written rows, computed by the same write job
    (``DataFrame.observe``), not by a second pass."""
    from pyspark.sql import Observation

    obs = Observation(f"materialize_{uuid.uuid4().hex}")
    observed = df.observe(obs, *[c.alias(n) for n, c in metrics.items()])
    return materialize(observed), dict(obs.get)
