"""Result sinks: distributed CSV / Parquet writes with a row count taken in
the same job (``DataFrame.observe``), so nothing passes through the driver
and the result is not computed twice. Results are published
(:mod:`tablescope.sources.published`): a write that fails leaves the result
that was there before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tablescope.sources.published import publish


def write_result(df: DataFrame, path: str, fmt: str = "csv", *,
                 mode: str = "publish", partition_by: list[str] | None = None) -> int:
    """Write ``df`` to ``path`` and return the number of rows written.

    ``mode`` is ``publish``, or one of Spark's save modes, which write plain
    files into ``path`` itself for readers that follow no manifest;
    ``overwrite`` deletes what is there before the new files exist.
    """
    if mode == "publish":
        return publish(df, path, fmt, partition_by=partition_by).rows
    obs = Observation("rows_written")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        writer.format(fmt).save(path)
    return int(obs.get["rows"])


def write_csv(df: DataFrame, path: str, mode: str = "publish") -> int:
    return write_result(df, path, "csv", mode=mode)


def write_results(outputs: dict[str, DataFrame], out_dir: str, fmt: str = "csv", *,
                  parallel: int = 4, mode: str = "publish") -> dict[str, int]:
    """Write independent outputs, one directory each under ``out_dir``;
    return rows written per output, in the order given.

    Up to ``parallel`` writes are submitted at once from driver threads (the
    scheduler runs their jobs side by side, so one output's last tasks do
    not leave the cluster idle); a cached input shared by several outputs
    is computed once, since a cache block is built by one task while others
    wait for it.
    """
    from concurrent.futures import ThreadPoolExecutor

    base = out_dir.rstrip("/")

    def one(name: str) -> int:
        return write_result(outputs[name], f"{base}/{name}", fmt, mode=mode)

    if parallel <= 1 or len(outputs) <= 1:
        return {name: one(name) for name in outputs}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = {name: pool.submit(one, name) for name in outputs}
        return {name: f.result() for name, f in futures.items()}
