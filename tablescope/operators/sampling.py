"""An exact sample from one scan, by mergeable sets of the smallest keys.

Every row draws a random key; the ``k`` smallest of all are the sample. Each
task keeps its own ``k`` smallest, and rows above the largest of those are
dropped as they come. The tasks' sets are then merged a few at a time, level by
level, until a few are left for the last cut: a task never holds more than a few
times ``k`` rows, however large ``k`` is, and the input is read once, without a
count of its rows. What leaves the scan is up to ``k`` rows a task, so for an
input whose rows are counted without reading them (Parquet) and a small ``k``,
:func:`explore.sample_rows` moves less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescope.functions.columns import internal
from tablescope.session import materialize, materialize_observed

#: Sets merged by one task of the next level.
FAN = 4


def _cut(batches: list[pa.RecordBatch], key: int, k: int) -> tuple[list[pa.RecordBatch], float]:
    """The ``k`` rows of smallest key (all, if fewer), and their largest key."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    keys = rows.column(key).to_numpy()
    if len(keys) > k:
        at = np.argpartition(keys, k - 1)[:k]
        rows, keys = rows.take(pa.array(np.sort(at))), keys[at]
    return rows.to_batches(), float(keys.max()) if len(keys) else 0.0


def smallest(k: int, key: int):
    """Batches of a task's ``k`` rows whose column ``key`` is smallest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows, most = [], 0, np.inf
        for batch in batches:
            if rows >= k:
                batch = batch.filter(pa.array(batch.column(key).to_numpy() < most))
            for a in range(0, batch.num_rows, k):  # a batch may be larger than the sample
                part = batch.slice(a, k)
                kept.append(part)
                rows += part.num_rows
                if rows >= 2 * k:
                    kept, most = _cut(kept, key, k)
                    rows = k
        if kept:
            yield from _cut(kept, key, k)[0]
    return run


def sample_one_scan(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(k, n)`` rows drawn uniformly without replacement, from one
    scan of ``df``; the sets of each level are written as small tables, and no
    rows are counted beforehand."""
    if k <= 0:
        return df.where(F.lit(False))
    r = internal("_r", df.columns)
    task = internal("_task", [*df.columns, r])
    keyed = df.withColumn(r, F.rand(seed))
    keep = smallest(k, len(df.columns))
    sets, seen = materialize_observed(keyed.mapInArrow(keep, keyed.schema).withColumn(task, F.spark_partition_id()),
                                      tasks=F.max(task))
    parts = (seen["tasks"] or 0) + 1
    while parts > FAN:
        parts = -(-parts // FAN)
        sets = materialize(sets.drop(task).repartition(parts, F.pmod(F.xxhash64(r), F.lit(parts)))
                           .mapInArrow(keep, keyed.schema).withColumn(task, F.spark_partition_id()))
    return sets.drop(task).orderBy(r).limit(k).drop(r)
