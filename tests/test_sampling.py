"""An exact sample from one scan."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tablescope.operators import sampling as S


def test_exact_size_and_rows(spark):
    df = spark.range(0, 50_000, 1, 23).select("id", (F.col("id") * 2).alias("_r"), F.lit("x").alias("_task"))
    for k in (1, 7, 3000, 49_999, 50_000, 60_000):
        got = S.sample_one_scan(df, k, seed=k)
        assert got.columns == df.columns
        ids = [r["id"] for r in got.collect()]
        assert len(ids) == len(set(ids)) == min(k, 50_000)
        assert all(r["_r"] == 2 * r["id"] for r in got.take(20))
    assert S.sample_one_scan(df, 0).count() == 0
    assert S.sample_one_scan(df.where("false"), 5).count() == 0


def test_every_row_has_the_same_chance(spark):
    """Counts of 40 draws of a tenth over ten blocks of uneven tasks."""
    df = spark.range(0, 2000, 1, 3).unionByName(spark.range(2000, 4000, 1, 17))
    drawn = np.zeros(4000)
    for seed in range(40):
        drawn[[r["id"] for r in S.sample_one_scan(df, 400, seed=seed).collect()]] += 1
    blocks = drawn.reshape(10, 400).sum(axis=1)  # 1,600 each on average, deviation about 36
    assert drawn.sum() == 40 * 400 and abs(blocks - 1600).max() < 180
    assert drawn.max() <= 16


def test_a_task_holds_a_few_times_k_rows(monkeypatch):
    held = []
    whole = S._cut

    def cut(batches, key, k):
        held.append(sum(b.num_rows for b in batches))
        return whole(batches, key, k)

    monkeypatch.setattr(S, "_cut", cut)
    rng = np.random.default_rng(3)
    keys = rng.random(200_000)
    batches = (pa.RecordBatch.from_arrays([pa.array(np.arange(a, a + 5000)), pa.array(keys[a:a + 5000])], names=["id", "r"])
               for a in range(0, 200_000, 5000))
    out = pa.Table.from_batches(S.smallest(1000, 1)(batches))
    assert sorted(out.column("id").to_pylist()) == sorted(np.argsort(keys)[:1000].tolist())
    assert max(held) <= 3000


def test_the_source_is_read_once(spark):
    df = spark.range(0, 1000, 1, 9).select("id", F.rand().alias("x"))
    plan = S.sample_one_scan(df, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan  # what is left reads the sets that the scan wrote
