"""Bounds from footers equal those of a scan, and read no column data."""

import glob
import math
import os
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablescope.operators import explore as X
from tablescope.sources import footers as B
from tests.conftest import SMALL


def scanned(df, cols=None):
    return sorted(tuple(r) for r in X.numeric_bounds(df, cols).collect())


def from_footers(df, cols=None):
    return sorted(tuple(r) for r in X.numeric_bounds(df, cols, footers=True).collect())


def blank_columns(folder):
    """Overwrite everything but the magic and the footer of each file."""
    for path in glob.glob(f"{folder}/*.parquet"):
        raw = open(path, "rb").read()
        size = int.from_bytes(raw[-8:-4], "little")
        with open(path, "wb") as f:
            f.write(raw[:4] + bytes(len(raw) - 12 - size) + raw[-8 - size:])
        crc = os.path.join(folder, f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_shared_tables(spark):
    for name in ("lineitem", "orders", "part", "customer", "events"):
        df = spark.read.parquet(f"{SMALL}/{name}.parquet")
        assert from_footers(df) == scanned(df), name


def test_no_column_data_is_read(spark, tmp_out):
    df = spark.range(0, 1000, 1, 5).select(F.col("id"), (F.col("id") * 0.25 - 7).alias("x"), F.lit(3).alias("c"))
    df.write.parquet(f"{tmp_out}/t")
    table = spark.read.parquet(f"{tmp_out}/t")
    want = scanned(table)
    blank_columns(f"{tmp_out}/t")
    assert from_footers(table) == want
    assert X.varying_columns(table, ["id", "x", "c"], footers=True) == ["id", "x"]
    assert B.table_bounds(table)["id"] == B.Bounds("id", 1000, 0.0, 999.0, 0)
    with pytest.raises(Exception):
        table.agg(F.sum("x")).collect()


def write(folder, name, columns, **options):
    os.makedirs(folder, exist_ok=True)
    pq.write_table(pa.table(columns), f"{folder}/{name}.parquet", **options)


def test_mixed_files(spark, tmp_out):
    """NaN, nulls only, no rows, no statistics, some row groups without."""
    nan, inf = math.nan, math.inf
    f64, i32 = pa.float64(), pa.int32()

    def col(x, y, n):
        return {"x": pa.array(x, f64), "y": pa.array(y, f64), "n": pa.array(n, i32)}

    write(tmp_out, "plain", col([1.0, 2.0, None], [5.0, nan, 6.0], [1, 2, 3]))
    write(tmp_out, "nans", col([nan, nan], [nan, None], [None, None]))
    write(tmp_out, "nulls", col([None] * 3, [None] * 3, [7] * 3))
    write(tmp_out, "empty", col([], [], []))
    write(tmp_out, "bare", col([-50.0, 99.5], [nan, 3.0], [-9, 9]), write_statistics=False)
    write(tmp_out, "groups", col([4.0, nan, None, 0.0], [-0.0, 0.0, inf, nan], [4, 5, 6, 7]), row_group_size=1)
    write(tmp_out, "some", col([1e3] * 4, [1e3] * 4, [1] * 4), write_statistics=["x"])
    df = spark.read.parquet(tmp_out)
    assert from_footers(df) == scanned(df) == [("n", -9.0, 9.0), ("x", -50.0, 1000.0), ("y", 0.0, inf)]
    assert B.table_bounds(df)["n"].rows == df.count()
    only = spark.read.parquet(f"{tmp_out}/nans.parquet", f"{tmp_out}/nulls.parquet")
    assert from_footers(only) == scanned(only) == [("n", 7.0, 7.0), ("x", None, None), ("y", None, None)]


def test_spark_files_with_nan(spark, tmp_out):
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, -0.0), (None, 0.0), (5.0, float("nan"))], "x double, y double")
    df.repartition(2).write.parquet(f"{tmp_out}/t")
    table = spark.read.parquet(f"{tmp_out}/t")
    assert from_footers(table) == scanned(table) == [("x", 2.0, 5.0), ("y", 0.0, 1.0)]


def test_types_partitions_and_names(spark, tmp_out):
    df = spark.createDataFrame([(1, 2, Decimal("1.50"), 2.5, "a", 10), (-3, 9, Decimal("-7.25"), 0.1, "b", 20)],
                               "b tinyint, l long, m decimal(9,2), f float, s string, part int")
    df.write.partitionBy("part").parquet(f"{tmp_out}/p")
    table = spark.read.parquet(f"{tmp_out}/p")
    assert from_footers(table) == scanned(table)
    renamed = spark.read.parquet(f"{tmp_out}/p").select(F.col("l").alias("long"))
    assert B.table_bounds(renamed, {"long": "l"})["long"].high == 9.0
    with pytest.raises(ValueError):
        B.table_bounds(table, ["s"])
    # a column that some files lack (null there), and one in other letters
    spark.range(3).select(F.col("id").alias("K")).write.parquet(f"{tmp_out}/q/1")
    spark.range(5, 9).select(F.col("id").alias("k"), F.col("id").alias("more")).write.parquet(f"{tmp_out}/q/2")
    both = spark.read.schema("k long, more long").parquet(f"{tmp_out}/q/1", f"{tmp_out}/q/2")
    assert from_footers(both) == scanned(both) == [("k", 0.0, 8.0), ("more", 5.0, 8.0)]


def test_unreadable_stores_are_scanned(spark, tmp_out, monkeypatch):
    spark.range(10).write.parquet(f"{tmp_out}/t")
    table = spark.read.parquet(f"{tmp_out}/t")
    assert B.footer_rows("nostore://x/y.parquet", ["id"]) == [("nostore://x/y.parquet", "id", 0, None, None, None, False)]
    rows = [(f, "id", 0, None, None, None, False) for f in table.inputFiles()]
    monkeypatch.setattr(B, "_read", lambda columns: (lambda batches: iter([pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(
            [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()])],
        names=[n.split()[0] for n in B._FOUND.split(", ")])])))
    assert B.table_bounds(table)["id"] == B.Bounds("id", 10, 0.0, 9.0, 0)


def test_explorer_operators(spark, tmp_out):
    df = spark.range(100).select("id", (F.col("id") % 10 * 1.5).alias("x"), F.lit(5).alias("same"),
                                 F.col("id").cast("string").alias("text"))
    df.write.parquet(f"{tmp_out}/t")
    table = spark.read.parquet(f"{tmp_out}/t")
    for color in (None, "same"):
        assert sorted(X.histogram(table, "x", color=color).collect()) == sorted(X.histogram(table, "x", color=color, footers=True).collect())
    ranges = {"id": (10, 60), "same": (0, 1), "text": (0, 30)}
    assert X.range_filters(table, ranges, footers=True).count() == X.range_filters(table, ranges).count() == 21
    from tablescope.plans.explorer import controls
    found = controls(table, footers=True)
    assert sorted(found.bounds.collect()) == sorted(X.numeric_bounds(table).collect())
    assert [r["column"] for r in found.categories.collect()] == ["text"]
    none = table.where("false")
    none.write.parquet(f"{tmp_out}/none")
    empty = spark.read.parquet(f"{tmp_out}/none")
    assert from_footers(empty) == scanned(empty) and X.histogram(empty, "x", footers=True).count() == 0


# ---------------------------------------------------------------------------
# Bounded sets
# ---------------------------------------------------------------------------

def test_low_cardinality_equals_counts(spark):
    rows = [(f"u{i}", f"v{i % 50}", f"w{i % 51}", None, "x" if i % 3 else None, f"p{i // 100}") for i in range(5000)]
    df = spark.createDataFrame(rows, "unique string, fifty string, more string, none string, one string, blocks string").repartition(7)
    got = {r["column"]: r for r in X.low_cardinality(df).collect()}
    want = {r["column"]: r for r in X.distinct_counts(df).collect()}
    assert set(got) == set(want)
    for c in want:
        assert got[c]["low_cardinality"] == want[c]["low_cardinality"], c
        if want[c]["low_cardinality"]:
            assert got[c]["n_distinct"] == want[c]["n_distinct"]
            assert got[c]["values"] == sorted(r[0] for r in X.distinct_values(df, c).collect())
        else:
            assert got[c]["n_distinct"] is None and got[c]["values"] is None


def test_few_values_leave_a_task():
    import numpy as np
    batches = [pa.RecordBatch.from_arrays([pa.array([f"u{i}" for i in range(a, a + 1000)]), pa.array([f"v{i % 3}" for i in range(1000)]),
                                           pa.array([f"w{i}" for i in np.arange(30) + a // 100])[:30].take(pa.array([i % 30 for i in range(1000)]))],
                                          names=["c0", "c1", "c2"]) for a in range(0, 5000, 1000)]
    out = pa.Table.from_batches(X._few_values(["u", "v", "w"], 50)(iter(batches))).to_pylist()
    assert [r for r in out if r["column"] == "u"] == [{"column": "u", "value": None}]
    assert [r["value"] for r in out if r["column"] == "v"] == ["v0", "v1", "v2"]
    assert [r for r in out if r["column"] == "w"] == [{"column": "w", "value": None}]
    assert len(out) == 5


def test_low_cardinality_of_few_rows(spark):
    empty = spark.createDataFrame([], "a string, n int")
    assert [tuple(r) for r in X.low_cardinality(empty).collect()] == [("a", True, 0, [])]
    assert X.low_cardinality(empty.select("n")).count() == 0
    days = spark.sql("select date'2024-01-02' as d union all select date'2024-01-01' union all select null")
    assert X.low_cardinality(days, ["d"]).first()["values"] == ["2024-01-01", "2024-01-02"]
    assert X.low_cardinality(days, ["d"], low=1).first()["low_cardinality"] is False
