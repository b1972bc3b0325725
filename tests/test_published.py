"""Publication: a result is seen whole or not at all, and keeps its schema."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablescope.sources import published as P
from tablescope.sources.files import read_csv, read_explorer_csv, read_parquet
from tablescope.sources.registry import available_outputs, load_output
from tablescope.sources.sinks import write_csv, write_result, write_results


def data_folders(path):
    return sorted(n for n in os.listdir(path) if n.startswith("data-"))


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_failed_write_leaves_the_old_result(spark, tmp_out, fmt):
    path = f"{tmp_out}/t"
    assert write_result(spark.range(10), path, fmt) == 10
    broken = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") == 977, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="half-way"):
        write_result(broken, path, fmt)
    assert sorted(r.id for r in P.read_published(spark, path).collect()) == list(range(10))
    assert write_result(spark.range(3), path, fmt) == 3
    assert P.read_published(spark, path).count() == 3


def test_a_failure_before_the_manifest_changes_nothing(spark, tmp_out, monkeypatch):
    path = f"{tmp_out}/t"
    P.publish(spark.range(5), path)
    monkeypatch.setattr(P._Store, "write_new", lambda *a: (_ for _ in ()).throw(OSError("store is gone")))
    with pytest.raises(OSError):
        P.publish(spark.range(9), path)
    monkeypatch.undo()
    assert P.read_published(spark, path).count() == 5
    assert len(data_folders(path)) == 2  # what the failure left is not the table, nor deleted under a writer at work
    monkeypatch.setattr(P, "ABANDONED_SECONDS", -1)
    P.publish(spark.range(7), path)
    assert P.read_published(spark, path).count() == 7 and len(data_folders(path)) == 2


def test_readers_of_the_result_before_can_finish(spark, tmp_out):
    path = f"{tmp_out}/t"
    P.publish(spark.range(5), path)
    planned = P.read_published(spark, path)
    P.publish(spark.range(6), path)
    assert planned.count() == 5
    for n in range(7, 12):
        P.publish(spark.range(n), path)
    assert len(data_folders(path)) == 1 + P.KEPT
    assert P.read_published(spark, path).count() == 11 and P.manifest(spark, path).rows == 11


def test_two_writers_at_once(spark, tmp_out):
    path = f"{tmp_out}/t"
    with ThreadPoolExecutor(6) as pool:
        rows = list(pool.map(lambda n: P.publish(spark.range(n), path).rows, range(1, 13)))
    assert rows == list(range(1, 13))
    assert P.read_published(spark, path).count() == P.manifest(spark, path).rows in rows


ROWS = [
    (1, "plain", 1.5, dt.date(2024, 2, 29), dt.datetime(2024, 1, 2, 3, 4, 5, 678901), Decimal("12.30"), True, 7),
    (2, 'say "so", then', float("inf"), None, None, None, None, None),
    (3, "two\nlines\r\nand \\ a slash\\", -0.0, dt.date(1, 1, 1), dt.datetime(1970, 1, 1), Decimal("-0.01"), False, -1),
    (4, "  spaces  ", 1e300, dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), Decimal("0.00"), True, 0),
    (5, "", 0.1, None, None, None, None, None),
    (6, None, None, None, None, None, None, None),
    (7, "007", float("nan"), None, None, None, True, 2),
    (8, "é,😀", 2.0, None, None, None, None, None),
]
SCHEMA = "id bigint, s string, x double, d date, t timestamp, m decimal(10,2), b boolean, n smallint"


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_types_and_values_come_back(spark, tmp_out, fmt):
    df = spark.createDataFrame(ROWS, SCHEMA)
    P.publish(df, f"{tmp_out}/t", fmt)
    back = P.read_published(spark, f"{tmp_out}/t")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert read_csv(spark, f"{tmp_out}/t").schema == back.schema


def test_a_column_of_nulls_keeps_its_rows(spark, tmp_out):
    df = spark.createDataFrame([("a",), (None,), ("",), ("b",)], "s string")
    P.publish(df, f"{tmp_out}/t", "csv")
    assert sorted((r.s is None, r.s or "") for r in P.read_published(spark, f"{tmp_out}/t").collect()) == [
        (False, ""), (False, "a"), (False, "b"), (True, "")]


def test_partitions_empty_tables_and_names(spark, tmp_out):
    df = spark.createDataFrame([(1, "x", "p"), (2, "y", None), (3, "z", "q")], "`a.b` int, `odd ``name` string, part string")
    P.publish(df, f"{tmp_out}/p", "parquet", partition_by=["part"])
    back = P.read_published(spark, f"{tmp_out}/p")
    assert back.columns == df.columns and sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    for fmt in ("csv", "parquet"):
        assert P.publish(df.where("false"), f"{tmp_out}/{fmt}", fmt).rows == 0
        empty = P.read_published(spark, f"{tmp_out}/{fmt}")
        assert empty.count() == 0 and empty.schema.simpleString() == df.schema.simpleString()
    assert P.manifest(spark, f"{tmp_out}/nothing") is None
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, f"{tmp_out}/nothing")


def test_readers_and_registry_follow_the_manifest(spark, tmp_out):
    df = spark.createDataFrame([(1, "007"), (2, "8")], "k int, code string")
    names = {"a": ("A", ""), "b": ("B", ""), "c": ("C", "")}
    write_results({"a": df}, tmp_out, "csv")
    write_results({"a": df.where("k = 1")}, tmp_out, "csv")
    write_csv(df, f"{tmp_out}/b", mode="overwrite")
    assert set(available_outputs(spark, tmp_out, names)) == {"a", "b"}
    assert [tuple(r) for r in load_output(spark, tmp_out, "a").collect()] == [(1, "007")]  # not inferred: still text
    assert load_output(spark, tmp_out, "b").count() == 2
    assert read_csv(spark, f"{tmp_out}/a", schema="k long, code string").first()["code"] == "007"
    assert read_explorer_csv(spark, f"{tmp_out}/a").schema.simpleString() == "struct<k:bigint,code:bigint>"
    write_result(df, f"{tmp_out}/q", "parquet")
    assert read_parquet(spark, f"{tmp_out}/q").count() == 2
    assert write_result(df, f"{tmp_out}/plain", "parquet", mode="overwrite", partition_by=["code"]) == 2
    assert spark.read.parquet(f"{tmp_out}/plain").count() == 2
