"""Running totals and ranks over many tasks, and the clustered layout."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tablescope.operators import ranking as R
from tablescope.operators import segments as G
from tablescope.sources import layout as L
from tablescope.sources.published import read_published


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows in one group, null keys, null orders and values, ties."""
    rnd = random.Random(11)
    out = []
    for i in range(6000):
        g = "hot" if i % 3 == 0 else rnd.choice([None, "a", "b", "c", f"g{i % 50}"])
        out.append((i, g, None if i % 97 == 0 else i // 3, None if i % 11 == 0 else rnd.randrange(100), rnd.randrange(8)))
    rnd.shuffle(out)
    return spark.createDataFrame(out, "id int, g string, t int, v int, w int").repartition(6)


@pytest.mark.parametrize("tasks", [None, 1, 16])
def test_running_totals_equal_the_window(spark, rows, tasks):
    sums = {"total": "v", "weights": "w"}
    ordered = rows.withColumn("k", F.struct(F.col("t"), F.col("id")))  # a tie-break for the window too
    want = R.running_totals(ordered, "g", "k", sums).drop("k")
    same(G.running_totals_spread(rows, "g", "t", sums, tiebreak=["id"], tasks=tasks), want)


def test_a_hot_group_lies_over_many_tasks(spark, rows):
    placed, task, _ = G.in_segments(rows, ["g"], [F.asc_nulls_first("t")], 30)
    spread = placed.where("g = 'hot'").groupBy(task).agg(F.count(F.lit(1)).alias("n"))
    assert spread.count() >= 8 and spread.agg(F.max("n")).first()[0] < 600


def test_rows_that_tie_have_totals_of_their_own(spark):
    df = spark.createDataFrame([(1, 5, 1)] * 1000, "g int, t int, v int").repartition(5)
    got = sorted(r["total"] for r in G.running_totals_spread(df, "g", "t", {"total": "v"}, tasks=8).collect())
    assert got == list(range(1, 1001))


def test_other_types_orders_and_few_rows(spark):
    from decimal import Decimal
    df = spark.createDataFrame([("a", 1, 2, Decimal("1.10"), None), ("a", 1, 1, Decimal("2.20"), None), ("a", 2, 1, None, 5.0),
                                (None, 1, 1, Decimal("0.01"), 1.0)], "g string, h int, t int, m decimal(9,2), _tie double")
    got = sorted(map(str, G.running_totals_spread(df, ["g", "h"], "t", {"sum_m": "m", "x": "_tie"}).collect()))
    want = sorted(map(str, R.running_totals(df, ["g", "h"], "t", {"sum_m": "m", "x": "_tie"}).collect()))
    assert got == want
    back = G.running_totals_spread(df, "g", "t", {"n": "h"}, descending=True, tiebreak=["h"]).where("g = 'a'")
    assert [(r["t"], r["h"], r["n"]) for r in sorted(back.collect(), key=lambda r: r["n"])] == [(2, 1, 1), (1, 1, 2), (1, 2, 4)]
    assert G.running_totals_spread(df.where("false"), "g", "t", {"n": "h"}).count() == 0


@pytest.mark.parametrize("value", ["v", "w", "t", "id"])
def test_ranks_equal_the_window(spark, rows, value, monkeypatch):
    want = R.rank_within(rows, "g", value).withColumn("rank", F.col("rank").cast("long"))
    same(G.rank_within_spread(rows, "g", value, tasks=12), want)
    monkeypatch.setattr(G, "FREQUENT", 10**9)  # every value by broadcast
    same(G.rank_within_spread(rows, "g", value), want)


def test_ranks_of_doubles_and_few_rows(spark):
    nan = math.nan
    df = spark.createDataFrame([(1, nan), (1, nan), (1, 2.0), (1, -0.0), (1, 0.0), (1, None), (1, None), (2, 1.0), (None, 3.0)], "g int, x double")
    same(G.rank_within_spread(df, "g", "x"), R.rank_within(df, "g", "x").withColumn("rank", F.col("rank").cast("long")))
    assert G.rank_within_spread(df.where("false"), "g", "x").count() == 0
    two = spark.createDataFrame([(1, 1, 5, 0), (1, 2, 6, 0), (1, 1, 7, 0)], "a int, b int, x int, _n int")
    same(G.rank_within_spread(two, ["a", "b"], "x", name="place"), R.rank_within(two, ["a", "b"], "x", "place").withColumn(
        "place", F.col("place").cast("long")))


# ---------------------------------------------------------------------------
# Layout
# ---------------------------------------------------------------------------

def test_a_box_reads_little_of_a_clustered_table(spark, tmp_out):
    df = spark.range(0, 400_000, 1, 8).select(
        F.col("id"), (F.rand(1) * 1000).alias("x"), F.floor(F.rand(2) * 10_000).cast("int").alias("y"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    df.write.option("parquet.block.size", 1 << 17).parquet(f"{tmp_out}/plain")
    plain = spark.read.parquet(f"{tmp_out}/plain")
    L.write_clustered(plain, f"{tmp_out}/t", ["x", "y"], files=16, row_group_bytes=1 << 17)
    table = read_published(spark, f"{tmp_out}/t")
    box = {"x": (200.0, 300.0), "y": (7000, 8000)}  # a tenth of each: one row in a hundred
    chosen = F.col("x").between(200.0, 300.0) & F.col("y").between(7000, 8000)
    same(table.where(chosen).select("id"), plain.where(chosen).select("id"))
    assert table.count() == 400_000
    before, after = L.pruning(plain, box).first(), L.pruning(table, box).first()
    assert before["bytes_read"] == before["bytes"] and after["bytes"] > 0
    assert after["bytes_read"] < 0.1 * before["bytes_read"]
    one = L.pruning(table, {"y": (7000, 8000)}).first()  # a filter on either column alone prunes too
    assert one["bytes_read"] < 0.3 * one["bytes"]


def test_hot_values_nulls_and_types(spark, tmp_out):
    df = spark.range(0, 9000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id").cast("int")).alias("n"),
        F.when(F.col("id") % 5 == 0, float("nan")).otherwise(F.col("id") / 7).alias("x"),
        F.concat(F.lit("k"), (F.col("id") % 400).cast("string")).alias("s"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("d"),
        (F.col("id") % 2 == 0).alias("b"), F.lit(None).cast("int").alias("none"), F.timestamp_seconds("id").alias("ts"))
    same(L.clustered(df, ["n", "x", "s", "d", "b", "none", "ts"], bits=4, files=5), df)
    sizes = L.clustered(df, ["n", "b"], files=8).groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] < 3000  # the rows of one hot place are dealt over files
    assert L.clustered(df.where("false"), ["n"]).count() == 0
    with pytest.raises(ValueError):
        L.clustered(df, ["n"] * 11)
    with pytest.raises(ValueError):
        L.clustered(df.withColumn("a", F.array("n")), ["a"])


def test_ranks_follow_the_order(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(None,), (math.nan,)], "x double")
    key = L.curve_key(df, ["x"], bits=3)
    got = df.select("x", key.alias("k")).orderBy(F.asc_nulls_first("x")).collect()
    ranks = [r["k"] for r in got]
    assert ranks == sorted(ranks) and ranks[0] == 0 and ranks[-1] == 7
