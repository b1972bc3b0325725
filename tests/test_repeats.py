"""Duplicates by digest, and top-k of long texts."""

import random

import pytest
from pyspark.sql import functions as F

from tablescope.operators import ranking as R
from tablescope.operators import repeats as D


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.fixture(scope="module")
def orders(spark):
    """100,000 wide rows, one in a hundred of them twice."""
    one = spark.range(0, 100_000, 1, 8).select("id", *[F.sha2(F.concat(F.lit(str(i)), F.col("id").cast("string")), 256).alias(f"s{i}")
                                                       for i in range(4)])
    return one.unionByName(one.where("id % 100 = 0"))


def test_only_repeated_rows_move(spark, orders):
    once, maybe = D.split_by_repeats(orders)
    assert once.count() + maybe.count() == 101_000
    assert 2000 <= maybe.count() < 2000 + 101_000 / D.BITS_PER_DIGEST * 1.5
    moved = [x for x in once._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]
    assert all("(_groupingexpression" in x for x in moved)  # words of the filter only
    assert D.drop_repeated_rows(orders).count() == 100_000


def test_exact_under_forced_collisions(spark, monkeypatch):
    rows = [(i % 40, f"t{i % 7}", None if i % 3 else i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, c int")
    for digest in (F.lit(7).cast("long"), (F.col("a") % 3).cast("long"), F.xxhash64("a") % 5):
        once, maybe = D.split_by_repeats(df, digest)
        same(once.unionByName(maybe.dropDuplicates()), df.dropDuplicates())


def test_values_that_are_equal_in_more_than_one_form(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0.0, nan, [1.0], ("x", 0.0)), (-0.0, nan, [1.0], ("x", -0.0)), (None, None, None, None), (None, None, None, None),
                                (1.0, None, [], ("x", None)), (1.0, None, [], (None, None)), (1.0, None, [-0.0], ("x", 1.0)), (1.0, None, [0.0], ("x", 1.0))],
                               "x double, y float, z array<double>, s struct<a:string,b:double>")
    assert D.drop_repeated_rows(df).count() == df.dropDuplicates().count()


def test_a_hot_row_stays_spread(spark):
    df = spark.range(0, 90_000, 1, 9).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                             F.lit("x" * 50).alias("s"))
    out = D.drop_repeated_rows(df)
    assert out.count() == 60_001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("keys=[k") >= 2  # a partial aggregate before the exchange: one row of it per task


def test_few_rows_and_clashing_names(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 3), (1, 2, 4)], "_digest int, _word int, `a.b` int")
    same(D.drop_repeated_rows(df), df.dropDuplicates())
    assert D.drop_repeated_rows(df.where("false")).count() == 0


# ---------------------------------------------------------------------------
# First rows by text
# ---------------------------------------------------------------------------

def first(df, n, order):
    return [tuple(r) for r in df.orderBy(*[F.asc_nulls_first(c) for c in order]).limit(n).collect()]


def test_block_numbers_keep_the_order(spark):
    rnd = random.Random(1)
    texts = {"", "a", "a\0", "a\0\0", "ab", "abcde", "abcde\0", "abcdef", "abcdeg", "\U0001f600", "é", "zz"} | {
        "".join(rnd.choice("ab\0é") for _ in range(rnd.randrange(9))) for _ in range(200)}
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("n", R.text_block(F.col("t"), 0))
    rows = sorted(df.collect(), key=lambda r: r["t"].encode())
    assert [r["n"] for r in rows] == sorted(r["n"] for r in rows)
    ended = [r for r in rows if r["n"] % 8 <= 5]
    assert len({r["n"] for r in ended}) == len(ended) and all(len(r["t"].encode()) <= 5 for r in ended)


def test_common_prefix_of_a_million_rows(spark):
    """Exact, and the final merge sees about n rows."""
    df = spark.range(0, 1_000_000, 1, 16).select(
        F.concat(F.lit("p" * 40), F.lpad((F.col("id") * 7919 % 1_000_003).cast("string"), 7, "0")).alias("t"), "id")
    small = R._candidates(df, 50_000, ["t"])
    assert 50_000 <= small.count() <= 120_000
    got = [r["t"] for r in R.first_rows(df, 50_000, ["t"]).select("t").collect()]
    numbers = sorted(i * 7919 % 1_000_003 for i in range(1_000_000))[:50_000]
    assert got == ["p" * 40 + f"{i:07d}" for i in numbers]


def test_hot_texts_nulls_and_other_types(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, "x" * 30, "x" * 30, "x" * 30 + "y", "w", "x" * 12 + chr(97 + rnd.randrange(26)) * 9]), rnd.randrange(10**6),
             rnd.random() < 0.5, bytes([rnd.randrange(3)] * 9 + [rnd.randrange(200)])) for _ in range(30_000)]
    df = spark.createDataFrame(rows, "t string, n int, b boolean, raw binary").repartition(6)
    for order in (["t", "n"], ["raw", "n"], ["b", "t", "n"], ["b", "n"]):
        got = [tuple(r) for r in R.first_rows(df, 3000, order).select(*order).collect()]
        assert got == [tuple(r) for r in first(df.select(*order), 3000, order)], order
        if order[0] != "t":
            assert R._candidates(df, 3000, order).count() < 20_000
