"""A key holding a third of all rows (and, inside it, one value repeated
thousands of times) must not land in one task, and results stay exact."""

import numpy as np
from pyspark.sql import functions as F

from tablescope.operators import explore as X
from tablescope.operators import quantiles as Q
from tablescope.operators.quantiles import (_quantiles_by_sort, _ranked_values, exact_quantiles,
                                             split_by_group_size)


def skewed(spark, n=30000):
    rng = np.random.default_rng(1)
    hot = [("hot", 5.0 if i % 2 else float(rng.integers(0, 1000))) for i in range(n // 3)]
    cold = [(f"k{i % 50}", float(rng.integers(0, 1000))) for i in range(n - n // 3)]
    return spark.createDataFrame(hot + cold, "k string, v double").repartition(8), hot + cold


def test_hot_group_and_hot_value_spread_over_range_partitions(spark):
    # tiny data: keep AQE from coalescing the range partitions into one
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        df, _ = skewed(spark)
        ranked = _ranked_values(df, ["k"], "v", seed=3)
    finally:
        spark.conf.set(key, old)
    parts = (ranked.filter(F.col("k") == "hot")
                   .select(F.shiftright("_id", 33).alias("p")).distinct().count())
    assert parts >= 3  # the hot group (and its repeated value 5.0) is split
    hot5 = (ranked.filter((F.col("k") == "hot") & (F.col("_v") == 5.0))
                  .select(F.shiftright("_id", 33).alias("p")).distinct().count())
    assert hot5 >= 2


def test_quantiles_exact_under_skew(spark):
    df, data = skewed(spark)
    got = {r["k"]: (r["q1"], r["med"], r["q3"]) for r in exact_quantiles(
        df, ["k"], ["v"], [0.25, 0.5, 0.75],
        names={("v", 0.25): "q1", ("v", 0.5): "med", ("v", 0.75): "q3"},
        # the hot group exceeds the bound in rows and in distinct values: sort path
        max_group_rows=500).collect()}
    for k in ("hot", "k0", "k49"):
        vals = np.array([v for kk, v in data if kk == k])
        want = tuple(float(np.percentile(vals, p)) for p in (25, 50, 75))
        assert np.allclose(got[k], want, rtol=0, atol=1e-9), (k, got[k], want)


def test_few_distinct_values_stay_in_memory_under_skew(spark):
    # the hot group has 10,000 rows; "c" has 4 distinct values, "v" ~1,000
    df, data = skewed(spark)
    df = df.withColumn("c", (F.col("v") % 4).cast("int"))
    assert split_by_group_size(df, ["k"], ["c", "v"], 5000) == (["c", "v"], [])
    assert split_by_group_size(df, ["k"], ["c", "v"], 500) == (["c"], ["v"])
    assert split_by_group_size(df, [], ["c", "v"], 500) == (["c"], ["v"])
    names = {("c", 0.5): "c_med", ("v", 0.5): "v_med", ("v", 0.9): "v_p90", ("c", 0.9): "c_p90"}
    mixed = exact_quantiles(df, ["k"], ["c", "v"], [0.5, 0.9], names=names, max_group_rows=500)
    assert mixed.columns == ["k", "c_med", "c_p90", "v_med", "v_p90"]
    got = {r["k"]: tuple(r)[1:] for r in mixed.collect()}
    for k in ("hot", "k0", "k49"):
        v = np.array([x for kk, x in data if kk == k])
        want = (np.percentile(v % 4, 50), np.percentile(v % 4, 90), np.percentile(v, 50), np.percentile(v, 90))
        assert np.allclose(got[k], want, rtol=0, atol=1e-9), (k, got[k], want)
    flat = exact_quantiles(df, [], ["c", "v"], [0.5], max_group_rows=500).first()
    v = np.array([x for _, x in data])
    assert np.allclose(tuple(flat), (np.percentile(v % 4, 50), np.percentile(v, 50)), rtol=0, atol=1e-9)


def test_selection_narrows_a_hot_group_exactly(spark, monkeypatch):
    # brackets must narrow over several rounds (at most 300 values or
    # distinct values gathered); the hot value 5.0 fills half the hot group,
    # so only the distinct-value bound lets its bracket stop
    def no_sort(*a, **k):
        raise AssertionError("fell back to the sort path")
    monkeypatch.setattr(Q, "_quantiles_by_sort", no_sort)
    rounds = []
    real_round = Q._round
    monkeypatch.setattr(Q, "_round", lambda *a, **k: rounds.append(1) or real_round(*a, **k))
    df, data = skewed(spark, n=6000)
    df = df.withColumn("w", F.when(F.col("v") != 5.0, F.col("v") / 3))
    probs = [0.0, 0.3, 0.5, 1.0]
    got = {r[0]: r[1:] for r in Q._quantiles_by_selection(df, ["k"], ["v", "w"], probs, {},
                                                           max_fetch=300).collect()}
    assert len(rounds) >= 2
    for k in ("hot", "k0", "k49"):
        v = np.array([x for kk, x in data if kk == k])
        w = v[v != 5.0] / 3
        want = [np.percentile(v, p * 100) for p in probs] + [np.percentile(w, p * 100) for p in probs]
        assert np.allclose(got[k], want, rtol=0, atol=1e-9), (k, got[k], want)
    flat = Q._quantiles_by_selection(df, [], ["v"], [0.5], {}, max_fetch=300).first()[0]
    assert abs(flat - np.percentile([x for _, x in data], 50)) < 1e-9


def test_dedupe_and_group_sizes_under_skew(spark):
    df, data = skewed(spark)
    assert df.dropDuplicates().count() == len(set(data))
    sizes = {r["k"]: r["count"] for r in X.group_sizes(df, ["k"]).collect()}
    assert sizes["hot"] == 10000


def test_all_quantile_paths_agree(spark):
    df, _ = skewed(spark, n=3000)
    df = df.withColumn("w", F.col("v") * 2 + 1)
    a = exact_quantiles(df, ["k"], ["v", "w"], [0.1, 0.5, 0.9], max_group_rows=None)  # selection
    b = exact_quantiles(df, ["k"], ["v", "w"], [0.1, 0.5, 0.9])  # sorted arrays
    c = _quantiles_by_sort(df, ["k"], ["v", "w"], [0.1, 0.5, 0.9], {}, seed=5)
    d = Q._quantiles_in_memory(df, ["k"], ["v", "w"], [0.1, 0.5, 0.9], {})  # percentile
    ra, rb, rc, rd = ({r[0]: r[1:] for r in x.collect()} for x in (a, b, c, d))
    assert ra.keys() == rb.keys() == rc.keys() == rd.keys()
    for k in ra:
        for other in (ra, rc, rd):
            assert np.allclose(other[k], rb[k], rtol=0, atol=1e-9), k
    flat_a = exact_quantiles(df, [], ["v"], [0.5], max_group_rows=None).first()[0]
    flat_b = exact_quantiles(df, [], ["v"], [0.5]).first()[0]
    assert abs(flat_a - flat_b) < 1e-9


def test_first_rows_with_a_hot_leading_value(spark):
    from tablescope.operators.ranking import first_rows
    # a third of the rows share the smallest date-like key; ties broken by b, then c
    hot = [(0, (i * 7) % 9000, i % 5) for i in range(9000)]
    cold = [(1 + i % 400, i, 0) for i in range(18000)]
    nulls = [(None, i, 1) for i in range(300)]
    data = hot + cold + nulls
    df = spark.createDataFrame(data, "a int, b int, c int").repartition(6)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    for n in (1200, 4000):  # 1200: the hot block (9000 rows > 4n) is narrowed on b
        want = sorted(data, key=key)[:n]
        got = [tuple(r) for r in first_rows(df, n, ["a", "b", "c"]).collect()]
        assert got == want, n


def test_first_rows_identical_hot_rows(spark):
    from tablescope.operators.ranking import first_rows
    data = [(0, 0)] * 12000 + [(1, i) for i in range(3000)]
    df = spark.createDataFrame(data, "a int, b int").repartition(4)
    for n in (1500, 5000):  # 1500: narrowed on b, then on the row hash, then repeated
        got = [tuple(r) for r in first_rows(df, n, ["a", "b"]).collect()]
        assert got == [(0, 0)] * n, n


def test_first_rows_key_beyond_double_precision(spark):
    from tablescope.operators.ranking import first_rows
    base = 2 ** 60
    data = [(base + i * 3, i) for i in range(6000)]
    df = spark.createDataFrame(data, "a bigint, b int").repartition(3)
    got = [tuple(r) for r in first_rows(df, 1200, ["a", "b"]).collect()]
    assert got == sorted(data)[:1200]


def test_rows_without_a_key_stay_out_of_a_large_lookup_join(spark):
    """Above the broadcast bound, null and unparsable keys do not meet in one partition."""
    from tablescope.operators.enrich import Lookup, enrich
    rows = [(i, None if i % 3 == 0 else "x" if i % 3 == 1 else str(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, key string")
    side = spark.createDataFrame([(i, f"n{i}", i / 2) for i in range(5)], "k int, name string, half double")
    lookup = Lookup(side, "k", 10**9)
    out = enrich(df, "key", lookup)
    small = enrich(df, "key", Lookup(side, "k", 5))
    assert out.columns == small.columns == ["id", "key", "name", "half"]
    assert sorted(map(str, out.collect())) == sorted(map(str, small.collect()))
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()
