"""Property checks on small random frames."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablescope.operators import explore as X
from tablescope.operators import quality as Q
from tablescope.operators.quantiles import exact_quantiles

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

groups = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                            st.one_of(st.none(), st.integers(-50, 50).map(float))),
                  min_size=1, max_size=40)


@settings(**SETTINGS)
@given(data=groups, p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]),
       bound=st.sampled_from([None, 10_000]))
def test_quantiles_match_numpy(spark, data, p, bound):
    df = spark.createDataFrame(data, "k string, v double")
    got = {r[0]: r[1] for r in exact_quantiles(df, ["k"], ["v"], [p], max_group_rows=bound).collect()}
    for k in {d[0] for d in data}:
        vals = [v for kk, v in data if kk == k and v is not None]
        want = float(np.percentile(vals, p * 100)) if vals else None
        assert (got[k] is None) if want is None else abs(got[k] - want) < 1e-9


@settings(**SETTINGS)
@given(data=groups)
def test_histogram_counts_non_null_rows(spark, data):
    df = spark.createDataFrame(data, "k string, v double")
    h = X.histogram(df, "v", bins=7)
    total = sum(r["count"] for r in h.collect())
    assert total == sum(v is not None for _, v in data)
    assert all(1 <= r["bin"] <= 7 for r in h.collect())


@settings(**SETTINGS)
@given(n=st.integers(0, 60), k=st.integers(1, 30))
def test_sample_size_is_exact(spark, n, k):
    df = spark.range(n)
    s = X.sample_rows(df, k, seed=n)
    ids = [r[0] for r in s.collect()]
    assert len(ids) == min(n, k) and len(set(ids)) == len(ids)


@settings(**SETTINGS)
@given(data=groups, lo=st.integers(-50, 50), width=st.integers(0, 60))
def test_filters_idempotent(spark, data, lo, width):
    df = spark.createDataFrame(data, "k string, v double")
    once = Q.filter_by_value(df, "v", lo, lo + width)
    assert once.count() == Q.filter_by_value(once, "v", lo, lo + width).count()
    c1 = X.category_filters(df, {"k": ["a"]})
    assert c1.count() == X.category_filters(c1, {"k": ["a"]}).count()
