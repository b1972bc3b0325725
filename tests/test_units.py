"""Micro-fixtures, one per semantic rule (see FIXTURES.md section 6)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablescope.functions import columns as C
from tablescope.functions.labels import OUTLIER_REASONS, PIVOT_LABELS, time_of_day
from tablescope.functions.timeparts import with_time_parts
from tablescope.operators import aggregate as A
from tablescope.operators import explore as X
from tablescope.operators import quality as Q
from tablescope.operators import ranking as R
from tablescope.operators.enrich import Lookup, broadcastable, enrich
from tablescope.operators.quantiles import exact_quantiles
from tablescope.plans import trip_report as tr
from tablescope.sources.lookups import payment_lookup, vendor_lookup

TRIP_SCHEMA = ("vendor_id int, pickup_datetime timestamp, passenger_count int, "
               "trip_distance double, payment_type int, fare_amount double")


def rows(df, order=None):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# -- dirty_names -------------------------------------------------------------

def test_normalise_names(spark):
    df = spark.createDataFrame([(1, 2.0)], "` VendorID` int, `Fare Amount` double")
    assert C.normalise_columns(df).columns == ["vendorid", "fare_amount"]


def test_normalise_clash_is_rejected(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, a_b int")
    with pytest.raises(ValueError, match="clash"):
        C.normalise_columns(df)


def test_roles_first_match_in_schema_order():
    cols = ["vendor_id", "tpep_pickup_datetime", "total_amount", "fare_amount",
            "trip_distance", "payment_type"]
    assert C.find_role(cols, "timestamp") == "tpep_pickup_datetime"
    assert C.find_role(cols, "fare") == "total_amount"
    assert C.find_role(cols, "distance") == "trip_distance"
    assert C.group_role(cols) == "payment_type"
    assert C.group_role(["vendor_id"]) == "vendor_id"
    assert C.find_role(["a"], "fare") is None


# -- padded ------------------------------------------------------------------

def test_trim_dedupe_dropna(spark):
    data = [("a ", 1), ("a", 1), ("\t a", 1), ("   ", 2), (None, 3), (None, None),
            (None, None), ("x", 5), ("x", 5)]
    df = spark.createDataFrame(data, "s string, n int")
    out = rows(Q.clean_dataframe(df), ["s", "n"])
    # spaces trimmed (tab kept), "a " and "a" merge, blank -> "" survives,
    # the all-null rows go, exact duplicates collapse
    assert out == [(None, 3), ("", 2), ("\t a", 1), ("a", 1), ("x", 5)]


def test_trim_only_strings(spark):
    df = spark.createDataFrame([(" a ", 1)], "s string, n int")
    assert rows(Q.trim_strings(df)) == [("a", 1)]


# -- bad_text ----------------------------------------------------------------

def test_bad_timestamp_text_becomes_null(spark):
    df = spark.createDataFrame([("junk",), ("",), ("2024-01-02 03:04:05",)], "pickup_time string")
    out = with_time_parts(df, "pickup_time").select("hour", "date", "month")
    got = sorted(rows(out), key=str)
    assert (3, dt.date(2024, 1, 2), "2024-01") in got
    assert got.count((None, None, None)) == 2


def test_enrich_bad_and_unmatched_keys(spark):
    df = spark.createDataFrame([("CMT",), ("1",), (None,), ("2",), ("7",)], "vendor string")
    out = enrich(df, "vendor", vendor_lookup(spark))
    got = dict(rows(out))
    assert got == {"CMT": None, "1": "Creative Mobile Technologies", None: None,
                   "2": "VeriFone Inc", "7": None}
    assert out.columns == ["vendor", "vendor_name"]


def test_broadcast_bound_is_checked(spark):
    big = spark.range(100)
    assert broadcastable(big, max_rows=100)
    assert not broadcastable(big, max_rows=99)
    assert broadcastable(Lookup(big, "id", 100), max_rows=100)


# -- null_hour ---------------------------------------------------------------

HOURS = [None, 0, 4, 5, 6, 7, 9, 10, 15, 16, 19, 20, 23]


def test_time_of_day_buckets(spark):
    df = spark.createDataFrame([(h,) for h in HOURS], "hour int")
    got = dict(rows(df.select("hour", time_of_day("hour").alias("s"))))
    assert got == {None: "Early Morning", 0: "Night", 4: "Night", 5: "Early Morning",
                   6: "Early Morning", 7: "Morning Rush", 9: "Morning Rush", 10: "Daytime",
                   15: "Daytime", 16: "Evening Rush", 19: "Evening Rush", 20: "Night",
                   23: "Night"}
    own = dict(rows(df.select("hour", time_of_day("hour", null_label="Unknown").alias("s"))))
    assert own[None] == "Unknown" and own[5] == "Early Morning"


def test_pivot_keeps_null_hour_and_zero_fills_values(spark):
    df = spark.createDataFrame([(h, 1.005 if h is None else 2.0) for h in HOURS],
                               "hour int, fare double")
    out = A.hour_session_pivot(A.trip_cube(df, ["hour"], fare="fare"))
    assert out.columns == ["hour", *PIVOT_LABELS]
    got = {r[0]: r[1:] for r in out.collect()}
    assert len(got) == len(HOURS)  # null hour is its own row, not merged into 0
    assert got[None] == (0.0, 0.0, 0.0, 0.0, 1.01)
    assert got[0] == (0.0, 0.0, 0.0, 2.0, 0.0)
    assert got[7] == (2.0, 0.0, 0.0, 0.0, 0.0)


# -- edge_fares --------------------------------------------------------------

def test_sanity_filter_inclusive_and_null(spark):
    fares = [0.0, 0.009, 0.01, 0.99, 1.0, 500.0, 500.01, None]
    df = spark.createDataFrame([(f, 1.0, 2) for f in fares], "fare double, dist double, passenger_count int")
    out = Q.sanity_filter(df, Q.trip_bounds("fare", "dist"))
    assert sorted(r[0] for r in out.collect()) == [0.01, 0.99, 1.0, 500.0]
    pax = spark.createDataFrame([(5.0, 1.0, p) for p in [0, 1, 5, 6, 7]], "fare double, dist double, passenger_count int")
    assert sorted(r[2] for r in Q.sanity_filter(pax, Q.trip_bounds("fare", "dist")).collect()) == [1, 5, 6]


def test_outlier_reason_priority(spark):
    data = [(float(v), 1) for v in [10] * 30] + [(1000.0, 7), (0.5, 7), (10.0, 7)]
    df = spark.createDataFrame(data, "fare double, passenger_count int")
    out = rows(Q.outliers(df, "fare", extra=["passenger_count"]), ["fare"])
    high, low, crowd = OUTLIER_REASONS
    assert out == [(low, 0.5, 7), (crowd, 10.0, 7), (high, 1000.0, 7)]


# -- tiny --------------------------------------------------------------------

def test_stats_on_tiny_tables(spark):
    empty = spark.createDataFrame([], "fare double, passenger_count int")
    assert rows(Q.column_stats(empty, "fare")) == [(None, None)]
    assert Q.outliers(empty, "fare").count() == 0
    one = spark.createDataFrame([(0.5, 7)], "fare double, passenger_count int")
    assert rows(Q.column_stats(one, "fare")) == [(0.5, None)]
    # null threshold: sigma rule off, the others still fire
    assert rows(Q.outliers(one, "fare", extra=[])) == [(OUTLIER_REASONS[1], 0.5)]


# -- no_passengers -----------------------------------------------------------

def test_trip_table_without_passengers(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 8), 2.0, 0.5)],
                               "pickup_datetime timestamp, trip_distance double, fare_amount double")
    t = tr.load_and_clean(df)
    assert t.passengers is None
    assert rows(tr.outliers(t).select("outlier_reason")) == [(OUTLIER_REASONS[1],)]
    assert "total_passengers" not in tr.time_series(t).columns
    with pytest.raises(ValueError):
        tr.daily(t)  # no payment or vendor column


# -- rank_ties / gap_days ----------------------------------------------------

def test_rank_ties_leave_gap(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(d, 1, 5.0), (d, 2, 5.0), (d, 3, 1.0)], "date date, g int, daily_revenue double")
    assert rows(R.rank_within(df, "date", "daily_revenue").select("g", "rank"), ["g"]) == [(1, 1), (2, 1), (3, 3)]


def test_running_totals_skip_gaps(spark):
    d = [dt.date(2024, 1, i) for i in (1, 2, 3)]
    df = spark.createDataFrame([(d[0], 1, 1.0, 1), (d[2], 1, 2.0, 2), (d[0], 2, 5.0, 5),
                                (d[1], 2, 1.0, 1), (d[2], 2, 1.0, 1)],
                               "date date, g int, daily_revenue double, trip_count bigint")
    out = R.running_totals(df, "g", "date", {"cum_rev": "daily_revenue", "cum_trips": "trip_count"})
    got = rows(out.select("g", "date", "cum_rev", "cum_trips"), ["g", "date"])
    assert got == [(1, d[0], 1.0, 1), (1, d[2], 3.0, 3), (2, d[0], 5.0, 5), (2, d[1], 6.0, 6), (2, d[2], 7.0, 7)]


# -- null_keys ---------------------------------------------------------------

def test_null_group_rules(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None), (None, 4.0)], "k string, v double")
    # Spark-style summary keeps the null group
    assert {r[0] for r in A.compute_summary(df, "k").collect()} == {"a", "b", None}
    # explorer group-by drops null keys, sum of all-null is 0
    got = rows(X.group_aggregate(df, ["k"], ["v"], "sum"), ["k"])
    assert got == [("a", 3.0), ("b", 0.0)]
    assert rows(X.group_aggregate(df, ["k"], ["v"], "mean"), ["k"]) == [("a", 1.5), ("b", None)]
    assert rows(X.group_aggregate(df, ["k"], ["v"], "count"), ["k"]) == [("a", 2), ("b", 0)]
    assert rows(X.group_aggregate(df, ["k"], ["v"], "median"), ["k"]) == [("a", 1.5), ("b", None)]
    assert rows(X.group_sizes(df, ["k"]), ["k"]) == [("a", 2), ("b", 1)]


def test_group_aggregate_sorted_desc(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 5.0), ("c", 3.0)], "k string, v double")
    assert [r[0] for r in X.group_aggregate(df, ["k"], ["v"], "max").collect()] == ["b", "c", "a"]
    with pytest.raises(ValueError):
        X.group_aggregate(df, ["k"], ["v"], "mode")


# -- wide_types --------------------------------------------------------------

def test_type_classes(spark):
    df = spark.createDataFrame(
        [(1, 2, 3, 4, 1.0, 2.0, Decimal("1.5"), True, "s", dt.date(2024, 1, 1))],
        "a tinyint, b smallint, c int, d bigint, e float, f double, g decimal(5,2), "
        "h boolean, i string, j date")
    assert C.numeric_columns(df) == list("abcdefg")
    assert C.string_columns(df) == ["i"]
    assert C.string_columns(df, include_dates=True) == ["i", "j"]


def test_summary_includes_every_numeric_width(spark):
    df = spark.createDataFrame([(1, Decimal("1.50"), "x")], "a smallint, g decimal(5,2), k string")
    out = A.compute_summary(df)
    assert out.columns[0] == "k"
    assert {"a_sum", "g_sum", "a_max", "g_avg"} <= set(out.columns)


def test_summary_fallthroughs(spark):
    nums = spark.createDataFrame([(1, 2.0), (3, 4.0)], "a int, b double")
    assert rows(A.compute_summary(nums).select("a_count", "a_sum", "b_max")) == [(2, 4.0, 4.0)]
    strs = spark.createDataFrame([("x",)], "s string")
    assert A.compute_summary(strs) is strs


# -- month_clash -------------------------------------------------------------

def test_monthly_series_ignores_month_column(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5), 7, 1.0), (dt.date(2024, 1, 9), 8, 2.0),
                                (dt.date(2024, 2, 1), 9, 3.0)], "date date, month int, v double")
    out = A.compute_time_series(df, "date")
    assert out.columns == ["month", "v_total", "row_count"]
    assert rows(out) == [("2024-01", 3.0, 2), ("2024-02", 3.0, 1)]


# -- even_median -------------------------------------------------------------

def test_even_median_and_quartiles(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 10)], "k string, v double")
    q = exact_quantiles(df, ["k"], ["v"], [0.25, 0.5, 0.75])
    assert rows(q) == [("g", 1.75, 2.5, 4.75)]
    box = X.box_stats(df, "v", by="k").collect()[0].asDict()
    assert (box["q1"], box["median"], box["q3"]) == (1.75, 2.5, 4.75)
    # IQR 3 -> fences -2.75 and 9.25: 10 is outside
    assert (box["lower_whisker"], box["upper_whisker"], box["n_outliers"]) == (1.0, 3.0, 1)
    flat = X.box_stats(df, "v").collect()[0].asDict()
    assert flat["median"] == 2.5 and flat["n"] == 4 and flat["n_outliers"] == 1


def test_box_from_sorted_arrays_equals_two_pass_box(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    data = [(f"g{i % 4}", float(rng.normal(0, 1) if i % 50 else rng.normal(0, 30)))
            for i in range(2000)] + [("g0", None), (None, 1.0), ("g9", 5.0)]
    df = spark.createDataFrame(data, "k string, v double")
    for by in ("k", None):
        one = X.box_stats(df, "v", by=by)  # every group within the bound: one pass
        two = X.box_stats(df, "v", by=by, max_group_rows=0)  # quartiles, fences, second pass
        assert one.columns == two.columns
        a, b = rows(one, [by] if by else None), rows(two, [by] if by else None)
        assert len(a) == len(b)
        for ra, rb in zip(a, b):
            assert np.allclose([x if x is not None else np.nan for x in ra[1 if by else 0:]],
                               [x if x is not None else np.nan for x in rb[1 if by else 0:]],
                               rtol=0, atol=1e-9, equal_nan=True), (ra, rb)
    empty = df.filter("v > 1e9")
    assert rows(X.box_stats(empty, "v")) == rows(X.box_stats(empty, "v", max_group_rows=0))


def test_quantiles_without_keys_and_empty_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    assert rows(exact_quantiles(df, [], ["v"], [0.5])) == [(2.0,)]
    assert rows(exact_quantiles(df, ["k"], ["v"], [0.5]), ["k"]) == [("a", 2.0), ("b", None)]


# -- bin_edges ---------------------------------------------------------------

def test_histogram_edges_and_constant(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 1.0, 50.0, 99.0, 100.0, None]], "x double")
    got = {r["bin"]: r["count"] for r in X.histogram(df, "x").collect()}
    assert got == {1: 2, 26: 1, 50: 2}  # max lands in the last (closed) bin
    const = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert rows(X.histogram(const, "x").select("bin", "count")) == [(1, 2)]


# -- filters -----------------------------------------------------------------

def test_filter_by_category_empty_keeps_nothing(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    assert Q.filter_by_category(df, "c", []).count() == 0
    assert X.category_filters(df, {"c": []}).count() == 2  # explorer: empty = no filter
    assert X.category_filters(df, {"c": ["a"]}).count() == 1


def test_range_filters(spark):
    df = spark.createDataFrame([(1.0, 7), (5.0, 7), (None, 7)], "x double, c int")
    assert X.range_filters(df, {"x": (0.0, 2.0)}).count() == 1
    assert X.range_filters(df, {"x": (1.0, 1.0)}).count() == 1
    # constant column: no range to pick, nothing filtered (nulls kept too)
    assert X.range_filters(df, {"c": (100, 200)}).count() == 3
    assert X.range_filters(df, {"x": (0.0, 2.0), "c": (100, 200)}).count() == 1
    assert Q.filter_by_value(df, "x", min_val=2).count() == 1
    assert Q.filter_by_value(df, "x").count() == 3


def test_top_n_nulls_last_and_default_column(spark):
    df = spark.createDataFrame([("a", None), ("b", 3), ("c", 1), ("d", 3)], "s string, n int")
    assert rows(R.compute_top_n(df, 3, tiebreak=["s"])) == [("b", 3), ("d", 3), ("c", 1)]
    assert R.compute_top_n(df, 10).count() == 4


def test_profiles(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", "x", 5), (None, "y", None)], "c1 string, c2 string, n int")
    assert rows(X.distinct_counts(df), ["column"]) == [("c1", 2, True), ("c2", 2, True)]
    assert rows(X.distinct_counts(df, low=1), ["column"])[0][2] is False
    assert rows(X.distinct_values(df, "c1"), ["c1"]) == [("a",), ("b",)]
    assert rows(X.numeric_bounds(df)) == [("n", 1.0, 5.0)]
    assert rows(X.row_counts(df, has_n=F.col("n").isNotNull())) == [(3, 2)]


def test_share_and_bar(spark):
    df = spark.createDataFrame([("a", "u", 1.0), ("a", "v", 1.0), ("b", "u", 2.0)], "x string, c string, y double")
    assert rows(X.share_of_total(df, "x", "y"), ["x"]) == [("a", 2.0, 0.5), ("b", 2.0, 0.5)]
    assert rows(X.bar_series(df, "x", "y", "c"), ["x", "c"]) == [("a", "u", 1.0), ("a", "v", 1.0), ("b", "u", 2.0)]


def test_wide_to_long_round_trip(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, 3.0, 0.0)], "hour int, A double, B double")
    long = X.wide_to_long(df, ["hour"], "session", "revenue")
    back = long.groupBy("hour").pivot("session", ["A", "B"]).agg(F.first("revenue"))
    assert rows(back, ["hour"]) == rows(df, ["hour"])


def test_enriched_cap_and_columns(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, h), 1, 1.0, 2, 10.0 + h) for h in range(5)], TRIP_SCHEMA)
    t = tr.load_and_clean(df)
    out = tr.enriched(t, spark, cap=3)
    assert out.columns == ["date", "hour", "month", "vendor_name", "payment_name",
                           "fare_amount", "trip_distance", "passenger_count"]
    got = rows(out)
    assert len(got) == 3 and [r[1] for r in got] == [0, 1, 2]
    assert got[0][3:5] == ("Creative Mobile Technologies", "Cash")
    assert payment_lookup(spark).rows == 6


def test_first_rows_threshold_path_is_exact(spark):
    import random
    rnd = random.Random(5)
    data = [(rnd.randint(0, 300) if i % 17 else None, rnd.random()) for i in range(6000)]
    df = spark.createDataFrame(data, "a int, b double")
    want = sorted(data, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1]))[:2500]
    got = rows(R.first_rows(df, 2500, ["a", "b"]))
    assert got == want
    assert R.first_rows(df, 7000, ["a", "b"]).count() == 6000
    strs = spark.createDataFrame([(str(i),) for i in range(3000)], "s string")
    assert R.first_rows(strs, 1500, ["s"]).count() == 1500


def test_output_orders(spark):
    df = spark.createDataFrame([(2, "b"), (None, "n"), (3, "c"), (1, "a")], "k int, s string")
    assert [r.s for r in R.sort_desc(df, "k").collect()] == ["c", "b", "a", "n"]
    assert [r.s for r in R.sort_asc(df, "k").collect()] == ["n", "a", "b", "c"]
    ties = df.unionByName(df.withColumn("s", F.concat("s", F.lit("2"))))
    assert [r.s for r in R.sort_desc(ties, "k", ["s"]).collect()] == ["c", "c2", "b", "b2", "a", "a2", "n", "n2"]
    assert [r.s for r in R.sort_asc(ties, "k", ["s"]).collect()] == ["n", "n2", "a", "a2", "b", "b2", "c", "c2"]
    trips = spark.createDataFrame([(h, 1.0) for h in (8, 8, 12, 12, 12, 22)], "hour int, fare double")
    sessions = A.time_of_day_summary(A.trip_cube(trips, ["hour"], fare="fare"))
    assert [r.trip_count for r in sessions.collect()] == [3, 2, 1]


def test_first_rows_prefilter_path(spark):
    # n well below the row count: the quantile cut and candidate table are used
    df = spark.range(0, 200_000).selectExpr("(id * 7919) % 200000 as a", "id as b")
    got = [r.a for r in R.first_rows(df, 5_000, ["a", "b"]).collect()]
    assert got == list(range(5_000))


def test_explorer_every_chart(spark):
    from tablescope.plans.explorer import CHARTS, ExplorerSpec, explore
    df = spark.createDataFrame([("a", "u", float(i), i % 3) for i in range(30)] +
                               [("b", "v", float(i) * 2, None) for i in range(10)] +
                               [(None, "u", 5.0, 1)], "g string, c string, y double, n int")
    base = dict(categories={"c": ["u", "v"]}, ranges={"y": (0.0, 100.0)})
    table = explore(df, ExplorerSpec(**base)).table
    assert table.count() == 41
    grouped = explore(df, ExplorerSpec(**base, group_by=["g"], aggregate=["y", "n"], func="sum")).table
    assert rows(grouped) == [("a", 435.0, 30), ("b", 90.0, 0)]  # null key dropped, sorted desc
    sizes = {}
    for kind in CHARTS:
        res = explore(df, ExplorerSpec(**base, chart=kind, x="g", y="y", color="c"))
        sizes[kind] = res.chart.count()
    assert sizes["bar"] == 3 and sizes["line"] == 41 and sizes["area"] == 41
    assert sizes["scatter"] == 41  # every row ...
    some = explore(df, ExplorerSpec(**base, chart="scatter", x="g", y="y", sample=7)).chart
    assert some.count() == 7  # ... unless a sample is asked for
    assert sizes["box"] == 2 and sizes["pie"] == 3 and sizes["histogram"] >= 2
    assert explore(df, ExplorerSpec(chart="bar", x="g")).chart is None  # no y: no chart
    with pytest.raises(ValueError):
        explore(df, ExplorerSpec(chart="radar", x="g", y="y"))


def test_approximate_options_are_close(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    exact = {r[0]: r[1] for r in X.group_aggregate(li, ["l_returnflag"], ["l_extendedprice"], "median").collect()}
    approx = {r[0]: r[1] for r in X.group_aggregate(li, ["l_returnflag"], ["l_extendedprice"], "median",
                                                     approx=True).collect()}
    assert exact.keys() == approx.keys()
    for k in exact:
        assert abs(exact[k] - approx[k]) <= 0.01 * exact[k]
    d_exact = {r[0]: r[1] for r in X.distinct_counts(li, ["l_returnflag", "l_linestatus"]).collect()}
    d_approx = {r[0]: r[1] for r in X.distinct_counts(li, ["l_returnflag", "l_linestatus"], approx=True).collect()}
    assert d_exact == d_approx  # tiny cardinalities are counted exactly by the sketch
    b1 = X.box_stats(li, "l_quantity", by="l_linestatus").orderBy("l_linestatus").collect()
    b2 = X.box_stats(li, "l_quantity", by="l_linestatus", approx=True).orderBy("l_linestatus").collect()
    for r1, r2 in zip(b1, b2):
        assert r1["n"] == r2["n"] and abs(r1["median"] - r2["median"]) <= 1.0


def test_range_is_decided_on_the_table_before_filters(spark):
    from tablescope.plans.explorer import ExplorerSpec, explore
    df = spark.createDataFrame([("a", 5.0), ("a", 5.0), ("b", 50.0)], "c string, v double")
    assert explore(df, ExplorerSpec(categories={"c": ["a"]}, ranges={"v": (10, 60)})).table.count() == 0
    assert explore(df.filter("c = 'a'"), ExplorerSpec(ranges={"v": (10, 60)})).table.count() == 2


def test_nan_is_missing_on_every_box_path(spark):
    nan, inf = float("nan"), float("inf")
    data = [("g", float(i)) for i in range(10)] + [("g", nan), ("g", None), ("h", nan), ("i", inf), ("i", 1.0), ("i", 2.0)]
    data += [("hot", float(i % 37)) for i in range(3000)] + [("hot", 5.0)] * 1500
    df = spark.createDataFrame(data, "k string, v double").repartition(4)
    for by in ("k", None):
        paths = [X.box_stats(df, "v", by=by), X.box_stats(df, "v", by=by, max_group_rows=0),
                 X.box_stats(df, "v", by=by, max_group_rows=0, max_broadcast_groups=0)]
        got = [sorted(repr(sorted(r.asDict().items())) for r in p.collect()) for p in paths]
        assert got[0] == got[1] == got[2]
    g = X.box_stats(df, "v", by="k").filter("k = 'g'").first()
    assert (g["n"], g["max"], g["n_outliers"]) == (10, 9.0, 0)


def test_nan_does_not_reach_a_histogram(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 1.0, 100.0, float("nan"), None]], "_lo double")
    got = {r["bin"]: r["count"] for r in X.histogram(df, "_lo").collect()}
    assert got == {1: 2 if 1.0 < 100 / 50 else 1, 50: 1}


def test_medians_are_equal_on_every_path(spark, monkeypatch):
    from tablescope.operators import quantiles as QQ
    data = [(f"k{i % 7}", float((i * 37) % 101)) for i in range(2000)] + [("hot", float(i % 59)) for i in range(3000)]
    data += [("n", None), ("n", float("nan")), ("one", 3.0)]
    df = spark.createDataFrame(data, "k string, v double").repartition(4)
    want = rows(exact_quantiles(df, ["k"], ["v"], [0.25, 0.5]), ["k"])
    assert rows(exact_quantiles(df, ["k"], ["v"], [0.25, 0.5], max_group_rows=100), ["k"]) == want
    assert rows(exact_quantiles(df, ["k"], ["v"], [0.25, 0.5], max_group_rows=None), ["k"]) == want
    monkeypatch.setattr(QQ, "MAX_BROADCAST_ROWS", 0)  # frequent groups by broadcast, others by a shuffle
    some = QQ._quantiles_by_selection(df, ["k"], ["v"], [0.25, 0.5], {}, max_fetch=20)
    assert rows(some, ["k"]) == want


def test_frequent_groups_are_not_shuffled(spark):
    """With groups too many to broadcast, the fence join sends a frequent
    group's rows to no common task."""
    from tablescope.operators.enrich import join_many_groups
    df = spark.createDataFrame([("hot", i) for i in range(2000)] + [(f"k{i}", i) for i in range(4000)], "k string, v int")
    groups = df.select("k").distinct().withColumn("x", F.length("k"))
    joined = join_many_groups(df.repartition(8), groups, "k")
    assert joined.count() == 6000
    parts = joined.filter("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 4


def test_text_that_is_no_number_or_date_is_null(spark):
    from tablescope.operators.aggregate import compute_time_series
    df = spark.createDataFrame([("5", "2020-01-02", 1), ("x", "never", 2), (None, None, 3)], "fare string, date string, n int")
    assert Q.sanity_filter(df, {"fare": (1, 10)}).count() == 1
    assert Q.filter_by_value(df, "fare", max_val=10).count() == 1
    assert X.range_filters(df.unionByName(df.withColumn("fare", F.lit("7"))), {"fare": (1, 6)}).count() == 1
    got = {r["month"]: r["row_count"] for r in compute_time_series(df).collect()}
    assert got == {"2020-01": 1, None: 2}


def test_share_of_a_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.0)], "x string, y double")
    assert {r["share"] for r in X.share_of_total(df, "x", "y").collect()} == {None}


def test_explorer_types(spark):
    from tablescope.sources.files import infer_text_types
    df = spark.createDataFrame([("12d", "1", "1.5", "True", None, "1e3"), ("34f", "-2", ".5", "False", None, None)],
                               "code string, whole string, number string, yes string, nothing string, exp string")
    assert dict(infer_text_types(df).dtypes) == {"code": "string", "whole": "bigint", "number": "double",
                                                 "yes": "boolean", "nothing": "double", "exp": "double"}


def test_first_rows_of_text_keys(spark):
    from tablescope.operators.ranking import first_rows
    data = [(f"{'prefix' if i % 3 else 'other'}{i * 7919 % 5000:05d}", i) for i in range(4000)] + [(None, 1), ("", 2), ("é", 3)]
    df = spark.createDataFrame(data, "a string, b int").repartition(4)
    want = sorted(data, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1]))
    for n in (1100, 2500):
        assert [tuple(r) for r in first_rows(df, n, ["a", "b"]).collect()] == want[:n]


def test_first_rows_that_tie_are_rows_of_the_table(spark):
    from tablescope.operators.ranking import first_rows
    df = spark.createDataFrame([(0, i) for i in range(9000)], "a int, b int").repartition(4)
    got = [r.b for r in first_rows(df, 1200, ["a"]).collect()]
    assert len(got) == len(set(got)) == 1200
