"""Physical-plan shape: the strategies the design relies on."""

import contextlib
import io
import pathlib
import re

from tablescope.plans import trip_report as tr
from tablescope.sources.testdata import trips
from tests.conftest import SMALL


def plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def cleaned(spark):
    return tr.load_and_clean(trips(spark, SMALL))


def test_lookup_joins_broadcast(spark):
    p = plan(tr.enriched(cleaned(spark), spark, cap=None))
    assert p.count("BroadcastHashJoin LeftOuter BuildRight") == 2
    assert "SortMergeJoin" not in p


def test_filters_pushed_and_columns_pruned(spark):
    p = plan(tr.daily(cleaned(spark)))
    scan = p[p.index("Scan parquet"):]
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(value,0\.01\)", scan)
    schema = re.search(r"ReadSchema: (struct<[^\n]*>)", scan).group(1)
    assert "user_id" not in schema and "event_id" not in schema
    assert "HashAggregate" in p and "partial_sum" in p  # map-side combine


def test_outlier_threshold_is_scalar_subquery(spark):
    p = plan(tr.outliers(cleaned(spark)))
    assert "Subquery" in p
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_top_n_is_bounded_heap(spark):
    from tablescope.operators.ranking import compute_top_n
    li = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    p = plan(compute_top_n(li, 20, "l_extendedprice", tiebreak=["l_orderkey"]))
    assert "TakeOrderedAndProject" in p


def test_share_uses_no_global_window(spark):
    from tablescope.operators.explore import share_of_total
    o = spark.read.parquet(f"{SMALL}/orders.parquet")
    p = plan(share_of_total(o, "o_orderpriority", "o_totalprice"))
    assert "Window" not in p


def test_share_scans_and_groups_once(spark):
    from tablescope.operators.explore import share_of_total
    o = spark.read.parquet(f"{SMALL}/orders.parquet")
    share = share_of_total(o, "o_orderpriority", "o_totalprice")
    share.collect()
    assert "ReusedExchange" in share._jdf.queryExecution().executedPlan().toString()


def test_explorer_ranges_reach_the_scan(spark):
    from tablescope.operators.explore import range_filters
    from tablescope.plans.explorer import ExplorerSpec, explore
    o = spark.read.parquet(f"{SMALL}/orders.parquet")
    for df in (range_filters(o, {"o_totalprice": (50000, 150000)}),
               explore(o, ExplorerSpec(ranges={"o_totalprice": (50000, 150000)})).table):
        assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_totalprice,50000", plan(df))


def test_pivot_has_no_value_discovery_and_one_shuffle(spark):
    p = plan(tr.pivot(cleaned(spark)))
    assert "pivotfirst" in p.lower() or "PivotFirst" in p
    assert "Exchange" in p


def test_library_never_pulls_rows_to_the_driver():
    src = pathlib.Path(__file__).resolve().parents[1] / "tablescope"
    for f in src.rglob("*.py"):
        if f.parent.name == "llm":  # an optional part, with a rule of its own in tests/llm
            continue
        text = f.read_text()
        for bad in (".collect(", ".toPandas(", "localCheckpoint", ".rdd."):
            assert bad not in text, f"{bad} in {f}"


def test_trip_path_stays_in_codegen(spark):
    from tablescope.sources.testdata import trips
    # AQE plans codegen stages at run time; inspect the static plan instead
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(tr.time_series(tr.load_and_clean(trips(spark, SMALL))), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # scan-side filter, JSON field, projection and partial aggregate fuse
    assert "WholeStageCodegen subtrees" in p
    assert re.search(r"\*\(\d+\) Generate json_tuple", p)
    assert re.search(r"\*\(\d+\) HashAggregate\(keys=\[date", p)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_quantile_selection_rounds_are_partial_aggregates(spark, monkeypatch):
    """Each selection round is one scan with map-side partial aggregates
    (count, distinct-value sketch, quantile sketch) and one hash shuffle of
    per-group buffers: no range-partitioned sort of the values."""
    from pyspark.sql import functions as F

    from tablescope.operators import quantiles as Q
    from tablescope.sources.testdata import table

    seen = []
    real = Q.materialize_observed
    monkeypatch.setattr(Q, "materialize_observed", lambda d, **m: seen.append(d) or real(d, **m))
    li = table(spark, SMALL, "lineitem")
    out = Q._quantiles_by_selection(li, ["l_returnflag"], ["l_extendedprice"], [0.5], {},
                                    max_fetch=200)
    want = {r[0]: r[1] for r in li.groupBy("l_returnflag")
            .agg(F.median("l_extendedprice")).collect()}
    assert {r[0]: r[1] for r in out.collect()} == want
    assert len(seen) >= 2  # at least one narrowing round after the first
    for d in seen:
        p = plan(d)
        assert "rangepartitioning" not in p and "Sort " not in p
        assert "partial_percentile_approx" in p and "partial_approx_count_distinct" in p
        assert plan(d, "simple").count("Exchange hashpartitioning") == 1
