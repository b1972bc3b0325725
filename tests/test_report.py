"""End-to-end trip report and the cross-output invariants the shipped
reference results satisfy."""

import pathlib

import pytest
from pyspark.sql import functions as F

from tablescope.functions.labels import PIVOT_LABELS
from tablescope.plans import trip_report as tr
from tablescope.session import _shared, ensure_checkpoint_dir
from tablescope.sources.files import read_parquet
from tablescope.sources.registry import available_outputs, load_output
from tablescope.sources.testdata import trips
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def outputs(spark):
    t = tr.load_and_clean(trips(spark, SMALL))
    return {k: v.toPandas() for k, v in tr.report_outputs(spark, t).items()}


def test_all_seven_outputs(outputs):
    assert set(outputs) == set(tr.OUTPUT_TITLES)


def test_trips_and_revenue_agree_everywhere(outputs):
    n = outputs["time_series"]["trip_count"].sum()
    rev = outputs["time_series"]["total_revenue"].sum()
    assert outputs["sessions"]["trip_count"].sum() == n
    assert outputs["ranked"]["trip_count"].sum() == n
    assert outputs["running_totals"]["trip_count"].sum() == n
    assert outputs["sessions"]["total_revenue"].sum() == pytest.approx(rev, abs=1e-6)
    assert outputs["ranked"]["daily_revenue"].sum() == pytest.approx(rev, abs=1e-6)
    assert outputs["pivot"][list(PIVOT_LABELS)].to_numpy().sum() == pytest.approx(rev, abs=0.01 * 24)
    assert len(outputs["joined"]) == n


def test_rank_is_min_rank_within_date(outputs):
    r = outputs["ranked"]
    expect = r.groupby("date")["daily_revenue"].rank(method="min", ascending=False).astype(int)
    assert (expect == r["rank"]).all()


def test_running_totals_are_cumsums(outputs):
    r = outputs["running_totals"].sort_values(["payment_type", "date"])
    cum = r.groupby("payment_type")["trip_count"].cumsum()
    assert (cum == r["cumulative_trips"]).all()
    cum_rev = r.groupby("payment_type")["daily_revenue"].cumsum()
    assert (cum_rev - r["cumulative_revenue"]).abs().max() < 1e-6


def test_pivot_one_nonzero_cell_per_hour(outputs):
    p = outputs["pivot"]
    assert len(p) == 24
    assert ((p[list(PIVOT_LABELS)] != 0).sum(axis=1) == 1).all()


def test_avg_fare_is_revenue_over_trips(outputs):
    s = outputs["sessions"]
    assert ((s["total_revenue"] / s["trip_count"] - s["avg_fare"]).abs() < 1e-9).all()


def test_run_writes_and_registry_finds(spark, tmp_out):
    counts = tr.run_trip_report(spark, trips(spark, SMALL), tmp_out)
    assert set(counts) == set(tr.OUTPUT_TITLES)
    assert counts["pivot"] == 24
    assert available_outputs(spark, tmp_out) == tr.OUTPUTS
    back = load_output(spark, tmp_out, "sessions")
    assert back.count() == counts["sessions"]
    assert available_outputs(spark, tmp_out + "/nothing") == {}


def test_parallel_writes_equal_sequential(spark, tmp_out):
    par = tr.run_trip_report(spark, trips(spark, SMALL), tmp_out + "/par", parallel=4)
    seq = tr.run_trip_report(spark, trips(spark, SMALL), tmp_out + "/seq", parallel=1)
    assert par == seq and list(par) == list(seq)
    for name in ("sessions", "pivot", "ranked"):
        a = sorted(map(tuple, load_output(spark, tmp_out + "/par", name).collect()))
        b = sorted(map(tuple, load_output(spark, tmp_out + "/seq", name).collect()))
        assert a == b, name


def test_table_report_runner_writes_cleaned_once(spark, tmp_out):
    from tablescope.plans.table_report import run_table_report, table_report
    from tablescope.sources.testdata import table

    li = table(spark, SMALL, "lineitem")
    opts = dict(category_col="l_returnflag", date_col="l_shipdate", top_col="l_extendedprice")
    counts = run_table_report(li, tmp_out + "/tab", **opts)
    lazy = table_report(li, **opts)
    assert list(counts) == list(lazy)
    assert counts == {k: v.count() for k, v in lazy.items()}
    top = read_parquet(spark, tmp_out + "/tab/top_n")
    assert sorted(map(tuple, top.collect())) == sorted(map(tuple, lazy["top_n"].collect()))


def tables_left(spark):
    base = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "tables"
    return set(base.iterdir()) if base.exists() else set()


def test_runs_delete_their_tables(spark, tmp_out):
    from tablescope.plans.table_report import run_table_report

    before = tables_left(spark)
    tr.run_trip_report(spark, trips(spark, SMALL), tmp_out + "/trips")
    run_table_report(spark.read.parquet(f"{SMALL}/orders.parquet"), tmp_out + "/table", sample_fraction=0.5)
    assert tables_left(spark) == before


def test_a_cap_and_a_sample_only_where_they_are_asked_for(spark):
    from tablescope.plans.table_report import table_report

    t = tr.load_and_clean(trips(spark, SMALL))
    n = t.df.count()
    assert tr.report_outputs(spark, t)["joined"].count() == n
    assert tr.report_outputs(spark, t, cap=7)["joined"].count() == 7
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    assert table_report(orders, outputs=("cleaned",))["cleaned"].count() == orders.count()
    some = table_report(orders, outputs=("cleaned",), sample_fraction=0.3)["cleaned"].count()
    assert 0.2 * orders.count() < some < 0.4 * orders.count()


@pytest.mark.parametrize(("folder", "master", "good"), [
    ("/shared/ckpt", "local[4]", True), ("/shared/ckpt", "yarn", False), ("file:/data/x", "spark://h:7077", False),
    ("file:///tmp/x", "yarn", False), ("file:///mnt/shared/x", "yarn", True), ("hdfs://n/x", "yarn", True),
    ("s3a://b/x", "k8s://h", True), ("file:///tmp", "yarn", False), ("file:///var/tmp/x", "yarn", False),
    ("file:///mnt/../tmp/x", "yarn", False), ("file:///tmpfiles/x", "yarn", True), ("file:///own/tmp/x", "yarn", None)])
@pytest.mark.parametrize("own", ["/tmp", "/own/tmp"])
def test_checkpoint_folders(folder, master, good, own, monkeypatch):
    """Whatever folder this machine's temporary files are set to."""
    monkeypatch.setattr("tempfile.gettempdir", lambda: own)
    assert _shared(folder, master) is (own != "/own/tmp" if good is None else good)
