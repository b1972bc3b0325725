"""Explorer query: filters -> optional group-by -> optional chart data, one
plan built from a small spec (range filters look at the table's bounds)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tablescope.operators import explore as ex

CHARTS = ("bar", "line", "scatter", "area", "histogram", "box", "pie")


@dataclass
class ExplorerSpec:
    categories: Mapping[str, Sequence] = field(default_factory=dict)
    ranges: Mapping[str, tuple] = field(default_factory=dict)
    group_by: Sequence[str] = ()
    aggregate: Sequence[str] = ()
    func: str = "sum"
    chart: str | None = None
    x: str | None = None
    y: str | None = None
    color: str | None = None
    sample: int | None = None  # rows of a scatter chart; None: all of them


@dataclass
class ExplorerResult:
    table: DataFrame
    chart: DataFrame | None


@dataclass
class ExplorerControls:
    """What the explorer offers for an unfiltered table."""

    categories: DataFrame  # column, low_cardinality, n_distinct, values
    bounds: DataFrame  # column, min, max


def controls(df: DataFrame, footers: bool = False) -> ExplorerControls:
    """The category lists and slider bounds of ``df``, one pass for each; with
    ``footers``, for a Parquet table as it was read, the bounds take none."""
    return ExplorerControls(categories=ex.low_cardinality(df), bounds=ex.numeric_bounds(df, footers=footers))


def explore(df: DataFrame, spec: ExplorerSpec, footers: bool = False) -> ExplorerResult:
    """``footers``: ``df`` is a Parquet table as it was read, whose footers say
    which ranges apply."""
    # Which ranges apply is decided on the table before any filter.
    rows = ex.range_filters(ex.category_filters(df, spec.categories), spec.ranges, table=df, footers=footers)
    table = rows
    if spec.group_by and spec.aggregate:
        table = ex.group_aggregate(rows, spec.group_by, spec.aggregate, spec.func)
    return ExplorerResult(table=table, chart=chart_data(table, spec))


def chart_data(df: DataFrame, spec: ExplorerSpec) -> DataFrame | None:
    """The rows a chart of ``spec.chart`` is drawn from (None: no chart)."""
    kind, x, y, color = spec.chart, spec.x, spec.y, spec.color
    if kind is None or y is None:
        return None
    if kind not in CHARTS:
        raise ValueError(f"unknown chart {kind!r}; expected one of {CHARTS}")
    if kind == "bar":
        return ex.bar_series(df, x, y, color)
    if kind in ("line", "area"):
        return ex.chart_projection(df, x, y, color)
    if kind == "scatter":
        return ex.chart_projection(df if spec.sample is None else ex.sample_rows(df, spec.sample), x, y, color)
    if kind == "histogram":
        return ex.histogram(df, x, color=color)
    if kind == "box":
        return ex.box_stats(df, y, by=color)
    return ex.share_of_total(df, x, y)
