"""Chart data of the report's results page: output name -> chart rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tablescope.functions.columns import group_role, keep_existing
from tablescope.operators.explore import category_frequency, group_sizes, wide_to_long


def _series(measure: str) -> Callable[[DataFrame], DataFrame]:
    """(date, payment type, measure): one line per payment type."""
    return lambda df: keep_existing(df, ["date", group_role(df), measure])


def _metrics(df: DataFrame) -> DataFrame:
    return wide_to_long(df, ["date"], "metric", "value", [c for c in ("trip_count", "total_revenue") if c in df.columns])


def _names(df: DataFrame) -> DataFrame:
    return group_sizes(df, [c for c in ("vendor_name", "payment_name") if c in df.columns])


CHARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "outliers": lambda df: category_frequency(df, "outlier_reason"),
    "ranked": _series("daily_revenue"),
    "running_totals": _series("cumulative_revenue"),
    "sessions": lambda df: keep_existing(df, ["session", "trip_count", "total_revenue"]),
    "pivot": lambda df: wide_to_long(df, ["hour"], "session", "revenue"),
    "time_series": _metrics,
    "joined": _names,
}


def chart_rows(outputs: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The rows each output's chart is drawn from; outputs without a chart
    are left out."""
    return {name: CHARTS[name](df) for name, df in outputs.items() if name in CHARTS}
