"""Row filters, cleaning and outlier flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablescope.functions.columns import as_number, keep_existing, normalise_columns
from tablescope.functions.labels import outlier_reason

# Sanity bounds of the trip report, inclusive.
TRIP_FARE_BOUNDS = (0.01, 500)
TRIP_DISTANCE_BOUNDS = (0.01, 100)
TRIP_PASSENGER_BOUNDS = (1, 6)


def sanity_filter(df: DataFrame, bounds: Mapping[str | None, tuple[Any, Any]]) -> DataFrame:
    """Keep rows with every bounded column inside its inclusive range.

    Columns that are absent (or ``None`` keys) are skipped; a null value
    fails ``between`` and is dropped, and so does text that is no number. One
    Filter node, pushed to the scan where the column is a plain source column.
    """
    preds = [as_number(df, c).between(lo, hi) for c, (lo, hi) in bounds.items()
             if c and c in df.columns]
    return df.filter(_all(preds)) if preds else df


def trip_bounds(fare: str | None, distance: str | None,
                passengers: str = "passenger_count") -> dict[str | None, tuple]:
    return {fare: TRIP_FARE_BOUNDS, distance: TRIP_DISTANCE_BOUNDS,
            passengers: TRIP_PASSENGER_BOUNDS}


def keep_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def filter_by_value(df: DataFrame, col: str, min_val=None, max_val=None) -> DataFrame:
    """Inclusive range filter; either bound may be omitted. With a numeric
    bound, text that is no number is dropped like a null."""
    numeric = any(isinstance(v, (int, float)) for v in (min_val, max_val))
    value = as_number(df, col) if numeric else F.col(col)
    preds = []
    if min_val is not None:
        preds.append(value >= min_val)
    if max_val is not None:
        preds.append(value <= max_val)
    return df.filter(_all(preds)) if preds else df


def filter_by_category(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Membership filter. An empty list keeps no row (``IN ()`` is false)."""
    if len(values) == 0:
        return df.filter(F.lit(False))
    return df.filter(F.col(col).isin(list(values)))


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim spaces from both ends of every string column, one projection."""
    cols = {f.name: F.trim(F.col(f.name)) for f in df.schema.fields
            if isinstance(f.dataType, StringType)}
    return df.withColumns(cols) if cols else df


def drop_duplicate_rows(df: DataFrame, by_digest: bool = False) -> DataFrame:
    """Exact duplicate removal.

    Planned as a hash aggregate on all columns with a map-side partial
    step, so a value repeated in a third of all rows is collapsed inside
    each map task before the shuffle. ``by_digest`` moves only rows that may be
    repeated, for three scans (:mod:`tablescope.operators.repeats`).
    """
    if by_digest:
        from tablescope.operators.repeats import drop_repeated_rows

        return drop_repeated_rows(df)
    return df.dropDuplicates()


def clean_dataframe(df: DataFrame, by_digest: bool = False) -> DataFrame:
    """Normalise names, trim strings, drop duplicates (``by_digest``: see
    :func:`drop_duplicate_rows`), drop all-null rows.

    Trimming comes before de-duplication, so ``"a "`` and ``"a"`` merge; a
    blank string becomes ``""`` which is not null and survives.
    """
    df = normalise_columns(df)
    df = trim_strings(df)
    df = drop_duplicate_rows(df, by_digest)
    return drop_all_null_rows(df)


def column_stats(df: DataFrame, col: str) -> DataFrame:
    """One row: mean and sample standard deviation of ``col``."""
    return df.agg(F.mean(col).alias("mean"), F.stddev_samp(col).alias("std"))


def sigma_threshold(df: DataFrame, col: str, k: float = 3.0) -> Column:
    """``mean + k * std`` of ``col`` as a scalar subquery.

    The aggregate runs once (partial per task, one final row); its value is
    substituted into the outer plan by Spark, so nothing passes through the
    Python driver and no join is needed.
    """
    return df.select((F.mean(col) + F.lit(k) * F.stddev_samp(col)).alias("t")).scalar()


def outliers(df: DataFrame, fare: str, passengers: str | None = "passenger_count",
             extra: Sequence[str] = ("passenger_count", "trip_distance", "hour", "date"),
             k: float = 3.0) -> DataFrame:
    """Rows flagged by the first matching reason, with the reason.

    The sigma threshold is computed over ``df`` itself (the cleaned rows).
    The passenger rule applies only when the column exists.
    """
    if passengers is not None and passengers not in df.columns:
        passengers = None
    reason = outlier_reason(fare, sigma_threshold(df, fare, k), passengers)
    flagged = keep_not_null(df.withColumn("outlier_reason", reason), "outlier_reason")
    return keep_existing(flagged, ["outlier_reason", fare, *extra])


def _all(preds: Sequence[Column]) -> Column:
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out
