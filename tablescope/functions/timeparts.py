"""Time-part expressions (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType


def parse_timestamp(df: DataFrame, col: str) -> Column:
    """Column ``col`` as a timestamp.

    Timestamps (with or without zone) pass through unchanged; dates are cast;
    text is parsed with ``try_to_timestamp`` so a bad value gives null
    rather than failing the job under ANSI mode.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.col(col)
    if isinstance(dtype, DateType):
        return F.col(col).cast("timestamp")
    if isinstance(dtype, StringType):
        return F.try_to_timestamp(F.col(col))
    return F.col(col).try_cast("timestamp")


def hour_of_day(ts: str | Column) -> Column:
    return F.hour(ts)


def calendar_date(ts: str | Column) -> Column:
    return F.to_date(ts)


def month_label(ts: str | Column) -> Column:
    """``yyyy-MM`` text label."""
    return F.date_format(ts, "yyyy-MM")


def with_time_parts(df: DataFrame, ts_col: str, out: str = "pickup_dt") -> DataFrame:
    """Add ``out`` (parsed timestamp), ``hour``, ``date`` and ``month``."""
    ts = parse_timestamp(df, ts_col)
    df = df.withColumn(out, ts)
    return df.withColumns({
        "hour": hour_of_day(out),
        "date": calendar_date(out),
        "month": month_label(out),
    })
