"""Label expressions: time-of-day buckets and outlier reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time-of-day labels, in bucket order
# (morning rush, daytime, evening rush, night, early morning).
SESSION_LABELS = ("Morning Rush", "Daytime", "Evening Rush", "Night", "Early Morning")
PIVOT_LABELS = ("Morning_Rush", "Daytime", "Evening_Rush", "Night", "Early_Morning")

# Outlier reasons, in priority order (first match wins).
OUTLIER_REASONS = ("fare > mean+3σ", "fare < $1", "passenger_count > 5")


def time_of_day(hour: str | Column = "hour",
                labels: Sequence[str] = SESSION_LABELS,
                null_label: str | None = None) -> Column:
    """Bucket an hour of day: [7,10) [10,16) [16,20) (>=20 or <5) else.

    A null hour fails every comparison and lands in the last ("early
    morning") bucket, which is the reference behaviour; pass ``null_label``
    to give it its own label instead.
    """
    h = F.col(hour) if isinstance(hour, str) else hour
    morning, day, evening, night, early = labels
    expr = (F.when((h >= 7) & (h < 10), morning)
             .when((h >= 10) & (h < 16), day)
             .when((h >= 16) & (h < 20), evening)
             .when((h >= 20) | (h < 5), night))
    if null_label is not None:
        expr = expr.when(h.isNull(), null_label)
    return expr.otherwise(early)


def outlier_reason(fare: str | Column, threshold: Column,
                   passengers: str | Column | None = "passenger_count") -> Column:
    """First matching reason, else null.

    ``threshold`` is a column (normally a scalar subquery); a null threshold
    (0 or 1 rows) disables the first rule only. ``passengers=None`` drops
    the passenger rule for tables without that column.
    """
    f = F.col(fare) if isinstance(fare, str) else fare
    high, low, crowd = OUTLIER_REASONS
    expr = F.when(f > threshold, high).when(f < 1.0, low)
    if passengers is not None:
        p = F.col(passengers) if isinstance(passengers, str) else passengers
        expr = expr.when(p > 5, crowd)
    return expr.otherwise(F.lit(None).cast("string"))
