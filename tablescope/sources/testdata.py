"""Adapters from the shared test tables (``<dir>/<name>.parquet``) to the
table shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Event type -> payment code used by the trip view
# (purchase maps to a code the payment lookup does not know).
EVENT_PAYMENT_CODES = [("click", 1), ("view", 2), ("error", 3), ("signup", 4), ("purchase", 9)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_events(events: DataFrame) -> DataFrame:
    """Trip-shaped view of ``events``.

    vendor_id = event_id % 3, pickup_datetime = ts,
    passenger_count = k % 8 and trip_distance = k / 4 with k = props.k,
    payment_type from the event type, fare_amount = value.

    ``k`` comes from ``json_tuple``, a generator: predicates on the derived
    columns cannot be inlined below it, so each row's JSON is parsed once
    instead of once per predicate (filters on ``value`` still reach the
    Parquet scan).
    """
    events = events.select("*", F.json_tuple(F.col("props"), "k").alias("_k"))
    k = F.col("_k").try_cast("int")
    pay = None
    for name, code in EVENT_PAYMENT_CODES:
        cond = F.col("event_type") == name
        pay = F.when(cond, F.lit(code)) if pay is None else pay.when(cond, F.lit(code))
    return events.select(
        (F.col("event_id") % 3).alias("vendor_id"),
        F.col("ts").alias("pickup_datetime"),
        (k % 8).alias("passenger_count"),
        (k / F.lit(4.0)).alias("trip_distance"),
        pay.alias("payment_type"),
        F.col("value").alias("fare_amount"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_events(table(spark, sf_dir, "events"))
