"""Literal lookup tables of the trip report."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tablescope.operators.enrich import Lookup

# Vendor code -> vendor name.
VENDOR_NAMES = [
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc"),
]

# Payment code -> payment name.
PAYMENT_NAMES = [
    (1, "Credit Card"),
    (2, "Cash"),
    (3, "No Charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided Trip"),
]


def lookup_table(spark: SparkSession, rows, key: str, name: str) -> Lookup:
    """A literal table with a declared schema and a known row count."""
    df = spark.createDataFrame(list(rows), f"{key} int, {name} string")
    return Lookup(df=df, key=key, rows=len(rows))


def vendor_lookup(spark: SparkSession) -> Lookup:
    return lookup_table(spark, VENDOR_NAMES, "vendor_id_key", "vendor_name")


def payment_lookup(spark: SparkSession) -> Lookup:
    return lookup_table(spark, PAYMENT_NAMES, "payment_type_key", "payment_name")
