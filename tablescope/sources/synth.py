"""Synthetic orders table, generated in parallel on the executors.

``spark.range`` provides the row ids; every random column is a seeded
``rand`` so the table is reproducible for a given partitioning, and no row
passes through the driver whatever its size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Categories, regions and sub-categories per category.
CATEGORIES = ["Electronics", "Clothing", "Food", "Sports", "Books", "Home", "Toys"]
REGIONS = ["North", "South", "East", "West", "Central"]
SUB_CATEGORIES = {
    "Electronics": ["Phones", "Laptops", "Audio", "Cameras"],
    "Clothing": ["Men", "Women", "Kids", "Accessories"],
    "Food": ["Bakery", "Dairy", "Produce", "Meat"],
    "Sports": ["Outdoor", "Gym", "Team Sports", "Water Sports"],
    "Books": ["Fiction", "Science", "History", "Children"],
    "Home": ["Furniture", "Decor", "Kitchen", "Garden"],
    "Toys": ["Board Games", "Outdoor", "Educational", "Action Figures"],
}
# First date, day span, id range, price/discount/rating ranges, null share.
START_DATE = dt.date(2022, 1, 1)
DAY_SPAN = 730
CUSTOMER_IDS = (1000, 9999)
QUANTITY = (1, 49)
UNIT_PRICE = (5.0, 500.0)
DISCOUNT = (0.0, 0.3)
RATING = (1.0, 5.0)
NULL_SHARE = 0.02
NULLABLE = ("rating", "discount", "region")


def pick(values: list[str], r: Column) -> Column:
    """Uniform choice from a literal list driven by a [0, 1) random column."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(r * len(values)) + 1).cast("int"))


def pick_keyed(choices: dict[str, list[str]], key: Column, r: Column) -> Column:
    """Uniform choice from the list that ``key`` selects."""
    pairs = []
    for k, vs in choices.items():
        pairs += [F.lit(k), F.array(*[F.lit(v) for v in vs])]
    arr = F.element_at(F.create_map(*pairs), key)
    return F.element_at(arr, (F.floor(r * F.size(arr)) + 1).cast("int"))


def uniform_int(lo: int, hi: int, r: Column) -> Column:
    """Integer in [lo, hi] inclusive."""
    return (F.floor(r * (hi - lo + 1)) + lo).cast("int")


def uniform(lo: float, hi: float, r: Column, digits: int) -> Column:
    return F.round(F.lit(lo) + r * (hi - lo), digits)


def with_nulls(col: Column, r: Column, share: float = NULL_SHARE) -> Column:
    """``col`` with a random ``share`` of rows set to null."""
    return F.when(r >= share, col)


def synthetic_orders(spark: SparkSession, n_rows: int, seed: int = 42,
                     num_partitions: int | None = None) -> DataFrame:
    """Orders with 11 columns: order_id 1..n, customer_id, date, category,
    sub_category, region, quantity, unit_price, revenue, discount, rating;
    about 2% nulls in rating, discount and region, independently."""
    ids = spark.range(1, n_rows + 1, numPartitions=num_partitions).withColumnRenamed("id", "order_id")
    r = [F.rand(seed + i) for i in range(12)]
    base = ids.select(
        "order_id",
        F.concat(F.lit("CUST-"), uniform_int(*CUSTOMER_IDS, r[0]).cast("string")).alias("customer_id"),
        F.date_add(F.lit(START_DATE), uniform_int(0, DAY_SPAN, r[1])).alias("date"),
        pick(CATEGORIES, r[2]).alias("category"),
        r[3].alias("_sub"),
        pick(REGIONS, r[4]).alias("region"),
        uniform_int(*QUANTITY, r[5]).alias("quantity"),
        uniform(*UNIT_PRICE, r[6], 2).alias("unit_price"),
        uniform(*DISCOUNT, r[7], 2).alias("discount"),
        uniform(*RATING, r[8], 1).alias("rating"),
    )
    out = base.select(
        "order_id", "customer_id", "date", "category",
        pick_keyed(SUB_CATEGORIES, F.col("category"), F.col("_sub")).alias("sub_category"),
        with_nulls(F.col("region"), r[9]).alias("region"),
        "quantity", "unit_price",
        F.round(F.col("quantity") * F.col("unit_price"), 2).alias("revenue"),
        with_nulls(F.col("discount"), r[10]).alias("discount"),
        with_nulls(F.col("rating"), r[11]).alias("rating"),
    )
    return out
