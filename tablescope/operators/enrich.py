"""Left-join enrichment from small lookup tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescope.functions.columns import as_int_key
from tablescope.session import materialize

# A lookup side is broadcast only below this many rows (checked, not assumed).
MAX_BROADCAST_ROWS = 200_000


# ... and below this many bytes, by the optimizer's estimate of the plan.
MAX_BROADCAST_BYTES = 256 << 20
# A group is frequent when it holds more than one in FREQUENT of all rows: at
# most FREQUENT groups can be, which bounds what is broadcast for them.
FREQUENT = 1000


def join_many_groups(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row per ``key``, too many
    to broadcast) that keeps a frequent group spread: its group row is
    broadcast and its rows stay where they are; all others are shuffled."""
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = rows.select(F.count(F.lit(1))).first()[0]
    hot = F.broadcast(materialize(sizes.filter(F.col("__n") * FREQUENT > total).select(key)))
    return (rows.join(F.broadcast(groups.join(hot, key, "left_semi")), key)
                .unionByName(rows.join(hot, key, "left_anti").join(groups, key)))


@dataclass(frozen=True)
class Lookup:
    """A lookup table with a known row count (e.g. built from literals)."""

    df: DataFrame
    key: str
    rows: int


def broadcastable(lookup: Lookup | DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """True when the lookup side has a proven size bound.

    A :class:`Lookup` is built from literals by this library and carries its
    row count. A plain DataFrame is counted (partial counts per task, one
    number per task moves) unless the optimizer's size estimate already
    exceeds the byte bound.
    """
    if isinstance(lookup, Lookup):
        return lookup.rows <= max_rows
    estimate = int(str(lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate <= MAX_BROADCAST_BYTES and lookup.count() <= max_rows


def enrich(df: DataFrame, key_col: str, lookup: Lookup, *,
           max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join on ``int(key_col) == lookup.key``; the lookup key is dropped.

    All left rows are kept; unparsable, null or unmatched keys give null
    lookup columns. The lookup is broadcast when its size is bounded, so the
    fact side is never shuffled; above the bound it is a regular shuffled
    join (AQE may still turn it into a broadcast at run time) of the rows that
    have a key: the others, which may be many, would all meet in one partition.
    """
    side = lookup.df
    if broadcastable(lookup, max_broadcast_rows):
        side = F.broadcast(side)
        return df.join(side, as_int_key(df[key_col]) == side[lookup.key], "left").drop(side[lookup.key])
    keyed, rest = df.where(as_int_key(key_col).isNotNull()), df.where(as_int_key(key_col).isNull())
    joined = keyed.join(side, as_int_key(keyed[key_col]) == side[lookup.key], "left").drop(side[lookup.key])
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in side.schema.fields if f.name != lookup.key]
    return joined.union(rest.select("*", *none))
