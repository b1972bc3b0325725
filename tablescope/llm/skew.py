"""Joining a value to rows whose key may be very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescope.functions.columns import internal

#: Bits per key of a filter, and the bounds of its bits: 2^25 bits are half a
#: million words to broadcast, whatever the data.
BITS_PER_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 25

#: A key is frequent when it holds more than one in FREQUENT of all rows, so
#: at most FREQUENT keys can be: the broadcast side is bounded by arithmetic.
FREQUENT = 1000


def join_by_group(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row per ``key``, holding
    how many of the ``total`` rows have it in column ``count``).

    Frequent keys are broadcast, so their rows stay where they are; the
    others are shuffled, and none of them fills a partition. Both inputs
    should be written tables, as each is read twice.
    """
    hot = F.col(count) * FREQUENT > total
    frequent = groups.where(hot)
    return (rows.join(F.broadcast(frequent), key).unionByName(
        rows.join(F.broadcast(frequent.select(key)), key, "left_anti")
            .join(groups.where(~hot), key)))


def split_by_keys(rows: DataFrame, keys: DataFrame, key: str, count: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``key`` may be among ``keys`` (``count`` of them, distinct,
    in a written table), and those whose key is not: told by a filter of bounded
    size that the keys set bits of and that is broadcast, so no row moves. More
    keys than it has bits for only make more rows that may."""
    bits = LEAST_BITS
    while bits < min(MOST_BITS, BITS_PER_KEY * count):
        bits *= 2
    at = F.xxhash64(key).bitwiseAND(F.lit(bits - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    word = F.shiftright(at, 6)
    own, theirs, held = (internal(n, rows.columns) for n in ("__at", "__word", "__bits"))
    words = keys.groupBy(word.alias(theirs)).agg(F.bit_or(one).alias(held))
    known = rows.withColumn(own, word).join(F.broadcast(words), F.col(own) == F.col(theirs), "left")
    maybe = F.coalesce(F.col(held).bitwiseAND(one), F.lit(0)) != 0
    return tuple(known.where(x).drop(own, theirs, held) for x in (maybe, ~maybe))


def with_key_in(rows: DataFrame, keys: DataFrame, key: str, count: int) -> DataFrame:
    """Rows whose ``key`` is among ``keys`` (see :func:`split_by_keys`), for rows
    too wide to shuffle for it: most others are dropped where they are."""
    return split_by_keys(rows, keys, key, count)[0].join(keys.select(key), key, "left_semi")
