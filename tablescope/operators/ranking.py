"""Window ranks, running totals, ordering and top-N."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)

from tablescope.functions.columns import numeric_columns


def rank_within(df: DataFrame, partition: str | Sequence[str], order_desc: str,
                name: str = "rank") -> DataFrame:
    """Rank rows by ``order_desc`` (descending) inside each partition key;
    ties share a rank and leave a gap.

    Meant for grouped tables (one row per key and group); the window
    shuffles on the partition key.
    """
    parts = [partition] if isinstance(partition, str) else list(partition)
    w = Window.partitionBy(*parts).orderBy(F.desc(order_desc))
    return df.withColumn(name, F.rank().over(w))


def running_totals(df: DataFrame, partition: str | Sequence[str], order: str,
                   sums: Mapping[str, str]) -> DataFrame:
    """Cumulative sums per partition from the first row to the current row.

    ``sums`` maps output name -> input column; all share one window spec,
    hence one sort.
    """
    parts = [partition] if isinstance(partition, str) else list(partition)
    w = (Window.partitionBy(*parts).orderBy(order)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumns({out: F.sum(src).over(w) for out, src in sums.items()})


def sort_desc(df: DataFrame, col: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Largest first, nulls last. ``tiebreak`` columns (ascending, nulls first)
    order rows that are equal in ``col``; without them their order is open."""
    return df.orderBy(F.desc(col), *[F.asc_nulls_first(c) for c in tiebreak or ()])


def sort_asc(df: DataFrame, col: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Smallest first, nulls first; ``tiebreak`` as for :func:`sort_desc`."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in (col, *(tiebreak or ()))])


def compute_top_n(df: DataFrame, n: int = 20, sort_col: str | None = None,
                  tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Top ``n`` rows by ``sort_col`` descending, nulls last.

    Default column: first numeric, else first column. ``tiebreak`` columns
    (ascending) make the cut deterministic; the plan is a per-task bounded
    heap (TakeOrderedAndProject), not a global sort.
    """
    if sort_col is None:
        nums = numeric_columns(df)
        sort_col = nums[0] if nums else df.columns[0]
    order: list[Column] = [F.desc_nulls_last(sort_col)]
    order += [F.asc_nulls_first(c) for c in (tiebreak or [])]
    return df.orderBy(*order).limit(n)


# Below this many rows Spark's own top-k (one bounded heap per task, merged
# in one task) is cheap enough: its final merge sees n rows per partition.
SMALL_TOP_K = 1_000
_THRESHOLD_TYPES = (NumericType, DateType, TimestampType, TimestampNTZType)
# Approximate-quantile accuracy (rank error <= rows / accuracy) and the grid
# of fractions evaluated in the same pass as the row count.
_ACCURACY = 10_000
_GRID = sorted({min(1.0, 2.0 / _ACCURACY * 2 ** i) for i in range(15)})


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows ordered by ``order`` (ascending, nulls first).

    Spark's top-k merges ``n`` rows from every partition in one task; for a
    large ``n`` on a large table that is the bottleneck. So, for large
    ``n``, the rows that can be among the first ``n`` are narrowed first
    (see :func:`_candidates`) and the top-k runs on those candidates only.
    The result is exact; rows that tie on every order column are
    interchangeable, as in any top-k.
    """
    sort = [F.asc_nulls_first(c) for c in order]
    if n <= SMALL_TOP_K:
        return df.orderBy(*sort).limit(n)
    return _candidates(df, n, list(order)).orderBy(*sort).limit(n)


#: Bytes of a text that one block of the radix refinement looks at.
_BLOCK = 5


def text_block(c: Column, offset: int) -> Column:
    """The bytes of a text (or binary) from ``offset`` on as a number in their
    order: five of them and, below those, how many of at most six there are. A
    text that ends within the block is told apart from all that go on, so equal
    numbers mean equal texts, or texts that all go on; exact in a double."""
    rest = F.substring(c.cast("binary"), offset + 1, _BLOCK + 1)
    digits = F.rpad(F.hex(F.substring(rest, 1, _BLOCK)), 2 * _BLOCK, "0")
    return F.conv(digits, 16, 10).cast("double") * 8 + F.octet_length(rest)


def _common_bytes(low, high) -> int:
    """Length of the common prefix of two texts, and so of all between them."""
    a, b = (bytes(x) if isinstance(x, (bytes, bytearray)) else x.encode() for x in (low, high))
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def _candidates(df: DataFrame, n: int, keys: list[str], offset: int = 0) -> DataFrame:
    """A small DataFrame that contains the first ``n`` rows of ``df`` in the
    order ``keys`` (ascending, nulls first).

    Per level: one aggregation counts rows and nulls of the leading key and
    sketches its quantiles at a grid of fractions; the cut is the smallest
    grid value holding about ``1.5 n`` rows (plus twice the sketch's rank
    error). A second aggregation counts rows below and at the cut. Rows
    below are few and written once as a table. If the block *at* the cut is
    large (a hot value, say one date holding a third of all rows), only its
    first ``n - below`` rows are needed: they are found the same way on the
    next key. Rows that tie on the last key too are interchangeable.

    A text key is refined by blocks of its bytes, from byte ``offset`` on: the
    block at the cut goes on with the bytes after these, or, if its texts end
    there and so are equal, with the next key. Where a block tells nothing
    apart, the smallest and largest text say how many more bytes all share.
    """
    from tablescope.session import materialize, materialize_observed

    if not keys:
        # all these rows tie on every key, so any n of them will do: a random
        # few more than n, written once
        draw = (1.2 * n + 100) / max(1, df.count())
        drawn, written = materialize_observed(df.filter(F.rand(7) < draw), rows=F.count(F.lit(1)))
        return drawn if written["rows"] >= n else df
    lead, kind = F.col(keys[0]), df.schema[keys[0]].dataType
    text = isinstance(kind, (StringType, BinaryType))
    if text:
        c = text_block(lead, offset)
    elif isinstance(kind, BooleanType):
        c = lead.cast("int")
    elif isinstance(kind, _THRESHOLD_TYPES):
        c = lead
    else:
        return df  # no order-preserving number for this type: Spark's own top-k over df
    stats = df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(lead.isNull()).alias("nulls"),
                   F.percentile_approx(c, _GRID, _ACCURACY).alias("cuts"), F.min(c).alias("low"), F.max(c).alias("high")).first()
    total, nulls, cuts = stats["rows"], stats["nulls"], stats["cuts"]
    if total <= n:
        return df
    if nulls >= n:  # the first n rows all have a null lead: order them by the rest
        return _candidates(df.filter(lead.isNull()), n, keys[1:])
    if text and stats["low"] == stats["high"] and stats["low"] % 8 > _BLOCK:
        # this block is the same in all texts: go to the first byte that is not
        ends = df.agg(F.min(lead).alias("low"), F.max(lead).alias("high")).first()
        known = df.filter(lead.isNotNull())
        rows = _candidates(known, n - nulls, keys, max(offset + _BLOCK, _common_bytes(*ends)))
        return rows.unionByName(df.filter(lead.isNull())) if nulls else rows
    need = (1.5 * n - nulls) / (total - nulls) + 2.0 / _ACCURACY
    i = next((j for j, f in enumerate(_GRID) if f >= need), None)
    if i is None or _GRID[i] >= 1.0 or cuts is None:
        return df
    cut = F.lit(cuts[i])
    below, at = lead.isNull() | (c < cut), c == cut
    counts = df.agg(F.count_if(below).alias("below"), F.count_if(at).alias("at")).first()
    n_below, n_at = counts["below"], counts["at"]
    if n_below >= n:
        return materialize(df.filter(below))
    if n_below + n_at < n:
        # the sketch's cut fell short (e.g. a value a double cannot hold
        # exactly): Spark's own top-k over all rows keeps the result exact
        return df
    if n_at <= 4 * n:
        return materialize(df.filter(below | at))
    head = materialize(df.filter(below))
    if text and cuts[i] % 8 > _BLOCK:  # these texts go on
        return head.unionByName(_candidates(df.filter(at), n - n_below, keys, offset + _BLOCK))
    return head.unionByName(_candidates(df.filter(at), n - n_below, keys[1:]))


def cap_rows(df: DataFrame, n: int, order: Sequence[str] | None = None) -> DataFrame:
    """At most ``n`` rows; with ``order`` the kept set is the first ``n`` in
    that order (stable, see :func:`first_rows`), otherwise any ``n`` rows."""
    if order:
        return first_rows(df, n, list(order))
    return df.limit(n)
