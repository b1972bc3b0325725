"""Running totals and ranks of groups that no task could hold.

A window function puts a whole group into one task, in order. Here the rows are
range-partitioned by (group, order), so a long group lies over many tasks, one
after the other; each task's part of a group is summed, a small table of those
sums gives every part the total of the parts before it, and a window inside the
parts does the rest. Equal rows are dealt over tasks too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablescope.functions.columns import internal
from tablescope.session import materialize, materialize_observed

#: A (group, value) with more than one in so many of all rows is joined by
#: broadcast; there are at most so many of them.
FREQUENT = 1000


def _of(side: str, column: str) -> Column:
    return F.col(f"{side}." + "`" + column.replace("`", "``") + "`")


def _same(columns: Sequence[str]) -> Column:
    """Rows of the sides ``a`` and ``b`` agree in ``columns``; nulls are equal."""
    return reduce(Column.__and__, [_of("a", c).eqNullSafe(_of("b", c)) for c in columns])


def in_segments(df: DataFrame, groups: Sequence[str], order: Sequence[Column], tasks: int | None = None) -> tuple[DataFrame, str, str]:
    """``df`` as a written table in the order of its ``groups`` and ``order``,
    with two columns more, whose names are returned: the number of the task that
    wrote a row, ascending in that order, and a number that tells equal rows
    apart."""
    task, tie = internal("_task", df.columns), internal("_tie", df.columns)
    keys = [*[F.asc_nulls_first(g) for g in groups], *order, F.col(tie).asc()]
    rows = df.withColumn(tie, F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(tasks, *keys) if tasks else rows.repartitionByRange(*keys)
    return materialize(dealt.withColumn(task, F.spark_partition_id())), task, tie


def running_totals_spread(df: DataFrame, partition: str | Sequence[str], order: str, sums: Mapping[str, str],
                          tiebreak: Sequence[str] = (), descending: bool = False, tasks: int | None = None) -> DataFrame:
    """:func:`ranking.running_totals` for groups of any size, from the first row
    to the current row: ``sums`` maps output name -> input column.

    Null order keys come first (last if ``descending``). Rows that are equal in
    ``order`` follow each other by ``tiebreak`` (ascending, nulls first), then in
    any order, each with a total of its own. Null group keys are a group; null
    values add nothing, and a total is null until there is a value. Writes the
    rows once, range-partitioned into ``tasks`` parts (default: as the session
    shuffles).
    """
    groups = [partition] if isinstance(partition, str) else list(partition)
    by = [F.desc_nulls_last(order) if descending else F.asc_nulls_first(order), *[F.asc_nulls_first(c) for c in tiebreak]]
    rows, task, tie = in_segments(df, groups, by, tasks)
    inside = Window.partitionBy(*groups, task).orderBy(*by, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*groups).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    own = {out: internal(f"_own_{i}", df.columns) for i, out in enumerate(sums)}
    past = {out: internal(f"_past_{i}", df.columns) for i, out in enumerate(sums)}
    parts = rows.groupBy(*groups, task).agg(*[F.sum(src).alias(past[out]) for out, src in sums.items()])
    # Only the first group of a task can have begun in another: a row per task at most.
    n = internal("_n", df.columns)
    earlier = materialize(parts.withColumns(
        {n: F.row_number().over(Window.partitionBy(*groups).orderBy(task)), **{p: F.sum(p).over(before) for p in past.values()}})
        .where(F.col(n) > 1).drop(n))
    local = rows.withColumns({own[out]: F.sum(src).over(inside) for out, src in sums.items()})
    joined = local.alias("a").join(F.broadcast(earlier).alias("b"), _same([*groups, task]), "left")
    here, there = ({out: _of(side, names[out]) for out in sums} for side, names in (("a", own), ("b", past)))
    totals = [F.coalesce(here[out] + there[out], here[out], there[out]).alias(out) for out in sums]
    return joined.select(*[_of("a", c) for c in df.columns if c not in sums], *totals)


def rank_within_spread(df: DataFrame, partition: str | Sequence[str], order_desc: str, name: str = "rank",
                       tasks: int | None = None) -> DataFrame:
    """:func:`ranking.rank_within` for groups of any size: rows by
    ``order_desc``, largest first (nulls last), equal ones share a rank (bigint)
    and leave a gap.

    Rows are counted per group and value, which a value shared by many combines
    to a row per task; a running total of the counts is the rank, and it is
    joined back to the rows by group and value.
    """
    groups = [partition] if isinstance(partition, str) else list(partition)
    n, upto = internal("_n", df.columns), internal("_upto", df.columns)
    keys = [*groups, *([order_desc] if order_desc not in groups else [])]
    counts, seen = materialize_observed(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)), rows=F.sum(n))
    totals = running_totals_spread(counts, groups, order_desc, {upto: n}, descending=True, tasks=tasks)
    ranks = materialize(totals.select(*[f"`{c}`" for c in keys], n, (F.col(upto) - F.col(n) + 1).alias(name)))
    hot = F.col(n) * FREQUENT > (seen["rows"] or 0)
    frequent, others = ranks.where(hot), ranks.where(~hot)
    columns = [_of("a", c) for c in df.columns if c != name]

    def joined(rows: DataFrame, side: DataFrame) -> DataFrame:
        return rows.alias("a").join(side.alias("b"), _same(keys)).select(*columns, _of("b", name))

    rare = df.alias("a").join(F.broadcast(frequent).alias("b"), _same(keys), "left_anti")
    return joined(df, F.broadcast(frequent)).unionByName(joined(rare, others))
