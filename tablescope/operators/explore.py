"""Interactive-explorer operators: filters, group-by, profiles and the data
behind common charts, as Spark plans (no rows are pulled to the driver).
Most are lazy; the range filters, exact quantiles, box statistics and exact
samples run small jobs when they are built, to decide how to go on, and the
last three write intermediate tables to the checkpoint folder.

Null rules follow a dataframe-explorer's conventions, which differ from
Spark's ``groupBy``: group keys that are null are dropped, and a sum over
only nulls is 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tablescope.functions.columns import as_number, internal, not_nan, numeric_columns, string_columns
from tablescope.operators.quality import _all

# Aggregate functions of the explorer group-by.
AGG_FUNCS = ("sum", "mean", "count", "min", "max", "median")
# A categorical column with at most this many distinct values
# gets a membership filter; histograms use this many bins.
LOW_CARDINALITY = 50
HISTOGRAM_BINS = 50


# ---------------------------------------------------------------------------
# Filters
# ---------------------------------------------------------------------------

def category_filters(df: DataFrame, selections: Mapping[str, Sequence]) -> DataFrame:
    """Conjunction of membership filters. An empty selection means no
    filter on that column; any selection drops null rows of that column."""
    preds = [F.col(c).isin(list(v)) for c, v in selections.items() if len(v) > 0]
    return df.filter(_all(preds)) if preds else df


def varying_columns(df: DataFrame, cols: Sequence[str], footers: bool = False) -> list[str]:
    """Those of ``cols`` whose values (nulls and NaN aside) are not all equal.
    One small aggregation job over all of them; one row reaches the driver. With
    ``footers``, for a Parquet table as it was read, numeric columns are decided
    by its files' footers (:mod:`tablescope.sources.footers`)."""
    if not cols:
        return []
    if footers:
        from tablescope.sources.footers import table_bounds

        known = table_bounds(df, [c for c in cols if isinstance(df.schema[c].dataType, NumericType)])
        others = varying_columns(df, [c for c in cols if c not in known])
        return [c for c in cols if (known[c].varies if c in known else c in others)]
    aggs = [F.coalesce(F.min(not_nan(df, c)) < F.max(not_nan(df, c)), F.lit(False)).alias(f"v{i}")
            for i, c in enumerate(cols)]
    row = df.agg(*aggs).first()
    return [c for i, c in enumerate(cols) if row[i]]


def range_filters(df: DataFrame, ranges: Mapping[str, tuple], table: DataFrame | None = None,
                  footers: bool = False) -> DataFrame:
    """Conjunction of inclusive ranges ``lo <= x <= hi``; null, NaN and text
    that is no number drop.

    Only columns whose values vary get a range: for a constant (or all-null)
    column the explorer offers none, so it filters nothing, not even nulls.
    That is decided on ``table``, the table before any filter (default:
    ``df``), by one small job when the filter is built, so that the filters
    themselves are plain comparisons that reach the scan; with ``footers`` that
    job reads footers only (see :func:`varying_columns`).
    """
    varying = varying_columns(df if table is None else table, list(ranges), footers)
    preds = [as_number(df, c).between(lo, hi) for c, (lo, hi) in ranges.items() if c in varying]
    return df.filter(_all(preds)) if preds else df


# ---------------------------------------------------------------------------
# Group-by
# ---------------------------------------------------------------------------

def _agg(func: str, c: str) -> Column:
    if func == "sum":
        return F.coalesce(F.sum(c), F.lit(0)).alias(c)
    if func == "mean":
        return F.avg(c).alias(c)
    if func == "count":
        return F.count(c).alias(c)
    if func == "min":
        return F.min(c).alias(c)
    if func == "max":
        return F.max(c).alias(c)
    raise ValueError(f"unknown aggregate {func!r}; expected one of {AGG_FUNCS}")


def group_aggregate(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                    func: str = "sum", approx: bool = False) -> DataFrame:
    """One aggregate function over each column per group; rows with a null
    key are dropped; output columns keep their input names; sorted by the
    first aggregate, largest first (nulls last).

    ``median`` is exact (see :mod:`tablescope.operators.quantiles` for the
    skew-safe form used when a group may be very large); ``approx=True``
    uses a one-pass quantile sketch (``percentile_approx``) instead.
    """
    keys, cols = list(keys), list(cols)
    if func == "median" and approx:
        return (df.dropna(subset=keys).groupBy(*keys)
                  .agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, 10_000).alias(c) for c in cols])
                  .orderBy(F.desc_nulls_last(cols[0])))
    if func == "median":
        from tablescope.operators.quantiles import exact_quantiles
        med = exact_quantiles(df.dropna(subset=keys), keys, cols, [0.5],
                              names={(c, 0.5): c for c in cols})
        return med.orderBy(F.desc_nulls_last(cols[0]))
    return (df.dropna(subset=keys).groupBy(*keys)
              .agg(*[_agg(func, c) for c in cols])
              .orderBy(F.desc_nulls_last(cols[0])))


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key combination, null keys dropped."""
    keys = list(keys)
    return df.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def category_frequency(df: DataFrame, col: str) -> DataFrame:
    """Rows per value of ``col`` (null counted as its own value)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------------------
# Column profiles
# ---------------------------------------------------------------------------

def _long(df: DataFrame, parts: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*parts)))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None,
                    low: int = LOW_CARDINALITY, approx: bool = False) -> DataFrame:
    """(column, n_distinct, low_cardinality) per column, nulls not counted.

    One aggregation for all columns; Spark expands each row per column and
    de-duplicates map-side, so no column's values gather in one task.
    ``approx=True`` uses HyperLogLog sketches instead (one pass, no values
    shuffled, about 1% relative error).
    """
    cols = list(cols) if cols is not None else string_columns(df)
    count = (lambda c: F.approx_count_distinct(c, 0.01)) if approx else F.count_distinct
    agg = df.agg(*[count(c).alias(f"n{i}") for i, c in enumerate(cols)])
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("n_distinct"),
                      (F.col(f"n{i}") <= low).alias("low_cardinality"))
             for i, c in enumerate(cols)]
    return _long(agg, parts)


def _few_values(columns: list[str], low: int):
    """Per task and column its distinct values, or, beyond ``low``, only that
    there are more."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        seen: list[set[str] | None] = [set() for _ in columns]
        for batch in batches:
            for i, known in enumerate(seen):
                if known is None:
                    continue
                some = pc.unique(batch.column(i).drop_null())
                if len(some) <= low:
                    known.update(some.to_pylist())
                if len(some) > low or len(known) > low:
                    seen[i] = None
        rows = [(c, v) for c, known in zip(columns, seen, strict=True) for v in ([None] if known is None else sorted(known))]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.string()) for j in (0, 1)], names=["column", "value"])
    return run


def low_cardinality(df: DataFrame, cols: Sequence[str] | None = None, low: int = LOW_CARDINALITY) -> DataFrame:
    """(column, low_cardinality, n_distinct, values) per categorical column:
    its sorted values if there are at most ``low``, else nulls for both. Nulls
    are not counted; values of other types than text are given as text.

    "At most ``low``?" needs no count: one pass over all columns keeps at most
    ``low`` values per column and task, in Arrow batches, and a column that has
    more somewhere sends that word alone. What leaves the tasks is written once
    as a small table. :func:`distinct_counts` counts the other columns exactly.
    """
    from tablescope.session import materialize

    cols = list(cols) if cols is not None else string_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, low_cardinality boolean, n_distinct long, values array<string>")
    texts = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)])
    # no word of a column at all would be no row: every column gets one
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols)], "place int, column string")
    found = materialize(texts.mapInArrow(_few_values(cols, low), "column string, value string").distinct())
    counts = found.groupBy("column").agg(F.bool_or(F.col("value").isNull()).alias("more"), F.count("value").alias("n"))
    few = counts.where(~F.col("more") & (F.col("n") <= low)).select("column")
    values = (found.where(F.col("value").isNotNull()).join(F.broadcast(few), "column")
              .groupBy("column").agg(F.sort_array(F.collect_list("value")).alias("values")))
    out = names.join(F.broadcast(counts), "column", "left").join(F.broadcast(values), "column", "left")
    is_low = ~F.coalesce("more", F.lit(False)) & (F.coalesce("n", F.lit(0)) <= low)
    return out.select("column", is_low.alias("low_cardinality"), F.when(is_low, F.coalesce("n", F.lit(0))).alias("n_distinct"),
                      F.when(is_low, F.coalesce("values", F.array().cast("array<string>"))).alias("values"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of one column."""
    return df.select(col).dropna().distinct()


def numeric_bounds(df: DataFrame, cols: Sequence[str] | None = None, footers: bool = False) -> DataFrame:
    """(column, min, max) of each numeric column, as doubles, one pass; with
    ``footers``, for a Parquet table as it was read, from its files' footers
    (:mod:`tablescope.sources.footers`)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    if footers:
        from tablescope.sources.footers import numeric_bounds as footer_bounds

        return footer_bounds(df, cols)
    aggs = []
    for i, c in enumerate(cols):
        value = not_nan(df, c).cast("double")
        aggs += [F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}")]
    agg = df.agg(*aggs)
    parts = [F.struct(F.lit(c).alias("column"), F.col(f"lo{i}").alias("min"),
                      F.col(f"hi{i}").alias("max")) for i, c in enumerate(cols)]
    return _long(agg, parts)


def row_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: ``rows`` plus, per keyword, the rows meeting the condition;
    all counted in one pass."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(cond).alias(name) for name, cond in conditions.items()]
    return df.agg(*aggs)


# ---------------------------------------------------------------------------
# Chart data
# ---------------------------------------------------------------------------

def chart_projection(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """(x, y[, color]) rows behind a line, scatter or area chart."""
    return df.select(*[c for c in (x, y, color) if c])


def histogram(df: DataFrame, x: str, bins: int = HISTOGRAM_BINS,
              color: str | None = None, footers: bool = False) -> DataFrame:
    """Equal-width bins over [min, max] of ``x``, last bin closed; count per
    (bin[, color]). A constant column is one bin. Nulls and NaN are not
    counted.

    min and max are scalar subqueries (one small job), so the binning is a
    plain projection followed by a partially aggregated count; with ``footers``,
    for a Parquet table as it was read, they come from its files' footers
    (:mod:`tablescope.sources.footers`). A
    non-numeric ``x`` is counted per value instead, as a categorical
    histogram does.
    """
    if not isinstance(df.schema[x].dataType, NumericType):
        keys = [x] + ([color] if color else [])
        return df.filter(F.col(x).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    if footers:
        from tablescope.sources.footers import table_bounds

        found = table_bounds(df, [x])[x]
        least, most = F.lit(found.low).cast("double"), F.lit(found.high).cast("double")
    else:
        known = not_nan(df, x).cast("double")
        bounds = df.select(F.min(known).alias("lo"), F.max(known).alias("hi"))
        least, most = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    # attach the bounds once; later expressions read the columns
    n_lo, n_hi = internal("_lo", df.columns), internal("_hi", df.columns)
    rows = df.filter(not_nan(df, x).isNotNull()).withColumns({n_lo: least, n_hi: most})
    lo, hi = F.col(n_lo), F.col(n_hi)
    xv = F.col(x).cast("double")
    raw = (F.floor((xv - lo) / (hi - lo) * F.lit(float(bins))) + 1).cast("int")
    b = F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(bins)))
    keys = ["bin"] + ([color] if color else [])
    width = (hi - lo) / F.lit(float(bins))
    return (rows.withColumn("bin", b)
                .groupBy(*keys, n_lo, n_hi).agg(F.count(F.lit(1)).alias("count"))
                .select(*keys, "count",
                        (lo + width * (F.col("bin") - 1)).alias("bin_start"),
                        (lo + width * F.col("bin")).alias("bin_end")))


def box_stats(df: DataFrame, y: str, by: str | None = None, approx: bool = False,
              max_group_rows: int | None = None, max_broadcast_groups: int | None = None) -> DataFrame:
    """Box-plot numbers of ``y`` per ``by`` group: n, min, q1, median, q3,
    max, whiskers (furthest values within 1.5 IQR of the box) and the count
    of points outside them. NaN is missing. Quartiles are exact, linear
    interpolation;
    ``approx=True`` takes them from a one-pass quantile sketch.

    For groups of at most ``max_group_rows`` rows (default: the quantile
    module's in-memory bound) one aggregation gathers the values as a sorted
    array and everything is read off it; for larger ones the quartiles come
    from :func:`exact_quantiles` and a second pass finds the whiskers against
    the fences. Both give equal results.
    """
    from tablescope.operators.quantiles import MAX_IN_MEMORY_GROUP, split_large_groups

    keys = [by] if by else []
    base = df.filter(not_nan(df, y).isNotNull())
    if by:
        base = base.filter(F.col(by).isNotNull())
    bound = MAX_IN_MEMORY_GROUP if max_group_rows is None else max_group_rows
    if approx:
        return _box_from_fences(base, y, by, True, max_broadcast_groups)
    small, large = split_large_groups(base, keys, bound)
    parts = [_box_from_sorted(small, y, keys)] if small is not None else []
    if large is not None:
        parts.append(_box_from_fences(large, y, by, False, max_broadcast_groups))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _box_from_fences(base: DataFrame, y: str, by: str | None, approx: bool,
                     max_broadcast_groups: int | None) -> DataFrame:
    """Box statistics in two passes: quartiles, then each row against its
    group's fences."""
    from tablescope.operators.enrich import MAX_BROADCAST_ROWS, join_many_groups
    from tablescope.operators.quantiles import exact_quantiles
    from tablescope.session import materialize_observed

    keys = [by] if by else []
    # one row per group, written once (the write also counts the groups,
    # which decides the broadcast): the fence join and the final join read
    # it instead of recomputing the quartiles
    if approx:
        qs = F.percentile_approx(F.col(y).cast("double"), [0.25, 0.5, 0.75], 10_000)
        agg = base.groupBy(*keys).agg(qs.alias("_q")) if keys else base.agg(qs.alias("_q"))
        quart = agg.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))])
    else:
        quart = exact_quantiles(base, keys, [y], [0.25, 0.5, 0.75],
                                names={(y, 0.25): "q1", (y, 0.5): "median", (y, 0.75): "q3"})
    q, written = materialize_observed(quart, groups=F.count(F.lit(1)))
    fences = q.withColumns({
        "lo_fence": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
        "hi_fence": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")),
    })
    yv = F.col(y)
    aggs = [F.count(F.lit(1)).alias("n"), F.min(yv).cast("double").alias("min"),
            F.max(yv).cast("double").alias("max"),
            F.min(F.when(yv >= F.col("lo_fence"), yv)).cast("double").alias("lower_whisker"),
            F.max(F.when(yv <= F.col("hi_fence"), yv)).cast("double").alias("upper_whisker"),
            F.count_if((yv < F.col("lo_fence")) | (yv > F.col("hi_fence"))).alias("n_outliers")]
    if by:
        if written["groups"] <= (MAX_BROADCAST_ROWS if max_broadcast_groups is None else max_broadcast_groups):
            joined = base.join(F.broadcast(fences), by, "inner")
        else:
            joined = join_many_groups(base, fences, by)
        stats = joined.groupBy(by).agg(*aggs)
        return stats.join(q, by, "inner")
    joined = base.withColumns({
        "lo_fence": fences.select("lo_fence").scalar(),
        "hi_fence": fences.select("hi_fence").scalar(),
    })
    stats = joined.agg(*aggs)
    return stats.withColumns({c: q.select(c).scalar() for c in ("q1", "median", "q3")})


def _box_from_sorted(base: DataFrame, y: str, keys: list[str]) -> DataFrame:
    """Box statistics from one aggregation: count, min, max and each group's
    values as a sorted array (bounded by the caller's group-size check)."""
    from tablescope.operators.quantiles import sorted_array_quantile

    v = F.col(y).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.min(y).cast("double").alias("min"),
            F.max(y).cast("double").alias("max"),
            F.array_sort(F.collect_list(F.when(~F.isnan(v), v))).alias("_a")]
    agg = base.groupBy(*keys).agg(*aggs) if keys else base.agg(*aggs)
    arr = F.col("_a")
    agg = agg.withColumns({"q1": sorted_array_quantile(arr, 0.25),
                           "median": sorted_array_quantile(arr, 0.5),
                           "q3": sorted_array_quantile(arr, 0.75)})
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    within_lo = F.filter(arr, lambda x: x >= lo_f)
    within_hi = F.filter(arr, lambda x: x <= hi_f)
    outside = F.filter(arr, lambda x: (x < lo_f) | (x > hi_f))
    return agg.select(*keys, "n", "min", "max",
                      F.get(within_lo, 0).alias("lower_whisker"),
                      F.when(F.size(within_hi) > 0, F.get(within_hi, F.size(within_hi) - 1))
                       .alias("upper_whisker"),
                      F.size(outside).cast("long").alias("n_outliers"),
                      "q1", "median", "q3")


def share_of_total(df: DataFrame, x: str, y: str) -> DataFrame:
    """Sum of ``y`` per ``x`` and its fraction of the grand total.

    The grand total is a scalar subquery over the grouped table, whose
    shuffle Spark reuses: the input is scanned and grouped once, and no single
    task sees every group. A total of zero gives a null share.
    """
    grouped = df.groupBy(x).agg(F.sum(y).cast("double").alias(y))
    total = grouped.select(F.sum(y)).scalar()
    return grouped.withColumn("share", F.try_divide(F.col(y), total))


def bar_series(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """``y`` summed per (x[, color]): what a stacked bar chart shows."""
    keys = [x] + ([color] if color else [])
    return df.groupBy(*keys).agg(F.sum(y).alias(y))


# ---------------------------------------------------------------------------
# Sampling and reshape
# ---------------------------------------------------------------------------

def sample_rows(df: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(k, n)`` rows drawn uniformly without replacement.

    Every row gets a seeded random key and the ``k`` smallest keys win.
    Two passes: a count, then the rows whose key falls below a threshold
    that holds ``k`` rows with overwhelming probability are written once as
    a small table; the top-``k`` runs on that table, so its final merge
    never sees ``k`` rows from every partition. If the table ever holds
    fewer than ``k`` rows the plain top-``k`` runs, so the result is exact.
    """
    from tablescope.session import materialize_observed

    r = internal("_r", df.columns)
    keyed = df.withColumn(r, F.rand(seed))
    n = df.count()
    if n <= k:
        return df
    frac = min(1.0, (k + 10.0 * (k ** 0.5) + 100.0) / n)
    if frac >= 1.0:
        return keyed.orderBy(r).limit(k).drop(r)
    cut, written = materialize_observed(keyed.filter(F.col(r) < frac), rows=F.count(F.lit(1)))
    if written["rows"] < k:
        cut = keyed
    return cut.orderBy(r).limit(k).drop(r)


def wide_to_long(df: DataFrame, ids: Sequence[str], name_col: str, value_col: str,
                 cols: Sequence[str] | None = None) -> DataFrame:
    """Unpivot ``cols`` (default: all non-id columns) into (ids, name, value),
    values as double."""
    ids = list(ids)
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in ids]
    cast = df.withColumns({c: F.col(c).cast("double") for c in cols})
    return cast.unpivot(ids, cols, name_col, value_col)
