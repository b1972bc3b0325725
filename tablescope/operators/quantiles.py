"""Exact quantiles per group without gathering a group in one task.

Spark's built-in ``percentile``/``median`` keep, per group, a map of every
distinct value; a group holding a third of a 100 TB table and many distinct
values would put them all into one task.

One cheap aggregation first finds the groups of more than
``MAX_IN_MEMORY_GROUP`` rows. The values of each other group are gathered as
one sorted array (primitive doubles) and indexed. For the large groups Spark's
``percentile`` is used where it is safe: it combines map-side into a value -> count map, so
its memory per group is set by the group's *distinct values*, not its rows;
these are estimated per group and column with HyperLogLog sketches in one
more pass (no values shuffled). A column with few distinct values (a
quantity, a discount) therefore stays on ``percentile`` however hot a group
is.

The remaining columns take the **selection path**, a few aggregation passes
over the values, each with map-side partial aggregates only:

1. every (group, column, p) target starts with the bracket "all values"; the
   target ranks are ``floor`` and ``ceil`` of ``pos = (n - 1) * p``;
2. one pass per round counts, per group and target, the values below and
   inside the bracket and sketches the inside values at a grid of 1,001
   fractions (``percentile_approx``); the next bracket is the pair of grid
   values around the target ranks, widened by the sketch's error bound, so
   each round shrinks a bracket about 300-fold (a 10^12-row group needs four);
3. the round's table (one row per group) is written to the checkpoint
   folder, so later rounds never recompute earlier ones, and the next round
   first verifies the counts: ``below <= rank_lo`` and ``rank_hi < below +
   inside``;
4. once every bracket holds at most ``MAX_FETCH`` values or distinct
   values (HyperLogLog estimate in the same pass; a hot value repeated
   millions of times is one value), one more pass counts the bracket's
   values per distinct value (map-side combined), runs the counts up in
   value order within each (group, target) - a window over at most
   ``MAX_FETCH`` rows - and takes the values at the two ranks, interpolated
   as Spark's ``percentile`` does: ``(hi - pos) * v_lo + (pos - lo) * v_hi``.

If a bracket ever fails verification, or the rounds run out, the **sort
path** keeps the result exact:

1. sort ``(keys, value, random tiebreak)``: range partitioning splits every
   group (and even a hot single value) across many tasks;
2. number the sorted rows with ``monotonically_increasing_id`` (partition
   index in the high bits, position in the low bits) and write them once
   as a table in the checkpoint folder, so the numbering is fixed even if
   executors are lost later;
3. count rows per (group, partition) - a table of about groups + partitions
   rows - and turn it into per-partition rank offsets with a window;
4. the rows at the interpolation ranks are then known by id; fetch their
   values with one join on the id and interpolate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablescope.functions.columns import internal
from tablescope.operators.enrich import FREQUENT, MAX_BROADCAST_ROWS, broadcastable
from tablescope.session import ensure_checkpoint_dir, materialize, materialize_observed

_PART_BITS = 33  # monotonically_increasing_id: partition index << 33


def _ranked_values(df: DataFrame, keys: list[str], col: str, seed: int) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    x = (df.select(*keys, F.col(col).cast("double").alias("_v"))
           .filter(F.col("_v").isNotNull() & ~F.isnan("_v")))
    ordered = x.orderBy(*keys, "_v", F.rand(seed))
    return materialize(ordered.withColumn("_id", F.monotonically_increasing_id()))


def _targets(ranked: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    pid = F.shiftright(F.col("_id"), _PART_BITS)
    parts = ranked.groupBy(*keys, pid.alias("_pid")).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_id").alias("_first"))
    by_group = Window.partitionBy(*keys)
    before = by_group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({
        "_n": F.sum("_cnt").over(by_group),
        "_off": F.coalesce(F.sum("_cnt").over(before), F.lit(0)),
    })
    wanted = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            wanted.append(F.struct(F.lit(i).alias("_q"), F.lit(side).alias("_side"),
                                   rank.cast("long").alias("_rank"), pos.alias("_pos")))
    t = parts.select(*keys, "_cnt", "_first", "_off", F.explode(F.array(*wanted)).alias("_w"))
    t = t.select(*keys, "_cnt", "_first", "_off", "_w.*")
    t = t.filter((F.col("_rank") >= F.col("_off")) & (F.col("_rank") < F.col("_off") + F.col("_cnt")))
    return t.select(*keys, "_q", "_side", "_rank", "_pos",
                    (F.col("_first") + F.col("_rank") - F.col("_off")).alias("_tid"))


def default_name(col: str, p: float) -> str:
    return f"{col}_q{p:g}".replace(".", "_")


# Groups up to this many rows, or up to this many distinct values of a
# column, use Spark's exact ``percentile`` for that column (its per-group
# value map then has a proven bound); other columns use the sort path.
MAX_IN_MEMORY_GROUP = 200_000
# Relative standard deviation of the distinct-value sketch, and the margin
# (five standard deviations) by which an estimate must clear the bound.
_HLL_RSD = 0.02
_HLL_MARGIN = 1.0 + 5 * _HLL_RSD


def exact_quantiles(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                    probs: Sequence[float], names: Mapping[tuple[str, float], str] | None = None,
                    seed: int = 17, max_group_rows: int | None = MAX_IN_MEMORY_GROUP) -> DataFrame:
    """One row per group (``keys``, may be empty) with the exact ``p``
    quantile of each column in ``cols`` for each ``p`` in ``probs``.

    Output column names come from ``names[(col, p)]``, default
    ``<col>_q<p>`` with the dot as ``_`` (``v_q0_25``). Nulls and NaN are
    ignored; a group with no value in a column gets null for it.

    Groups of at most ``max_group_rows`` rows use sorted per-group arrays. Of
    the larger groups, columns that hold at most that many distinct values
    use Spark's exact ``percentile`` and the others (all groups and columns
    with ``max_group_rows=None``) use the selection path of this module,
    whose memory per task does not depend on group sizes. All give equal
    results; a large group does not slow the small ones down.
    """
    keys, cols, names = list(keys), list(cols), dict(names or {})
    if max_group_rows is None:
        in_memory, by_sort = [], cols
    else:
        small, large = split_large_groups(df, keys, max_group_rows)
        if large is None:
            return _quantiles_by_array(df, keys, cols, probs, names)
        if small is not None:
            return (_quantiles_by_array(small, keys, cols, probs, names)
                    .unionByName(_quantiles_of_large(large, keys, cols, probs, names, seed, max_group_rows)))
        in_memory, by_sort = _split_by_distinct(df, keys, cols, max_group_rows)
    return _quantiles_of_both(df, keys, cols, probs, names, seed, in_memory, by_sort)


def split_large_groups(df: DataFrame, keys: list[str], bound: int) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of groups of at most ``bound`` rows, rows of larger groups); None
    for a part that is known to be empty. Without keys the table is one group."""
    if not keys:
        return (df, None) if _largest_group(df, keys) <= bound else (None, df)
    n = internal("_n", df.columns)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)).filter(F.col(n) > bound)
    names = [internal(f"_k{i}", df.columns) for i in range(len(keys))]
    large, seen = materialize_observed(sizes.select(*[F.col(k).alias(m) for k, m in zip(keys, names)]),
                                       groups=F.count(F.lit(1)))
    if not seen["groups"]:
        return df, None
    side = F.broadcast(large) if seen["groups"] <= MAX_BROADCAST_ROWS else large
    cond = reduce(and_, [df[k].eqNullSafe(side[m]) for k, m in zip(keys, names)])
    return df.join(side, cond, "left_anti"), df.join(side, cond, "left_semi")


def _quantiles_of_large(df: DataFrame, keys: list[str], cols: list[str], probs: Sequence[float],
                        names: Mapping[tuple[str, float], str], seed: int, bound: int) -> DataFrame:
    in_memory, by_sort = _split_by_distinct(df, keys, cols, bound)
    return _quantiles_of_both(df, keys, cols, probs, names, seed, in_memory, by_sort)


def _quantiles_of_both(df: DataFrame, keys: list[str], cols: list[str], probs: Sequence[float],
                       names: Mapping[tuple[str, float], str], seed: int,
                       in_memory: list[str], by_sort: list[str]) -> DataFrame:
    """``percentile`` for some columns and selection for the others."""
    parts = []
    if in_memory:
        parts.append(_quantiles_in_memory(df, keys, in_memory, probs, names))
    if by_sort:
        parts.append(_quantiles_by_selection(df, keys, by_sort, probs, names, seed=seed))
    if len(parts) == 1:
        return parts[0]
    order = [names.get((c, p), default_name(c, p)) for c in cols for p in probs]
    mem, srt = parts
    if not keys:  # two one-row results: attach the second as scalar subqueries
        return mem.withColumns({c: srt.select(c).scalar() for c in srt.columns}).select(*order)
    return _join_on_keys(mem, srt, keys).select(*keys, *order)


def split_by_group_size(df: DataFrame, keys: list[str], cols: list[str],
                        bound: int) -> tuple[list[str], list[str]]:
    """(columns for an in-memory method, columns for the selection path).

    One aggregation finds the largest group; when it holds at most ``bound``
    rows every column qualifies. Otherwise a second pass estimates, per
    group and column, the distinct values (HyperLogLog: fixed-size sketches
    merged map-side, no values shuffled); a column qualifies when its
    largest estimate clears ``bound`` by a five-sigma margin.
    """
    if _largest_group(df, keys) <= bound:
        return list(cols), []
    return _split_by_distinct(df, keys, cols, bound)


def _largest_group(df: DataFrame, keys: list[str]) -> int:
    if not keys:
        return df.select(F.count(F.lit(1))).first()[0] or 0
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.max("_n")).first()[0] or 0


def _split_by_distinct(df: DataFrame, keys: list[str], cols: list[str],
                       bound: int) -> tuple[list[str], list[str]]:
    est = [F.approx_count_distinct(c, _HLL_RSD).alias(f"_d{i}") for i, c in enumerate(cols)]
    per_group = df.groupBy(*keys).agg(*est) if keys else df.agg(*est)
    top = per_group.agg(*[F.max(f"_d{i}") for i in range(len(cols))]).first()
    small = [c for i, c in enumerate(cols) if (top[i] or 0) * _HLL_MARGIN <= bound]
    return small, [c for c in cols if c not in small]


def _quantiles_by_array(df: DataFrame, keys: list[str], cols: list[str],
                        probs: Sequence[float], names: Mapping[tuple[str, float], str]) -> DataFrame:
    """Each group's values of a column as one sorted array (bounded by the
    group-size check), indexed at the two ranks of each ``p`` and
    interpolated as Spark's ``percentile`` does. Faster than ``percentile``
    for mostly distinct values: primitive arrays instead of a boxed map."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs.append(F.array_sort(F.collect_list(F.when(~F.isnan(v), v))).alias(f"_a{i}"))
    agg = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return agg.select(*keys, *[sorted_array_quantile(F.col(f"_a{i}"), p)
                               .alias(names.get((c, p), default_name(c, p)))
                               for i, c in enumerate(cols) for p in probs])


def sorted_array_quantile(arr, p: float):
    """The ``p`` quantile of an ascending array of doubles (null when it is
    empty), interpolated as Spark's ``percentile`` does."""
    n = F.size(arr)
    pos = (n - 1).cast("double") * F.lit(float(p))
    lo, hi = F.floor(pos).cast("int"), F.ceil(pos).cast("int")
    v_lo, v_hi = F.get(arr, lo), F.get(arr, hi)
    return (F.when(n == 0, F.lit(None).cast("double")).when(hi == lo, v_lo)
             .otherwise((hi.cast("double") - pos) * v_lo + (pos - lo.cast("double")) * v_hi))


def _quantiles_in_memory(df: DataFrame, keys: list[str], cols: list[str],
                         probs: Sequence[float], names: Mapping[tuple[str, float], str]) -> DataFrame:
    ps = F.array(*[F.lit(float(p)) for p in probs])
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs.append(F.percentile(F.when(~F.isnan(v), v), ps).alias(f"_a_{c}"))
    agg = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return agg.select(*keys, *[F.col(f"_a_{c}")[i].alias(names.get((c, p), default_name(c, p)))
                               for c in cols for i, p in enumerate(probs)])


def _quantiles_by_sort(df: DataFrame, keys: list[str], cols: list[str], probs: Sequence[float],
                       names: Mapping[tuple[str, float], str], seed: int) -> DataFrame:
    """Several columns are unpivoted into one (keys, column, value) stream,
    so they share one sort and one written table."""
    if len(cols) == 1:
        long = df.select(*keys, F.lit(0).alias("_c"), F.col(cols[0]).alias("_x"))
    else:
        pairs = [F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_x"))
                 for i, c in enumerate(cols)]
        long = df.select(*keys, F.explode(F.array(*pairs)).alias("_s")).select(*keys, "_s._c", "_s._x")
    gkeys = keys + ["_c"]
    ranked = _ranked_values(long, gkeys, "_x", seed)
    targets = _targets(ranked, gkeys, probs)
    side = F.broadcast(targets) if broadcastable(targets) else targets
    hits = (ranked.select("_id", "_v")
                  .join(side, F.col("_id") == F.col("_tid"), "inner")
                  .select(*gkeys, "_q", "_side", "_rank", "_pos", "_v"))
    lo = F.max(F.when(F.col("_side") == "lo", F.col("_v")))
    hi = F.max(F.when(F.col("_side") == "hi", F.col("_v")))
    lo_r = F.max(F.when(F.col("_side") == "lo", F.col("_rank")))
    hi_r = F.max(F.when(F.col("_side") == "hi", F.col("_rank")))
    pos = F.max("_pos")
    interp = F.when(hi_r == lo_r, lo).otherwise((hi_r - pos) * lo + (pos - lo_r) * hi)
    per_q = hits.groupBy(*gkeys, "_q").agg(interp.alias("_val"))
    out = [F.max(F.when((F.col("_c") == ci) & (F.col("_q") == qi), F.col("_val")))
             .alias(names.get((c, p), default_name(c, p)))
           for ci, c in enumerate(cols) for qi, p in enumerate(probs)]
    if not keys:
        return per_q.agg(*out)
    result = per_q.groupBy(*keys).agg(*out)
    # every group appears, also one whose values are all null
    return _join_on_keys(df.select(*keys).dropDuplicates(), result, keys)


# Selection path: fraction grid of the in-bracket sketch, the sketch's
# accuracy (rank error <= values / accuracy), the most values gathered per
# target in the last pass, and the rounds before the sort path takes over.
_GRID_STEPS = 1000
_SKETCH_ACCURACY = 10_000
_SKETCH_SLACK = 2.0 / _SKETCH_ACCURACY
MAX_FETCH = 100_000
_MAX_ROUNDS = 8


def _grid():
    """The sketch's fractions 0, 1/1000, ..., 1 as one array constant (parsed
    once; a literal per fraction would make every plan 1,001 nodes wider)."""
    fractions = ",".join(repr(i / _GRID_STEPS) for i in range(_GRID_STEPS + 1))
    return F.from_json(F.lit(f"[{fractions}]"), "array<double>")


def _long_values(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """(keys, _c, _v): one row per non-null, non-NaN value of each column."""
    pairs = [F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v"))
             for i, c in enumerate(cols)]
    long = df.select(*keys, F.inline(F.array(*pairs)))
    return long.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def _ranks(p: float) -> tuple:
    pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
    return pos, F.floor(pos).cast("long"), F.ceil(pos).cast("long")


def _inside(t: int):
    a, b, v = F.col(f"_a{t}"), F.col(f"_b{t}"), F.col("_v")
    return (a.isNull() | (v >= a)) & (b.isNull() | (v <= b))


def _with_brackets(values: DataFrame, brackets: DataFrame | None, gkeys: list[str],
                   n_targets: int, groups: int | None = None) -> DataFrame:
    """Attach each group's current brackets to its values (unbounded at
    first). The bracket table has one row per group; it is broadcast when
    its size is bounded; else frequent groups' rows are joined to a broadcast of
    theirs (a bounded number), and the others by a shuffle."""
    if brackets is None:
        none = F.lit(None).cast("double")
        return values.withColumns({f"_{e}{t}": none for t in range(n_targets) for e in "ab"})
    side = brackets.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(gkeys)],
                           *[f"_{e}{t}" for t in range(n_targets) for e in "ab"])
    small = groups <= MAX_BROADCAST_ROWS if groups is not None else broadcastable(side)
    drop = [f"_k{i}" for i in range(len(gkeys))]

    def joined(rows: DataFrame, part: DataFrame, how: str = "inner") -> DataFrame:
        cond = None
        for i, k in enumerate(gkeys):
            c = rows[k].eqNullSafe(part[f"_k{i}"])
            cond = c if cond is None else cond & c
        return rows.join(part, cond, how)

    if small:
        return joined(values, F.broadcast(side)).drop(*drop)
    total = brackets.select(F.sum("_n")).first()[0] or 0
    hot = side.join(brackets.filter(F.col("_n") * FREQUENT > total)
                    .select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(gkeys)]),
                    reduce(and_, [F.col(f"_k{i}").eqNullSafe(F.col(f"_h{i}")) for i in range(len(gkeys))]), "left_semi")
    rest = joined(values, F.broadcast(hot.select(*drop)), "left_anti")
    return joined(values, F.broadcast(hot)).unionByName(joined(rest, side)).drop(*drop)


def _round(values: DataFrame, brackets: DataFrame | None, gkeys: list[str],
           probs: Sequence[float], max_fetch: int,
           groups: int | None = None) -> tuple[DataFrame, dict]:
    """One pass: per group, the value count and, per target, the current
    bracket, the values below and inside it, whether it holds the target
    ranks, and the next (narrower) bracket. Written once as a table; also
    returns the group count and the least flags, observed by the write."""
    nt = len(probs)
    if brackets is None:
        # first round: every bracket is "all values", so all targets share
        # one count, one distinct-value sketch and one quantile sketch
        r = values.groupBy(*gkeys).agg(
            F.count(F.lit(1)).alias("_n"),
            F.approx_count_distinct("_v", _HLL_RSD).alias("_d"),
            F.percentile_approx("_v", _grid(), _SKETCH_ACCURACY).alias("_s"))
        none = F.lit(None).cast("double")
        shared = {}
        for t in range(nt):
            shared.update({f"_a{t}": none, f"_b{t}": none, f"_lt{t}": F.lit(0).cast("long"),
                           f"_in{t}": F.col("_n"), f"_d{t}": F.col("_d"), f"_s{t}": F.col("_s")})
        return _next_brackets(r.withColumns(shared).drop("_d", "_s"), probs, max_fetch)
    j = _with_brackets(values, brackets, gkeys, nt, groups)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for t in range(nt):
        a = F.col(f"_a{t}")
        aggs += [F.any_value(a).alias(f"_a{t}"), F.any_value(f"_b{t}").alias(f"_b{t}"),
                 F.count_if(a.isNotNull() & (F.col("_v") < a)).alias(f"_lt{t}"),
                 F.count_if(_inside(t)).alias(f"_in{t}"),
                 F.approx_count_distinct(F.when(_inside(t), F.col("_v")), _HLL_RSD).alias(f"_d{t}"),
                 F.percentile_approx(F.when(_inside(t), F.col("_v")), _grid(),
                                     _SKETCH_ACCURACY).alias(f"_s{t}")]
    return _next_brackets(j.groupBy(*gkeys).agg(*aggs), probs, max_fetch)


def _next_brackets(r: DataFrame, probs: Sequence[float], max_fetch: int) -> tuple[DataFrame, dict]:
    """Verification flags and the next bracket of each target, from a
    round's counts and sketches; written once as a table."""
    nt = len(probs)
    cols = {}
    for t, p in enumerate(probs):
        _, lo, hi = _ranks(p)
        lt, inn, sk = F.col(f"_lt{t}"), F.col(f"_in{t}"), F.col(f"_s{t}")
        cols[f"_ok{t}"] = (lt <= lo) & (hi < lt + inn)
        # few enough values, or few enough distinct values (a hot value
        # repeated millions of times is one (value, count) pair), to gather
        cols[f"_done{t}"] = ((inn <= F.lit(max_fetch))
                             | (F.col(f"_d{t}") * F.lit(_HLL_MARGIN) <= F.lit(max_fetch)))
        # grid cells around the local ranks, widened by the sketch's error
        f_lo = F.try_divide((lo - lt).cast("double"), inn) - F.lit(_SKETCH_SLACK)
        f_hi = F.try_divide((hi - lt + 1).cast("double"), inn) + F.lit(_SKETCH_SLACK)
        i_lo = F.floor(f_lo * _GRID_STEPS).cast("int") - 1
        i_hi = F.ceil(f_hi * _GRID_STEPS).cast("int") + 1
        cols[f"_na{t}"] = F.when(i_lo >= 0, F.get(sk, i_lo)).otherwise(F.col(f"_a{t}"))
        cols[f"_nb{t}"] = F.when(i_hi <= _GRID_STEPS, F.get(sk, i_hi)).otherwise(F.col(f"_b{t}"))
    r = r.withColumns(cols).drop(*[f"_s{t}" for t in range(nt)])
    # the write job itself reports the group count and the flags
    flags = {f"{f}{t}": F.min(F.col(f"_{f}{t}").cast("int")) for t in range(nt) for f in ("ok", "done")}
    return materialize_observed(r, groups=F.count(F.lit(1)), **flags)


def _quantiles_by_selection(df: DataFrame, keys: list[str], cols: list[str], probs: Sequence[float],
                            names: Mapping[tuple[str, float], str], seed: int = 17,
                            max_fetch: int = MAX_FETCH, max_rounds: int = _MAX_ROUNDS) -> DataFrame:
    """Exact quantiles by bracket narrowing (see the module docstring);
    falls back to the sort path if a bracket fails verification."""
    ensure_checkpoint_dir(df.sparkSession)
    gkeys = keys + ["_c"]
    nt = len(probs)
    values = _long_values(df, keys, cols)
    brackets, groups = None, None
    for _ in range(max_rounds):
        r, check = _round(values, brackets, gkeys, probs, max_fetch, groups)
        groups = check["groups"]
        if groups == 0:  # no values at all
            return _pick(values, None, df, keys, cols, probs, names)
        if not all(check[f"ok{t}"] == 1 for t in range(nt)):
            return _quantiles_by_sort(df, keys, cols, probs, names, seed)
        if all(check[f"done{t}"] == 1 for t in range(nt)):
            return _pick(values, r, df, keys, cols, probs, names, groups)
        brackets = r.select(*gkeys, "_n", *[F.col(f"_n{e}{t}").alias(f"_{e}{t}")
                                      for t in range(nt) for e in "ab"])
    return _quantiles_by_sort(df, keys, cols, probs, names, seed)


def _pick(values: DataFrame, r: DataFrame | None, df: DataFrame, keys: list[str], cols: list[str],
          probs: Sequence[float], names: Mapping[tuple[str, float], str],
          groups: int | None = None) -> DataFrame:
    """Count each verified bracket's values per distinct value (at most
    ``MAX_FETCH`` pairs per group and target, combined map-side), run the
    counts up in value order inside each (group, target) and take the values
    at the two ranks; interpolate between them."""
    gkeys = keys + ["_c"]
    nt = len(probs)
    out_names = [names.get((c, p), default_name(c, p)) for c in cols for p in probs]
    if r is None:  # every column is empty: one null per group
        nulls = [F.lit(None).cast("double").alias(n) for n in out_names]
        if not keys:
            return df.sparkSession.range(1).select(*nulls)
        return df.select(*keys).dropDuplicates().select(*keys, *nulls)
    j = _with_brackets(values, r, gkeys, nt, groups)
    # keep the values inside some bracket first (after narrowing, very few),
    # then tag each with the targets whose bracket holds it
    any_inside = _inside(0)
    for t in range(1, nt):
        any_inside = any_inside | _inside(t)
    j = j.filter(any_inside)
    tags = F.array_compact(F.array(*[F.when(_inside(t), F.lit(t)) for t in range(nt)]))
    pairs = (j.select(*gkeys, "_v", F.explode(tags).alias("_t"))
              .groupBy(*gkeys, "_t", "_v").agg(F.count(F.lit(1)).alias("_w")))
    run = Window.partitionBy(*gkeys, "_t").orderBy("_v").rowsBetween(Window.unboundedPreceding,
                                                                       Window.currentRow)
    pairs = pairs.withColumn("_end", F.sum("_w").over(run))
    info = r.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(gkeys)], "_n",
                    F.inline(F.array(*[F.struct(F.lit(t).alias("_ti"), F.col(f"_lt{t}").alias("_lt"),
                                                F.lit(float(p)).alias("_p"))
                                       for t, p in enumerate(probs)])))
    small = groups * nt <= MAX_BROADCAST_ROWS if groups is not None else broadcastable(info)
    info = F.broadcast(info) if small else info
    cond = pairs["_t"] == info["_ti"]
    for i, k in enumerate(gkeys):
        cond = cond & pairs[k].eqNullSafe(info[f"_k{i}"])
    hit = pairs.join(info, cond, "inner")
    pos = (F.col("_n") - 1).cast("double") * F.col("_p")
    lo, hi = F.floor(pos).cast("long") - F.col("_lt"), F.ceil(pos).cast("long") - F.col("_lt")
    start = F.col("_end") - F.col("_w")
    hit = hit.select(*gkeys, "_t", "_v", pos.alias("_pos"), F.floor(pos).alias("_rlo"),
                     F.ceil(pos).alias("_rhi"),
                     ((start <= lo) & (lo < F.col("_end"))).alias("_is_lo"),
                     ((start <= hi) & (hi < F.col("_end"))).alias("_is_hi"))
    per_t = hit.filter(F.col("_is_lo") | F.col("_is_hi")).groupBy(*gkeys, "_t").agg(
        F.max(F.when(F.col("_is_lo"), F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("_is_hi"), F.col("_v"))).alias("_vhi"),
        F.max("_pos").alias("_pos"), F.max("_rlo").alias("_rlo"), F.max("_rhi").alias("_rhi"))
    vlo, vhi, ps = F.col("_vlo"), F.col("_vhi"), F.col("_pos")
    per_t = per_t.select(*gkeys, "_t", F.when(F.col("_rhi") == F.col("_rlo"), vlo).otherwise(
        (F.col("_rhi") - ps) * vlo + (ps - F.col("_rlo")) * vhi).alias("_val"))
    out = [F.max(F.when((F.col("_c") == ci) & (F.col("_t") == qi), F.col("_val"))).alias(n)
           for (ci, qi), n in zip(((ci, qi) for ci in range(len(cols)) for qi in range(nt)), out_names)]
    if not keys:
        return per_t.agg(*out)
    result = per_t.groupBy(*keys).agg(*out)
    # every group appears, also one whose values are all null
    return _join_on_keys(df.select(*keys).dropDuplicates(), result, keys)

def _join_on_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on null-safe key equality, keys kept once."""
    r = right.select(*[right[k].alias(f"_rk{i}") for i, k in enumerate(keys)],
                     *[right[c] for c in right.columns if c not in keys])
    cond = None
    for i, k in enumerate(keys):
        c = left[k].eqNullSafe(r[f"_rk{i}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*[f"_rk{i}" for i in range(len(keys))])
