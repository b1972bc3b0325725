"""The trip report: load-and-clean, then seven named outputs.

Every output is a lazy DataFrame over the cleaned trips. The report runner
(:func:`run_trip_report`) writes them with distributed writers; the four
grouped outputs are rolled up from one shared fine-grained aggregate so the
trip rows are scanned once for all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tablescope.functions.columns import find_role, group_role, keep_existing, normalise_columns
from tablescope.functions.timeparts import with_time_parts
from tablescope.operators import aggregate, quality, ranking
from tablescope.operators.enrich import enrich
from tablescope.sources.lookups import payment_lookup, vendor_lookup


@dataclass
class Trips:
    """Cleaned trips and the columns found for each role."""

    df: DataFrame
    fare: str | None
    distance: str | None
    group: str | None
    has_time: bool

    @property
    def passengers(self) -> str | None:
        return "passenger_count" if "passenger_count" in self.df.columns else None


def load_and_clean(df: DataFrame) -> Trips:
    """Normalise names, derive pickup_dt/hour/date/month, apply the sanity
    bounds (only for columns that exist)."""
    df = normalise_columns(df)
    ts = find_role(df, "timestamp")
    if ts:
        df = with_time_parts(df, ts, out="pickup_dt")
    fare = find_role(df, "fare")
    dist = find_role(df, "distance")
    df = quality.sanity_filter(df, quality.trip_bounds(fare, dist))
    return Trips(df=df, fare=fare, distance=dist, group=group_role(df), has_time=bool(ts))


def _require(cond: bool, what: str) -> None:
    if not cond:
        raise ValueError(f"trip table lacks {what}")


def outliers(t: Trips) -> DataFrame:
    _require(t.fare is not None, "a fare column")
    return quality.outliers(t.df, t.fare, passengers=t.passengers)


def base_cube(t: Trips, *keys: str) -> DataFrame:
    """Per (date, hour, group): the additive pieces every grouped output
    needs. Its size is dates x 24 x groups, independent of the trip count. A
    single output names the ``keys`` it needs, and is grouped once."""
    _require(t.has_time, "a pickup time column")
    by = list(keys) or ["date", "hour"] + ([t.group] if t.group else [])
    return aggregate.trip_cube(t.df, by, t.fare, t.distance, t.passengers)


def daily(t: Trips, cube: DataFrame | None = None) -> DataFrame:
    _require(t.fare is not None and t.has_time and t.group is not None,
             "fare, pickup time or a payment/vendor column")
    return aggregate.daily_by_group(base_cube(t, "date", t.group) if cube is None else cube, t.group)


def ranked(t: Trips, daily_df: DataFrame | None = None) -> DataFrame:
    d = daily(t) if daily_df is None else daily_df
    return ranking.rank_within(d, "date", "daily_revenue")


def running(t: Trips, daily_df: DataFrame | None = None) -> DataFrame:
    d = daily(t) if daily_df is None else daily_df
    return ranking.running_totals(d, t.group, "date", {
        "cumulative_revenue": "daily_revenue",
        "cumulative_trips": "trip_count",
    })


def sessions(t: Trips, cube: DataFrame | None = None) -> DataFrame:
    return aggregate.time_of_day_summary(base_cube(t, "hour") if cube is None else cube)


def pivot(t: Trips, cube: DataFrame | None = None) -> DataFrame:
    _require(t.fare is not None and t.has_time, "fare or pickup time")
    return aggregate.hour_session_pivot(base_cube(t, "hour") if cube is None else cube)


def time_series(t: Trips, cube: DataFrame | None = None) -> DataFrame:
    return aggregate.daily_series(base_cube(t, "date") if cube is None else cube)


def enriched(t: Trips, spark: SparkSession, cap: int | None = None) -> DataFrame:
    """All trips with vendor and payment names; the first ``cap`` in column
    order only if a cap is given."""
    df = t.df
    vendor = find_role(df, "vendor")
    payment = find_role(df, "payment")
    if vendor:
        df = enrich(df, vendor, vendor_lookup(spark))
    if payment:
        df = enrich(df, payment, payment_lookup(spark))
    # The columns of the output.
    out = keep_existing(df, ["date", "hour", "month", "vendor_name", "payment_name",
                             t.fare, "trip_distance", "passenger_count"])
    return ranking.cap_rows(out, cap, order=out.columns) if cap else out


# Output name -> (title, description).
OUTPUTS = {
    "outliers": ("Outlier detection", "Trips flagged by the first rule they meet: fare above mean + 3 standard "
                 "deviations, fare below one, more than five passengers"),
    "ranked": ("Daily revenue rank per payment type", "Revenue and trips per day and payment type, ranked within the day"),
    "running_totals": ("Running revenue and trips per payment type", "Cumulative revenue and trips per payment type by day"),
    "sessions": ("Trips per time-of-day label", "Revenue, average fare, trips and average distance per time of day"),
    "pivot": ("Revenue by hour x time-of-day label", "Revenue per hour, one column per time of day, empty cells zero"),
    "time_series": ("Daily trips and revenue", "Trips, revenue, average fare and distance, passengers per day"),
    "joined": ("Trips with vendor and payment names", "Every cleaned trip with the names of its vendor and payment type"),
}
OUTPUT_TITLES = {name: title for name, (title, _) in OUTPUTS.items()}


def report_columns(t: Trips) -> list[str]:
    """Columns any output reads: role columns, time parts, name keys."""
    df = t.df
    want = ["date", "hour", "month", t.fare, t.distance, "trip_distance", "passenger_count",
            t.group, find_role(df, "vendor"), find_role(df, "payment")]
    return [c for c in dict.fromkeys(want) if c and c in df.columns]


def prune(t: Trips) -> Trips:
    return Trips(df=t.df.select(*report_columns(t)), fare=t.fare, distance=t.distance,
                 group=t.group, has_time=t.has_time)


def report_outputs(spark: SparkSession, t: Trips, cube: DataFrame | None = None,
                   cap: int | None = None) -> dict[str, DataFrame]:
    """The seven outputs that apply to this table (missing roles skip an
    output instead of failing the report). The grouped outputs roll up
    ``cube`` (default: :func:`base_cube` of ``t``); ``joined`` holds every
    trip unless a ``cap`` is given."""
    out: dict[str, DataFrame] = {}
    if t.fare:
        out["outliers"] = outliers(t)
    if t.has_time:
        cube = base_cube(t) if cube is None else cube
        if t.fare and t.group:
            d = daily(t, cube)
            out["ranked"] = ranked(t, d)
            out["running_totals"] = running(t, d)
        out["sessions"] = sessions(t, cube)
        if t.fare:
            out["pivot"] = pivot(t, cube)
        out["time_series"] = time_series(t, cube)
    out["joined"] = enriched(t, spark, cap)
    return out


def run_trip_report(spark: SparkSession, source: DataFrame, out_dir: str, fmt: str = "csv", *,
                    storage: StorageLevel | None = None, cap: int | None = None,
                    parallel: int = 4) -> dict[str, int]:
    """Clean ``source``, write every applicable output under ``out_dir``
    (one directory per output), return rows written per output.

    The cleaned trips are pruned to the columns the outputs read. The shared
    aggregate is written once below the checkpoint folder and deleted when
    the run ends; outliers and joined trips read the source again unless
    ``storage`` says where to keep the trips. Up to ``parallel`` outputs are
    written at once.
    """
    from tablescope.session import materialize, scratch
    from tablescope.sources.sinks import write_results

    t = prune(load_and_clean(source))
    cached = t.df.persist(storage) if storage is not None else None
    try:
        with scratch(spark):
            cube = materialize(base_cube(t)) if t.has_time else None
            return write_results(report_outputs(spark, t, cube, cap), out_dir, fmt, parallel=parallel)
    finally:
        if cached is not None:
            cached.unpersist()
