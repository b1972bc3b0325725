"""Registered queries and their oracle SQL.

Each query reads the shared test tables (``<sf_dir>/<table>.parquet``) in
full and returns a DataFrame (some run small jobs, or write intermediate
tables to the checkpoint folder, while they are built). ``ORACLE_SQL`` holds, for the same key,
an independent DuckDB statement over views of those tables. Column names
match on both sides; money sums are rounded to 2 digits and averages /
deviations / shares to 6 on both sides, because floating-point sums depend
on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescope.operators import ranking
from tablescope.plans import trip_report as tr
from tablescope.sources.testdata import table, trips

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE_SQL[key] = sql
        return fn
    return deco


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Round for comparison. Averages and shares (4+ digits) are rounded
    twice, first to ``d + 3`` digits, which absorbs summation-order noise
    that would otherwise decide an exact tie (e.g. 1546.13 / 32)."""
    def r(c: str, d: int) -> Column:
        return F.round(F.round(c, d + 3), d) if d >= 4 else F.round(c, d)
    return df.withColumns({c: r(c, d) for c, d in digits.items() if c in df.columns})


def cleaned_trips(spark: SparkSession, sf_dir: str) -> tr.Trips:
    return tr.load_and_clean(trips(spark, sf_dir))


# ---------------------------------------------------------------------------
# Shared SQL pieces
# ---------------------------------------------------------------------------

# Fixed values in these statements: bounds, labels, names and lookup rows.
TRIP_RAW_CTE = """
trip_raw AS (
  SELECT event_id % 3 AS vendor_id,
         ts AS pickup_datetime,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 8 AS passenger_count,
         CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) / 4.0 AS trip_distance,
         CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'error' THEN 3
                         WHEN 'signup' THEN 4 WHEN 'purchase' THEN 9 END AS payment_type,
         value AS fare_amount
  FROM events)"""

TRIPS_CTE = TRIP_RAW_CTE + """,
trips AS (
  SELECT *, pickup_datetime AS pickup_dt,
         CAST(hour(pickup_datetime) AS INTEGER) AS hour,
         CAST(pickup_datetime AS DATE) AS date,
         strftime(pickup_datetime, '%Y-%m') AS month
  FROM trip_raw
  WHERE fare_amount BETWEEN 0.01 AND 500
    AND trip_distance BETWEEN 0.01 AND 100
    AND passenger_count BETWEEN 1 AND 6)"""


def session_case(col: str = "hour", sep: str = " ") -> str:
    m, e = f"Morning{sep}Rush", f"Evening{sep}Rush"
    early = f"Early{sep}Morning"
    return (f"CASE WHEN {col} >= 7 AND {col} < 10 THEN '{m}' "
            f"WHEN {col} >= 10 AND {col} < 16 THEN 'Daytime' "
            f"WHEN {col} >= 16 AND {col} < 20 THEN '{e}' "
            f"WHEN {col} >= 20 OR {col} < 5 THEN 'Night' ELSE '{early}' END")


DAILY_CTE = TRIPS_CTE + """,
daily AS (
  SELECT date, payment_type, CAST(SUM(fare_amount) AS DOUBLE) AS daily_revenue,
         COUNT(*) AS trip_count
  FROM trips GROUP BY date, payment_type)"""

OUTLIER_CTE = TRIPS_CTE + """,
thr AS (SELECT AVG(fare_amount) + 3 * STDDEV_SAMP(fare_amount) AS t FROM trips),
flagged AS (
  SELECT CASE WHEN fare_amount > thr.t THEN 'fare > mean+3σ'
              WHEN fare_amount < 1.0 THEN 'fare < $1'
              WHEN passenger_count > 5 THEN 'passenger_count > 5' END AS outlier_reason,
         fare_amount, passenger_count, trip_distance, hour, date
  FROM trips, thr)"""

ENRICHED_CTE = TRIPS_CTE + """,
vendor(vendor_id_key, vendor_name) AS (
  VALUES (1, 'Creative Mobile Technologies'), (2, 'VeriFone Inc')),
payment(payment_type_key, payment_name) AS (
  VALUES (1, 'Credit Card'), (2, 'Cash'), (3, 'No Charge'), (4, 'Dispute'),
         (5, 'Unknown'), (6, 'Voided Trip')),
enriched AS (
  SELECT t.date, t.hour, t.month, v.vendor_name, p.payment_name,
         t.fare_amount, t.trip_distance, t.passenger_count
  FROM trips t
  LEFT JOIN vendor v ON TRY_CAST(t.vendor_id AS INTEGER) = v.vendor_id_key
  LEFT JOIN payment p ON TRY_CAST(t.payment_type AS INTEGER) = p.payment_type_key)"""


# ---------------------------------------------------------------------------
# Trip report (events as trips)
# ---------------------------------------------------------------------------

@register("p5_p8_time_parts", f"""
WITH {TRIP_RAW_CTE}
SELECT pickup_datetime AS pickup_dt, CAST(hour(pickup_datetime) AS INTEGER) AS hour,
       CAST(pickup_datetime AS DATE) AS date, strftime(pickup_datetime, '%Y-%m') AS month
FROM trip_raw""")
def q_time_parts(spark, sf_dir):
    from tablescope.functions.timeparts import with_time_parts
    return with_time_parts(trips(spark, sf_dir), "pickup_datetime").select(
        "pickup_dt", "hour", "date", "month")


@register("p9_time_of_day_label", f"""
WITH {TRIPS_CTE}
SELECT hour, {session_case()} AS session, COUNT(*) AS trips FROM trips GROUP BY ALL""")
def q_time_of_day(spark, sf_dir):
    from tablescope.functions.labels import time_of_day
    t = cleaned_trips(spark, sf_dir).df
    return (t.withColumn("session", time_of_day("hour"))
             .groupBy("hour", "session").agg(F.count(F.lit(1)).alias("trips")))


@register("f1_sanity_filter", f"""
WITH {TRIPS_CTE} SELECT * FROM trips""")
def q_sanity(spark, sf_dir):
    return cleaned_trips(spark, sf_dir).df


@register("a1_fare_stats", f"""
WITH {TRIPS_CTE}
SELECT ROUND(ROUND(AVG(fare_amount), 9), 6) AS mean, ROUND(ROUND(STDDEV_SAMP(fare_amount), 9), 6) AS std FROM trips""")
def q_fare_stats(spark, sf_dir):
    from tablescope.operators.quality import column_stats
    t = cleaned_trips(spark, sf_dir)
    return rounded(column_stats(t.df, t.fare), {"mean": 6, "std": 6})


@register("a2_outliers", f"""
WITH {OUTLIER_CTE} SELECT * FROM flagged WHERE outlier_reason IS NOT NULL""")
def q_outliers(spark, sf_dir):
    return tr.outliers(cleaned_trips(spark, sf_dir))


@register("a18_outlier_reason_counts", f"""
WITH {OUTLIER_CTE}
SELECT outlier_reason, COUNT(*) AS count FROM flagged
WHERE outlier_reason IS NOT NULL GROUP BY outlier_reason""")
def q_outlier_counts(spark, sf_dir):
    from tablescope.operators.explore import category_frequency
    return category_frequency(tr.outliers(cleaned_trips(spark, sf_dir)), "outlier_reason")


@register("a3_daily_by_payment", f"""
WITH {DAILY_CTE}
SELECT date, payment_type, ROUND(daily_revenue, 2) AS daily_revenue, trip_count FROM daily""")
def q_daily(spark, sf_dir):
    return rounded(tr.daily(cleaned_trips(spark, sf_dir)), {"daily_revenue": 2})


@register("w1_rank_within_day", f"""
WITH {DAILY_CTE}
SELECT date, payment_type, ROUND(daily_revenue, 2) AS daily_revenue, trip_count,
       CAST(RANK() OVER (PARTITION BY date ORDER BY daily_revenue DESC) AS INTEGER) AS rank
FROM daily""")
def q_ranked(spark, sf_dir):
    return rounded(tr.ranked(cleaned_trips(spark, sf_dir)), {"daily_revenue": 2})


@register("w2_w3_running_totals", f"""
WITH {DAILY_CTE}
SELECT date, payment_type, ROUND(daily_revenue, 2) AS daily_revenue, trip_count,
       ROUND(SUM(daily_revenue) OVER w, 2) AS cumulative_revenue,
       CAST(SUM(trip_count) OVER w AS BIGINT) AS cumulative_trips
FROM daily
WINDOW w AS (PARTITION BY payment_type ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_running(spark, sf_dir):
    return rounded(tr.running(cleaned_trips(spark, sf_dir)),
                   {"daily_revenue": 2, "cumulative_revenue": 2})


@register("a4_time_of_day_summary", f"""
WITH {TRIPS_CTE}
SELECT {session_case()} AS session, ROUND(SUM(fare_amount), 2) AS total_revenue,
       ROUND(ROUND(AVG(fare_amount), 9), 6) AS avg_fare, COUNT(*) AS trip_count,
       ROUND(ROUND(AVG(trip_distance), 9), 6) AS avg_distance
FROM trips GROUP BY 1""")
def q_sessions(spark, sf_dir):
    return rounded(tr.sessions(cleaned_trips(spark, sf_dir)),
                   {"total_revenue": 2, "avg_fare": 6, "avg_distance": 6})


PIVOT_SQL = f"""
WITH {TRIPS_CTE},
lab AS (SELECT hour, fare_amount, {session_case(sep='_')} AS s FROM trips)
SELECT hour,
  COALESCE(ROUND(SUM(CASE WHEN s = 'Morning_Rush' THEN fare_amount END), 2), 0) AS Morning_Rush,
  COALESCE(ROUND(SUM(CASE WHEN s = 'Daytime' THEN fare_amount END), 2), 0) AS Daytime,
  COALESCE(ROUND(SUM(CASE WHEN s = 'Evening_Rush' THEN fare_amount END), 2), 0) AS Evening_Rush,
  COALESCE(ROUND(SUM(CASE WHEN s = 'Night' THEN fare_amount END), 2), 0) AS Night,
  COALESCE(ROUND(SUM(CASE WHEN s = 'Early_Morning' THEN fare_amount END), 2), 0) AS Early_Morning
FROM lab GROUP BY hour"""


@register("a5_hour_session_pivot", PIVOT_SQL)
def q_pivot(spark, sf_dir):
    return tr.pivot(cleaned_trips(spark, sf_dir))


@register("r1_pivot_to_long", f"""
WITH p AS ({PIVOT_SQL})
UNPIVOT p ON Morning_Rush, Daytime, Evening_Rush, Night, Early_Morning
INTO NAME session VALUE revenue""")
def q_pivot_long(spark, sf_dir):
    from tablescope.operators.explore import wide_to_long
    return wide_to_long(tr.pivot(cleaned_trips(spark, sf_dir)), ["hour"], "session", "revenue")


SERIES_SQL = f"""
WITH {TRIPS_CTE}
SELECT date, COUNT(*) AS trip_count, ROUND(SUM(fare_amount), 2) AS total_revenue,
       ROUND(ROUND(AVG(fare_amount), 9), 6) AS avg_fare, ROUND(ROUND(AVG(trip_distance), 9), 6) AS avg_distance,
       CAST(SUM(passenger_count) AS BIGINT) AS total_passengers
FROM trips GROUP BY date"""


@register("a6_daily_series", SERIES_SQL)
def q_series(spark, sf_dir):
    return rounded(tr.time_series(cleaned_trips(spark, sf_dir)),
                   {"total_revenue": 2, "avg_fare": 6, "avg_distance": 6})


@register("r2_series_to_long", f"""
WITH s AS ({SERIES_SQL})
SELECT date, metric, value FROM (
  SELECT date, 'trip_count' AS metric, CAST(trip_count AS DOUBLE) AS value FROM s
  UNION ALL SELECT date, 'total_revenue', total_revenue FROM s)""")
def q_series_long(spark, sf_dir):
    from tablescope.operators.explore import wide_to_long
    s = q_series(spark, sf_dir)
    return wide_to_long(s, ["date"], "metric", "value", ["trip_count", "total_revenue"])


@register("j1_j2_enrich_lookups", f"""
WITH {ENRICHED_CTE} SELECT * FROM enriched""")
def q_enriched(spark, sf_dir):
    return tr.enriched(cleaned_trips(spark, sf_dir), spark, cap=None)


@register("l3_enriched_trips", f"""
WITH {ENRICHED_CTE} SELECT * FROM enriched""")
def q_enriched_all(spark, sf_dir):
    return tr.report_outputs(spark, cleaned_trips(spark, sf_dir))["joined"]


# T4, a row cap where the caller gives one.
ROW_CAP = 50_000


@register("l3_enriched_trips_capped", f"""
WITH {ENRICHED_CTE}
SELECT * FROM enriched
ORDER BY date NULLS FIRST, hour NULLS FIRST, month NULLS FIRST, vendor_name NULLS FIRST,
         payment_name NULLS FIRST, fare_amount NULLS FIRST, trip_distance NULLS FIRST,
         passenger_count NULLS FIRST
LIMIT {ROW_CAP}""")
def q_enriched_capped(spark, sf_dir):
    return tr.enriched(cleaned_trips(spark, sf_dir), spark, cap=ROW_CAP)


@register("a17_vendor_payment_sizes", f"""
WITH {ENRICHED_CTE}
SELECT vendor_name, payment_name, COUNT(*) AS count FROM enriched
WHERE vendor_name IS NOT NULL AND payment_name IS NOT NULL GROUP BY ALL""")
def q_vendor_payment(spark, sf_dir):
    from tablescope.operators.explore import group_sizes
    return group_sizes(tr.enriched(cleaned_trips(spark, sf_dir), spark, cap=None),
                       ["vendor_name", "payment_name"])


@register("a16_row_counts", f"""
WITH {TRIP_RAW_CTE}
SELECT COUNT(*) AS rows,
       COUNT(*) FILTER (WHERE fare_amount BETWEEN 0.01 AND 500 AND trip_distance BETWEEN 0.01 AND 100
                        AND passenger_count BETWEEN 1 AND 6) AS clean_rows
FROM trip_raw""")
def q_row_counts(spark, sf_dir):
    from tablescope.operators.explore import row_counts
    from tablescope.operators.quality import TRIP_DISTANCE_BOUNDS, TRIP_FARE_BOUNDS, TRIP_PASSENGER_BOUNDS
    raw = trips(spark, sf_dir)
    clean = (F.col("fare_amount").between(*TRIP_FARE_BOUNDS)
             & F.col("trip_distance").between(*TRIP_DISTANCE_BOUNDS)
             & F.col("passenger_count").between(*TRIP_PASSENGER_BOUNDS))
    return row_counts(raw, clean_rows=clean)


# ---------------------------------------------------------------------------
# Generic table library (cleaning, summaries, top-N) on the TPC-H-like tables
# ---------------------------------------------------------------------------

def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` made dirty: raw names with spaces and capitals, padded
    strings, every row twice (differently padded), and rows with a
    negative balance blanked to all-null."""
    c = table(spark, sf_dir, "customer")
    keep = F.col("c_acctbal") >= 0

    def copy(pad_l: str, pad_r: str) -> DataFrame:
        return c.select(
            F.when(keep, F.col("c_custkey")).alias(" CustKey"),
            F.when(keep, F.concat(F.lit(pad_l), "c_name", F.lit(pad_r))).alias("Customer Name "),
            F.when(keep, F.col("c_nationkey")).alias("Nation Key"),
            F.when(keep, F.col("c_acctbal")).alias("Acct Bal"),
            F.when(keep, F.concat(F.lit(pad_r), "c_mktsegment", F.lit(pad_l))).alias(" Mkt Segment"),
        )
    return copy("  ", " ").unionByName(copy("", "   "))


DIRTY_SQL = """
dirty AS (
  SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END AS custkey,
         CASE WHEN c_acctbal >= 0 THEN '  ' || c_name || ' ' END AS customer_name,
         CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS nation_key,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acct_bal,
         CASE WHEN c_acctbal >= 0 THEN ' ' || c_mktsegment || '  ' END AS mkt_segment
  FROM customer
  UNION ALL
  SELECT CASE WHEN c_acctbal >= 0 THEN c_custkey END,
         CASE WHEN c_acctbal >= 0 THEN c_name || '   ' END,
         CASE WHEN c_acctbal >= 0 THEN c_nationkey END,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END,
         CASE WHEN c_acctbal >= 0 THEN '   ' || c_mktsegment END
  FROM customer)"""

ALL_NULL = ("custkey IS NULL AND customer_name IS NULL AND nation_key IS NULL "
            "AND acct_bal IS NULL AND mkt_segment IS NULL")


@register("p1_normalise_names", f"""
WITH {DIRTY_SQL} SELECT * FROM dirty""")
def q_normalise(spark, sf_dir):
    from tablescope.functions.columns import normalise_columns
    return normalise_columns(dirty_customers(spark, sf_dir))


@register("p2_trim_strings", f"""
WITH {DIRTY_SQL}
SELECT custkey, trim(customer_name) AS customer_name, nation_key, acct_bal,
       trim(mkt_segment) AS mkt_segment FROM dirty""")
def q_trim(spark, sf_dir):
    from tablescope.functions.columns import normalise_columns
    from tablescope.operators.quality import trim_strings
    return trim_strings(normalise_columns(dirty_customers(spark, sf_dir)))


@register("f5_drop_all_null_rows", f"""
WITH {DIRTY_SQL} SELECT * FROM dirty WHERE NOT ({ALL_NULL})""")
def q_drop_null_rows(spark, sf_dir):
    from tablescope.functions.columns import normalise_columns
    from tablescope.operators.quality import drop_all_null_rows
    return drop_all_null_rows(normalise_columns(dirty_customers(spark, sf_dir)))


@register("a10_drop_duplicates", """
SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders)""")
def q_dedupe(spark, sf_dir):
    from tablescope.operators.quality import drop_duplicate_rows
    o = table(spark, sf_dir, "orders")
    return drop_duplicate_rows(o.unionByName(o))


@register("a10_duplicates_by_digest", """
SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 100 = 0)""")
def q_dedupe_digest(spark, sf_dir):
    """One row in a hundred is there twice."""
    from tablescope.operators.quality import drop_duplicate_rows
    o = table(spark, sf_dir, "orders")
    return drop_duplicate_rows(o.unionByName(o.where(F.col("o_orderkey") % 100 == 0)), by_digest=True)


CLEAN_SQL = f"""
{DIRTY_SQL},
cleaned AS (
  SELECT DISTINCT custkey, trim(customer_name) AS customer_name, nation_key, acct_bal,
         trim(mkt_segment) AS mkt_segment FROM dirty),
kept AS (SELECT * FROM cleaned WHERE NOT ({ALL_NULL}))"""


@register("a11_clean_dataframe", f"""
WITH {CLEAN_SQL} SELECT * FROM kept""")
def q_clean(spark, sf_dir):
    from tablescope.operators.quality import clean_dataframe
    return clean_dataframe(dirty_customers(spark, sf_dir))


@register("a11_clean_by_digest", f"""
WITH {CLEAN_SQL} SELECT * FROM kept""")
def q_clean_digest(spark, sf_dir):
    from tablescope.operators.quality import clean_dataframe
    return clean_dataframe(dirty_customers(spark, sf_dir), by_digest=True)


@register("f3_filter_by_value", """
SELECT * FROM lineitem WHERE l_quantity >= 10 AND l_quantity <= 20""")
def q_filter_value(spark, sf_dir):
    from tablescope.operators.quality import filter_by_value
    return filter_by_value(table(spark, sf_dir, "lineitem"), "l_quantity", 10, 20)


@register("f4_filter_by_category", """
SELECT * FROM lineitem WHERE l_returnflag IN ('A', 'R')""")
def q_filter_category(spark, sf_dir):
    from tablescope.operators.quality import filter_by_category
    return filter_by_category(table(spark, sf_dir, "lineitem"), "l_returnflag", ["A", "R"])


LINEITEM_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax"]


def summary_sql(cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts += [f"COUNT({c}) AS {c}_count", f"ROUND(CAST(SUM({c}) AS DOUBLE), 2) AS {c}_sum",
                  f"ROUND(ROUND(AVG({c}), 9), 6) AS {c}_avg", f"MIN({c}) AS {c}_min", f"MAX({c}) AS {c}_max"]
    return ", ".join(parts)


def summary_digits(cols: list[str]) -> dict[str, int]:
    return {**{f"{c}_sum": 2 for c in cols}, **{f"{c}_avg": 6 for c in cols}}


@register("a7_summary_by_category", f"""
SELECT l_returnflag, {summary_sql(LINEITEM_NUM)} FROM lineitem GROUP BY l_returnflag""")
def q_summary(spark, sf_dir):
    from tablescope.operators.aggregate import compute_summary
    return rounded(compute_summary(table(spark, sf_dir, "lineitem"), "l_returnflag"),
                   summary_digits(LINEITEM_NUM))


ORDERS_NUM = ["o_orderkey", "o_custkey", "o_totalprice"]


@register("a8_summary_ungrouped", f"""
SELECT {summary_sql(ORDERS_NUM)} FROM orders""")
def q_summary_flat(spark, sf_dir):
    from tablescope.operators.aggregate import compute_summary
    o = table(spark, sf_dir, "orders").select(*ORDERS_NUM, "o_orderdate")
    return rounded(compute_summary(o), summary_digits(ORDERS_NUM))


@register("a9_monthly_series", """
SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m') AS month,
       ROUND(CAST(SUM(o_orderkey) AS DOUBLE), 2) AS o_orderkey_total,
       ROUND(CAST(SUM(o_custkey) AS DOUBLE), 2) AS o_custkey_total,
       ROUND(SUM(o_totalprice), 2) AS o_totalprice_total,
       COUNT(*) AS row_count
FROM orders GROUP BY 1""")
def q_monthly(spark, sf_dir):
    from tablescope.operators.aggregate import compute_time_series
    return rounded(compute_time_series(table(spark, sf_dir, "orders"), "o_orderdate"),
                   {f"{c}_total": 2 for c in ORDERS_NUM})


LINEITEM_COLS = LINEITEM_NUM + ["l_returnflag", "l_linestatus", "l_shipdate"]


def order_all(cols: list[str], first: str | None = None) -> str:
    head = [f"{first} DESC NULLS LAST"] if first else []
    return ", ".join(head + [f"{c} ASC NULLS FIRST" for c in cols if c != first])


@register("t1_top_n", f"""
SELECT * FROM lineitem ORDER BY {order_all(LINEITEM_COLS, 'l_extendedprice')} LIMIT 20""")
def q_top_n(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return ranking.compute_top_n(li, 20, "l_extendedprice",
                                 tiebreak=[c for c in li.columns if c != "l_extendedprice"])


CLEAN_COLS = ["custkey", "customer_name", "nation_key", "acct_bal", "mkt_segment"]


@register("l5_report_summary", f"""
WITH {CLEAN_SQL}
SELECT customer_name, {summary_sql(['custkey', 'nation_key', 'acct_bal'])}
FROM kept GROUP BY customer_name""")
def q_report_summary(spark, sf_dir):
    from tablescope.plans.table_report import table_report
    out = table_report(dirty_customers(spark, sf_dir), outputs=("summary",))["summary"]
    return rounded(out, summary_digits(["custkey", "nation_key", "acct_bal"]))


@register("l5_report_top_n", f"""
WITH {CLEAN_SQL}
SELECT * FROM kept ORDER BY {order_all(CLEAN_COLS, 'custkey')} LIMIT 20""")
def q_report_top(spark, sf_dir):
    from tablescope.plans.table_report import table_report
    return table_report(dirty_customers(spark, sf_dir), outputs=("top_n",))["top_n"]


@register("l5_report_cleaned", f"""
WITH {CLEAN_SQL} SELECT * FROM kept""")
def q_report_cleaned(spark, sf_dir):
    from tablescope.plans.table_report import table_report
    return table_report(dirty_customers(spark, sf_dir), outputs=("cleaned",))["cleaned"]


@register("l5_report_cleaned_sample", f"""
WITH {CLEAN_SQL}
SELECT * FROM kept ORDER BY {order_all(CLEAN_COLS)} LIMIT 5000""")
def q_report_sample(spark, sf_dir):
    from tablescope.plans.table_report import table_report
    cleaned = table_report(dirty_customers(spark, sf_dir), outputs=("cleaned",))["cleaned"]
    return ranking.cap_rows(cleaned, 5_000, order=cleaned.columns)


# ---------------------------------------------------------------------------
# Explorer
# ---------------------------------------------------------------------------

@register("f6_category_filters", """
SELECT * FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def q_cat_filters(spark, sf_dir):
    from tablescope.operators.explore import category_filters
    return category_filters(table(spark, sf_dir, "orders"), {
        "o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH"],
        "o_custkey": []})


@register("f7_range_filters", """
SELECT * FROM orders
WHERE (NOT COALESCE((SELECT MIN(o_totalprice) < MAX(o_totalprice) FROM orders), FALSE)
       OR o_totalprice BETWEEN 50000 AND 150000)
  AND (NOT COALESCE((SELECT MIN(o_custkey) < MAX(o_custkey) FROM orders), FALSE)
       OR o_custkey BETWEEN 100 AND 900)""")
def q_range_filters(spark, sf_dir):
    from tablescope.operators.explore import range_filters
    return range_filters(table(spark, sf_dir, "orders"), {
        "o_totalprice": (50000, 150000), "o_custkey": (100, 900)})


GROUP_KEYS = ["l_returnflag", "l_linestatus"]
GROUP_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
GROUP_SQL = {
    "sum": ("ROUND(COALESCE(SUM({c}), 0), 2)", 2),
    "mean": ("ROUND(ROUND(AVG({c}), 9), 6)", 6),
    "count": ("COUNT({c})", None),
    "min": ("MIN({c})", None),
    "max": ("MAX({c})", None),
    "median": ("ROUND(ROUND(MEDIAN({c}), 9), 6)", 6),
}


def _group_query(func: str):
    expr, digits = GROUP_SQL[func]
    sql = (f"SELECT {', '.join(GROUP_KEYS)}, "
           + ", ".join(f"{expr.format(c=c)} AS {c}" for c in GROUP_COLS)
           + f" FROM lineitem WHERE {' AND '.join(k + ' IS NOT NULL' for k in GROUP_KEYS)}"
           + f" GROUP BY {', '.join(GROUP_KEYS)}")

    def q(spark, sf_dir):
        from tablescope.operators.explore import group_aggregate
        out = group_aggregate(table(spark, sf_dir, "lineitem"), GROUP_KEYS, GROUP_COLS, func)
        return rounded(out, {c: digits for c in GROUP_COLS}) if digits else out
    register(f"a12_groupby_{func}", sql)(q)


for _f in GROUP_SQL:
    _group_query(_f)


@register("a13_distinct_counts", """
SELECT 'p_name' AS "column", COUNT(DISTINCT p_name) AS n_distinct,
       COUNT(DISTINCT p_name) <= 50 AS low_cardinality FROM part
UNION ALL SELECT 'p_brand', COUNT(DISTINCT p_brand), COUNT(DISTINCT p_brand) <= 50 FROM part
UNION ALL SELECT 'p_type', COUNT(DISTINCT p_type), COUNT(DISTINCT p_type) <= 50 FROM part""")
def q_distinct_counts(spark, sf_dir):
    from tablescope.operators.explore import distinct_counts
    return distinct_counts(table(spark, sf_dir, "part"))


@register("a13_low_cardinality", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", COUNT(DISTINCT {c}) <= 50 AS low_cardinality,
       CASE WHEN COUNT(DISTINCT {c}) <= 50 THEN COUNT(DISTINCT {c}) END AS n_distinct,
       CASE WHEN COUNT(DISTINCT {c}) <= 50 THEN array_to_string(list_sort(list(DISTINCT {c})), '|') END AS options
FROM (SELECT *, CAST(p_partkey AS VARCHAR) AS key FROM part)""" for c in ("p_name", "p_brand", "p_type", "key")))
def q_low_cardinality(spark, sf_dir):
    """Which columns get a list, and the list; one column is unique."""
    from tablescope.operators.explore import low_cardinality
    part = table(spark, sf_dir, "part").withColumn("key", F.col("p_partkey").cast("string"))
    return low_cardinality(part).select("column", "low_cardinality", "n_distinct",
                                        F.array_join("values", "|").alias("options"))


@register("a14_distinct_values", """
SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL""")
def q_distinct_values(spark, sf_dir):
    from tablescope.operators.explore import distinct_values
    return distinct_values(table(spark, sf_dir, "part"), "p_brand")


@register("a15_numeric_bounds", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(MIN({c}) AS DOUBLE) + 0.0 AS min, CAST(MAX({c}) AS DOUBLE) + 0.0 AS max FROM lineitem"
    for c in LINEITEM_NUM))
def q_bounds(spark, sf_dir):
    from tablescope.operators.explore import numeric_bounds
    return numeric_bounds(table(spark, sf_dir, "lineitem"))


@register("a15_bounds_from_footers", ORACLE_SQL["a15_numeric_bounds"])
def q_footer_bounds(spark, sf_dir):
    from tablescope.operators.explore import numeric_bounds
    return numeric_bounds(table(spark, sf_dir, "lineitem"), footers=True)


@register("a17_group_sizes", """
SELECT o_orderstatus, o_orderpriority, COUNT(*) AS count FROM orders
WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY ALL""")
def q_group_sizes(spark, sf_dir):
    from tablescope.operators.explore import group_sizes
    return group_sizes(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


def histogram_sql(color: str | None) -> str:
    c_sel = f", {color}" if color else ""
    return f"""
WITH s AS (SELECT CAST(MIN(o_totalprice) AS DOUBLE) AS lo, CAST(MAX(o_totalprice) AS DOUBLE) AS hi FROM orders),
b AS (
  SELECT CASE WHEN hi = lo THEN 1
              ELSE LEAST(CAST(FLOOR((CAST(o_totalprice AS DOUBLE) - lo) / (hi - lo) * 50.0) + 1 AS INTEGER), 50)
         END AS bin, lo, hi{c_sel}
  FROM orders, s WHERE o_totalprice IS NOT NULL)
SELECT bin{c_sel}, COUNT(*) AS count,
       lo + (hi - lo) / 50.0 * (bin - 1) AS bin_start, lo + (hi - lo) / 50.0 * bin AS bin_end
FROM b GROUP BY bin, lo, hi{c_sel}"""


@register("a19_histogram", histogram_sql(None))
def q_hist(spark, sf_dir):
    from tablescope.operators.explore import histogram
    return histogram(table(spark, sf_dir, "orders"), "o_totalprice")


@register("a19_histogram_by_color", histogram_sql("o_orderstatus"))
def q_hist_color(spark, sf_dir):
    from tablescope.operators.explore import histogram
    return histogram(table(spark, sf_dir, "orders"), "o_totalprice", color="o_orderstatus")


@register("a19_histogram_footer_bounds", histogram_sql("o_orderstatus"))
def q_hist_footers(spark, sf_dir):
    from tablescope.operators.explore import histogram
    return histogram(table(spark, sf_dir, "orders"), "o_totalprice", color="o_orderstatus", footers=True)


@register("l6_explorer_footer_ranges", """
SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice BETWEEN 10000 AND 300000""")
def q_explorer_footers(spark, sf_dir):
    from tablescope.plans.explorer import ExplorerSpec, explore
    spec = ExplorerSpec(categories={"o_orderstatus": ["F", "O"]}, ranges={"o_totalprice": (10000, 300000)})
    return explore(table(spark, sf_dir, "orders"), spec, footers=True).table.select("o_orderkey")


@register("a20_box_stats", """
WITH base AS (SELECT o_orderpriority, o_totalprice AS y FROM orders
              WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL),
q AS (SELECT o_orderpriority, QUANTILE_CONT(y, 0.25) AS q1, QUANTILE_CONT(y, 0.5) AS median,
             QUANTILE_CONT(y, 0.75) AS q3 FROM base GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT b.o_orderpriority, COUNT(*) AS n, MIN(y) AS min, MAX(y) AS max,
       MIN(CASE WHEN y >= lo_f THEN y END) AS lower_whisker,
       MAX(CASE WHEN y <= hi_f THEN y END) AS upper_whisker,
       COUNT(*) FILTER (WHERE y < lo_f OR y > hi_f) AS n_outliers,
       ROUND(ROUND(ANY_VALUE(f.q1), 9), 6) AS q1, ROUND(ROUND(ANY_VALUE(f.median), 9), 6) AS median,
       ROUND(ROUND(ANY_VALUE(f.q3), 9), 6) AS q3
FROM base b JOIN f USING (o_orderpriority) GROUP BY b.o_orderpriority""")
def q_box(spark, sf_dir):
    from tablescope.operators.explore import box_stats
    out = box_stats(table(spark, sf_dir, "orders"), "o_totalprice", by="o_orderpriority")
    return rounded(out, {"q1": 6, "median": 6, "q3": 6})


@register("a21_share_of_total", """
WITH g AS (SELECT o_orderpriority, CAST(SUM(o_totalprice) AS DOUBLE) AS o_totalprice
           FROM orders GROUP BY 1)
SELECT o_orderpriority, ROUND(o_totalprice, 2) AS o_totalprice,
       ROUND(ROUND(o_totalprice / SUM(o_totalprice) OVER (), 9), 6) AS share FROM g""")
def q_share(spark, sf_dir):
    from tablescope.operators.explore import share_of_total
    out = share_of_total(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")
    return rounded(out, {"o_totalprice": 2, "share": 6})


@register("a22_bar_series", """
SELECT l_returnflag, l_linestatus, SUM(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL""")
def q_bar(spark, sf_dir):
    from tablescope.operators.explore import bar_series
    return bar_series(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_quantity", "l_linestatus")


@register("p16_chart_projection", """
SELECT o_orderdate, o_totalprice, o_orderstatus FROM orders""")
def q_projection(spark, sf_dir):
    from tablescope.operators.explore import chart_projection
    return chart_projection(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice",
                            "o_orderstatus")


@register("t5_sample_exact", """
SELECT LEAST(3000, COUNT(*)) AS rows, LEAST(3000, COUNT(DISTINCT o_orderkey)) AS keys,
       LEAST(3000, COUNT(*)) AS known FROM orders""")
def q_sample(spark, sf_dir):
    """What holds for any draw: its size, distinct keys, all of them orders."""
    from tablescope.operators.explore import sample_rows
    orders = table(spark, sf_dir, "orders")
    drawn = sample_rows(orders, 3000, seed=7)
    known = drawn.join(orders.select("o_orderkey"), "o_orderkey", "left_semi")
    return drawn.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("keys")).withColumn(
        "known", known.select(F.count(F.lit(1))).scalar())


@register("t5_sample_one_scan", ORACLE_SQL["t5_sample_exact"])
def q_sample_one_scan(spark, sf_dir):
    """The same properties, of a sample drawn without counting the rows."""
    from tablescope.operators.sampling import sample_one_scan
    orders = table(spark, sf_dir, "orders")
    drawn = sample_one_scan(orders, 3000, seed=7)
    known = drawn.join(orders.select("o_orderkey"), "o_orderkey", "left_semi")
    return drawn.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("keys")).withColumn(
        "known", known.select(F.count(F.lit(1))).scalar())


@register("w2_w3_running_spread", """
SELECT o_orderkey, o_orderstatus, ROUND(SUM(o_totalprice) OVER w, 2) AS price_so_far, COUNT(o_custkey) OVER w AS orders_so_far
FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate NULLS FIRST, o_orderkey
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_running_spread(spark, sf_dir):
    """Raw rows, a third of them in each group: no group lies in one task."""
    from tablescope.operators.segments import running_totals_spread
    orders = table(spark, sf_dir, "orders").withColumn("one", F.when(F.col("o_custkey").isNotNull(), 1))
    out = running_totals_spread(orders, "o_orderstatus", "o_orderdate", {"price_so_far": "o_totalprice", "orders_so_far": "one"},
                                tiebreak=["o_orderkey"])
    return rounded(out.select("o_orderkey", "o_orderstatus", "price_so_far", "orders_so_far"), {"price_so_far": 2})


@register("w1_rank_spread", """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_quantity,
       RANK() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS rank FROM lineitem""")
def q_rank_spread(spark, sf_dir):
    """Few quantities, so each rank is shared by many of a third of all rows."""
    from tablescope.operators.segments import rank_within_spread
    return rank_within_spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity"), "l_returnflag", "l_quantity")


@register("f7_clustered_layout", """
SELECT * FROM lineitem WHERE l_extendedprice BETWEEN 20000 AND 30000 AND l_quantity BETWEEN 10 AND 20""")
def q_clustered(spark, sf_dir):
    """Written along a curve through both columns, then filtered on both."""
    from tablescope.operators.explore import range_filters
    from tablescope.sources.layout import write_clustered
    from tablescope.sources.published import read_published
    path = _folder(spark)
    write_clustered(table(spark, sf_dir, "lineitem"), path, ["l_extendedprice", "l_quantity"])
    return range_filters(read_published(spark, path), {"l_extendedprice": (20000, 30000), "l_quantity": (10, 20)}, footers=True)


EXPLORER_SPEC = dict(
    categories={"o_orderstatus": ["F", "O"]}, ranges={"o_totalprice": (10000, 300000)},
    group_by=["o_orderpriority"], aggregate=["o_totalprice", "o_custkey"], func="mean",
    chart="pie", x="o_orderpriority", y="o_totalprice")

EXPLORER_ROWS_SQL = """
SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_totalprice BETWEEN 10000 AND 300000"""


@register("l6_explorer_table", f"""
SELECT o_orderpriority, ROUND(ROUND(AVG(o_totalprice), 9), 6) AS o_totalprice,
       ROUND(ROUND(AVG(o_custkey), 9), 6) AS o_custkey
FROM ({EXPLORER_ROWS_SQL}) WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def q_explorer_table(spark, sf_dir):
    from tablescope.plans.explorer import ExplorerSpec, explore
    res = explore(table(spark, sf_dir, "orders"), ExplorerSpec(**EXPLORER_SPEC))
    return rounded(res.table, {"o_totalprice": 6, "o_custkey": 6})


@register("l6_explorer_chart", f"""
WITH g AS (SELECT o_orderpriority, AVG(o_totalprice) AS o_totalprice
           FROM ({EXPLORER_ROWS_SQL}) WHERE o_orderpriority IS NOT NULL GROUP BY 1)
SELECT o_orderpriority, ROUND(ROUND(o_totalprice, 7), 4) AS o_totalprice,
       ROUND(ROUND(o_totalprice / SUM(o_totalprice) OVER (), 9), 6) AS share FROM g""")
def q_explorer_chart(spark, sf_dir):
    from tablescope.plans.explorer import ExplorerSpec, explore
    res = explore(table(spark, sf_dir, "orders"), ExplorerSpec(**EXPLORER_SPEC))
    return rounded(res.chart, {"o_totalprice": 4, "share": 6})


PART_NUM = ["p_partkey", "p_size", "p_retailprice"]


@register("p4_summary_default_roles", f"""
SELECT p_name, {summary_sql(PART_NUM)} FROM part GROUP BY p_name""")
def q_summary_defaults(spark, sf_dir):
    """No category given: the first string column (p_name) groups, every
    numeric column (bigint, int, double) is a measure."""
    from tablescope.operators.aggregate import compute_summary
    return rounded(compute_summary(table(spark, sf_dir, "part")), summary_digits(PART_NUM))


@register("t1_top_n_default_column", """
SELECT * FROM orders ORDER BY o_orderkey DESC NULLS LAST LIMIT 20""")
def q_top_n_default(spark, sf_dir):
    """No sort column given: the first numeric column (o_orderkey, unique)."""
    return ranking.compute_top_n(table(spark, sf_dir, "orders"))


# ---------------------------------------------------------------------------
# Text values that do not parse, filters of a constant column
# ---------------------------------------------------------------------------

@register("f1_text_values", """
SELECT event_id, value FROM events WHERE event_id % 7 <> 0 AND value BETWEEN 0.01 AND 500""")
def q_sanity_text(spark, sf_dir):
    from tablescope.operators.quality import TRIP_FARE_BOUNDS, sanity_filter
    events = table(spark, sf_dir, "events")
    text = events.withColumn("fare", F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string")))
    return sanity_filter(text, {"fare": TRIP_FARE_BOUNDS}).select("event_id", "value")


@register("f3_text_values", """
SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0 AND o_totalprice >= 100000""")
def q_filter_text(spark, sf_dir):
    from tablescope.operators.quality import filter_by_value
    orders = table(spark, sf_dir, "orders")
    text = orders.withColumn("price", F.when(F.col("o_orderkey") % 5 == 0, "12,5").otherwise(
        F.col("o_totalprice").cast("string")))
    return filter_by_value(text, "price", min_val=100000).select("o_orderkey")


@register("a9_text_dates", """
SELECT CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m') END AS month,
       CAST(SUM(o_orderkey) AS DOUBLE) AS o_orderkey_total, COUNT(*) AS row_count
FROM orders GROUP BY 1""")
def q_monthly_text(spark, sf_dir):
    from tablescope.operators.aggregate import compute_time_series
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 == 0, "no date").otherwise(day).alias("day"))
    return compute_time_series(text, "day")


@register("l6_explorer_range_of_constant", """
SELECT COUNT(*) AS rows FROM (SELECT *, CASE o_orderstatus WHEN 'P' THEN 2 ELSE 1 END AS kind FROM orders)
WHERE o_orderstatus IN ('P') AND kind BETWEEN 0 AND 1""")
def q_explorer_constant(spark, sf_dir):
    """The category filter leaves one value of ``kind``, outside its range."""
    from tablescope.plans.explorer import ExplorerSpec, explore
    orders = table(spark, sf_dir, "orders").withColumn("kind", F.when(F.col("o_orderstatus") == "P", 2).otherwise(1))
    spec = ExplorerSpec(categories={"o_orderstatus": ["P"]}, ranges={"kind": (0, 1)})
    return explore(orders, spec).table.agg(F.count(F.lit(1)).alias("rows"))


@register("t4_first_rows_text_key", """
SELECT o_orderpriority, o_orderkey FROM orders
ORDER BY o_orderpriority NULLS FIRST, o_orderkey NULLS FIRST LIMIT 2000""")
def q_first_rows_text(spark, sf_dir):
    cols = ["o_orderpriority", "o_orderkey"]
    return ranking.first_rows(table(spark, sf_dir, "orders").select(*cols), 2000, cols)


@register("t4_first_rows_common_prefix", """
SELECT 'a common beginning of more than forty bytes/' || CAST(o_orderkey * 7919 % 15013 AS VARCHAR) AS path, o_orderkey
FROM orders ORDER BY path, o_orderkey LIMIT 2000""")
def q_first_rows_prefix(spark, sf_dir):
    key = F.col("o_orderkey")
    paths = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("a common beginning of more than forty bytes/"), (key * 7919 % 15013).cast("string")).alias("path"), key)
    return ranking.first_rows(paths, 2000, ["path", "o_orderkey"])


PRIORITY_SIZES = "SELECT o_orderpriority, COUNT(*) AS count FROM orders GROUP BY 1"


def _numbered(df: DataFrame) -> DataFrame:
    """The place of each row of a small sorted result."""
    from pyspark.sql import Window
    return df.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))


@register("t2_sorted_descending", f"""
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY count DESC, o_orderpriority NULLS FIRST) AS INTEGER) AS place
FROM ({PRIORITY_SIZES})""")
def q_sort_desc(spark, sf_dir):
    from tablescope.operators.explore import category_frequency
    sizes = category_frequency(table(spark, sf_dir, "orders"), "o_orderpriority")
    return _numbered(ranking.sort_desc(sizes, "count", tiebreak=["o_orderpriority"]))


@register("t3_sorted_ascending", f"""
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY o_orderpriority NULLS FIRST) AS INTEGER) AS place FROM ({PRIORITY_SIZES})""")
def q_sort_asc(spark, sf_dir):
    from tablescope.operators.explore import category_frequency
    sizes = category_frequency(table(spark, sf_dir, "orders"), "o_orderpriority")
    return _numbered(ranking.sort_asc(sizes, "o_orderpriority"))


# ---------------------------------------------------------------------------
# Sinks and sources: written to the checkpoint folder and read back
# ---------------------------------------------------------------------------

def _folder(spark: SparkSession) -> str:
    import uuid

    from tablescope.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/results/{uuid.uuid4().hex}"


@register("s1_s4_csv_round_trip", "SELECT * FROM orders")
def q_csv(spark, sf_dir):
    from tablescope.sources.files import read_csv
    from tablescope.sources.sinks import write_csv
    orders, path = table(spark, sf_dir, "orders"), _folder(spark)
    write_csv(orders, path)
    return read_csv(spark, path, schema=orders.schema)


@register("s2_explorer_csv", """
SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS whole, o_totalprice AS number,
       o_orderkey % 2 = 0 AS yes, CAST(o_orderkey AS VARCHAR) || 'd' AS code, CAST(NULL AS DOUBLE) AS nothing
FROM orders""")
def q_explorer_csv(spark, sf_dir):
    from tablescope.sources.files import read_explorer_csv
    from tablescope.sources.sinks import write_csv
    key, path = F.col("o_orderkey"), _folder(spark)
    write_csv(table(spark, sf_dir, "orders").select(
        F.when(key % 3 == 0, "N/A").otherwise(key.cast("string")).alias("whole"),
        F.col("o_totalprice").alias("number"), F.when(key % 2 == 0, "True").otherwise("False").alias("yes"),
        F.concat(key.cast("string"), F.lit("d")).alias("code"), F.lit("NaN").alias("nothing")), path)
    return read_explorer_csv(spark, path)


@register("s2_explorer_na_spellings", """
SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS whole,
       CASE WHEN o_orderkey % 5 <> 1 THEN o_totalprice END AS number,
       CASE WHEN o_orderkey % 5 <> 2 THEN o_orderkey % 2 = 0 END AS yes,
       CASE WHEN o_orderkey % 5 <> 3 THEN CASE o_orderkey % 4 WHEN 0 THEN '007' WHEN 1 THEN '1e3' WHEN 2 THEN 'True'
                                           ELSE 'part ' || CAST(o_orderkey AS VARCHAR) END END AS mixed
FROM orders""")
def q_explorer_na(spark, sf_dir):
    """One value in five is missing, in every spelling; a text column of values
    that read as something else keeps them as they are spelled."""
    from tablescope.sources.files import NA_SPELLINGS, read_explorer_csv
    from tablescope.sources.sinks import write_csv
    key, path = F.col("o_orderkey"), _folder(spark)
    missing = F.element_at(F.array(*[F.lit(x) for x in NA_SPELLINGS]), (F.floor(key / 5) % len(NA_SPELLINGS) + 1).cast("int"))

    def holed(i: int, column: Column) -> Column:
        return F.when(key % 5 == i, missing).otherwise(column.cast("string"))

    mixed = F.when(key % 4 == 0, "007").when(key % 4 == 1, "1e3").when(key % 4 == 2, "True").otherwise(
        F.concat(F.lit("part "), key.cast("string")))
    write_csv(table(spark, sf_dir, "orders").select(
        holed(0, F.col("o_custkey")).alias("whole"), holed(1, F.col("o_totalprice")).alias("number"),
        holed(2, F.when(key % 2 == 0, "True").otherwise("False")).alias("yes"), holed(3, mixed).alias("mixed")), path)
    return read_explorer_csv(spark, path)


@register("s6_published_csv", "SELECT *, 'second, \"quoted\"' AS note, CAST(NULL AS VARCHAR) AS empty FROM orders WHERE o_orderkey % 2 = 0")
def q_published_csv(spark, sf_dir):
    """A CSV result is replaced; it comes back with its schema, nothing inferred."""
    from tablescope.sources.published import publish, read_published
    orders, path = table(spark, sf_dir, "orders"), _folder(spark)
    publish(orders, path, "csv")
    publish(orders.where(F.col("o_orderkey") % 2 == 0).withColumn("note", F.lit('second, "quoted"'))
            .withColumn("empty", F.lit(None).cast("string")), path, "csv")
    return read_published(spark, path)


@register("s5_table_export", "SELECT 'orders' AS name, COUNT(*) AS written, COUNT(*) AS rows FROM orders")
def q_export(spark, sf_dir):
    from tablescope.sources.files import read_parquet
    from tablescope.sources.sinks import write_results
    path = _folder(spark)
    written = write_results({"orders": table(spark, sf_dir, "orders")}, path, "parquet")["orders"]
    return read_parquet(spark, f"{path}/orders").agg(
        F.lit("orders").alias("name"), F.lit(written).cast("long").alias("written"), F.count(F.lit(1)).alias("rows"))


def _report_query(name: str, digits: dict[str, int]) -> QueryFn:
    """One output of the written report, found and loaded by the registry."""
    def run(spark, sf_dir):
        from tablescope.sources.registry import available_outputs, load_output
        path = _folder(spark)
        tr.run_trip_report(spark, trips(spark, sf_dir), path, "parquet")
        if name not in available_outputs(spark, path):
            raise ValueError(f"the report lacks {name}")
        return rounded(load_output(spark, path, name, "parquet"), digits)
    return run


for _name, _like, _digits in (
        ("outliers", "a2_outliers", {}), ("ranked", "w1_rank_within_day", {"daily_revenue": 2}),
        ("running_totals", "w2_w3_running_totals", {"daily_revenue": 2, "cumulative_revenue": 2}),
        ("sessions", "a4_time_of_day_summary", {"total_revenue": 2, "avg_fare": 6, "avg_distance": 6}),
        ("pivot", "a5_hour_session_pivot", {}),
        ("time_series", "a6_daily_series", {"total_revenue": 2, "avg_fare": 6, "avg_distance": 6}),
        ("joined", "l3_enriched_trips", {})):
    register(f"l4_s6_report_{_name}", ORACLE_SQL[_like])(_report_query(_name, _digits))


# ---------------------------------------------------------------------------
# Results page
# ---------------------------------------------------------------------------

def _chart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from tablescope.plans.results_page import chart_rows
    return chart_rows(tr.report_outputs(spark, cleaned_trips(spark, sf_dir)))[name]


@register("n17_ranked_series", f"""
WITH {DAILY_CTE} SELECT date, payment_type, ROUND(daily_revenue, 2) AS daily_revenue FROM daily""")
def q_ranked_series(spark, sf_dir):
    return rounded(_chart(spark, sf_dir, "ranked"), {"daily_revenue": 2})


@register("n17_running_series", f"""
WITH {DAILY_CTE}
SELECT date, payment_type, ROUND(SUM(daily_revenue) OVER (
  PARTITION BY payment_type ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS cumulative_revenue
FROM daily""")
def q_running_series(spark, sf_dir):
    return rounded(_chart(spark, sf_dir, "running_totals"), {"cumulative_revenue": 2})


@register("n17_session_bars", f"""
WITH {TRIPS_CTE}
SELECT {session_case()} AS session, COUNT(*) AS trip_count, ROUND(SUM(fare_amount), 2) AS total_revenue
FROM trips GROUP BY 1""")
def q_session_bars(spark, sf_dir):
    return rounded(_chart(spark, sf_dir, "sessions"), {"total_revenue": 2})
