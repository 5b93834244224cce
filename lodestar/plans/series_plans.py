"""Array-series queries: the reference's workout arrays, rebuilt as one
row per bounded workout (user, chunk of 50 events) from ``events`` (F7-F15, E9, W5, W6, A12, D10, D11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import arrays as X
from lodestar.operators import aggregates as A
from lodestar.operators import reshape as H
from lodestar.plans.fixtures import WORKOUT_SQL, workout_series
from lodestar.plans.registry import query
from lodestar.tables import Tables

_SERIES_SQL = WORKOUT_SQL   # DuckDB form of fixtures.workout_series


# fixed values: points that a series needs
MIN_POINTS = 10
#: Classes that count as valid (of the series' first event); others are left out.
VALID_KINDS = ("view", "click", "purchase", "signup")


@query("s_series_features", "E9 F11 F12 F14 W5 W6 P14 C5", sql=f"""
WITH {_SERIES_SQL},
     c AS (SELECT user_id, chunk, types[1] AS kind, vals,
                  list_transform(range(1, len(ts)), lambda i: CAST(ts[i + 1] - ts[i] AS DOUBLE)) AS gaps,
                  list_transform(ts, lambda t: (t % 86400) / 60.0) AS mins
           FROM s WHERE len(vals) >= {MIN_POINTS} AND types[1] IN {VALID_KINDS}),
     f AS (SELECT *, len(vals) AS n, greatest(1, len(vals) // 4) AS q FROM c)
SELECT user_id, chunk, kind,
       round(list_avg(vals), 6) AS v_mean, list_max(vals) AS v_max, list_min(vals) AS v_min,
       round(list_max(vals) - list_min(vals), 6) AS v_range,
       round(list_avg(list_slice(vals, n - q + 1, n)) - list_avg(list_slice(vals, 1, q)), 6) AS v_trend,
       round(list_avg(list_transform(range(1, n - 3),
             lambda i: list_stddev_pop(list_slice(vals, i, i + 4)))), 6) AS v_rolling_std,
       round(list_avg(gaps), 6) AS gap_mean, list_max(gaps) AS gap_max,
       round(list_avg(mins), 6) AS minute_mean,
       round(list_max(mins) - list_min(mins), 6) AS minute_range,
       CAST(n AS DOUBLE) AS length
FROM f""")
def s_series_features(spark, sf):
    """Eleven features over three channels of every series: the values, the
    gaps between events in seconds, and the minute of the day; series of
    enough points and of a valid class only."""
    s = workout_series(Tables(spark, sf).events)
    kind = F.get("event_type", 0)
    s = s.where((F.size("value") >= MIN_POINTS) & kind.isin(*VALID_KINDS))
    v, gap = X.as_double("value"), X.as_double(X.intervals("ts"))
    minute = F.transform("ts", lambda t: (t % 86400) / F.lit(60.0))
    return s.select(
        "user_id", "chunk", kind.alias("kind"),
        F.round(X.mean(v), 6).alias("v_mean"), F.array_max(v).alias("v_max"),
        F.array_min(v).alias("v_min"),
        F.round(F.array_max(v) - F.array_min(v), 6).alias("v_range"),
        F.round(X.trend(v), 6).alias("v_trend"),
        F.round(X.rolling_std_mean(v, 5), 6).alias("v_rolling_std"),
        F.round(X.mean(gap), 6).alias("gap_mean"), F.array_max(gap).alias("gap_max"),
        F.round(X.mean(minute), 6).alias("minute_mean"),
        F.round(F.array_max(minute) - F.array_min(minute), 6).alias("minute_range"),
        F.size(v).cast("double").alias("length"))


@query("s_time_features", "F7 F8 F9 F13 Q3 Q4 Q5 Q6 X2", sql=f"""
WITH {_SERIES_SQL},
     d AS (SELECT user_id, chunk, ts,
                  CASE WHEN len(ts) = 1 THEN [CAST(0 AS BIGINT)]
                       ELSE list_transform(range(2, len(ts) + 1), lambda i: ts[i] - ts[i - 1]) END AS iv
           FROM s)
SELECT user_id, chunk,
       CAST(hour(make_timestamp(list_min(ts) * 1000000) - INTERVAL 7 HOUR) AS INTEGER) AS start_hour,
       round((list_max(ts) - list_min(ts)) / 60.0, 6) AS duration_min,
       round((list_max(ts) - list_min(ts)) % 86400 / 60.0, 6) AS duration_wrapped_min,
       list_max(iv) AS max_interval, CAST(len(iv) AS INTEGER) AS n_intervals,
       CAST(list_sum(iv) AS BIGINT) AS sum_interval,
       CAST(list_sum(list_slice(iv, greatest(len(iv) - 4, 1), len(iv))) AS BIGINT) AS last5_interval_sum
FROM d""")
def s_time_features(spark, sf):
    s = workout_series(Tables(spark, sf).events)
    dt = X.epoch_to_ts("ts", shift_hours=7)
    iv = X.intervals("ts")
    return s.select(
        "user_id", "chunk", X.start_hour(dt).alias("start_hour"),
        F.round(X.duration_min("ts"), 6).alias("duration_min"),
        F.round(X.duration_min("ts", wrap_days=True), 6).alias("duration_wrapped_min"),
        F.array_max(iv).alias("max_interval"), F.size(iv).alias("n_intervals"),
        F.aggregate(iv, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("sum_interval"),
        F.aggregate(X.trailing(iv, 5), F.lit(0).cast("bigint"), lambda a, x: a + x)
         .alias("last5_interval_sum"))


@query("s_per_user_series_stats", "A12 X5 H5", sql="""
SELECT user_id, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS stddev, count(value) AS n,
       round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75, round(quantile_cont(value, 0.95), 6) AS p95
FROM events GROUP BY user_id""")
def s_per_user_series_stats(spark, sf):
    s = workout_series(Tables(spark, sf).events)
    rows = H.explode_series(s, ["user_id", "chunk"], ["ts", "value"])
    st = A.series_stats(rows, "user_id", "value")
    return st.select("user_id", "min", "max", F.round("mean", 6).alias("mean"),
                     F.round("stddev", 6).alias("stddev"), "n",
                     *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75", "p95")])


@query("s_track_bounds", "D10", sql=f"""
WITH {_SERIES_SQL},
     b AS (SELECT user_id, chunk, list_min(vals) - list_stddev_pop(vals) AS lo,
                  list_max(vals) + list_stddev_pop(vals) AS hi FROM s WHERE len(vals) >= 2)
SELECT user_id, chunk, round(lo + (hi - lo) / 12.0 / 4, 6) AS lo, round(hi - (hi - lo) / 12.0 / 4, 6) AS hi
FROM b""")
def s_track_bounds(spark, sf):
    s = workout_series(Tables(spark, sf).events).where(F.size("value") >= 2)
    lo, hi = X.padded_bounds("value")
    return s.select("user_id", "chunk", F.round(lo, 6).alias("lo"), F.round(hi, 6).alias("hi"))


@query("s_overlay_rows", "D11 W9 H5", sql=f"""
WITH {_SERIES_SQL},
     r2 AS (SELECT user_id, chunk, list_transform(ts, lambda t: t - list_min(ts)) AS rel, vals FROM s)
SELECT user_id, chunk, CAST(p - 1 AS INTEGER) AS pos, rel[p] AS t_rel, vals[p] AS value
FROM r2, range(1, len(vals) + 1) AS g(p)""")
def s_overlay_rows(spark, sf):
    s = workout_series(Tables(spark, sf).events)
    s = s.select("user_id", "chunk", X.relative_to_start("ts").alias("t_rel"), "value")
    return H.explode_series(s, ["user_id", "chunk"], ["t_rel", "value"])


@query("s_distinct_types_per_user", "F15", sql="""
SELECT user_id, count(DISTINCT event_type) AS n_types,
       CAST(count(*) AS BIGINT) AS n_items FROM events GROUP BY user_id""")
def s_distinct_types_per_user(spark, sf):
    s = workout_series(Tables(spark, sf).events)
    # flatten of a bounded nested array (head + tail of the workout), then the
    # unbounded per-user union as explode + aggregate (never a collected set)
    halves = F.flatten(F.array(F.slice("event_type", 1, 1),
                               F.slice("event_type", 2, F.greatest(F.size("event_type") - 1, F.lit(1)))))
    x = s.select("user_id", F.explode(halves).alias("t"))
    return x.groupBy("user_id").agg(F.countDistinct("t").alias("n_types"),
                                    F.count(F.lit(1)).alias("n_items"))
