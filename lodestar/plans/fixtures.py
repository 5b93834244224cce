"""Deterministic derived inputs shared by several queries.

The driver tables hold no NULLs, so cleaning/profiling queries inject them
by a fixed rule on the key (every row is kept; only values are blanked).
Each helper has a Spark form and the identical SQL CTE for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dirty_customer(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    seg = (F.when(k % 7 == 0, F.lit(None).cast("string"))
            .when(k % 11 == 0, F.lit("Unknown"))
            .otherwise(F.col("c_mktsegment")))
    bal = F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal"))
    name = F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name"))
    return customer.select("c_custkey", name.alias("c_name"), "c_nationkey",
                           bal.alias("c_acctbal"), seg.alias("c_mktsegment"))


DIRTY_CUSTOMER_SQL = """dirty_customer AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS c_name,
         c_nationkey,
         CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
         CASE WHEN c_custkey % 7 = 0 THEN NULL
              WHEN c_custkey % 11 = 0 THEN 'Unknown' ELSE c_mktsegment END AS c_mktsegment
  FROM customer)"""


WORKOUT_SIZE = 50


def workout_series(events: DataFrame, size: int = WORKOUT_SIZE) -> DataFrame:
    """Stand-in for the reference's workouts as BOUNDED series: each user's
    events in (ts, event_id) order, cut into consecutive chunks of ``size``
    events; one row per (user_id, chunk) with parallel arrays ``ts`` (epoch
    seconds), ``value``, ``event_type``. Positions come from prefix
    counts over range partitions (no per-user sort in one task), so even a user holding a third of all events yields many
    small arrays."""
    from lodestar.operators.windows import positions_within
    ev = events.select("user_id", "event_id", "ts", "value", "event_type")
    p = positions_within(ev, "user_id", [F.col("ts").asc(), F.col("event_id").asc()])
    x = p.select("user_id", F.floor(F.col("pos") / size).cast("bigint").alias("chunk"),
                 F.struct("pos", F.unix_micros(F.col("ts").cast("timestamp")).alias("t_us"),
                          "value", "event_type").alias("e"))
    g = x.groupBy("user_id", "chunk").agg(F.array_sort(F.collect_list("e")).alias("es"))
    return g.select(
        "user_id", "chunk",
        F.transform("es", lambda e: F.floor(e["t_us"] / 1000000).cast("bigint")).alias("ts"),
        F.transform("es", lambda e: e["value"]).alias("value"),
        F.transform("es", lambda e: e["event_type"]).alias("event_type"))


WORKOUT_SQL = f"""r AS (
  SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // {WORKOUT_SIZE} AS chunk
  FROM events),
  s AS (
  SELECT user_id, chunk,
         list(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) ORDER BY ts, event_id) AS ts,
         list(value ORDER BY ts, event_id) AS vals,
         list(event_type ORDER BY ts, event_id) AS types
  FROM r GROUP BY 1, 2)"""
