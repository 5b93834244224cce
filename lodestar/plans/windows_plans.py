"""Window queries (W-series), sampling (R-series)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import recurrences as R
from lodestar.operators import sampling as S
from lodestar.operators import windows as W
from lodestar.operators.business import NET_SQL, money, money_sql, net_sum, part_revenue
from lodestar.plans.fixtures import DIRTY_CUSTOMER_SQL, dirty_customer
from lodestar.plans.registry import query
from lodestar.tables import Tables


@query("w_top3_orders_per_customer", "W1 O6", sql="""
SELECT o_custkey, o_orderkey, o_totalprice, CAST(rn AS INTEGER) AS rank FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM orders) WHERE rn <= 3""")
def w_top3_orders_per_customer(spark, sf):
    o = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return W.top_n_per_group(o, "o_custkey",
                             [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 3)


@query("w_dense_rank_suppliers", "W1 B20", sql=f"""
WITH s AS (SELECT l_suppkey, {money_sql(f"sum({NET_SQL})")} AS revenue,
                  count(*) AS n_lines FROM lineitem GROUP BY 1)
SELECT s_nationkey, s_suppkey, revenue, n_lines, CAST(r AS INTEGER) AS rank FROM (
  SELECT s_nationkey, s_suppkey, revenue, n_lines,
         dense_rank() OVER (PARTITION BY s_nationkey ORDER BY revenue DESC) AS r
  FROM s JOIN supplier ON s_suppkey = l_suppkey) WHERE r <= 3""")
def w_dense_rank_suppliers(spark, sf):
    t = Tables(spark, sf)
    s = t.lineitem.groupBy("l_suppkey").agg(
        money(net_sum()).alias("revenue"), F.count(F.lit(1)).alias("n_lines"))
    j = s.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("s_suppkey") == F.col("l_suppkey"))
    j = j.select("s_nationkey", "s_suppkey", "revenue", "n_lines")
    return W.top_n_per_group(j, "s_nationkey", [F.col("revenue").desc()], 3, rank="dense_rank")


@query("w_latest_event_per_user", "W2 S17 K6", sql="""
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def w_latest_event_per_user(spark, sf):
    e = Tables(spark, sf).events.select("user_id", "ts", "event_id", "event_type", "value")
    return W.latest_per_key(e, "user_id", ["ts", "event_id"])


@query("w_hash_sample_per_type", "W3 R5", sql="""
SELECT event_type, event_id, user_id FROM (
  SELECT event_type, event_id, user_id,
         row_number() OVER (PARTITION BY event_type
                            ORDER BY md5(CAST(event_id AS VARCHAR) || ':42'), event_id) AS rn
  FROM events) WHERE rn <= 4""")
def w_hash_sample_per_type(spark, sf):
    e = Tables(spark, sf).events.select("event_type", "event_id", "user_id")
    return W.hashed_sample_per_group(e, "event_type", "event_id", 4, seed=42)


@query("w_gaps_between_events", "W4 B26", sql="""
SELECT event_id, user_id,
       round(epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)), 6) AS gap_s
FROM events""")
def w_gaps_between_events(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "user_id", "ts")
    g = W.gaps(e, "user_id", "ts")
    return g.select("event_id", "user_id", F.round("gap_s", 6).alias("gap_s"))


@query("w_running_spend", "W8", sql="""
SELECT o_orderkey, o_custkey,
       round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate
                                     RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running
FROM orders""")
def w_running_spend(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    r = W.running_sum(o, "o_custkey", "o_orderdate", "o_totalprice")
    return r.select("o_orderkey", "o_custkey", F.round("running", 2).alias("running"))


@query("w_abc_classes", "W8 B19", sql=f"""
WITH r AS (SELECT l_partkey, sum({NET_SQL}) AS revenue FROM lineitem GROUP BY 1),
     c AS (SELECT l_partkey, revenue,
                  CAST(sum(revenue) OVER (ORDER BY revenue DESC, l_partkey
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
                  / CAST(sum(revenue) OVER () AS DOUBLE) AS cum_share FROM r)
SELECT l_partkey, {money_sql("revenue")} AS revenue, round(cum_share, 6) AS cum_share,
       CASE WHEN cum_share <= 0.8 THEN 'A' WHEN cum_share <= 0.95 THEN 'B' ELSE 'C' END AS abc
FROM c""")
def w_abc_classes(spark, sf):
    pr = part_revenue(Tables(spark, sf).lineitem).select("l_partkey", "revenue")
    c = W.global_running_share(pr, "revenue", "l_partkey")
    cls = (F.when(F.col("cum_share") <= 0.8, "A").when(F.col("cum_share") <= 0.95, "B")
            .otherwise("C"))
    return c.select("l_partkey", money("revenue").alias("revenue"),
                    F.round("cum_share", 6).alias("cum_share"), cls.alias("abc"))


@query("w_moving_avg_daily", "W7", sql="""
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(value) AS v FROM events GROUP BY 1, 2)
SELECT event_type, day, round(v, 4) AS v,
       round(avg(v) OVER (PARTITION BY event_type ORDER BY day
                          ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS ma7,
       round(v - lag(v) OVER (PARTITION BY event_type ORDER BY day), 4) AS delta
FROM d""")
def w_moving_avg_daily(spark, sf):
    from pyspark.sql import Window
    e = Tables(spark, sf).events
    d = e.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum("value").alias("v"))
    m = W.moving_avg(d, "event_type", "day", "v", 7, "ma7", chunk_rows=8)
    m = m.withColumn("delta", F.col("v") - F.lag("v").over(
        Window.partitionBy("event_type").orderBy("day")))
    return m.select("event_type", "day", F.round("v", 4).alias("v"),
                    F.round("ma7", 4).alias("ma7"), F.round("delta", 4).alias("delta"))


@query("w_recursive_indicators", "W7", sql="""
WITH RECURSIVE r AS (
  SELECT event_id, user_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
y AS (
  SELECT event_id, user_id, value, rn, value AS ema, CAST(0 AS DOUBLE) AS up, CAST(0 AS DOUBLE) AS down
  FROM r WHERE rn = 1
  UNION ALL
  SELECT r.event_id, r.user_id, r.value, r.rn, 0.2 * r.value + 0.8 * y.ema,
         (1 - 1 / 14.0) * y.up + greatest(r.value - y.value, 0),
         (1 - 1 / 14.0) * y.down + greatest(y.value - r.value, 0)
  FROM r JOIN y ON r.user_id = y.user_id AND r.rn = y.rn + 1)
SELECT event_id, round(ema, 6) AS ema,
       round(CASE WHEN up + down > 0 THEN 100 * up / (up + down) END, 6) AS rsi FROM y""")
def w_recursive_indicators(spark, sf):
    """Exponential average and relative strength of every user's values."""
    e = Tables(spark, sf).events.select("event_id", "user_id", "ts", "value")
    order = ["ts", "event_id"]
    x = R.exponential_average(e, "user_id", order, "value", 0.2)
    x = R.relative_strength(x, "user_id", order, "value", 14)
    return x.select("event_id", F.round("ema", 6).alias("ema"), F.round("rsi", 6).alias("rsi"))


@query("w_seconds_since_start", "W9 D11", sql="""
SELECT event_id, user_id,
       round(epoch(ts) - epoch(min(ts) OVER (PARTITION BY user_id)), 6) AS t_rel_s
FROM events""")
def w_seconds_since_start(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "user_id", "ts")
    s = W.since_start(e, "user_id", "ts")
    return s.select("event_id", "user_id", F.round("t_rel_s", 6).alias("t_rel_s"))


@query("w_group_mean_impute", "W10 C3 Q11", sql=f"""
WITH {DIRTY_CUSTOMER_SQL}
SELECT c_custkey, c_nationkey,
       round(coalesce(c_acctbal, avg(c_acctbal) OVER (PARTITION BY c_nationkey)), 4) AS c_acctbal
FROM dirty_customer""")
def w_group_mean_impute(spark, sf):
    c = dirty_customer(Tables(spark, sf).customer).select("c_custkey", "c_nationkey", "c_acctbal")
    out = W.group_mean_impute(c, "c_nationkey", "c_acctbal")
    return out.select("c_custkey", "c_nationkey", F.round("c_acctbal", 4).alias("c_acctbal"))


# --------------------------------------------------------------- R-series

_UNIT = "CAST(('0x' || substr(md5(CAST({c} AS VARCHAR) || ':{s}'), 1, 8))::UBIGINT AS BIGINT) / 4294967296.0"


@query("r_hash_split_3way", "R3 R6", sql=f"""
SELECT split, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM (
  SELECT o_totalprice,
         CAST(CASE WHEN u < 0.7 THEN 0 WHEN u < 0.9 THEN 1 ELSE 2 END AS INTEGER) AS split
  FROM (SELECT o_totalprice, {_UNIT.format(c='o_orderkey', s=7)} AS u FROM orders))
GROUP BY split""")
def r_hash_split_3way(spark, sf):
    o = Tables(spark, sf).orders
    s = S.hash_split(o, "o_orderkey", [0.7, 0.2, 0.1], seed=7)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                  F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("r_stratified_split", "R4", sql=f"""
SELECT l_returnflag, is_train, count(*) AS n FROM (
  SELECT l_returnflag, {_UNIT.format(c='l_orderkey * 10 + l_linenumber', s=3)} < 0.8 AS is_train
  FROM lineitem) GROUP BY 1, 2""")
def r_stratified_split(spark, sf):
    li = Tables(spark, sf).lineitem.withColumn(
        "row_key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    s = S.stratified_split(li, "row_key", "l_returnflag", 0.8, seed=3)
    return s.groupBy("l_returnflag", "is_train").agg(F.count(F.lit(1)).alias("n"))


@query("r_hash_sample_to_size", "R1 R2", sql=f"""
SELECT count(*) AS n FROM (
  SELECT {_UNIT.format(c='event_id', s=42)} AS u FROM events)
WHERE u < least(500.0 / (SELECT count(*) FROM events), 1.0)""")
def r_hash_sample_to_size(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "user_id")
    s = S.sample_to_size(e, "event_id", 500, seed=42)
    return s.agg(F.count(F.lit(1)).alias("n"))


@query("r_native_sample", "R1 R3 R4 Q20")
def r_native_sample(spark, sf):
    """Native seeded Bernoulli sample + randomSplit + sampleBy: row counts
    only (the chosen rows depend on partition layout)."""
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    a = S.bernoulli(li, 0.1, seed=1).withColumn("kind", F.lit("bernoulli"))
    tr, te = S.random_split(li, [0.8, 0.2], seed=2)
    b = tr.withColumn("kind", F.lit("train"))
    c = S.stratified_sample(li, "l_returnflag", {"A": 0.1, "N": 0.05, "R": 0.1}, seed=3) \
        .withColumn("kind", F.lit("sample_by"))
    return a.unionByName(b).unionByName(c).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("r_two_level_sample", "R5 W3", sql=f"""
WITH ents AS (SELECT DISTINCT c_mktsegment, c_custkey FROM customer),
     chosen AS (SELECT c_custkey FROM (
        SELECT c_custkey, row_number() OVER (PARTITION BY c_mktsegment
               ORDER BY md5(CAST(c_custkey AS VARCHAR) || ':42'), c_custkey) AS rn FROM ents)
        WHERE rn <= 20),
     pool AS (SELECT o.* FROM orders o JOIN chosen ON o_custkey = c_custkey)
SELECT o_orderpriority, o_orderkey, o_custkey FROM (
  SELECT o_orderpriority, o_orderkey, o_custkey,
         row_number() OVER (PARTITION BY o_orderpriority
               ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey) AS rn FROM pool)
WHERE rn <= 5""")
def r_two_level_sample(spark, sf):
    t = Tables(spark, sf)
    oc = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"),
                       "o_custkey")
    s = S.two_level_sample(oc.withColumnRenamed("o_custkey", "c_custkey"), "c_mktsegment",
                           "c_custkey", 20, "o_orderpriority", "o_orderkey", 5, seed=42)
    return s.select("o_orderpriority", "o_orderkey", F.col("c_custkey").alias("o_custkey"))
