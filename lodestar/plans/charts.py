"""Chart-data queries (D-series)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import charts as D
from lodestar.operators.joins import small_side
from lodestar.operators.quantiles import exact_quantiles
from lodestar.plans.registry import query
from lodestar.tables import Tables


@query("d_histogram_totalprice", "D1", sql="""
WITH m AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
     b AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 10.0)), 9) AS INTEGER) AS bin
           FROM orders, m)
SELECT bin, round(lo + bin * (hi - lo) / 10.0, 4) AS lo, round(lo + (bin + 1) * (hi - lo) / 10.0, 4) AS hi,
       count(*) AS n, round(count(*) / ((SELECT count(*) FROM orders) * ((hi - lo) / 10.0)), 12) AS density
FROM b, m GROUP BY bin, m.lo, m.hi""")
def d_histogram_totalprice(spark, sf):
    h = D.histogram(Tables(spark, sf).orders, "o_totalprice", 10)
    return h.select("bin", F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"), "n",
                    F.round("density", 12).alias("density"))


@query("d_grouped_hour_histogram", "D2 F10", sql="""
WITH b AS (SELECT event_type, CAST(least(floor((hour(ts) - 0.0) / 2.0), 11) AS INTEGER) AS bin FROM events),
     h AS (SELECT event_type, bin, count(*) AS n FROM b GROUP BY 1, 2)
SELECT event_type, bin, CAST(bin * 2 AS DOUBLE) AS lo, CAST((bin + 1) * 2 AS DOUBLE) AS hi, n,
       round(n / (sum(n) OVER (PARTITION BY event_type) * 2.0), 12) AS density FROM h""")
def d_grouped_hour_histogram(spark, sf):
    e = Tables(spark, sf).events.withColumn("hour", F.hour("ts"))
    h = D.histogram(e, "hour", 12, keys=["event_type"], lo=0, hi=24)
    return h.select("event_type", "bin", "lo", "hi", "n", F.round("density", 12).alias("density"))


@query("d_line_series_by_year", "D3 D8", sql="""
SELECT year(o_orderdate) AS x, round(avg(o_totalprice), 4) AS mean,
       round(sum(o_totalprice), 2) AS total, count(*) AS n FROM orders GROUP BY 1""")
def d_line_series_by_year(spark, sf):
    s = D.line_series(Tables(spark, sf).orders, F.year("o_orderdate"), "o_totalprice")
    return s.select(F.col("x").cast("bigint").alias("x"), F.round("mean", 4).alias("mean"),
                    F.round("total", 2).alias("total"), "n")


@query("d_nation_year_lines", "D8 B29 J1", sql="""
SELECT n_name, year(o_orderdate) AS year, round(sum(o_totalprice), 2) AS revenue, count(*) AS n_orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2""")
def d_nation_year_lines(spark, sf):
    from lodestar.operators.joins import bounded
    t = Tables(spark, sf)
    per = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum("o_totalprice").alias("rev"), F.count(F.lit(1)).alias("n"))
    j = per.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    j = j.join(bounded(t.nation, 25), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name", F.col("year").cast("bigint").alias("year")).agg(
        F.round(F.sum("rev"), 2).alias("revenue"), F.sum("n").alias("n_orders"))


@query("d_box_stats", "D5 C7", sql="""
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
     f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT f.event_type, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       min(CASE WHEN value BETWEEN lf AND uf THEN value END) AS whisker_lo,
       max(CASE WHEN value BETWEEN lf AND uf THEN value END) AS whisker_hi,
       count_if(NOT (value BETWEEN lf AND uf)) AS n_outliers
FROM events JOIN f USING (event_type) GROUP BY f.event_type, q1, median, q3""")
def d_box_stats(spark, sf):
    b = D.box_stats(Tables(spark, sf).events, "event_type", "value")
    return b.select("event_type", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")],
                    "whisker_lo", "whisker_hi", "n_outliers")


@query("d_regression_line", "D6 B10", sql="""
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, count(*) AS n
FROM lineitem GROUP BY 1""")
def d_regression_line(spark, sf):
    r = D.regression_line(Tables(spark, sf).lineitem, "l_extendedprice", "l_quantity",
                          ["l_returnflag"])
    return r.select("l_returnflag", F.round("slope", 6).alias("slope"),
                    F.round("intercept", 4).alias("intercept"), F.round("r2", 6).alias("r2"), "n")


@query("d_scatter_sample", "D6 R1")
def d_scatter_sample(spark, sf):
    """Seeded sample of scatter points (native sampling: rows-only)."""
    li = Tables(spark, sf).lineitem.select("l_quantity", "l_extendedprice")
    return li.sample(False, 0.05, seed=11)


@query("d_scatter_zone", "D6", sql="""
WITH r AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a,
                  regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem),
     d AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM lineitem),
     s AS (SELECT *, md5(l_orderkey || ':' || l_linenumber || ':' || l_partkey) AS h FROM d
           ORDER BY h, l_quantity, l_extendedprice LIMIT 500)
SELECT l_quantity AS x, l_extendedprice AS y, round(a * l_quantity + b, 4) AS line,
       l_extendedprice > 1.5 * (a * l_quantity + b) AS in_zone FROM s, r""")
def d_scatter_zone(spark, sf):
    """Scatter plot: 500 points at any size of the table (least hashes, each
    task keeps 500), the regression line of all rows at each, and whether the
    point lies in the shaded zone (over 1.5 times the line)."""
    li = Tables(spark, sf).lineitem
    p = D.scatter_points(li, ["l_orderkey", "l_linenumber", "l_partkey"], "l_quantity",
                         "l_extendedprice", 500, zone=1.5)
    return p.select("x", "y", F.round("line", 4).alias("line"), "in_zone")


@query("d_ohlc_daily", "D7", sql="""
SELECT date_trunc('day', ts) AS period, first(value ORDER BY ts, event_id) AS open,
       max(value) AS high, min(value) AS low, last(value ORDER BY ts, event_id) AS close,
       count(*) AS volume
FROM events GROUP BY 1""")
def d_ohlc_daily(spark, sf):
    e = Tables(spark, sf).events
    o = D.ohlc(e, "ts", "value", "event_id", "day")
    return o.withColumn("period", F.col("period").cast("timestamp_ntz"))


@query("d_heatmap_type_slot", "D9 H3", sql="""
SELECT event_type,
       round(avg(value) FILTER (WHERE hour(ts) // 6 = 0), 6) AS "0",
       round(avg(value) FILTER (WHERE hour(ts) // 6 = 1), 6) AS "1",
       round(avg(value) FILTER (WHERE hour(ts) // 6 = 2), 6) AS "2",
       round(avg(value) FILTER (WHERE hour(ts) // 6 = 3), 6) AS "3"
FROM events GROUP BY 1""")
def d_heatmap_type_slot(spark, sf):
    e = Tables(spark, sf).events
    h = D.heatmap(e, "event_type", F.floor(F.hour("ts") / 6).cast("int"), [0, 1, 2, 3],
                  F.avg("value"))
    return h.select("event_type", *[F.round(F.col(str(i)), 6).alias(str(i)) for i in range(4)])


@query("d_class_conditional", "D12", sql="""
WITH b AS (SELECT l_returnflag, CAST(least(floor((l_quantity - 0.0) / 10.0), 4) AS INTEGER) AS bin
           FROM lineitem WHERE l_quantity BETWEEN 0 AND 50)
SELECT b.l_returnflag, bin, count(*) AS n, m.median
FROM b JOIN (SELECT l_returnflag, quantile_cont(l_quantity, 0.5) AS median FROM lineitem GROUP BY 1) m
  ON m.l_returnflag = b.l_returnflag
GROUP BY b.l_returnflag, bin, m.median""")
def d_class_conditional(spark, sf):
    li = Tables(spark, sf).lineitem
    h = D.histogram(li, "l_quantity", 5, keys=["l_returnflag"], lo=0, hi=50)
    med = exact_quantiles(li, "l_returnflag", "l_quantity", [0.5], names=["median"])
    return h.select("l_returnflag", "bin", "n").join(small_side(med, fixed=True), "l_returnflag")


@query("d_completion_by_length", "D14 B30 J7", sql="""
WITH v AS (SELECT p_size * 4 AS length_min, least(l_quantity * 4, p_size * 4) AS watched
           FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT CASE WHEN length_min <= 120 THEN '<=120' WHEN length_min <= 180 THEN '<=180' ELSE '>180' END AS band,
       round(avg(least(watched / length_min, 1.0)), 6) AS completion, count(*) AS n
FROM v GROUP BY 1""")
def d_completion_by_length(spark, sf):
    """Catalogue = part (length = 4 x p_size minutes); watch log = each order
    line (watched = 4 x quantity minutes, capped at the length)."""
    t = Tables(spark, sf)
    cat = t.part.select(F.col("p_partkey").alias("l_partkey"),
                        (F.col("p_size") * 4).alias("length_min"))
    # the log is reduced to (title, minutes) counts before it meets the catalogue
    v = t.lineitem.groupBy("l_partkey", "l_quantity").agg(F.count(F.lit(1)).alias("views"))
    v = v.join(cat, "l_partkey")
    v = v.withColumn("watched", F.least(F.col("l_quantity") * 4, F.col("length_min").cast("double")))
    r = D.banded_rate(v, "length_min", [120, 180], F.col("watched"), F.col("length_min"), weight="views")
    return r.select("band", F.round("completion", 6).alias("completion"), "n")
