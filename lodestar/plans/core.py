"""Relational core: projections/filters (P), joins (J), aggregates (A),
sort/top-k (O), set operations (U), reshaping (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.numeric import fixed, fixed_sql
from lodestar.operators import aggregates as A
from lodestar.operators import joins as J
from lodestar.operators import relational as R
from lodestar.operators import reshape as H
from lodestar.operators.business import NET_SQL, money, money_sql, net_sum
from lodestar.plans.fixtures import DIRTY_CUSTOMER_SQL, dirty_customer
from lodestar.plans.registry import query
from lodestar.tables import Tables

# --------------------------------------------------------------- P-series


@query("p_part_predicates", "P1 P3 P4 P7 P8 P9 P10 P13 F1 S14 Q18", sql=f"""
SELECT p_partkey, left(p_name, 3) AS name3, CAST(length(p_name) AS INTEGER) AS name_len,
       {fixed_sql("p_retailprice * 1.1", 2)} AS price_up, 'catalog' AS src,
       p_size IN (5, 10, 15, 20) AS size_flag
FROM part
WHERE p_name LIKE '%ring%' AND p_brand NOT LIKE 'Brand#1%' AND p_type LIKE '%O%'
  AND p_size BETWEEN 5 AND 40 AND length(p_name) > 8""")
def p_part_predicates(spark, sf):
    p = Tables(spark, sf).part
    p.createOrReplaceTempView("lodestar_part")       # S14: a view on the frame
    q = spark.sql("""
        SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM lodestar_part
        WHERE p_name LIKE '%ring%' AND p_brand NOT LIKE 'Brand#1%' AND p_type LIKE '%O%'
          AND p_size BETWEEN 5 AND 40 AND length(p_name) > 8""")
    return q.select(
        "p_partkey", F.left("p_name", F.lit(3)).alias("name3"),
        F.length("p_name").alias("name_len"),
        fixed(F.col("p_retailprice") * 1.1, 2).alias("price_up"),
        F.lit("catalog").alias("src"),
        F.col("P_SIZE").isin(5, 10, 15, 20).alias("size_flag"))  # Q18: case-insensitive resolution


@query("p_null_tests", "P11 P16 Q1", sql=f"""
WITH {DIRTY_CUSTOMER_SQL}
SELECT c_nationkey,
       count_if(c_mktsegment IS NULL) AS n_null,
       count_if(c_mktsegment IS NULL OR c_mktsegment = 'Unknown') AS n_missing_or_placeholder,
       count_if(c_mktsegment IS NOT DISTINCT FROM 'BUILDING') AS n_building,
       count_if(NOT (c_mktsegment IS NOT DISTINCT FROM 'BUILDING')) AS n_not_building
FROM dirty_customer GROUP BY c_nationkey""")
def p_null_tests(spark, sf):
    c = dirty_customer(Tables(spark, sf).customer)
    seg = F.col("c_mktsegment")
    return A.conditional_counts(c, {
        "n_null": seg.isNull(),
        "n_missing_or_placeholder": R.missing_or_placeholder(seg),
        "n_building": seg.eqNullSafe("BUILDING"),
        "n_not_building": ~seg.eqNullSafe("BUILDING"),
    }, keys=["c_nationkey"])


@query("p_band_balance", "P12 Q10 F16", sql=f"""
WITH {DIRTY_CUSTOMER_SQL}
SELECT CASE WHEN c_acctbal IS NULL THEN NULL WHEN c_acctbal < 0 THEN 'debt'
            WHEN c_acctbal < 5000 THEN 'mid' ELSE 'rich' END AS band,
       count(*) AS n,
       round(sum(least(greatest(coalesce(c_acctbal, 0), 0), 9000)), 2) AS clipped_sum
FROM dirty_customer GROUP BY 1""")
def p_band_balance(spark, sf):
    from lodestar.operators.clean import clip
    c = dirty_customer(Tables(spark, sf).customer)
    b = R.band(F.col("c_acctbal"), [0, 5000], ["debt", "mid", "rich"])
    return c.groupBy(b.alias("band")).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(clip(F.coalesce(F.col("c_acctbal"), F.lit(0.0)), 0, 9000)), 2)
         .alias("clipped_sum"))


@query("p_time_slice", "P15 F10 Q17", sql="""
SELECT o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-02-01' AND DATE '1996-02-29'
GROUP BY o_orderpriority""")
def p_time_slice(spark, sf):
    o = Tables(spark, sf).orders
    d = F.to_date("o_orderdate")
    sl = o.where(d.between(F.lit("1996-02-01").cast("date"), F.lit("1996-02-29").cast("date")))
    return sl.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"),
                                             F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("p_last_100_orders", "P15 O1 O2 S12", sql="""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100""")
def p_last_100_orders(spark, sf):
    o = Tables(spark, sf).orders
    return R.top_k(o.select("o_orderkey", "o_orderdate", "o_totalprice"),
                   [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 100)


@query("p_transform_chain", "P2 P5 P6 P17 Q13 Q14", sql="""
SELECT c_custkey AS id, c_nationkey AS nation, CAST(trunc(c_acctbal) AS BIGINT) AS bal_int,
       c_acctbal >= 0 AS solvent
FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'""")
def p_transform_chain(spark, sf):
    c = Tables(spark, sf).customer

    def no_auto(df):
        return df.where(F.col("c_mktsegment") != "AUTOMOBILE")

    def typed(df):
        return R.safe_cast(df.withColumn("bal_int", F.col("c_acctbal")), {"bal_int": "BIGINT"})

    def flagged(df):
        return df.withColumn("solvent", F.col("c_acctbal") >= 0)

    out = R.pipe(c, no_auto, typed, flagged).drop("c_name", "c_mktsegment", "c_acctbal")
    return R.rename_all(out, ["id", "nation", "bal_int", "solvent"])   # positional


@query("p_point_lookup", "P19", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, l_linenumber, l_partkey
FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey = 7""")
def p_point_lookup(spark, sf):
    t = Tables(spark, sf)
    o = t.orders.where(F.col("o_orderkey") == 7)           # pushed into the scan
    li = t.lineitem.where(F.col("l_orderkey") == 7)
    return o.join(li, o.o_orderkey == li.l_orderkey).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "l_linenumber", "l_partkey")


# --------------------------------------------------------------- J-series


@query("j_order_lines_by_priority", "J1 A5", sql="""
SELECT o_orderpriority, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS gross,
       round(avg(l_quantity), 6) AS avg_qty
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def j_order_lines_by_priority(spark, sf):
    t = Tables(spark, sf)
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_extendedprice").alias("g"),
        F.sum("l_quantity").alias("q"))
    j = J.inner(t.orders.select("o_orderkey", "o_orderpriority"),
                per_order.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")
    return j.groupBy("o_orderpriority").agg(
        F.sum("n").alias("n_lines"), F.round(F.sum("g"), 2).alias("gross"),
        F.round(F.sum("q") / F.sum("n"), 6).alias("avg_qty"))


_PRICE_PER_DATE_SQL = """
SELECT CAST(o_orderdate AS DATE) AS order_date, round(sum(l_extendedprice), 2) AS price
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1"""


@query("b28_price_per_date_explicit", "B28 J1", sql=_PRICE_PER_DATE_SQL)
def b28_explicit(spark, sf):
    t = Tables(spark, sf)
    j = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "inner")
    return j.groupBy(F.to_date("o_orderdate").alias("order_date")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("b28_price_per_date_implicit", "B28 J2", sql=_PRICE_PER_DATE_SQL)
def b28_implicit(spark, sf):
    t = Tables(spark, sf)
    return spark.sql(
        "SELECT CAST(o_orderdate AS DATE) AS order_date, round(sum(l_extendedprice), 2) AS price "
        "FROM {o}, {l} WHERE o_orderkey = l_orderkey GROUP BY 1",
        o=t.orders, l=t.lineitem)


@query("j_left_join_orders", "J3", sql="""
SELECT o.o_orderstatus, count(*) AS n_orders,
       count_if(l.n IS NULL) AS n_without_lines,
       CAST(sum(coalesce(l.n, 0)) AS BIGINT) AS n_lines
FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l
  ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderstatus""")
def j_left_join_orders(spark, sf):
    t = Tables(spark, sf)
    per = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    j = J.left_outer(t.orders.select("o_orderkey", "o_orderstatus"),
                     per.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")
    return j.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("n").isNull()).alias("n_without_lines"),
        F.sum(F.coalesce(F.col("n"), F.lit(0))).alias("n_lines"))


@query("j_anti_customers_no_urgent", "J4", sql="""
SELECT c_custkey, c_nationkey FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                  AND o.o_orderpriority = '1-URGENT')""")
def j_anti_customers_no_urgent(spark, sf):
    t = Tables(spark, sf)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("c_custkey"))
    return J.anti(t.customer.select("c_custkey", "c_nationkey"), urgent, "c_custkey")


@query("j_anti_orders_no_lines", "J4", sql="""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def j_anti_orders_no_lines(spark, sf):
    t = Tables(spark, sf)
    return J.anti(t.orders.select("o_orderkey", "o_custkey"),
                  t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("j_semi_customers_with_urgent", "J5", sql="""
SELECT c_custkey, c_mktsegment FROM customer c
WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
              AND o.o_orderpriority = '1-URGENT')""")
def j_semi_customers_with_urgent(spark, sf):
    t = Tables(spark, sf)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("c_custkey"))
    return J.semi(t.customer.select("c_custkey", "c_mktsegment"), urgent, "c_custkey")


@query("j_scalar_subquery", "J8 Q22", sql="""
SELECT DISTINCT p_type FROM part
WHERE p_retailprice > (SELECT avg(p_retailprice) FROM part) AND p_size > 45""")
def j_scalar_subquery(spark, sf):
    p = Tables(spark, sf).part
    return spark.sql(
        "SELECT DISTINCT p_type FROM {p} "
        "WHERE p_retailprice > (SELECT avg(p_retailprice) FROM {p}) AND p_size > 45", p=p)


@query("j_attach_by_key", "J6", sql="""
SELECT c_custkey, c_mktsegment, n_orders FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1) o
  ON o.o_custkey = c_custkey""")
def j_attach_by_key(spark, sf):
    t = Tables(spark, sf)
    counts = A.group_count(t.orders, "o_custkey", "n_orders").withColumnRenamed(
        "o_custkey", "c_custkey")
    return J.attach_by_key(t.customer.select("c_custkey", "c_mktsegment"), counts, "c_custkey")


# --------------------------------------------------------------- A-series


@query("a_flag_status_summary", "A1 A2 A4 A5 A6", sql=f"""
SELECT l_returnflag, l_linestatus,
       round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
       {money_sql(f"sum({NET_SQL})")} AS sum_disc_price,
       round(avg(l_quantity), 6) AS avg_qty, round(avg(l_discount), 6) AS avg_disc,
       min(l_shipdate) AS min_ship, max(l_shipdate) AS max_ship, count(*) AS count_order
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def a_flag_status_summary(spark, sf):
    li = Tables(spark, sf).lineitem
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
        money(net_sum()).alias("sum_disc_price"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.min("l_shipdate").alias("min_ship"), F.max("l_shipdate").alias("max_ship"),
        F.count(F.lit(1)).alias("count_order"))


@query("a_global_totals", "A1 A2 I2", sql="""
SELECT count(*) AS n_rows, round(sum(o_totalprice), 2) AS sum_o_totalprice,
       round(avg(o_totalprice), 4) AS avg_o_totalprice, min(o_totalprice) AS min_o_totalprice,
       max(o_totalprice) AS max_o_totalprice, count(DISTINCT o_custkey) AS count_distinct_o_custkey
FROM orders""")
def a_global_totals(spark, sf):
    o = Tables(spark, sf).orders
    g = A.global_agg(o, {"o_totalprice": ["sum", "avg", "min", "max"], "o_custkey": "count_distinct"},
                     F.count(F.lit(1)).alias("n_rows"))
    return g.select("n_rows", F.round("sum_o_totalprice", 2).alias("sum_o_totalprice"),
                    F.round("avg_o_totalprice", 4).alias("avg_o_totalprice"),
                    "min_o_totalprice", "max_o_totalprice", "count_distinct_o_custkey")


@query("a_distinct_users_per_type", "A7 A8", sql="""
SELECT event_type, count(DISTINCT user_id) AS n_users, count(*) AS n_events
FROM events GROUP BY event_type""")
def a_distinct_users_per_type(spark, sf):
    e = Tables(spark, sf).events
    return e.groupBy("event_type").agg(F.countDistinct("user_id").alias("n_users"),
                                       F.count(F.lit(1)).alias("n_events"))


@query("a_having_frequent_customers", "A9", sql="""
SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey HAVING count(*) >= 15""")
def a_having_frequent_customers(spark, sf):
    o = Tables(spark, sf).orders
    return A.having(o, "o_custkey", F.count(F.lit(1)).alias("n_orders"), F.col("n_orders") >= 15)


@query("a_conditional_counts", "A10", sql="""
SELECT l_linestatus, count_if(l_returnflag = 'R') AS n_returned,
       count_if(l_discount > 0.05) AS n_discounted, count_if(l_quantity >= 40) AS n_bulk
FROM lineitem GROUP BY l_linestatus""")
def a_conditional_counts(spark, sf):
    li = Tables(spark, sf).lineitem
    return A.conditional_counts(li, {
        "n_returned": F.col("l_returnflag") == "R",
        "n_discounted": F.col("l_discount") > 0.05,
        "n_bulk": F.col("l_quantity") >= 40}, keys=["l_linestatus"])


@query("a_value_stats_by_type", "A12 X5 D5", sql="""
SELECT event_type, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS stddev, count(value) AS n,
       round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75, round(quantile_cont(value, 0.95), 6) AS p95
FROM events GROUP BY event_type""")
def a_value_stats_by_type(spark, sf):
    e = Tables(spark, sf).events
    s = A.series_stats(e, "event_type", "value")
    return s.select("event_type", "min", "max", *[F.round(c, 6).alias(c) for c in
                    ("mean", "stddev")], "n",
                    *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75", "p95")])


@query("a_brand_share_top5", "A13 U2 Q19 D4", sql=f"""
WITH b AS (SELECT p_brand, sum({NET_SQL}) AS revenue
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand),
     t AS (SELECT * FROM b ORDER BY revenue DESC, p_brand LIMIT 5),
     tot AS (SELECT sum(revenue) AS s FROM b)
SELECT p_brand, {money_sql("revenue")} AS revenue,
       round(CAST(revenue AS DOUBLE) * 100.0 / CAST(s AS DOUBLE), 4) AS pct FROM t, tot
UNION ALL
SELECT 'Others', {money_sql("s - (SELECT sum(revenue) FROM t)")},
       round(CAST(s - (SELECT sum(revenue) FROM t) AS DOUBLE) * 100.0 / CAST(s AS DOUBLE), 4) FROM tot""")
def a_brand_share_top5(spark, sf):
    from lodestar.operators.business import part_revenue
    t = Tables(spark, sf)
    pr = part_revenue(t.lineitem)
    by_brand = pr.join(t.part.select("p_partkey", "p_brand"),
                       pr.l_partkey == F.col("p_partkey")).groupBy("p_brand").agg(
        F.sum("revenue").alias("revenue"))
    out = A.top_k_with_others(by_brand, "p_brand", "revenue", 5)
    return out.select("p_brand", money("revenue").alias("revenue"),
                      F.round("pct", 4).alias("pct"))


@query("a_within_group_share", "A14 W8", sql="""
WITH g AS (SELECT o_orderpriority, o_orderstatus, CAST(count(*) AS DOUBLE) AS n
           FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, o_orderstatus, n,
       round(n * 100.0 / sum(n) OVER (PARTITION BY o_orderpriority), 4) AS pct FROM g""")
def a_within_group_share(spark, sf):
    o = Tables(spark, sf).orders.withColumn("one", F.lit(1.0))
    s = A.within_group_share(o, "o_orderpriority", "o_orderstatus", "one")
    return s.select("o_orderpriority", "o_orderstatus", F.col("one").alias("n"),
                    F.round("pct", 4).alias("pct"))


@query("a_describe_orders_per_customer", "A15 I3", sql="""
WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT count(n) AS n_keys, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS stddev,
       min(n) AS min, max(n) AS max FROM c""")
def a_describe_orders_per_customer(spark, sf):
    d = A.describe_counts(Tables(spark, sf).orders, "o_custkey")
    return d.select("n_keys", F.round("mean", 6).alias("mean"),
                    F.round("stddev", 6).alias("stddev"), "min", "max")


# --------------------------------------------------------------- O / U / H


@query("o_top_customers_by_spend", "O1 O3 O4 Q12", sql="""
SELECT o_custkey, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY 1
ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 20""")
def o_top_customers_by_spend(spark, sf):
    o = Tables(spark, sf).orders
    s = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"))
    top = R.top_k(s, [F.col("s").desc(), F.col("o_custkey").asc()], 20)
    return top.select("o_custkey", F.round("s", 2).alias("spend"))


@query("u_nation_set_ops", "U1 U3 S7", sql="""
SELECT 'union' AS op, count(*) AS n FROM (
  SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'union_all', count(*) FROM (
  SELECT c_nationkey FROM customer UNION ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'intersect', count(*) FROM (
  SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'except', count(*) FROM (
  SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier)""")
def u_nation_set_ops(spark, sf):
    t = Tables(spark, sf)
    c = t.customer.select(F.col("c_nationkey").alias("k"))
    s = t.supplier.select(F.col("s_nationkey").alias("k"))
    n = t.nation.select(F.col("n_nationkey").alias("k"))

    def cnt(df, op):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(op).alias("op"), "n")

    return R.union_all(cnt(R.union_all(c, s).distinct(), "union"),
                       cnt(R.union_all(c, s), "union_all"),
                       cnt(c.intersect(s), "intersect"),
                       cnt(n.subtract(s), "except"))


@query("u_dedupe_lines", "U4", sql="""
SELECT DISTINCT ON (l_orderkey, l_linenumber)
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity""")
def u_dedupe_lines(spark, sf):
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                                           "l_suppkey", "l_quantity")
    return R.dedupe_deterministic(li, ["l_orderkey", "l_linenumber"])


@query("u_distinct_projection", "U3 I13", sql="""
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders""")
def u_distinct_projection(spark, sf):
    return R.dedupe(Tables(spark, sf).orders.select("o_orderstatus", "o_orderpriority"))


@query("h_pivot_flag_status", "H1 H2 H3", sql="""
SELECT l_returnflag, count_if(l_linestatus = 'F') AS "F", count_if(l_linestatus = 'O') AS "O",
       count(*) AS total
FROM lineitem GROUP BY l_returnflag""")
def h_pivot_flag_status(spark, sf):
    li = Tables(spark, sf).lineitem
    p = H.pivot_count(li, ["l_returnflag"], "l_linestatus", ["F", "O"])
    return H.with_total(p, ["F", "O"])


@query("h_unpivot_back", "H4", sql="""
SELECT l_returnflag, l_linestatus AS status, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def h_unpivot_back(spark, sf):
    li = Tables(spark, sf).lineitem
    p = H.pivot_count(li, ["l_returnflag"], "l_linestatus", ["F", "O"])
    u = H.unpivot(p, ["l_returnflag"], ["F", "O"], "status", "n")
    return u.where(F.col("n") > 0)


@query("f_number_formatting", "F17 B1", sql="""
SELECT p_type, format('{:,.2f}', revenue) AS revenue_text, round(revenue / 1000000.0, 3) AS revenue_m
FROM (SELECT p_type, CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
                               AS DECIMAL(18,2)) AS DOUBLE) AS revenue
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type)""")
def f_number_formatting(spark, sf):
    """thousands-separated text of exact cent amounts + rounding."""
    from lodestar.operators.business import revenue_by_category
    t = Tables(spark, sf)
    r = revenue_by_category(t.lineitem, t.part, "p_type")
    return r.select("p_type", F.format_number("revenue", 2).alias("revenue_text"),
                    F.round(F.col("revenue") / 1000000.0, 3).alias("revenue_m"))


@query("e_derived_flags", "E10 P3 P12", sql="""
WITH n AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1)
SELECT n_lines + 1 AS family_size, n_lines = 1 AS alone, count(*) AS n_orders FROM n GROUP BY 1, 2""")
def e_derived_flags(spark, sf):
    """The reference's family-size / alone features, re-aimed: lines per
    order + 1, and a flag for single-line orders."""
    n = A.group_count(Tables(spark, sf).lineitem, "l_orderkey", "n_lines")
    d = n.select((F.col("n_lines") + 1).alias("family_size"), (F.col("n_lines") == 1).alias("alone"))
    return d.groupBy("family_size", "alone").agg(F.count(F.lit(1)).alias("n_orders"))
