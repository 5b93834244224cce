"""Business report queries (B-series) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.numeric import fixed, fixed_sql
from lodestar.operators import business as B
from lodestar.operators.business import NET_SQL, money, money_sql  # noqa: F401
from lodestar.operators.graph import item_graph
from lodestar.plans.registry import query
from lodestar.tables import Tables


@query("b1_revenue_by_type", "B1 J1 A5", sql=f"""
SELECT p_type, {money_sql(f"sum({NET_SQL})")} AS revenue,
       count(*) AS n_lines
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def b1_revenue_by_type(spark, sf):
    t = Tables(spark, sf)
    return B.revenue_by_category(t.lineitem, t.part, "p_type")


@query("b1_top_items", "B1 O3 D4", sql=f"""
SELECT p_partkey, p_name, {money_sql("revenue")} AS revenue FROM (
  SELECT l_partkey, sum({NET_SQL}) AS revenue
  FROM lineitem GROUP BY l_partkey ORDER BY revenue DESC, l_partkey LIMIT 10) r
JOIN part ON p_partkey = l_partkey""")
def b1_top_items(spark, sf):
    t = Tables(spark, sf)
    return B.top_items(t.lineitem, t.part, 10)


@query("b1_monthly_order_value", "B1 F10 D3", sql="""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       round(avg(o_totalprice), 4) AS avg_order_value, count(*) AS n_orders
FROM orders GROUP BY 1""")
def b1_monthly_order_value(spark, sf):
    return B.monthly_order_value(Tables(spark, sf).orders)


@query("b1_monthly_sales_trend", "B1 D6", sql="""
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  sum(o_totalprice) AS sales FROM orders GROUP BY 1),
     x AS (SELECT month, sales, CAST(year(month) * 12 + month(month) AS DOUBLE) AS idx FROM m),
     r AS (SELECT regr_slope(sales, idx) AS s, regr_intercept(sales, idx) AS i FROM x)
SELECT month, round(sales, 2) AS sales, round(i + s * idx, 2) AS trend FROM x, r""")
def b1_monthly_sales_trend(spark, sf):
    return B.monthly_sales_trend(Tables(spark, sf).orders)


def _r(c, n=6):
    return F.round(F.col(c).cast("double"), n).alias(c)


@query("b2_cheque_by_weekday_slot", "B2 F10", sql="""
SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday, CAST(hour(ts) // 6 AS INTEGER) AS slot,
       round(avg(value), 6) AS avg_cheque, count(*) AS n
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""")
def b2_cheque_by_weekday_slot(spark, sf):
    e = Tables(spark, sf).events.where(F.col("event_type") == "purchase")
    return e.groupBy(F.dayofweek("ts").alias("weekday"),
                     F.floor(F.hour("ts") / 6).cast("int").alias("slot")).agg(
        F.round(F.avg("value"), 6).alias("avg_cheque"), F.count(F.lit(1)).alias("n"))


@query("b3_slow_movers", "B3 J4", sql="""
SELECT p_partkey, p_name, last_sold FROM part
LEFT JOIN (SELECT l_partkey, max(l_shipdate) AS last_sold FROM lineitem GROUP BY 1) l
  ON l.l_partkey = p_partkey
WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem
                        WHERE l_shipdate > (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 365 DAY)""")
def b3_slow_movers(spark, sf):
    t = Tables(spark, sf)
    return B.slow_movers(t.lineitem, t.part, 365)


@query("b3_critical_stock", "B3", sql="""
WITH m AS (
  SELECT l_partkey AS p_partkey, l_shipdate AS ts, -l_quantity AS delta FROM lineitem
  UNION ALL
  SELECT p_partkey, q, CAST(20 + p_size AS DOUBLE)
  FROM part, (SELECT unnest(generate_series(date_trunc('quarter', min(l_shipdate)), max(l_shipdate),
                                            INTERVAL 3 MONTH)) AS q FROM lineitem)),
n AS (SELECT p_partkey, ts, sum(delta) AS d FROM m GROUP BY 1, 2),
b AS (SELECT n.p_partkey, ts, 100 + 4 * p_size AS opening,
             100 + 4 * p_size + sum(d) OVER (PARTITION BY n.p_partkey ORDER BY ts) AS balance
      FROM n JOIN part USING (p_partkey)),
w AS (SELECT *, coalesce(lag(balance) OVER (PARTITION BY p_partkey ORDER BY ts), opening) AS was FROM b)
SELECT p_partkey, min(ts) FILTER (WHERE balance < 50) AS first_low, min(balance) AS lowest,
       count(*) FILTER (WHERE balance < 50 AND was >= 50) AS times_fallen
FROM w GROUP BY 1 HAVING min(balance) < 50""")
def b3_critical_stock(spark, sf):
    t = Tables(spark, sf)
    ends = t.lineitem.agg(F.min("l_shipdate").alias("a"), F.max("l_shipdate").alias("b"))
    m = B.stock_movements(t.lineitem, t.part, ends.select("a").scalar(), ends.select("b").scalar())
    return B.critical_stock(m, "p_partkey", "ts", "delta", "opening", 50.0)


@query("b3_turnover", "B3", sql="""
SELECT l_partkey, sum(l_quantity) AS qty,
       count(DISTINCT date_trunc('month', l_shipdate)) AS months_active,
       round(sum(l_quantity) / count(DISTINCT date_trunc('month', l_shipdate)), 6) AS turnover
FROM lineitem GROUP BY 1""")
def b3_turnover(spark, sf):
    t = B.turnover(Tables(spark, sf).lineitem)
    return t.select("l_partkey", "qty", "months_active", _r("turnover"))


@query("b4_supplier_lead_times", "B4", sql="""
SELECT l_suppkey, round(avg(datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))), 6) AS avg_lead_days,
       round(avg(CASE WHEN datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) > 90
                      THEN 1.0 ELSE 0.0 END), 6) AS late_rate, count(*) AS n_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def b4_supplier_lead_times(spark, sf):
    t = Tables(spark, sf)
    s = B.supplier_lead_times(t.lineitem, t.orders, 90)
    return s.select("l_suppkey", _r("avg_lead_days"), _r("late_rate"), "n_lines")


@query("b5_return_rate_type_brand", "B5", sql="""
SELECT p_type, p_brand, round(count_if(l_returnflag = 'R') / count(*), 6) AS return_rate,
       count(*) AS n_lines
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def b5_return_rate_type_brand(spark, sf):
    t = Tables(spark, sf)
    r = B.return_rates(t.lineitem, t.part, ["p_type", "p_brand"])
    return r.select("p_type", "p_brand", _r("return_rate"), "n_lines")


@query("b24_defect_rate_by_brand", "B24 B5", sql="""
SELECT p_brand, round(count_if(l_returnflag = 'R') / count(*), 6) AS return_rate, count(*) AS n_lines
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def b24_defect_rate_by_brand(spark, sf):
    t = Tables(spark, sf)
    r = B.return_rates(t.lineitem, t.part, ["p_brand"])
    return r.select("p_brand", _r("return_rate"), "n_lines")


@query("b6_loyalty_tiers", "B6 I7 P12", sql="""
WITH n AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1),
     c AS (SELECT c_acctbal, coalesce(n_orders, 0) AS n_orders FROM customer
           LEFT JOIN n ON o_custkey = c_custkey)
SELECT CASE WHEN c_acctbal < 0 THEN 'none' WHEN c_acctbal < 3000 THEN 'silver'
            WHEN c_acctbal < 7000 THEN 'gold' ELSE 'platinum' END AS tier,
       count(*) AS n_customers, round(avg(n_orders), 6) AS avg_orders,
       round(corr(c_acctbal, n_orders), 6) AS corr_balance_orders
FROM c GROUP BY 1""")
def b6_loyalty_tiers(spark, sf):
    t = Tables(spark, sf)
    r = B.loyalty_tiers(t.customer, t.orders, [0, 3000, 7000], ["none", "silver", "gold", "platinum"])
    return r.select("tier", "n_customers", _r("avg_orders"), _r("corr_balance_orders"))


@query("b7_abandoned_carts", "B7 A10", sql="""
WITH f AS (SELECT user_id, CAST(ts AS DATE) AS day,
                  max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS v,
                  max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS p
           FROM events GROUP BY 1, 2)
SELECT day, count_if(v = 1) AS n_viewing, count_if(v = 1 AND p = 0) AS n_abandoned FROM f GROUP BY 1""")
def b7_abandoned_carts(spark, sf):
    return B.abandoned_carts(Tables(spark, sf).events)


@query("g_item_relations", "G5 B7 J9", sql="""
WITH i AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
     e AS (SELECT a.l_partkey AS src, b.l_partkey AS dst, count(*) AS weight
           FROM i a JOIN i b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey GROUP BY 1, 2),
     d AS (SELECT item, count(*) AS degree FROM (SELECT src AS item FROM e UNION ALL SELECT dst FROM e)
           GROUP BY 1)
SELECT src, dst, weight, s.degree AS src_degree, t.degree AS dst_degree
FROM e JOIN d s ON s.item = src JOIN d t ON t.item = dst""")
def g_item_relations(spark, sf):
    """Edges between parts of one order, with weight and degrees: at most
    n * (n - 1) / 2 rows for an order of n parts."""
    return item_graph(Tables(spark, sf).lineitem, "l_orderkey", "l_partkey")


@query("b7_brand_pairs", "B7 J9", sql="""
WITH ob AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
     n AS (SELECT count(DISTINCT l_orderkey) AS n FROM ob)
SELECT a.p_brand AS item_a, b.p_brand AS item_b, count(*) AS support
FROM ob a JOIN ob b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand
GROUP BY 1, 2 HAVING count(*) >= ceil(0.014 * (SELECT n FROM n))""")
def b7_brand_pairs(spark, sf):
    t = Tables(spark, sf)
    return B.frequent_pairs(B.baskets(t.lineitem, t.part, "p_brand"), 0.014)


@query("b7_time_to_purchase", "B7 W4", sql="""
WITH x AS (SELECT user_id, event_type, ts,
                  last_value(CASE WHEN event_type = 'view' THEN ts END IGNORE NULLS) OVER (
                    PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv FROM events)
SELECT user_id, count(*) AS n_purchases, round(avg(epoch_us(ts) - epoch_us(lv)), 0) / 1e6 AS avg_secs
FROM x WHERE event_type = 'purchase' AND lv IS NOT NULL GROUP BY 1""")
def b7_time_to_purchase(spark, sf):
    return B.time_to_purchase(Tables(spark, sf).events)


@query("b8_promotion_roi", "B8", sql=f"""
SELECT p_type,
       {money_sql(f"sum(CASE WHEN l_discount > 0 THEN {NET_SQL} END)")} AS promo_revenue,
       {money_sql(f"sum(CASE WHEN NOT (l_discount > 0) THEN {NET_SQL} END)")} AS full_revenue,
       {money_sql(f"sum(CASE WHEN l_discount > 0 THEN CAST(l_extendedprice AS DECIMAL(12,2)) - {NET_SQL} END)")} AS discount_given
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def b8_promotion_roi(spark, sf):
    t = Tables(spark, sf)
    r = B.promotion_roi(t.lineitem, t.part)
    return r.select("p_type", *[money(c).alias(c) for c in
                                ("promo_revenue", "full_revenue", "discount_given")])


@query("b9_seasonality", "B9", sql=f"""
WITH m AS (SELECT p_type, CAST(month(l_shipdate) AS INTEGER) AS moy, sum({NET_SQL}) AS rev
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT p_type, moy, {money_sql("rev")} AS rev,
       round(CAST(rev AS DOUBLE) / avg(CAST(rev AS DOUBLE)) OVER (PARTITION BY p_type), 6) AS coef
FROM m""")
def b9_seasonality(spark, sf):
    t = Tables(spark, sf)
    s = B.seasonality(t.lineitem, t.part)
    return s.select("p_type", "moy", money("rev").alias("rev"), _r("coef"))


@query("b10_price_elasticity", "B10", sql="""
SELECT p_type, round(regr_slope(ln(l_quantity), ln(l_extendedprice / l_quantity)), 6) AS elasticity,
       count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def b10_price_elasticity(spark, sf):
    t = Tables(spark, sf)
    r = B.price_elasticity(t.lineitem, t.part)
    return r.select("p_type", _r("elasticity"), "n")


@query("b10_price_bands", "B10", sql=f"""
SELECT CAST(floor(l_extendedprice / l_quantity / 500.0) AS BIGINT) AS band,
       {money_sql(f"sum({NET_SQL})")} AS revenue, sum(l_quantity) AS qty
FROM lineitem GROUP BY 1""")
def b10_price_bands(spark, sf):
    r = B.price_bands(Tables(spark, sf).lineitem, 500.0)
    return r.select("band", money("revenue").alias("revenue"), "qty")


@query("b11_delivery_cost", "B11 J1", sql="""
SELECT r_name, p_type,
       CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS DOUBLE) AS cost
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def b11_delivery_cost(spark, sf):
    t = Tables(spark, sf)
    r = B.delivery_cost(t.lineitem, t.part, t.orders, t.customer, t.nation, t.region)
    return r.select("r_name", "p_type", money("cost").alias("cost"))


@query("b12_rating_by_source", "B12 J1", sql="""
SELECT source, count(*) AS n, round(avg(quality), 6) AS avg_quality,
       count_if(quality = 0) AS n_q0, count_if(quality = 1) AS n_q1, round(avg(toxic), 6) AS toxic_rate
FROM labels JOIN documents USING (doc_id) GROUP BY 1""")
def b12_rating_by_source(spark, sf):
    t = Tables(spark, sf)
    j = t.labels.join(t.documents.select("doc_id", "source"), "doc_id")
    return j.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("quality"), 6).alias("avg_quality"),
        F.count_if(F.col("quality") == 0).alias("n_q0"), F.count_if(F.col("quality") == 1).alias("n_q1"),
        F.round(F.avg("toxic"), 6).alias("toxic_rate"))


@query("b13_churn_ltv", "B13", sql="""
SELECT user_id, max(ts) AS last_seen,
       round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END), 4) AS ltv,
       count(*) AS n_events,
       max(ts) < (SELECT max(ts) FROM events) - INTERVAL 3 DAY AS churned
FROM events GROUP BY 1""")
def b13_churn_ltv(spark, sf):
    c = B.churn_and_ltv(Tables(spark, sf).events, 3)
    return c.select("user_id", "last_seen", F.round("ltv", 4).alias("ltv"), "n_events", "churned")


@query("b14_segments", "B14", sql="""
WITH per AS (SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS spend FROM orders GROUP BY 1)
SELECT c_mktsegment, count(*) AS n_customers, round(avg(coalesce(n, 0)), 6) AS orders_per_customer,
       round(sum(spend) / sum(n), 4) AS avg_order_size
FROM customer LEFT JOIN per ON o_custkey = c_custkey GROUP BY 1""")
def b14_segments(spark, sf):
    t = Tables(spark, sf)
    s = B.segment_summary(t.customer, t.orders)
    return s.select("c_mktsegment", "n_customers", _r("orders_per_customer"),
                    F.round("avg_order_size", 4).alias("avg_order_size"))


@query("b15_marketplace_profit", "B15", sql=f"""
SELECT n_name, {money_sql("sum(CAST(l_extendedprice AS DECIMAL(12,2)))")} AS gross,
       {money_sql(f"sum({NET_SQL})")} AS net,
       {money_sql("sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)))")} AS tax,
       {money_sql(f"sum({NET_SQL}) * CAST(0.08 AS DECIMAL(3,2))")} AS commission
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY 1""")
def b15_marketplace_profit(spark, sf):
    t = Tables(spark, sf)
    r = B.marketplace_profit(t.lineitem, t.supplier, t.nation, 0.08)
    return r.select("n_name", *[money(c).alias(c) for c in ("gross", "net", "tax", "commission")])


@query("b16_best_discount", "B16", sql="""
WITH g AS (SELECT p_type, l_discount, sum(l_quantity) / count(*) AS avg_qty
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT p_type, l_discount AS best_discount, round(avg_qty, 6) AS best_avg_qty FROM (
  SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY avg_qty DESC, l_discount DESC) AS rn FROM g)
WHERE rn = 1""")
def b16_best_discount(spark, sf):
    t = Tables(spark, sf)
    b = B.best_discount(t.lineitem, t.part)
    return b.select("p_type", "best_discount", _r("best_avg_qty"))


@query("b17_channel_share", "B17 A13 W8", sql="""
SELECT event_type, round(sum(value), 4) AS spend,
       round(sum(value) * 100.0 / (SELECT sum(value) FROM events), 6) AS pct
FROM events GROUP BY 1""")
def b17_channel_share(spark, sf):
    from lodestar.operators.aggregates import share_of_total
    g = Tables(spark, sf).events.groupBy("event_type").agg(F.sum("value").alias("spend"))
    s = share_of_total(g, "spend")
    return s.select("event_type", F.round("spend", 4).alias("spend"), _r("pct"))


@query("b18_funnel", "B18 D15", sql="""
WITH f AS (SELECT user_id, CAST(ts AS DATE) AS day,
                  max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS v,
                  max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS c,
                  max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS p
           FROM events GROUP BY 1, 2)
SELECT 0 AS step_no, 'view' AS step, count_if(v = 1) AS n FROM f
UNION ALL SELECT 1, 'click', count_if(v = 1 AND c = 1) FROM f
UNION ALL SELECT 2, 'purchase', count_if(v = 1 AND c = 1 AND p = 1) FROM f""")
def b18_funnel(spark, sf):
    return B.funnel(Tables(spark, sf).events, ["view", "click", "purchase"])


@query("b21_branch_rollup", "B21", sql=f"""
SELECT r_name, n_name, {money_sql(f"sum({NET_SQL})")} AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def b21_branch_rollup(spark, sf):
    from lodestar.operators.business import net_sum
    from lodestar.operators.joins import bounded
    t = Tables(spark, sf)
    per = t.lineitem.groupBy("l_suppkey").agg(net_sum().alias("rev"))
    j = per.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    n = bounded(t.nation, 25).join(bounded(t.region, 5), F.col("n_regionkey") == F.col("r_regionkey"))
    j = j.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"))
    return j.rollup("r_name", "n_name").agg(money(F.sum("rev")).alias("revenue"))


@query("b22_price_vs_market", "B22 W10", sql=f"""
WITH ps AS (SELECT l_partkey, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS v,
                   sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2),
     m AS (SELECT l_partkey, CAST(sum(v) AS DOUBLE) / sum(q) AS market FROM ps GROUP BY 1),
     j AS (SELECT l_partkey, l_suppkey, CAST(v AS DOUBLE) / q AS price, market FROM ps JOIN m USING (l_partkey))
SELECT l_partkey, l_suppkey, {fixed_sql("price")} AS price, {fixed_sql("market")} AS market,
       {fixed_sql("100.0 * (price / market - 1)")} AS pct_vs_market
FROM j""")
def b22_price_vs_market(spark, sf):
    """Each supplier's unit price vs the part's volume-weighted market
    price; both from exact decimal sums (order-independent)."""
    li = Tables(spark, sf).lineitem
    ps = li.groupBy("l_partkey", "l_suppkey").agg(
        B.units_sum(B.cents("l_extendedprice"), 2).alias("v"),
        F.sum("l_quantity").alias("q"))
    m = ps.groupBy("l_partkey").agg(
        (F.sum("v").cast("double") / F.sum("q")).alias("market"))
    j = ps.withColumn("price", F.col("v").cast("double") / F.col("q")).join(m, "l_partkey")
    return j.select("l_partkey", "l_suppkey", fixed("price").alias("price"),
                    fixed("market").alias("market"),
                    fixed(F.lit(100.0) * (F.col("price") / F.col("market") - F.lit(1))).alias("pct_vs_market"))


@query("b23_cost_structure", "B23 A13", sql="""
SELECT p_type, round(sum(l_extendedprice) * 100.0 / (SELECT sum(l_extendedprice) FROM lineitem), 6) AS cost_share,
       round(avg(l_quantity), 6) AS avg_batch, round(sum(l_extendedprice) / sum(l_quantity), 6) AS unit_cost
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def b23_cost_structure(spark, sf):
    from lodestar.operators.aggregates import share_of_total
    t = Tables(spark, sf)
    per = t.lineitem.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("c"),
                                              F.sum("l_quantity").alias("q"),
                                              F.count(F.lit(1)).alias("n"))
    j = per.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    g = j.groupBy("p_type").agg(F.sum("c").alias("cost"), F.sum("q").alias("q"), F.sum("n").alias("n"))
    g = share_of_total(g, "cost", "cost_share")
    return g.select("p_type", _r("cost_share"), F.round(F.col("q") / F.col("n"), 6).alias("avg_batch"),
                    F.round(F.col("cost") / F.col("q"), 6).alias("unit_cost"))


@query("b25_payment_share", "B25 A13", sql="""
SELECT o_orderpriority, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 6) AS pct,
       round(avg(o_totalprice), 4) AS avg_cheque
FROM orders GROUP BY 1""")
def b25_payment_share(spark, sf):
    from lodestar.operators.aggregates import share_of_total
    g = Tables(spark, sf).orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("avg_cheque"))
    g = share_of_total(g, "n")
    return g.select("o_orderpriority", "n", _r("pct"), F.round("avg_cheque", 4).alias("avg_cheque"))


@query("b26_idle_time", "B26 W4", sql="""
WITH g AS (SELECT user_id, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS gap FROM events)
SELECT user_id, count(*) AS n_events,
       round(sum(CASE WHEN gap > 3600 THEN gap ELSE 0.0 END), 3) AS idle_s,
       round(sum(CASE WHEN NOT (gap > 3600) THEN gap ELSE 0.0 END), 3) AS busy_s
FROM g GROUP BY 1""")
def b26_idle_time(spark, sf):
    r = B.idle_time(Tables(spark, sf).events, 3600.0)
    return r.select("user_id", "n_events", F.round("idle_s", 3).alias("idle_s"),
                    F.round("busy_s", 3).alias("busy_s"))


@query("b27_processing_time", "B27", sql="""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, epoch_us(max(ts)) - epoch_us(min(ts)) AS us
           FROM events GROUP BY 1, 2)
SELECT user_id, round(avg(us), 0) / 1e6 AS avg_secs, count(*) AS n_days FROM d GROUP BY 1""")
def b27_processing_time(spark, sf):
    return B.processing_time(Tables(spark, sf).events)


@query("b29_top5_nations_since_1998", "B29 A5 O3", sql="""
WITH y AS (SELECT n_name, year(o_orderdate) AS yr, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS rev
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1, 2),
     g AS (SELECT n_name, sum(rev) AS s, count(*) AS n FROM y GROUP BY 1)
SELECT n_name, CAST((2 * s + n) // (2 * n) AS BIGINT) / 100.0 AS mean_revenue, n AS n_years
FROM g ORDER BY (2 * s + n) // (2 * n) DESC, n_name LIMIT 5""")
def b29_top5_nations_since_1998(spark, sf):
    """Top nations by mean yearly revenue. The mean is taken on exact cent
    totals with integer half-up rounding, so it is identical whatever the
    summation order (averages of cents often sit exactly on a half cent)."""
    from lodestar.operators.joins import bounded
    t = Tables(spark, sf)
    o = t.orders.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    per = o.groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(
        F.sum(B.cents("o_totalprice").cast("decimal(18,0)")).alias("r"))
    j = per.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    j = j.groupBy("c_nationkey", "yr").agg(F.sum("r").alias("rev"))
    j = j.join(bounded(t.nation, 25), F.col("c_nationkey") == F.col("n_nationkey"))
    g = j.groupBy("n_name").agg(F.sum("rev").alias("s"), F.count(F.lit(1)).alias("n_years"))
    g = g.withColumn("mean_cents", F.expr("(2 * s + n_years) div (2 * n_years)"))
    top = g.orderBy(F.col("mean_cents").desc(), F.col("n_name")).limit(5)
    return top.select("n_name", (F.col("mean_cents") / F.lit(100.0)).alias("mean_revenue"), "n_years")


@query("b31_retention_cohorts", "B31", sql="""
WITH uw AS (SELECT DISTINCT user_id, CAST(date_trunc('week', ts) AS DATE) AS week FROM events),
     f AS (SELECT user_id, min(week) AS cohort FROM uw GROUP BY 1)
SELECT cohort, CAST(datediff('day', cohort, week) / 7 AS INTEGER) AS week_offset, count(*) AS n_users
FROM uw JOIN f USING (user_id) GROUP BY 1, 2""")
def b31_retention_cohorts(spark, sf):
    return B.retention_cohorts(Tables(spark, sf).events)


@query("b31_value_by_length", "B31", sql=f"""
WITH u AS (
  SELECT o_custkey, CASE WHEN 4 * p_size <= 120 THEN '<=120' WHEN 4 * p_size <= 180 THEN '<=180'
                         ELSE '>180' END AS band,
         sum({NET_SQL}) AS v, count(DISTINCT year(o_orderdate)) AS years
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT band, count(*) AS n_users, round(CAST(sum(v) AS DOUBLE) / count(*), 4) AS lifetime_value,
       round(avg(CASE WHEN years > 1 THEN 1.0 ELSE 0.0 END), 6) AS retained_share
FROM u GROUP BY 1""")
def b31_value_by_length(spark, sf):
    t = Tables(spark, sf)
    r = B.value_by_length(t.lineitem, t.orders, t.part)
    return r.select("band", "n_users", _r("lifetime_value", 4), _r("retained_share"))


@query("b32_macro_factors", "B32 I7 P12 J1", sql="""
WITH ny AS (SELECT c_nationkey, year(o_orderdate) AS yr, sum(o_totalprice) AS rev,
                   count(DISTINCT o_custkey) AS n_cust, avg(c_acctbal) AS bal
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT CASE WHEN bal < 4000 THEN 'low' WHEN bal < 5000 THEN 'mid' ELSE 'high' END AS bal_band,
       count(*) AS n, round(corr(rev, n_cust), 6) AS corr_rev_customers,
       round(corr(rev, bal), 6) AS corr_rev_balance
FROM ny GROUP BY 1""")
def b32_macro_factors(spark, sf):
    from lodestar.operators.relational import band
    t = Tables(spark, sf)
    oc = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey",
                                         "c_acctbal"), "o_custkey")
    ny = oc.groupBy("c_nationkey", F.year("o_orderdate").alias("yr")).agg(
        F.sum("o_totalprice").alias("rev"), F.countDistinct("o_custkey").alias("n_cust"),
        F.avg("c_acctbal").alias("bal"))
    g = ny.groupBy(band(F.col("bal"), [4000, 5000], ["low", "mid", "high"]).alias("bal_band")).agg(
        F.count(F.lit(1)).alias("n"), F.corr("rev", "n_cust").alias("corr_rev_customers"),
        F.corr("rev", "bal").alias("corr_rev_balance"))
    return g.select("bal_band", "n", _r("corr_rev_customers"), _r("corr_rev_balance"))
