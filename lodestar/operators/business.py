"""Business reports (survey §2.20, B1-B32) composed from the operators.

Recurring plan shape: aggregate the fact table (lineitem / orders / events)
on its own join key FIRST — the partial aggregate collapses each key inside
every map task, so hot keys cost one row per task — then join the much
smaller aggregate to its dimension, then aggregate to the report grain.
Catalyst does not push aggregates below joins by itself, so this is
written out explicitly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators import windows as W
from lodestar.operators.joins import anti, bounded

# Money is exact. Per row it is integer arithmetic on the 2-decimal inputs
# (cents x hundredths = 1e-4 currency units, a BIGINT: codegen-fast); sums
# run in DECIMAL(28,0), so they are exact in any order (totals do not depend
# on partitioning, half-cent ties round the same everywhere) and cannot
# overflow even when one key holds a third of a 100 TB table.
def cents(col: str):
    """A 2-decimal amount as exact integer hundredths."""
    return F.rint(F.col(col) * F.lit(100.0)).cast("bigint")


def net_units():
    """Net line amount, price x (1 - discount), in 1e-4 units."""
    return cents("l_extendedprice") * (F.lit(100) - cents("l_discount"))


def units_sum(units, scale: int):
    """Exact sum of integer ``units`` of 10^-scale, as a decimal."""
    unit = F.lit("0." + "0" * (scale - 1) + "1").cast(f"decimal({scale},{scale})")
    return F.sum(units.cast("decimal(18,0)")) * unit


def net_sum():
    return units_sum(net_units(), 4)


NET_SQL = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


def money(c):
    """Exact decimal amount -> cents -> double (for reports)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(38,2)").cast("double")


def money_sql(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(38,2)) AS DOUBLE)"


def part_revenue(lineitem: DataFrame) -> DataFrame:
    """Revenue, quantity and line count per part (the map-side combined
    pre-aggregate most item reports start from)."""
    return lineitem.groupBy("l_partkey").agg(
        net_sum().alias("revenue"), F.sum("l_quantity").alias("qty"),
        F.count(F.lit(1)).alias("n_lines"))


def revenue_by_category(lineitem: DataFrame, part: DataFrame, by: str = "p_type") -> DataFrame:
    """B1: revenue per category."""
    pr = part_revenue(lineitem)
    j = pr.join(part.select("p_partkey", by), pr.l_partkey == part.p_partkey)
    return j.groupBy(by).agg(money(F.sum("revenue")).alias("revenue"),
                             F.sum("n_lines").alias("n_lines"))


def top_items(lineitem: DataFrame, part: DataFrame, k: int = 10) -> DataFrame:
    """B1/O3: the k best-selling parts by revenue (distributed top-k on the
    per-part aggregate; names joined to the k rows only)."""
    pr = part_revenue(lineitem)
    top = pr.orderBy(F.col("revenue").desc(), F.col("l_partkey").asc()).limit(k)
    names = part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return top.join(names, "l_partkey").select(
        F.col("l_partkey").alias("p_partkey"), "p_name",
        money("revenue").alias("revenue"))


def month_of(col: str):
    return F.trunc(F.to_date(F.col(col)), "month")


def monthly_order_value(orders: DataFrame) -> DataFrame:
    """B1: mean order value and order count by month."""
    return orders.groupBy(month_of("o_orderdate").alias("month")).agg(
        F.round(F.avg("o_totalprice"), 4).alias("avg_order_value"),
        F.count(F.lit(1)).alias("n_orders"))


def monthly_sales_trend(orders: DataFrame) -> DataFrame:
    """Monthly sales with a least-squares trend line over the month
    index (slope/intercept are scalar subqueries over the monthly series)."""
    m = orders.groupBy(month_of("o_orderdate").alias("month")).agg(
        F.sum("o_totalprice").alias("sales"))
    m = m.withColumn("idx", (F.year("month") * 12 + F.month("month")).cast("double"))
    slope = m.agg(F.regr_slope("sales", "idx")).scalar()
    icpt = m.agg(F.regr_intercept("sales", "idx")).scalar()
    return m.select("month", F.round("sales", 2).alias("sales"),
                    F.round(icpt + slope * F.col("idx"), 2).alias("trend"))


def _ymd(col: str):
    return F.to_date(F.col(col))


def slow_movers(lineitem: DataFrame, part: DataFrame, days: int = 365) -> DataFrame:
    """Parts with no sale in the last ``days`` days of the data (the end
    date is a scalar subquery); anti-join, no id list through the driver."""
    end = lineitem.agg(F.max("l_shipdate")).scalar()
    recent = lineitem.where(F.col("l_shipdate") > end - F.make_interval(days=F.lit(days)))
    last = lineitem.groupBy("l_partkey").agg(F.max("l_shipdate").alias("last_sold"))
    slow = anti(part.select("p_partkey", "p_name"),
                recent.select(F.col("l_partkey").alias("p_partkey")), "p_partkey")
    return slow.join(last.withColumnRenamed("l_partkey", "p_partkey"), "p_partkey", "left")


# fixed value: parts whose quarterly receipts one task makes
PARTS_PER_TASK = 20_000


def stock_movements(lineitem: DataFrame, part: DataFrame, first: Column, last: Column) -> DataFrame:
    """B3 stand-in for a stock ledger (the tables have none): every part
    starts with 100 + 4 * p_size units, receives 20 + p_size at the start of
    each quarter from ``first`` to ``last``, and loses what is shipped.
    Columns p_partkey, ts, delta, opening."""
    opening = (F.lit(100) + 4 * F.col("p_size")).cast("double")
    # one row becomes one per quarter: spread first, so that no task makes them all
    spread = part.select("p_partkey", "p_size").repartition(max(1, math.ceil(part.count() / PARTS_PER_TASK)))
    quarters = F.sequence(F.trunc(F.to_date(first), "quarter"), F.to_date(last), F.expr("INTERVAL 3 MONTHS"))
    supply = spread.select("p_partkey", "p_size", F.explode(quarters).alias("day")).select(
        "p_partkey", F.col("day").cast("timestamp_ntz").alias("ts"),
        (F.lit(20) + F.col("p_size")).cast("double").alias("delta"))
    sold = lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_shipdate").alias("ts"),
                           (-F.col("l_quantity")).alias("delta"))
    return supply.unionByName(sold).join(part.select("p_partkey", opening.alias("opening")), "p_partkey")


def critical_stock(movements: DataFrame, key: str, ts: str, delta: str, opening: str,
                   level: float) -> DataFrame:
    """B3 critically low stock: per ``key`` the first time its running balance
    (opening plus all movements up to then) falls below ``level``, the lowest
    balance and the number of times it went from enough to too little. Keys
    that never do are left out. Movements at one time count together. Balances
    run per (key, stretch of rows) and are stitched, so a key with a third of
    the movements is spread."""
    from lodestar.operators.recurrences import previous_value
    from lodestar.operators.windows import running_sum
    net = movements.groupBy(key, ts).agg(F.sum(delta).alias("_d"), F.first(opening).alias("_o"))
    x = running_sum(net, key, ts, "_d", "_run").withColumn("_balance", F.col("_o") + F.col("_run"))
    x = x.withColumn("_low", F.col("_balance") < level)
    x = previous_value(x, key, ts, "_low", "_was")
    fell = F.col("_low") & ~F.coalesce(F.col("_was"), F.col("_o") < level)
    out = x.groupBy(key).agg(F.min(F.when(F.col("_low"), F.col(ts))).alias("first_low"),
                             F.min("_balance").alias("lowest"), F.count_if(fell).alias("times_fallen"))
    return out.where("first_low is not null")


def turnover(lineitem: DataFrame) -> DataFrame:
    """Units sold per active month, per part."""
    return lineitem.groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.countDistinct(F.trunc(_ymd("l_shipdate"), "month")).alias("months_active")
    ).withColumn("turnover", F.col("qty") / F.col("months_active"))


def supplier_lead_times(lineitem: DataFrame, orders: DataFrame, late_days: int = 90) -> DataFrame:
    """Mean order->ship lead time and share of late lines per supplier."""
    lead = F.datediff(_ymd("l_shipdate"), _ymd("o_orderdate"))
    j = lineitem.select("l_orderkey", "l_suppkey", "l_shipdate").join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return j.groupBy("l_suppkey").agg(
        F.avg(lead).alias("avg_lead_days"),
        F.avg(F.when(lead > late_days, 1.0).otherwise(0.0)).alias("late_rate"),
        F.count(F.lit(1)).alias("n_lines"))


def return_rates(lineitem: DataFrame, part: DataFrame, by: list[str]) -> DataFrame:
    """Share of returned lines per part attribute(s)."""
    per = lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    j = per.join(part.select(F.col("p_partkey").alias("l_partkey"), *by), "l_partkey")
    return j.groupBy(*by).agg((F.sum("r") / F.sum("n")).alias("return_rate"),
                              F.sum("n").alias("n_lines"))


def loyalty_tiers(customer: DataFrame, orders: DataFrame, edges, labels) -> DataFrame:
    """Order frequency vs balance by balance tier (customers without
    orders count as 0)."""
    from lodestar.operators.relational import band
    n = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    c = customer.select("c_custkey", "c_acctbal").join(
        n.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left").fillna(0, ["n_orders"])
    return c.groupBy(band(F.col("c_acctbal"), edges, labels).alias("tier")).agg(
        F.count(F.lit(1)).alias("n_customers"), F.avg("n_orders").alias("avg_orders"),
        F.corr("c_acctbal", "n_orders").alias("corr_balance_orders"))


def user_day_flags(events: DataFrame, types) -> DataFrame:
    """One row per (user, day) with a 0/1 flag per event type
    (``max(when)``: map-side combined)."""
    aggs = [F.max(F.when(F.col("event_type") == t, 1).otherwise(0)).alias(t) for t in types]
    return events.groupBy("user_id", F.to_date("ts").alias("day")).agg(*aggs)


def abandoned_carts(events: DataFrame) -> DataFrame:
    """Per day, user-days that viewed but did not purchase."""
    f = user_day_flags(events, ["view", "purchase"])
    return f.groupBy("day").agg(
        F.count_if(F.col("view") == 1).alias("n_viewing"),
        F.count_if((F.col("view") == 1) & (F.col("purchase") == 0)).alias("n_abandoned"))


def baskets(lineitem: DataFrame, part: DataFrame, item: str = "p_brand") -> DataFrame:
    """One row per order with its distinct item set (an order is a
    bounded group: its lines; the set is bounded by the item domain)."""
    j = lineitem.select("l_orderkey", "l_partkey").join(
        part.select(F.col("p_partkey").alias("l_partkey"), F.col(item).alias("item")), "l_partkey")
    return j.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("item")).alias("items"))


def frequent_pairs(basket_df: DataFrame, min_support: float) -> DataFrame:
    """Item pairs bought together, by distributed FP-growth
    (no pair self-join: nothing quadratic per basket is materialised)."""
    from pyspark.ml.fpm import FPGrowth
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=0.0).fit(basket_df)
    fi = model.freqItemsets.where(F.size("items") == 2)
    s = F.array_sort("items")
    return fi.select(s[0].alias("item_a"), s[1].alias("item_b"), F.col("freq").alias("support"))


def time_to_purchase(events: DataFrame) -> DataFrame:
    """Seconds from the latest earlier view to each purchase, within the
    same user-day (hour-bucketed windows + carry: a hot user-day is split)."""
    e = events.select("user_id", "event_id", "event_type", "ts", F.to_date("ts").alias("day"))
    x = W.last_flagged_before(e, ["user_id", "day"], "ts", F.col("event_type") == "view",
                              "event_id", name="lv")
    us = (F.unix_micros(F.col("ts").cast("timestamp")) -
          F.unix_micros(F.col("lv").cast("timestamp")))
    x = x.where((F.col("event_type") == "purchase") & F.col("lv").isNotNull())
    return x.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_purchases"),
                                    micros_to_secs(F.avg(us)).alias("avg_secs"))


def micros_to_secs(avg_us):
    """Mean of exact integer microseconds, rounded to whole microseconds,
    in seconds (exact integer sums make the result order-independent)."""
    return F.round(avg_us, 0) / F.lit(1e6)


def promotion_roi(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Discounted vs full-price revenue per category."""
    promo = F.col("l_discount") > 0
    per = lineitem.groupBy("l_partkey").agg(
        units_sum(F.when(promo, net_units()), 4).alias("promo"),
        units_sum(F.when(~promo, net_units()), 4).alias("full"),
        units_sum(F.when(promo, cents("l_extendedprice") * 100 - net_units()), 4).alias("given"))
    j = per.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    return j.groupBy("p_type").agg(F.sum("promo").alias("promo_revenue"),
                                   F.sum("full").alias("full_revenue"),
                                   F.sum("given").alias("discount_given"))


def seasonality(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Month-of-year revenue / the category's mean month-of-year revenue."""
    from pyspark.sql import Window
    per = lineitem.groupBy("l_partkey", F.month("l_shipdate").alias("moy")).agg(
        net_sum().alias("rev"))
    j = per.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    m = j.groupBy("p_type", "moy").agg(F.sum("rev").alias("rev"))
    avg = F.avg(F.col("rev").cast("double")).over(Window.partitionBy("p_type"))  # 12 rows per type
    return m.withColumn("coef", F.col("rev").cast("double") / avg)


def price_elasticity(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Log-log slope of quantity on unit price, per category. Lines are
    reduced to sums per part before they meet the catalogue (sums about fixed
    points near the data, so that little cancels)."""
    x = F.ln(F.col("l_extendedprice") / F.col("l_quantity")) - 7
    y = F.ln("l_quantity") - 3
    xy = lineitem.select("l_partkey", x.alias("x"), y.alias("y")).where("x is not null and y is not null")
    per = xy.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y"),
        F.sum(F.col("x") * F.col("x")).alias("xx"), F.sum(F.col("x") * F.col("y")).alias("xy"))
    j = per.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    t = j.groupBy("p_type").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "xy")])
    slope = F.try_divide(F.col("n") * F.col("xy") - F.col("x") * F.col("y"),
                         F.col("n") * F.col("xx") - F.col("x") * F.col("x"))
    return t.select("p_type", slope.alias("elasticity"), "n")


def value_by_length(lineitem: DataFrame, orders: DataFrame, part: DataFrame,
                    edges=(120, 180)) -> DataFrame:
    """Lifetime value and retention of customers by the length of what
    they watch (stand-in: part length = 4 x p_size minutes). Per band: users,
    mean value of a user there, and the share of users active in more than one
    year. Lines are reduced per order and band, then per user, year and band."""
    length = 4 * F.col("p_size")
    band = F.when(length <= edges[0], f"<={edges[0]}").when(length <= edges[1], f"<={edges[1]}") \
        .otherwise(f">{edges[1]}")
    per_order = lineitem.groupBy("l_orderkey", "l_partkey").agg(F.sum(net_units()).alias("v")).join(
        part.select(F.col("p_partkey").alias("l_partkey"), band.alias("band")), "l_partkey").groupBy(
        "l_orderkey", "band").agg(F.sum("v").alias("v"))
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
                      F.year("o_orderdate").alias("year"))
    per_user = per_order.join(o, "l_orderkey").groupBy("o_custkey", "band", "year").agg(
        F.sum("v").alias("v")).groupBy("o_custkey", "band").agg(
        F.sum(F.col("v").cast("decimal(28,0)")).alias("v"), F.count(F.lit(1)).alias("years"))
    return per_user.groupBy("band").agg(
        F.count(F.lit(1)).alias("n_users"),
        (F.sum("v").cast("double") / 1e4 / F.count(F.lit(1))).alias("lifetime_value"),
        F.avg((F.col("years") > 1).cast("double")).alias("retained_share"))


def price_bands(lineitem: DataFrame, width: float) -> DataFrame:
    """Revenue and volume per unit-price band of fixed width."""
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    b = F.floor(unit / width).cast("bigint")
    return lineitem.groupBy(b.alias("band")).agg(
        net_sum().alias("revenue"), F.sum("l_quantity").alias("qty"))


def delivery_cost(lineitem, part, orders, customer, nation, region) -> DataFrame:
    """Tax-as-delivery-cost by customer region and part type. Lines are
    reduced to (order, type) before meeting orders; region/nation are
    bounded dimensions (broadcast)."""
    cost = cents("l_extendedprice") * cents("l_tax")             # 1e-4 units
    lt = lineitem.select("l_orderkey", "l_partkey", cost.alias("cost")).join(
        part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    per_order = lt.groupBy("l_orderkey", "p_type").agg(units_sum(F.col("cost"), 4).alias("cost"))
    oc = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(
        customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    j = per_order.join(oc, "l_orderkey").groupBy("c_nationkey", "p_type").agg(
        F.sum("cost").alias("cost"))
    geo = bounded(nation, 25).join(bounded(region, 5), F.col("n_regionkey") == F.col("r_regionkey"))
    j = j.join(F.broadcast(geo.select("n_nationkey", "r_name")),
               F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("r_name", "p_type").agg(F.sum("cost").alias("cost"))


def churn_and_ltv(events: DataFrame, inactive_days: int = 3) -> DataFrame:
    """Last activity, purchase value and churn flag per user."""
    end = events.agg(F.max("ts")).scalar()
    u = events.groupBy("user_id").agg(
        F.max("ts").alias("last_seen"),
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(0.0)).alias("ltv"),
        F.count(F.lit(1)).alias("n_events"))
    return u.withColumn("churned",
                        F.col("last_seen") < end - F.make_interval(days=F.lit(inactive_days)))


def segment_summary(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Per market segment: customers, orders per customer, order size."""
    per = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"),
                                          F.sum("o_totalprice").alias("spend"))
    j = customer.select("c_custkey", "c_mktsegment").join(
        per.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "left")
    return j.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.avg(F.coalesce(F.col("n"), F.lit(0))).alias("orders_per_customer"),
        (F.sum("spend") / F.sum("n")).alias("avg_order_size"))


def marketplace_profit(lineitem, supplier, nation, commission: float = 0.08) -> DataFrame:
    """Gross, net, commission and tax per supplier nation."""
    per = lineitem.groupBy("l_suppkey").agg(
        units_sum(cents("l_extendedprice"), 2).alias("gross"),
        net_sum().alias("net"),
        units_sum(cents("l_extendedprice") * cents("l_tax"), 4).alias("tax"))
    j = per.join(supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    j = j.groupBy("s_nationkey").agg(F.sum("gross").alias("gross"), F.sum("net").alias("net"),
                                     F.sum("tax").alias("tax"))
    j = j.join(bounded(nation, 25), F.col("s_nationkey") == F.col("n_nationkey"))
    return j.select("n_name", "gross", "net", "tax",
                    (F.col("net") * F.lit(commission).cast("decimal(3,2)")).alias("commission"))


def best_discount(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Mean quantity per discount level per category, and the level
    with the highest mean (ties: the larger discount)."""
    per = lineitem.groupBy("l_partkey", "l_discount").agg(
        F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"))
    j = per.join(part.select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    g = j.groupBy("p_type", "l_discount").agg((F.sum("q") / F.sum("n")).alias("avg_qty"))
    best = g.groupBy("p_type").agg(F.max(F.struct("avg_qty", "l_discount")).alias("b"))
    return best.select("p_type", F.col("b.l_discount").alias("best_discount"),
                       F.col("b.avg_qty").alias("best_avg_qty"))


def funnel(events: DataFrame, steps) -> DataFrame:
    """User-days reaching each successive step (all earlier steps
    present the same day) and the conversion from the previous step."""
    f = user_day_flags(events, steps)
    aggs = []
    cond = F.lit(True)
    for s in steps:
        cond = cond & (F.col(s) == 1)
        aggs.append(F.count_if(cond).alias(s))
    wide = f.agg(*aggs)
    stack = ", ".join(f"{i}, '{s}', `{s}`" for i, s in enumerate(steps))
    return wide.selectExpr(f"stack({len(steps)}, {stack}) AS (step_no, step, n)")


def idle_time(events: DataFrame, threshold_s: float = 3600.0) -> DataFrame:
    """Busy vs idle seconds per user from gaps between events."""
    g = W.gaps(events.select("user_id", "ts"), "user_id", "ts")
    idle = F.col("gap_s") > threshold_s
    return g.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.when(idle, F.col("gap_s")).otherwise(0.0)).alias("idle_s"),
        F.sum(F.when(~idle, F.col("gap_s")).otherwise(0.0)).alias("busy_s"))


def processing_time(events: DataFrame) -> DataFrame:
    """First->last event seconds per user-day, averaged per user."""
    d = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    us = (F.unix_micros(F.col("t1").cast("timestamp")) -
          F.unix_micros(F.col("t0").cast("timestamp")))
    return d.groupBy("user_id").agg(micros_to_secs(F.avg(us)).alias("avg_secs"),
                                    F.count(F.lit(1)).alias("n_days"))


def retention_cohorts(events: DataFrame) -> DataFrame:
    """Users active in each week after their first-active week."""
    wk = F.date_trunc("week", F.col("ts")).cast("date")
    uw = events.select("user_id", wk.alias("week")).distinct()
    first = uw.groupBy("user_id").agg(F.min("week").alias("cohort"))
    j = uw.join(first, "user_id")
    off = (F.datediff("week", "cohort") / 7).cast("int")
    return j.groupBy("cohort", off.alias("week_offset")).agg(
        F.count(F.lit(1)).alias("n_users"))
