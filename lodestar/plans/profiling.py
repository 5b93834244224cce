"""Profiling (I-series) and cleaning (C-series) queries."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from lodestar.operators import clean as C
from lodestar.operators import profile as P
from lodestar.operators import sketches as SK
from lodestar.operators.joins import small_side
from lodestar.plans.fixtures import DIRTY_CUSTOMER_SQL, WORKOUT_SQL, dirty_customer, workout_series
from lodestar.plans.registry import query
from lodestar.session import scratch_dir
from lodestar.tables import Tables


@query("i_schema_profile", "I1 I2", sql="""
SELECT CAST(ordinal AS INTEGER) AS ordinal, column_name AS "column", data_type,
       non_null, n_rows FROM (
  SELECT 0 AS ordinal, 'c_custkey' AS column_name, 'bigint' AS data_type, count(c_custkey) AS non_null, count(*) AS n_rows FROM customer
  UNION ALL SELECT 1, 'c_name', 'string', count(c_name), count(*) FROM customer
  UNION ALL SELECT 2, 'c_nationkey', 'int', count(c_nationkey), count(*) FROM customer
  UNION ALL SELECT 3, 'c_acctbal', 'double', count(c_acctbal), count(*) FROM customer
  UNION ALL SELECT 4, 'c_mktsegment', 'string', count(c_mktsegment), count(*) FROM customer)""")
def i_schema_profile(spark, sf):
    return P.schema_profile(Tables(spark, sf).customer)


@query("i_null_counts", "I8 I9 I10 C6", sql=f"""
WITH {DIRTY_CUSTOMER_SQL}
SELECT * FROM (
  SELECT 'c_custkey' AS "column", count_if(c_custkey IS NULL) AS n_missing,
         count_if(c_custkey IS NULL) * 100.0 / count(*) AS pct_missing FROM dirty_customer
  UNION ALL SELECT 'c_name', count_if(c_name IS NULL), count_if(c_name IS NULL) * 100.0 / count(*) FROM dirty_customer
  UNION ALL SELECT 'c_nationkey', count_if(c_nationkey IS NULL), count_if(c_nationkey IS NULL) * 100.0 / count(*) FROM dirty_customer
  UNION ALL SELECT 'c_acctbal', count_if(c_acctbal IS NULL OR isnan(c_acctbal)),
                   count_if(c_acctbal IS NULL OR isnan(c_acctbal)) * 100.0 / count(*) FROM dirty_customer
  UNION ALL SELECT 'c_mktsegment', count_if(c_mktsegment IS NULL), count_if(c_mktsegment IS NULL) * 100.0 / count(*) FROM dirty_customer)""")
def i_null_counts(spark, sf):
    return P.null_counts(dirty_customer(Tables(spark, sf).customer))


@query("i_anomaly_scan", "I11 Q1 Q2", sql=f"""
WITH {WORKOUT_SQL.replace("list(value ORDER BY", "list(CASE WHEN event_type = 'error' THEN 0.0 ELSE value END ORDER BY")}
SELECT 'user_id' AS "column", 'number' AS kind, count_if(user_id IS NULL OR user_id = 0) AS n_anomalous FROM s
UNION ALL SELECT 'vals', 'array', count_if(vals IS NULL OR len(list_filter(vals, lambda x: x IS NULL OR isnan(x) OR x = 0)) > 0) FROM s
UNION ALL SELECT 'types', 'array', count_if(types IS NULL OR len(list_filter(types, lambda x: x IS NULL)) > 0) FROM s""")
def i_anomaly_scan(spark, sf):
    e = Tables(spark, sf).events.withColumn(
        "value", F.when(F.col("event_type") == "error", F.lit(0.0)).otherwise(F.col("value")))
    s = workout_series(e).select("user_id", F.col("value").alias("vals"),
                                 F.col("event_type").alias("types"))
    return P.anomaly_counts(s)


@query("i_describe_lineitem", "I3", sql="""
SELECT * FROM (
  SELECT 'l_quantity' AS "column", count(l_quantity) AS count, round(avg(l_quantity), 6) AS mean,
         round(stddev_samp(l_quantity), 6) AS stddev, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem
  UNION ALL SELECT 'l_discount', count(l_discount), round(avg(l_discount), 6), round(stddev_samp(l_discount), 6),
         min(l_discount), max(l_discount) FROM lineitem
  UNION ALL SELECT 'l_tax', count(l_tax), round(avg(l_tax), 6), round(stddev_samp(l_tax), 6),
         min(l_tax), max(l_tax) FROM lineitem)""")
def i_describe_lineitem(spark, sf):
    d = P.describe_long(Tables(spark, sf).lineitem, ["l_quantity", "l_discount", "l_tax"])
    return d.select("column", "count", F.round("mean", 6).alias("mean"),
                    F.round("stddev", 6).alias("stddev"), "min", "max")


@query("i_summary_percentiles", "I4 I5", sql="""
SELECT * FROM (
  SELECT 'o_totalprice' AS "column", count(o_totalprice) AS count, round(avg(o_totalprice), 4) AS mean,
         round(quantile_cont(o_totalprice, 0.25), 4) AS p25, round(quantile_cont(o_totalprice, 0.5), 4) AS p50,
         round(quantile_cont(o_totalprice, 0.75), 4) AS p75 FROM orders
  UNION ALL SELECT 'c_acctbal', count(c_acctbal), round(avg(c_acctbal), 4),
         round(quantile_cont(c_acctbal, 0.25), 4), round(quantile_cont(c_acctbal, 0.5), 4),
         round(quantile_cont(c_acctbal, 0.75), 4) FROM customer)""")
def i_summary_percentiles(spark, sf):
    t = Tables(spark, sf)
    a = P.summary_long(t.orders, ["o_totalprice"])
    b = P.summary_long(t.customer, ["c_acctbal"])
    out = a.unionByName(b)
    return out.select("column", "count", F.round("mean", 4).alias("mean"),
                      *[F.round(c, 4).alias(c) for c in ("p25", "p50", "p75")])


@query("i_approx_quantiles", "I5")
def i_approx_quantiles(spark, sf):
    """Sketch-based quantiles (``percentile_approx``), bounded memory per
    group: rows-only check (approximate by definition)."""
    d = P.summary_long(Tables(spark, sf).lineitem, ["l_extendedprice", "l_quantity"],
                       approx=True)
    return d.select("column", "p25", "p50", "p75")


@query("i_mergeable_sketches", "A7 I5", sql="""
WITH e AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
     r AS (SELECT 'all' AS span, DATE '1900-01-01' AS a, DATE '2999-01-01' AS b
           UNION ALL SELECT 'to the 10th', DATE '1900-01-01', DATE '2024-01-10'
           UNION ALL SELECT 'from the 8th to the 21st', DATE '2024-01-08', DATE '2024-01-21')
SELECT span, event_type, count(*) AS n, TRUE AS distinct_ok, TRUE AS quantiles_ok
FROM e JOIN r ON day BETWEEN a AND b GROUP BY 1, 2""")
def i_mergeable_sketches(spark, sf):
    """Sketches stored per event type and day, merged for three ranges of
    days, and their errors held against the exact answers: distinct events
    within four standard errors, quartiles within 2 % of rank."""
    base = scratch_dir(spark, f"sketches-{uuid.uuid4().hex}")
    e = Tables(spark, sf).events.withColumn("day", F.to_date("ts"))
    SK.daily_sketches(e, ["event_type"], F.col("day"), "event_id", "value").write.partitionBy(
        "day").parquet(base)
    mart = spark.read.parquet(base)
    out = None
    for span, a, b in (("all", None, None), ("to the 10th", None, date(2024, 1, 10)),
                       ("from the 8th to the 21st", date(2024, 1, 8), date(2024, 1, 21))):
        est = SK.merge_days(mart, ["event_type"], a, b)
        rows = e if a is None else e.where(F.col("day") >= F.lit(a))
        rows = rows if b is None else rows.where(F.col("day") <= F.lit(b))
        x = rows.join(small_side(est.drop("n")), "event_type").groupBy("event_type").agg(
            F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("exact"),
            F.first("n_distinct").alias("n_distinct"),
            *[F.avg((F.col("value") <= F.col(q)).cast("double")).alias(q) for q in ("q25", "q50", "q75")])
        x = x.select(
            F.lit(span).alias("span"), "event_type", "n",
            (F.abs(F.col("n_distinct") - F.col("exact"))
             <= 4 * SK.distinct_error(12) * F.col("exact")).alias("distinct_ok"),
            (F.greatest(*[F.abs(F.col(f"q{p}") - p / 100) for p in (25, 50, 75)])
             <= 0.02 + 1 / F.col("n")).alias("quantiles_ok"))
        out = x if out is None else out.unionByName(x)
    return out


@query("i_frequent_items", "I6", sql="""
SELECT p_size, count(*) AS n FROM part GROUP BY p_size
HAVING count(*) >= 0.021 * (SELECT count(*) FROM part)""")
def i_frequent_items(spark, sf):
    return P.frequent_items(Tables(spark, sf).part, "p_size", 0.021)


@query("i_native_freq_items", "I6")
def i_native_freq_items(spark, sf):
    """``DataFrame.freqItems`` (one-pass, may include false positives)."""
    p = Tables(spark, sf).part
    return p.freqItems(["p_size", "p_brand"], 0.05).select(
        F.size("p_size_freqItems").alias("n_sizes"), F.size("p_brand_freqItems").alias("n_brands"))


@query("i_correlations", "I7 B29", sql="""
SELECT * FROM (
  SELECT 'l_quantity' AS col_a, 'l_extendedprice' AS col_b, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem
  UNION ALL SELECT 'l_discount', 'l_tax', round(corr(l_discount, l_tax), 6) FROM lineitem
  UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) FROM lineitem)""")
def i_correlations(spark, sf):
    c = P.correlation(Tables(spark, sf).lineitem, [("l_quantity", "l_extendedprice"),
                                                   ("l_discount", "l_tax"),
                                                   ("l_quantity", "l_discount")])
    return c.select("col_a", "col_b", F.round("r", 6).alias("r"))


@query("i_entity_summary", "I12 A7", sql="""
SELECT event_type, count(*) AS n_records, count(DISTINCT user_id) AS n_user_id,
       count(DISTINCT CAST(ts AS DATE)) AS n_day
FROM (SELECT *, CAST(ts AS DATE) AS day FROM events)
GROUP BY ROLLUP (event_type)""")
def i_entity_summary(spark, sf):
    e = Tables(spark, sf).events.withColumn("day", F.to_date("ts"))
    return P.entity_summary(e, ["user_id", "day"], "event_type")


@query("i_frequency_table", "I13 I14 A3", sql="""
SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1""")
def i_frequency_table(spark, sf):
    from lodestar.operators.aggregates import group_count
    return group_count(Tables(spark, sf).customer, "c_mktsegment").orderBy(F.col("n").desc())


@query("x_registered_band_udf", "X1 X3 Q10 Y1", sql="""
SELECT CASE WHEN c_acctbal / 2.0 < 450 THEN 'Underdeveloped'
            WHEN c_acctbal / 2.0 < 6000 THEN 'Developing' ELSE 'Developed' END AS band,
       count(*) AS n
FROM customer GROUP BY 1""")
def x_registered_band_udf(spark, sf):
    """Arrow-batched pandas UDF registered for SQL (the only UDF kept)."""
    from lodestar.functions.udfs import register
    name = register(spark)
    c = Tables(spark, sf).customer
    return spark.sql(f"SELECT {name}(c_acctbal / 2.0) AS band, count(*) AS n FROM {{c}} GROUP BY 1",
                     c=c)


# --------------------------------------------------------------- C-series


@query("c_drop_and_fill", "C1 C2", sql=f"""
WITH {DIRTY_CUSTOMER_SQL}
SELECT 'dropna_any' AS step, count(*) AS n FROM dirty_customer
  WHERE c_name IS NOT NULL AND c_acctbal IS NOT NULL AND c_mktsegment IS NOT NULL
UNION ALL SELECT 'dropna_subset', count(*) FROM dirty_customer WHERE c_acctbal IS NOT NULL
UNION ALL SELECT 'dropna_all', count(*) FROM dirty_customer
  WHERE NOT (c_name IS NULL AND c_acctbal IS NULL AND c_mktsegment IS NULL)
UNION ALL SELECT 'filled_nulls', count_if(coalesce(c_mktsegment, 'Unknown') IS NULL
                                          OR coalesce(c_acctbal, 0.0) IS NULL) FROM dirty_customer""")
def c_drop_and_fill(spark, sf):
    c = dirty_customer(Tables(spark, sf).customer)

    def n(df, step):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(step).alias("step"), "n")

    filled = C.fill_missing(c, {"c_mktsegment": "Unknown", "c_acctbal": 0.0})
    left = filled.agg(F.count_if(F.col("c_mktsegment").isNull() | F.col("c_acctbal").isNull())
                      .alias("n")).select(F.lit("filled_nulls").alias("step"), "n")
    return (n(C.drop_missing(c, "any"), "dropna_any")
            .unionByName(n(C.drop_missing(c, "any", ["c_acctbal"]), "dropna_subset"))
            .unionByName(n(C.drop_missing(c.drop("c_custkey", "c_nationkey"), "all"), "dropna_all"))
            .unionByName(left))


@query("c_value_mapping", "C4 F6 Q9", sql="""
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high'
            WHEN '5-LOW' THEN 'low' ELSE o_orderpriority END AS priority,
       count(*) AS n
FROM orders GROUP BY 1""")
def c_value_mapping(spark, sf):
    o = Tables(spark, sf).orders
    m = C.map_values(F.col("o_orderpriority"), {"1-URGENT": "high", "2-HIGH": "high", "5-LOW": "low"})
    return o.groupBy(m.alias("priority")).agg(F.count(F.lit(1)).alias("n"))


@query("c_zscore_outliers", "C7 B2", sql="""
WITH m AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd FROM events)
SELECT event_id, user_id, value, round((value - mu) / sd, 6) AS z
FROM events, m WHERE abs((value - mu) / sd) > 3""")
def c_zscore_outliers(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "user_id", "value")
    out = C.zscore_outliers(e, "value", threshold=3.0)
    return out.select("event_id", "user_id", "value", F.round("z", 6).alias("z"))


@query("c_iqr_outliers", "C7 D5", sql="""
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
           FROM events GROUP BY 1)
SELECT event_type, count(*) AS n_outliers FROM events JOIN q USING (event_type)
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) GROUP BY 1""")
def c_iqr_outliers(spark, sf):
    e = Tables(spark, sf).events
    return C.iqr_outliers(e, "value", "event_type").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_outliers"))


@query("c_standardize", "C8", sql="""
WITH m AS (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd FROM events GROUP BY 1)
SELECT event_id, round((value - mu) / sd, 6) AS z FROM events JOIN m USING (event_type)""")
def c_standardize(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "event_type", "value")
    return C.standardize(e, "value", "event_type").select("event_id", F.round("z", 6).alias("z"))


@query("c_rule_violations", "C9 C5", sql=f"""
WITH {DIRTY_CUSTOMER_SQL},
     v AS (SELECT 'has_name' AS rule FROM dirty_customer WHERE c_name IS NULL
           UNION ALL SELECT 'has_segment' FROM dirty_customer WHERE c_mktsegment IS NULL
           UNION ALL SELECT 'balance_known' FROM dirty_customer WHERE c_acctbal IS NULL)
SELECT rule, count(*) AS n_failed FROM v GROUP BY rule""")
def c_rule_violations(spark, sf):
    c = dirty_customer(Tables(spark, sf).customer)
    checked = C.rule_violations(c, {
        "has_name": F.col("c_name").isNotNull(),
        "has_segment": F.col("c_mktsegment").isNotNull(),
        "balance_known": F.col("c_acctbal").isNotNull()})
    return C.violation_counts(checked)


@query("c_retention", "C6 C5 P14 Q15", sql=f"""
WITH {WORKOUT_SQL}
SELECT (SELECT count(*) FROM s) AS n_raw, count(*) AS n_clean,
       count(*) * 100.0 / (SELECT count(*) FROM s) AS pct_kept
FROM s WHERE len(ts) >= 10""")
def c_retention(spark, sf):
    """Workouts kept by the minimum-length rule (>= 10 points)."""
    s = workout_series(Tables(spark, sf).events)
    cleaned = s.where(F.size("ts") >= 10)
    return C.retention(s, cleaned)
