"""Source/sink round trips (S-series): each writes data derived from the
driver tables into a fresh folder under the shared checkpoint location,
reads it back through the source under test and aggregates."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestar.session import scratch_dir
from lodestar.sources import files as IO
from lodestar.sources.generator import churn_records, churn_sql
from lodestar.plans.registry import query
from lodestar.tables import SCHEMAS, Tables


def _dir(spark, name):
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")


@query("s_csv_roundtrip", "S2 S3 S4 S10", sql="""
SELECT 'explicit' AS reader, c_mktsegment AS segment, count(*) AS n, round(sum(c_acctbal), 2) AS bal
FROM customer GROUP BY 2
UNION ALL SELECT 'inferred', c_mktsegment, count(*), round(sum(c_acctbal), 2) FROM customer GROUP BY 2
UNION ALL SELECT 'no_header', c_mktsegment, count(*), round(sum(c_acctbal), 2) FROM customer GROUP BY 2""")
def s_csv_roundtrip(spark, sf):
    base = _dir(spark, "csv")
    IO.write_csv(Tables(spark, sf).customer, f"{base}/customer")
    a = IO.read_csv(spark, f"{base}/customer", header=True, schema=SCHEMAS["customer"])
    b = IO.read_csv(spark, f"{base}/customer", header=True, infer=True)
    c = IO.read_csv(spark, f"{base}/customer", header=False)          # _c0.. strings
    c = c.where(F.col("_c0") != "c_custkey").select(
        F.col("_c4").alias("c_mktsegment"), F.expr("try_cast(_c3 AS DOUBLE)").alias("c_acctbal"))

    def agg(df, name):
        return df.groupBy(F.col("c_mktsegment").alias("segment")).agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("bal")
        ).select(F.lit(name).alias("reader"), "segment", "n", "bal")

    return agg(a, "explicit").unionByName(agg(b, "inferred")).unionByName(agg(c, "no_header"))


@query("s_json_optional_fields", "S1 S16 C1 F19", sql="""
SELECT o_orderstatus, count(*) AS n, count(CASE WHEN o_orderkey % 9 <> 0 THEN 1 END) AS n_with_priority
FROM orders GROUP BY 1""")
def s_json_optional_fields(spark, sf):
    """Documents where some records omit a field, plus malformed lines:
    the schema'd reader yields NULL for the missing field and DROPMALFORMED
    removes the broken lines."""
    base = _dir(spark, "json")
    o = Tables(spark, sf).orders
    docs = o.select("o_orderkey", "o_orderstatus",
                    F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    docs.write.json(f"{base}/docs")                                  # NULL fields are omitted
    spark.range(3).select(F.lit("{broken json").alias("value")).write.text(f"{base}/docs_bad")
    r = IO.read_json(spark, [f"{base}/docs", f"{base}/docs_bad"],
                     schema="o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING",
                     mode="DROPMALFORMED")
    return r.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"),
                                          F.count("o_orderpriority").alias("n_with_priority"))


@query("s_json_props", "F19", sql="""
SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k,
       count(*) AS n FROM events GROUP BY 1""")
def s_json_props(spark, sf):
    e = Tables(spark, sf).events
    k = F.from_json("props", "k INT")["k"]
    return e.groupBy("event_type").agg(F.sum(k).alias("sum_k"), F.count(F.lit(1)).alias("n"))


@query("s_external_header", "S5 S6 S7 S14", sql="""
SELECT r_name, count(*) AS n_nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def s_external_header(spark, sf):
    base = _dir(spark, "hdr")
    t = Tables(spark, sf)
    t.nation.write.option("header", False).csv(f"{base}/data")
    IO.from_rows(spark, [("n_nationkey,n_name,n_regionkey",)], "value STRING") \
        .coalesce(1).write.text(f"{base}/header")
    n = IO.with_external_header(spark, f"{base}/data", f"{base}/header")
    n.createOrReplaceTempView("lodestar_nation_txt")
    t.region.createOrReplaceTempView("lodestar_region")
    return spark.sql("""SELECT r_name, count(*) AS n_nations FROM lodestar_nation_txt n
                        JOIN lodestar_region r ON CAST(n.n_regionkey AS INT) = r.r_regionkey
                        GROUP BY r_name""")


@query("s_parquet_partition_append", "S13 S20 S22 S23", sql="""
SELECT 'appended' AS source, l_returnflag, count(*) * (CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END) AS n
FROM lineitem GROUP BY 2
UNION ALL SELECT 'orc', l_returnflag, count(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'pruned', l_returnflag, count(*) FROM lineitem WHERE l_returnflag = 'R' GROUP BY 2""")
def s_parquet_partition_append(spark, sf):
    base = _dir(spark, "pq")
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_returnflag")
    IO.write_parquet(li, f"{base}/li", partition_by=["l_returnflag"])       # S13/S20
    IO.replace(li, f"{base}/li2")                                            # S23
    IO.append(li.where(F.col("l_returnflag") == "R"), f"{base}/li2")        # S22
    IO.write_orc(li, f"{base}/li_orc")

    def counts(df, source):
        return df.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(source).alias("source"), "l_returnflag", "n")

    pruned = spark.read.parquet(f"{base}/li").where(F.col("l_returnflag") == "R")  # partition pruning
    return (counts(spark.read.parquet(f"{base}/li2"), "appended")
            .unionByName(counts(spark.read.orc(f"{base}/li_orc"), "orc"))
            .unionByName(counts(pruned, "pruned")))


def _buckets(spark) -> int:
    """Buckets follow the session's parallelism, like any other exchange."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("s_bucketed_orders", "S15 W2", sql="""
SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders GROUP BY 1""")
def s_bucketed_orders(spark, sf):
    """Orders bucketed by the partition key: the aggregate on the bucket key
    needs no shuffle."""
    base = _dir(spark, "bucket")
    name = f"lodestar_orders_{uuid.uuid4().hex[:8]}"
    o = IO.clustered_log(Tables(spark, sf).orders, "o_custkey", "o_orderdate")
    IO.save_bucketed(o, name, "o_custkey", _buckets(spark), ["o_custkey", "o_orderdate"], path=f"{base}/t")
    t = spark.table(name)
    return t.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                      F.max("o_orderdate").alias("last_order"))


@query("s_log_newest_first", "S17 W1 W2", sql="""
SELECT user_id, ts, event_id, event_type, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rank FROM events)
WHERE rank <= 5""")
def s_log_newest_first(spark, sf):
    """The log table in its clustering order, newest first per user, and the
    five newest entries of every user read from it without shuffle or sort."""
    base = _dir(spark, "newest")
    name = f"lodestar_log_{uuid.uuid4().hex[:8]}"
    e = Tables(spark, sf).events.select("user_id", "ts", "event_id", "event_type")
    IO.save_newest_first(e, name, "user_id", "ts", _buckets(spark), ["event_id"], path=f"{base}/t")
    return IO.newest_n(spark, name, "user_id", 5, ["event_id"])


@query("s_tuned_warehouse", "S15 J1 A5", sql="""
SELECT c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM orders JOIN customer ON o_custkey = c_custkey WHERE month(o_orderdate) = 12 GROUP BY 1""")
def s_tuned_warehouse(spark, sf):
    """A tuned warehouse: the fact table partitioned by month, statistics of
    tables and columns, cost-based join order. The calendar is filtered by
    month of the year, and dynamic partition pruning carries that to the fact
    scan: partitions of other months are not read."""
    base, tag = _dir(spark, "tuned"), uuid.uuid4().hex[:8]
    t = Tables(spark, sf)
    fact, dim, cal = (f"lodestar_{n}_{tag}" for n in ("fact", "cust", "cal"))
    month = F.date_format("o_orderdate", "yyyy-MM")
    (IO.by_partition(t.orders.select("o_custkey", "o_totalprice", month.alias("month")), ["month"])
     .write.partitionBy("month").option("path", f"{base}/fact").saveAsTable(fact))
    t.customer.select("c_custkey", "c_mktsegment").write.option("path", f"{base}/cust").saveAsTable(dim)
    (t.orders.select(month.alias("month"), F.month("o_orderdate").alias("m")).distinct()
     .write.option("path", f"{base}/cal").saveAsTable(cal))
    IO.analyze(spark, fact, ["o_custkey", "month"])
    IO.analyze(spark, dim, ["c_custkey", "c_mktsegment"])
    IO.analyze(spark, cal, ["month", "m"])
    spark.conf.set("spark.sql.cbo.enabled", "true")
    spark.conf.set("spark.sql.cbo.joinReorder.enabled", "true")
    return spark.sql(f"""
        SELECT c_mktsegment, count(*) AS n_orders,
               round(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100, 2) AS total
        FROM {fact} f JOIN {dim} c ON f.o_custkey = c.c_custkey JOIN {cal} k ON f.month = k.month
        WHERE k.m = 12 GROUP BY c_mktsegment""")


@query("s_upsert_partitions", "S24 S22 S13", sql="""
WITH cur AS (SELECT o_orderkey, o_orderstatus, o_orderdate, strftime(o_orderdate, '%Y-%m') AS month,
                    CASE WHEN o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1998 THEN 'X'
                         ELSE o_orderstatus END AS status FROM orders),
     cut AS (SELECT max(o_orderdate) - INTERVAL 1000 DAY AS t FROM orders)
SELECT month, status AS o_orderstatus, count(*) AS n FROM cur, cut WHERE o_orderdate > t GROUP BY 1, 2""")
def s_upsert_partitions(spark, sf):
    """A table partitioned by month takes an upsert of some orders of 1998
    (only these partitions are written) and then expires by age (old
    partitions are deleted, one is rewritten)."""
    base = _dir(spark, "upsert")
    o = Tables(spark, sf).orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    cols = ["o_orderkey", "o_orderstatus", "version", "o_orderdate", "month"]
    cur = o.withColumn("version", F.lit(1)).select(*cols)
    IO.by_partition(cur, ["month"]).write.partitionBy("month").parquet(f"{base}/t")
    chg = (o.where((F.col("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") == 1998))
           .withColumn("version", F.lit(2)).withColumn("o_orderstatus", F.lit("X")).select(*cols))
    IO.upsert_partitions(f"{base}/t", chg, ["o_orderkey"], "version", ["month"])
    cut = o.agg((F.max("o_orderdate") - F.expr("INTERVAL 1000 DAYS")).alias("t")).select(
        F.date_format("t", "yyyy-MM").alias("month"), "t").first()
    IO.expire_partitions(spark, f"{base}/t", cur.schema, "month", "o_orderdate", tuple(cut))
    out = spark.read.schema(cur.schema).parquet(f"{base}/t")
    return out.groupBy("month", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("s_upsert_ttl", "S24 S22", sql="""
WITH cur AS (SELECT o_orderkey, o_orderstatus, 1 AS version, o_orderdate FROM orders),
     chg AS (SELECT o_orderkey, 'X' AS o_orderstatus, 2 AS version, o_orderdate FROM orders
             WHERE o_orderpriority = '1-URGENT'),
     u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) AS rn
                          FROM (SELECT * FROM cur UNION ALL SELECT * FROM chg)) WHERE rn = 1)
SELECT o_orderstatus, count(*) AS n FROM u
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 1000 DAY GROUP BY 1""")
def s_upsert_ttl(spark, sf):
    o = Tables(spark, sf).orders
    cur = o.select("o_orderkey", "o_orderstatus", F.lit(1).alias("version"), "o_orderdate")
    chg = o.where(F.col("o_orderpriority") == "1-URGENT").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), F.lit(2).alias("version"), "o_orderdate")
    u = IO.upsert(cur, chg, ["o_orderkey"], "version")
    now = o.agg(F.max("o_orderdate")).scalar()
    live = IO.expire(u, "o_orderdate", now, 1000 * 86400)
    return live.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("s_churn_records", "S19 F16 F18", sql=f"""
WITH {churn_sql("customer", "c_custkey")}
SELECT ContractType, count(*) AS n,
       avg(CASE WHEN Churn = 'Yes' THEN 1.0 ELSE 0.0 END) AS churn_rate,
       avg(TechSupportCalls) AS avg_calls, avg(TenureMonths) AS avg_tenure
FROM churn GROUP BY 1""")
def s_churn_records(spark, sf):
    """Rule-based churn record per customer (hash-seeded, reproducible):
    summary per contract type."""
    ch = churn_records(Tables(spark, sf).customer, "c_custkey", seed=42)
    return ch.groupBy("ContractType").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.when(F.col("Churn") == "Yes", 1.0).otherwise(0.0)).alias("churn_rate"),
        F.avg("TechSupportCalls").alias("avg_calls"), F.avg("TenureMonths").alias("avg_tenure"))


@query("s_bucketed_join", "S15 J1 A5", sql="""
SELECT o_orderpriority, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS gross
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def s_bucketed_join(spark, sf):
    """Co-located join: orders and lineitem written as tables bucketed (and
    sorted) on the order key with the same bucket count; the sort-merge join
    then reads matching buckets with no exchange on either side."""
    base = _dir(spark, "bjoin")
    t = Tables(spark, sf)
    tag = uuid.uuid4().hex[:8]
    IO.save_bucketed(t.orders.select("o_orderkey", "o_orderpriority"), f"lodestar_bo_{tag}",
                     "o_orderkey", _buckets(spark), ["o_orderkey"], path=f"{base}/o")
    IO.save_bucketed(t.lineitem.select("l_orderkey", "l_extendedprice"), f"lodestar_bl_{tag}",
                     "l_orderkey", _buckets(spark), ["l_orderkey"], path=f"{base}/l")
    o, li = spark.table(f"lodestar_bo_{tag}"), spark.table(f"lodestar_bl_{tag}")
    j = o.hint("merge").join(li, o.o_orderkey == li.l_orderkey)
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_lines"),
                                            F.round(F.sum("l_extendedprice"), 2).alias("gross"))
