"""Triple-pattern queries (G-series) on the part graph."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.operators import triples as G
from lodestar.operators.joins import anti
from lodestar.plans.registry import query
from lodestar.session import scratch_dir
from lodestar.sources import files as IO
from lodestar.tables import Tables

_GRAPH_SQL = """g AS (
  SELECT 'ex:Part_' || p_partkey AS s, 'ex:name' AS p, p_name AS o, CAST(NULL AS VARCHAR) AS datatype FROM part
  UNION ALL SELECT 'ex:Part_' || p_partkey, 'ex:type', p_type, NULL FROM part
  UNION ALL SELECT 'ex:Part_' || p_partkey, 'ex:size', CAST(p_size AS VARCHAR), 'xsd:integer' FROM part
  UNION ALL SELECT 'ex:Part_' || p_partkey, 'ex:brand',
                   CASE WHEN p_partkey % 11 = 0 THEN 'Unknown' ELSE p_brand END, NULL
            FROM part WHERE p_partkey % 7 <> 0)"""


@query("g_star_pattern", "G1 G3 F5", sql=f"""
WITH {_GRAPH_SQL}
SELECT split_part(t.s, '_', 2) AS local_id, n.o AS name, TRY_CAST(z.o AS INTEGER) AS size
FROM g t JOIN g n ON n.s = t.s AND n.p = 'ex:name'
         JOIN g z ON z.s = t.s AND z.p = 'ex:size'
WHERE t.p = 'ex:type' AND t.o = 'STANDARD' AND TRY_CAST(z.o AS INTEGER) > 45""")
def g_star_pattern(spark, sf):
    g = G.part_graph(Tables(spark, sf).part)
    m = G.star(g, [("ex:type", "type"), ("ex:name", "name"), ("ex:size", "size")])
    m = m.withColumn("size", G.typed_value("size", "size__dt"))
    m = m.where((F.col("type") == "STANDARD") & (F.col("size") > 45))
    return m.select(F.substring_index(G.local("s"), "_", -1).alias("local_id"), "name", "size") \
            .orderBy(F.col("size").desc(), "local_id")


@query("g_optional_unbound", "G2 P16", sql=f"""
WITH {_GRAPH_SQL}
SELECT t.o AS type, count(*) AS n_missing_brand
FROM g t LEFT JOIN g b ON b.s = t.s AND b.p = 'ex:brand'
WHERE t.p = 'ex:type' AND (b.o IS NULL OR b.o = 'Unknown') GROUP BY 1""")
def g_optional_unbound(spark, sf):
    from lodestar.operators.relational import missing_or_placeholder
    g = G.part_graph(Tables(spark, sf).part)
    m = G.star(g, [("ex:type", "type")], optional=[("ex:brand", "brand")])
    return m.where(missing_or_placeholder(F.col("brand"))).groupBy("type").agg(
        F.count(F.lit(1)).alias("n_missing_brand"))


@query("g_typed_literal_stats", "G3", sql=f"""
WITH {_GRAPH_SQL}
SELECT t.o AS type, CAST(sum(CAST(z.o AS INTEGER)) AS BIGINT) AS total_size, count(*) AS n
FROM g t JOIN g z ON z.s = t.s AND z.p = 'ex:size' AND z.datatype = 'xsd:integer'
WHERE t.p = 'ex:type' GROUP BY 1""")
def g_typed_literal_stats(spark, sf):
    g = G.part_graph(Tables(spark, sf).part)
    m = G.star(g, [("ex:type", "type"), ("ex:size", "size")])
    return m.groupBy("type").agg(F.sum(G.typed_value("size", "size__dt")).alias("total_size"),
                                 F.count(F.lit(1)).alias("n"))


@query("g_turtle_roundtrip", "S18 S5 G3", sql=f"""
WITH {_GRAPH_SQL}
SELECT p, count(*) AS n, count(datatype) AS n_typed FROM g GROUP BY p""")
def g_turtle_roundtrip(spark, sf):
    """Write the graph as Turtle-subset text to the shared scratch folder,
    read it back with the text source and parse it as a Spark job."""
    g = G.part_graph(Tables(spark, sf).part)
    path = scratch_dir(spark, f"turtle-{uuid.uuid4().hex}")
    G.to_turtle_lines(g).write.mode("overwrite").text(path)
    back = G.parse_turtle_lines(IO.read_text(spark, path))
    return back.groupBy("p").agg(F.count(F.lit(1)).alias("n"), F.count("datatype").alias("n_typed"))


# fixed value: lines whose (customer, part) pairs one task compares
LINES_PER_TASK = 250_000


@query("g_multi_hop_recommend", "G4 J4 W1 M7", sql="""
WITH cb AS (SELECT o_custkey, p_brand, count(*) AS n FROM orders
            JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
     topb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, p_brand) AS r
                             FROM cb) WHERE r <= 2),
     pop AS (SELECT p_brand, l_partkey, count(*) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),
     seen AS (SELECT DISTINCT o_custkey, l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
     open AS (SELECT b.o_custkey, p.l_partkey, b.p_brand, p.n FROM topb b JOIN pop p ON p.p_brand = b.p_brand
              WHERE NOT EXISTS (SELECT 1 FROM seen s
                                WHERE s.o_custkey = b.o_custkey AND s.l_partkey = p.l_partkey))
SELECT o_custkey, l_partkey AS rec_partkey, p_brand
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, p_brand ORDER BY n DESC, l_partkey) AS r FROM open)
WHERE r <= 3""")
def g_multi_hop_recommend(spark, sf):
    """customer -> bought part -> brand -> the three most popular parts of
    that brand that the customer has not bought, for the customer's two top
    brands. Of m bought parts of a brand, the answer lies among its m + 3 most
    popular ones, so each customer meets only that many: the brand's ranking
    is cut at the customer's own count before the bought parts are removed."""
    t = Tables(spark, sf)
    sold = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    ranked = sold.join(part, "l_partkey").withColumn("at", F.row_number().over(
        Window.partitionBy("p_brand").orderBy(F.col("n").desc(), "l_partkey")))
    bought = (t.lineitem.select("l_orderkey", "l_partkey")
              .join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
              .groupBy("o_custkey", "l_partkey").agg(F.count(F.lit(1)).alias("lines"))
              .join(part, "l_partkey"))
    brands = bought.groupBy("o_custkey", "p_brand").agg(
        F.sum("lines").alias("n"), F.count(F.lit(1)).alias("m"))
    top = brands.withColumn("r", F.row_number().over(
        Window.partitionBy("o_custkey").orderBy(F.col("n").desc(), "p_brand"))).where("r <= 2")
    # one row per (customer, brand, rank to look at), joined on (brand, rank)
    wanted = top.select("o_custkey", "p_brand", F.explode(F.sequence(
        F.lit(1), (F.col("m") + 3).cast("int"))).alias("at"))
    near = wanted.join(ranked.select("p_brand", "at", "l_partkey", "n"), ["p_brand", "at"])
    # both sides are sorted in memory: as many tasks as the lines call for, however well they compress
    n = max(1, math.ceil(t.lineitem.count() / LINES_PER_TASK))
    pair = ["o_custkey", "l_partkey"]
    fresh = anti(near.repartition(n, *pair), bought.select(*pair).repartition(n, *pair), pair)
    best = fresh.withColumn("r", F.row_number().over(
        Window.partitionBy("o_custkey", "p_brand").orderBy("at"))).where("r <= 3")
    return best.select("o_custkey", F.col("l_partkey").alias("rec_partkey"), "p_brand")
