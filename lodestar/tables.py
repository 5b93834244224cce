"""Named input tables: explicit schemas and loaders.

Every table is read with a declared schema (no inference pass, stable types
for the oracle comparison). Scans are lazy; Catalyst prunes columns and
pushes filters into the Parquet reader.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

SCHEMAS: dict[str, str] = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": ("c_custkey BIGINT, c_name STRING, c_nationkey INT, "
                 "c_acctbal DOUBLE, c_mktsegment STRING"),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, "
             "p_size INT, p_retailprice DOUBLE"),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
               "o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, "
                 "l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
                 "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                 "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
               "value DOUBLE, props STRING"),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

TABLES = tuple(SCHEMAS)

# Dimension tables whose cardinality is fixed by the data model, not by the
# scale factor (5 regions, 25 nations at every size). Only these are ever
# broadcast by hint; every other join side is left to AQE, which broadcasts
# only after measuring the shuffle output against the threshold.
BOUNDED_DIMENSIONS = {"region": 5, "nation": 25}


def path_of(sf_dir: str, name: str) -> str:
    p = os.path.join(sf_dir, f"{name}.parquet")
    return p


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(path_of(sf_dir, name))


class Tables:
    """Lazy accessor: ``t = Tables(spark, sf_dir); t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in SCHEMAS:
            return load(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register_views(self) -> None:
        for name in SCHEMAS:
            load(self.spark, self.sf_dir, name).createOrReplaceTempView(name)
