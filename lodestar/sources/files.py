"""File sources and sinks (survey §2.1 S1-S24).

Readers take explicit schemas wherever the caller has one (inference is an
extra pass over the data); sinks write from the executors — nothing passes
through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestar.session import cut_lineage


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              mode: str = "PERMISSIVE") -> DataFrame:
    """JSON lines; missing fields come back NULL. Malformed lines keep
    their row (add a ``_corrupt_record`` column to a schema to count them);
    ``mode="DROPMALFORMED"`` drops them, which callers must ask for."""
    r = spark.read.option("mode", mode)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_csv(spark: SparkSession, path: str, header: bool = True,
             schema: StructType | str | None = None, infer: bool = False,
             sep: str = ",") -> DataFrame:
    """CSV with header and/or explicit schema. Without header and
    schema every column is a string named ``_c0..``."""
    r = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def with_external_header(spark: SparkSession, data_path: str, header_path: str,
                         sep: str = ",") -> DataFrame:
    """Headerless delimited data + a separate one-line header file. Only
    the header line (bounded) is read on the driver; the data is parsed by
    the CSV reader on the executors, all columns as strings."""
    head = spark.read.text(header_path).first()
    names = [n.strip() for n in head["value"].split(sep)] if head else []
    df = spark.read.option("header", False).option("sep", sep).csv(data_path)
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} header names for {len(df.columns)} columns")
    return df.toDF(*names)


def from_rows(spark: SparkSession, rows: Sequence, schema: StructType | str) -> DataFrame:
    """A small local collection (parameters, lookup rows) -> DataFrame."""
    return spark.createDataFrame(list(rows), schema)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV written by the executors (no ``toPandas``)."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  mode: str = "overwrite") -> None:
    """Columnar sink, optionally Hive-partitioned (enables
    partition pruning on the partition columns)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_orc(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """ORC sink."""
    df.write.mode(mode).orc(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append records to an existing dataset."""
    df.write.mode("append").format(fmt).save(path)


def replace(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Drop + create as one overwrite."""
    df.write.mode("overwrite").format(fmt).save(path)


def clustered_log(df: DataFrame, key: str, ts: str, partitions: int | None = None,
                  time_bucket: str = "day") -> DataFrame:
    """Wide-column log layout — hash-partitioned by (partition key, time
    bucket), the usual bound on wide partitions (a hot key is spread over
    its days instead of one task), and sorted by key then clustering time
    descending inside each partition."""
    b = F.date_trunc(time_bucket, F.col(ts))
    x = df.repartition(partitions, key, b) if partitions else df.repartition(key, b)
    return x.sortWithinPartitions(F.col(key), F.col(ts).desc())


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, sort_by: Sequence[str] = (),
                  path: str | None = None) -> None:
    """Managed table bucketed (and sorted) on ``key``: later joins
    and aggregations on ``key`` read co-partitioned data without a shuffle."""
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    if sort_by:
        w = w.sortBy(*sort_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def upsert(current: DataFrame, changes: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Merge without in-place update — union old and new rows and keep
    the latest version per key (map-side combined ``max(struct)``)."""
    from lodestar.operators.windows import latest_per_key
    return latest_per_key(current.unionByName(changes), list(key), [version])


def partitions_of(df: DataFrame, by: Sequence[str], most: int = 100_000) -> list[tuple]:
    """Values of the partition columns that occur in ``df``: distinct
    combinations, counted before they come to the driver."""
    found = df.select(*by).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} partitions are touched; replace the table instead")
    return [tuple(r) for r in found]


def in_partitions(by: Sequence[str], values: Sequence[tuple]) -> Column:
    """Static filter on partition columns: the reader lists no other folder."""
    if len(by) == 1:
        known = [v[0] for v in values if v[0] is not None]
        hit = F.col(by[0]).isin(known)
        return hit | F.col(by[0]).isNull() if len(known) < len(values) else hit
    out = F.lit(False)
    for v in values:
        same = F.lit(True)
        for c, x in zip(by, v, strict=True):
            same &= F.col(c).eqNullSafe(F.lit(x))
        out |= same
    return out


def upsert_partitions(table: str, changes: DataFrame, key: Sequence[str], version: str,
                      by: Sequence[str]) -> list[tuple]:
    """Merges ``changes`` into the Parquet folder ``table``, partitioned
    by ``by``, by dynamic partition overwrite: only partitions that hold a
    changed key are read, merged and written; files of all others stay as they
    are. A key's partition values must not change (they are part of it). The
    merged rows are written to the shared checkpoint folder first, because the
    partitions they come from are replaced; partitions are replaced one by one,
    so a run that was lost is repeated as it is. Returns the partitions written."""
    spark = changes.sparkSession
    changes = cut_lineage(changes)
    touched = partitions_of(changes, by)
    if not touched:
        return []
    current = spark.read.schema(changes.schema).parquet(table).where(in_partitions(by, touched))
    merged = cut_lineage(upsert(current.select(*changes.columns), changes, [*by, *key], version))
    (by_partition(merged, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(table))
    return touched


def by_partition(df: DataFrame, by: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows dealt for a partitioned write: a partition becomes at most ``files``
    files (an eighth of the session's shuffle partitions), so there are few
    small ones, and one with a third of the rows is written by as many tasks."""
    files = files or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files))
    return df.repartition(*by, deal)


def expire(df: DataFrame, ts: str, now, ttl_seconds: int) -> DataFrame:
    """TTL — keep rows younger than ``ttl_seconds`` at ``now``."""
    return df.where(F.col(ts) > now - F.make_interval(secs=F.lit(ttl_seconds)))


def expire_partitions(spark: SparkSession, table: str, schema, by: str, ts: str, cut) -> tuple[int, int]:
    """TTL of a folder partitioned by a period of ``ts`` (a column of
    sortable text, such as yyyy-MM): partitions that lie before that of ``cut``
    are deleted whole, the one ``cut`` falls into is rewritten without its
    expired rows (ts <= cut), later ones are not touched. ``cut`` is (period,
    time). Returns (partitions deleted, partitions rewritten)."""
    period, time = cut
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(table)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in fs.listStatus(root)
            if s.getPath().getName().startswith(f"{by}=")
            and s.getPath().getName().split("=", 1)[1] < period]
    for path in gone:
        fs.delete(path, True)
    edge = jvm.org.apache.hadoop.fs.Path(f"{table}/{by}={period}")
    if not fs.exists(edge):
        return len(gone), 0
    kept = cut_lineage(spark.read.schema(schema).parquet(table).where(
        (F.col(by) == period) & (F.col(ts) > F.lit(time))))
    if kept.isEmpty():
        fs.delete(edge, True)
        return len(gone) + 1, 0
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(table)
    return len(gone), 1


def save_newest_first(df: DataFrame, table: str, key: str, ts: str, buckets: int,
                      then: Sequence[str] = (), path: str | None = None, slices: int = 1) -> None:
    """Log table in clustering order: bucketed by ``key`` and sorted by
    (key, ``ts`` descending, ``then``). Bucket files can only be sorted
    ascending, so the order is that of ``newest``, the negated time in
    microseconds. One task writes one bucket as one file, which is what lets
    readers rely on the order. ``slices`` > 1 cuts every key into as many
    pieces by row hash, each a bucket key of its own: a key with a third of
    the rows is then spread."""
    x = df.withColumn("newest", -F.unix_micros(F.col(ts).cast("timestamp")))
    x = x.withColumn("slice", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]),
                                     F.lit(slices)).cast("int"))
    w = (x.repartition(buckets, key, "slice").write.mode("overwrite").format("parquet")
         .bucketBy(buckets, key, "slice").sortBy(key, "slice", "newest", *then))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def newest_n(spark: SparkSession, table: str, key: str, n: int, then: Sequence[str] = (),
             sliced: bool = False) -> DataFrame:
    """The ``n`` newest rows per key of a ``save_newest_first`` table
    (``then`` as it was saved), with their ``rank``. Rows stream out of the
    bucket files in order, so the plan has no exchange and no sort. Of a
    ``sliced`` table the n newest of each slice are found in this way; only
    these are shuffled for the n newest of the key.

    Sets ``spark.sql.legacy.bucketedTableScan.outputOrdering`` for the session:
    Spark then uses the order of bucketed tables whose buckets are one file
    each (it checks that itself)."""
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    order = ["newest", *then]
    w = Window.partitionBy(key, "slice").orderBy(*order)
    out = spark.table(table).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    if sliced:
        w = Window.partitionBy(key).orderBy(*order)
        out = out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return out.drop("newest", "slice")


def analyze(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> None:
    """S15 tuning: table and column statistics, which the cost-based optimizer
    (``spark.sql.cbo.enabled``, ``spark.sql.cbo.joinReorder.enabled``) uses to
    order joins and to choose build sides."""
    what = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS{what}")


def fetch(df: DataFrame, n: int = 20):
    """Bring at most ``n`` rows to the driver as pandas (the only
    driver fetch the library offers is a bounded one; ``limit`` is pushed
    into the plan, so executors stop early)."""
    return df.limit(n).toPandas()
