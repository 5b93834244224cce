"""Sharding: two-pass external shuffle of records into training shards.

Pass 1 scatters every record into a shard and, within it, a memory-sized
bucket, both by seeded hashes. Pass 2 shuffles each bucket (Spark's array
``shuffle`` is a Fisher-Yates shuffle) and lays the buckets of a shard one
after the other. DataFrame functions only: no Python runs on the executors.

The shard of a record is the one of the highest of ``shards`` seeded hashes
of its id (rendezvous hashing): id and shard count decide, and one more
shard takes records only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import shuffle_partitions, text_bytes, without

OUTPUTS = ("shard", "slot", "grown_shard")


def rendezvous(key: Column, shards: int, seed: int) -> Column:
    """Index of the shard whose seeded hash of ``key`` is highest (of equal
    hashes: the highest index)."""
    scored = [F.struct(F.xxhash64(F.lit(seed + i), key).alias("h"), F.lit(i).alias("i"))
              for i in range(shards)]
    return (F.greatest(*scored) if shards > 1 else scored[0])["i"]


def shard_records(docs: DataFrame, shards: int = 16, seed: int = 42,
                  bucket_bytes: int = 2 << 20, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``shard`` (0..shards-1), ``slot`` (gapless
    from 0 in each shard, in shuffled order) and ``grown_shard`` (the shard
    with one more shard). Input columns of these names are replaced.

    ``bucket_bytes`` is what a bucket holds of texts on average. The shard of
    a row follows its id alone, its bucket id and text, so the rows of an id
    that repeats often spread over the buckets of their shard. A bucket that
    equal rows overfill is shuffled in pieces of that size, so memory stays
    bounded whatever the ids.

    Null ids count as one more id value; a null text has no bytes; repeated
    rows are all kept, in the same shard; an empty table gives no rows.
    """
    df = without(docs, *OUTPUTS)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    spread = max(1, -(-text_bytes(df, text_col) // (bucket_bytes * shards)))
    size = F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + F.lit(1)

    def place(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("_shard", rendezvous(key, shards, seed))
                    .withColumn("_bucket", F.pmod("_deal", F.lit(spread))))

    # where each bucket starts in its shard: from the hashes alone
    by_shard = Window.partitionBy("_shard").orderBy("_bucket")
    deal = F.xxhash64(F.lit(~seed), key, F.col(text_col)).alias("_deal")
    starts = (place(df.select(id_col, deal)).groupBy("_shard", "_bucket")
              .agg(F.count(F.lit(1)).alias("_n"))
              .select("_shard", "_bucket",
                      (F.sum("_n").over(by_shard) - F.col("_n")).alias("_start")))

    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    in_bucket = Window.partitionBy("_shard", "_bucket").orderBy("_mix", "_key")
    scattered = (
        place(df.select(id_col, record.alias("_record"), size.cast("long").alias("_size"),
                        F.xxhash64(F.lit(seed), key, F.col(text_col)).alias("_mix"),
                        key.alias("_key"), deal))
        .drop(id_col, "_deal")              # texts travel once, inside the record
        .select("*", F.row_number().over(in_bucket).cast("long").alias("_rank"),
                F.sum("_size").over(in_bucket.rowsBetween(
                    Window.unboundedPreceding, 0)).alias("_upto"))
        .withColumn("_piece", F.floor(F.col("_upto") / bucket_bytes)))
    mixed = (scattered.groupBy("_shard", "_bucket", "_piece")
             .agg(F.min("_rank").alias("_first"),
                  F.shuffle(F.collect_list("_record"), seed).alias("_records"))
             .join(starts, ["_shard", "_bucket"])
             .select("_shard", (F.col("_start") + F.col("_first") - 1).alias("_at"),
                     F.posexplode("_records").alias("_pos", "_record")))
    out = mixed.select("_record.*", F.col("_shard").cast("int").alias("shard"),
                       (F.col("_at") + F.col("_pos")).cast("long").alias("slot"))
    newest = F.xxhash64(F.lit(seed + shards), key)
    best = F.greatest(*[F.xxhash64(F.lit(seed + i), key) for i in range(shards)]) \
        if shards > 1 else F.xxhash64(F.lit(seed), key)
    return out.withColumn("grown_shard", F.when(newest >= best, F.lit(shards))
                          .otherwise(F.col("shard")).cast("int"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file. Range
    partitioning by (shard, slot) keeps files even and never puts a whole
    shard into one task."""
    n = shuffle_partitions(sharded.sparkSession)
    (sharded.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
