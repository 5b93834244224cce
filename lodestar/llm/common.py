"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lodestar.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by a path that only Spark needs to understand."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` (shared by the driver
    and all executors); tests without that setting get a scratch folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"lodestar-{name}-{uuid.uuid4().hex}")


#: Folders written by ``materialise`` within ``written_tables``.
_WRITTEN: ContextVar[list | None] = ContextVar("written", default=None)
#: The folder of each table that ``materialise`` returned.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
#: Makes Spark delete the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage,
    survives lost executors, and later reads prune columns. What was shuffled
    for it is deleted once it is written."""
    spark = df.sparkSession
    path, before = shared_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    if _WRITTEN.get() is not None:
        _WRITTEN.get().append(path)
    table = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


@contextmanager
def written_tables() -> Iterator[list[str]]:
    """The folders that ``materialise`` writes inside, in order; those around
    it list them too."""
    token = _WRITTEN.set(inner := [])
    try:
        yield inner
    finally:
        _WRITTEN.reset(token)
        if _WRITTEN.get() is not None:
            _WRITTEN.get().extend(inner)


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that ``materialise`` wrote and nothing reads any more."""
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` returned and no later step reads;
    other tables are left alone."""
    for table in tables:
        if table in _FOLDERS:
            delete_tables(table.sparkSession, [_FOLDERS.pop(table)])


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of a text column plus one per row: one pass, one number."""
    row = df.agg(F.sum(F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + F.lit(1))
                 .cast("long")).first()
    return int(row[0] or 0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns whose names (in any case) an operator's outputs take."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


#: Rows, and items of array columns, of a broadcast table at most; larger
#: tables are shuffled.
BROADCAST_ROWS = 2_000_000
BROADCAST_ITEMS = 4_000_000


def join_by_id(big: DataFrame, ids: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join a table with texts to a written table of a few numbers a row: the
    small one is counted, with the items of its arrays, and broadcast up to
    ``BROADCAST_ROWS`` and ``BROADCAST_ITEMS``, so the texts stay where they
    are; beyond that both are shuffled."""
    return big.join(maybe_broadcast(ids), on, how)


def maybe_broadcast(ids: DataFrame) -> DataFrame:
    """A written table of numbers, marked for broadcast if it is small."""
    return F.broadcast(ids) if is_small(ids) else ids


def is_small(ids: DataFrame) -> bool:
    """Whether a written table of numbers and arrays of numbers may be broadcast."""
    lists = [f"`{f.name}`" for f in ids.schema.fields if isinstance(f.dataType, ArrayType)]
    items = [F.sum(F.greatest(F.size(c), F.lit(0)).cast("long")) for c in lists]
    row = ids.agg(F.count(F.lit(1)), *items).first()
    return row[0] <= BROADCAST_ROWS and sum(n or 0 for n in row[1:]) <= BROADCAST_ITEMS
