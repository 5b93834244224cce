"""Joins (survey §2.4, J1-J9).

Broadcast policy: a side is hinted for broadcast only when its size is
bounded by construction (``tables.BOUNDED_DIMENSIONS``) or it is the
output of an aggregate over such a bounded key. Everything else is left to
Catalyst + AQE, which switches a sort-merge join to a broadcast join at run
time only after measuring the shuffled side against
``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.session import cut_lineage


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` — callers pass only frames whose row count is
    bounded by the data model (``max_rows`` documents that bound)."""
    assert max_rows <= 1_000_000, "not a bounded dimension"
    return F.broadcast(df)


def small_side(stats: DataFrame, most: int = 100_000, fixed: bool = False) -> DataFrame:
    """Statistics per group, to be joined back to the rows: they are written
    once (unless ``fixed``: local or written rows already), counted, and
    broadcast up to ``most`` rows, so the rows they describe stay where they
    are; beyond, groups are many and an ordinary join spreads them."""
    stats = stats if fixed else cut_lineage(stats)
    return F.broadcast(stats) if stats.limit(most + 1).count() <= most else stats


def inner(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """J1."""
    return left.join(right, on, "inner")


def left_outer(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """J3."""
    return left.join(right, on, "left")


def _keys_only(right: DataFrame, on) -> DataFrame:
    """The probe side of a semi/anti join only needs its distinct keys:
    deduplicating them (map-side partial aggregate) turns a key repeated a
    billion times into one row per task before the shuffle."""
    if isinstance(on, str):
        on = [on]
    if isinstance(on, (list, tuple)) and all(isinstance(c, str) for c in on):
        return right.select(*on).distinct()
    return right


def anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with no match (NOT EXISTS), planned as a
    left-anti join rather than left join + IS NULL."""
    return left.join(_keys_only(right, on), on, "left_anti")


def semi(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows of ``left`` with a match (EXISTS); no id list through the
    driver."""
    return left.join(_keys_only(right, on), on, "left_semi")


def attach_by_key(base: DataFrame, extra: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Column-bind. Rows carry their key through every transform, so the
    bind is a key join instead of a positional zip."""
    return base.join(extra, key, "left")


def implicit_join(spark, left_view: str, right_view: str, cond: str, cols: str) -> DataFrame:
    """``FROM a, b WHERE cond`` — parsed by Spark SQL into the same
    inner join as the explicit form."""
    return spark.sql(f"SELECT {cols} FROM {left_view}, {right_view} WHERE {cond}")
