"""Mergeable sketches kept per day (survey A7, I5).

Distinct counts and quantiles do not add up over days, but their sketches
merge: one small binary column per (key, day) answers any range of days
without reading the rows again, and a late day is one row rewritten. Sketches
are aggregates with partial results, so a day or a key with a third of the rows
costs each task one sketch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_error(lg_k: int) -> float:
    """Relative standard error of a distinct count with 2 ** lg_k registers."""
    return 1.04 / math.sqrt(1 << lg_k)


def daily_sketches(df: DataFrame, keys: Sequence[str], day: Column, distinct: str, value: str,
                   lg_k: int = 12, k: int = 400) -> DataFrame:
    """One row per (keys, ``day``): ``n``, an HLL sketch of ``distinct`` (null
    values are no value) and a KLL sketch of ``value``."""
    return df.groupBy(*keys, day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(distinct, lg_k).alias("distinct_sketch"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias("value_sketch"))


def merge_days(mart: DataFrame, keys: Sequence[str], first=None, last=None,
               probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The sketches of all days from ``first`` to ``last`` (a filter on the
    mart's partitions) merged: ``n``, ``n_distinct`` (estimate) and one
    estimated quantile per probability (``q25`` ...)."""
    if first is not None:
        mart = mart.where(F.col("day") >= F.lit(first))
    if last is not None:
        mart = mart.where(F.col("day") <= F.lit(last))
    merged = mart.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.hll_union_agg("distinct_sketch").alias("_d"),
        F.kll_merge_agg_double("value_sketch").alias("_v"))
    return merged.select(*keys, "n", F.hll_sketch_estimate("_d").alias("n_distinct"), *[
        F.kll_sketch_get_quantile_double("_v", F.lit(float(p))).alias(f"q{int(round(100 * p)):02d}")
        for p in probs])
