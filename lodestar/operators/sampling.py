"""Sampling and splitting (survey §2.10, R1-R6).

Two families:
* native (``sample``, ``randomSplit``, ``sampleBy``): seeded, fast,
  partition-layout dependent;
* hash-based: a row's fate is a pure function of (id, seed), so the same
  rows are chosen on any cluster, after any retry, and by a SQL oracle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.windows import hashed_sample_per_group


def unit_hash(id_col: str, seed: int = 42) -> Column:
    """Uniform-ish value in [0, 1) from md5(id || ':' || seed) (portable:
    the first 8 hex digits of md5 -> integer / 16^8)."""
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def bernoulli(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Native sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_to_size(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """R2: fraction = min(n / count, 1) with the count as a scalar subquery
    folded into the hash threshold (no driver round-trip). ``id_col`` should
    be a key: rows of one id enter or leave together."""
    total = df.agg(F.count(F.lit(1))).scalar()
    frac = F.least(F.try_divide(F.lit(float(n)), total), F.lit(1.0))
    return df.where(unit_hash(id_col, seed) < frac)


def hash_sample(df: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    """R1 (portable): keep rows whose hash falls below ``fraction``."""
    return df.where(unit_hash(id_col, seed) < fraction)


def hash_split(df: DataFrame, id_col: str, weights: Sequence[float],
               seed: int = 42, name: str = "split") -> DataFrame:
    """R3/R6 (portable): tag each row with its split index; cumulative
    weight thresholds on the unit hash."""
    total = float(sum(weights))
    edges, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        edges.append(acc)
    u = unit_hash(id_col, seed)
    expr = None
    for i, e in enumerate(edges):
        expr = F.when(u < e, F.lit(i)) if expr is None else expr.when(u < e, F.lit(i))
    expr = F.lit(len(weights) - 1) if expr is None else expr.otherwise(F.lit(len(weights) - 1))
    return df.withColumn(name, expr.cast("int"))


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """R3/R6 native: ``randomSplit`` (callers persist a sorted input first if
    the split must be reproducible across runs)."""
    return df.randomSplit(list(weights), seed)


def stratified_split(df: DataFrame, id_col: str, label: str, train: float = 0.8,
                     seed: int = 42) -> DataFrame:
    """Per-class split — the hash split is applied inside every class,
    so each class keeps ``train`` of its rows (up to hash noise) without a
    per-class loop."""
    return hash_split(df, id_col, [train, 1 - train], seed).withColumn(
        "is_train", F.col("split") == 0).drop("split")


def stratified_sample(df: DataFrame, label: str, fractions: dict, seed: int = 42) -> DataFrame:
    """R4 native: ``sampleBy``."""
    return df.sampleBy(label, fractions, seed)


def two_level_sample(df: DataFrame, group: str, entity: str, n_entities: int,
                     sub_group: str, item: str, n_items: int, seed: int = 42) -> DataFrame:
    """N entities per group, then m items per sub-group among those
    entities — two hash-ranked top-n windows and a semi-join, no id lists
    through the driver."""
    ents = df.select(group, entity).distinct()
    chosen = hashed_sample_per_group(ents, group, entity, n_entities, seed).select(entity)
    pool = df.join(chosen, entity, "left_semi")
    return hashed_sample_per_group(pool, sub_group, item, n_items, seed)
