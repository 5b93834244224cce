"""Projection, filters, predicates, set operations, sort/limit
(survey §2.3 P1-P19, §2.7 O1-O4, §2.8 U1-U4).

Thin by design: each is a Catalyst-visible expression so column pruning and
Parquet filter pushdown reach the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """P5: positional rename of every column."""
    return df.toDF(*names)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P5: rename some columns."""
    return df.withColumnsRenamed(mapping)


def safe_cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``try_cast`` so dirty text becomes NULL under ANSI mode
    instead of failing the job."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {t})") for c, t in types.items()})


def band(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``x < e0 -> l0, x < e1 -> l1, ... else l_last``; NULL stays
    NULL (the reference's Python UDF raised on NULL)."""
    assert len(labels) == len(edges) + 1
    expr = F.when(col.isNull(), F.lit(None).cast("string"))
    for e, lab in zip(edges, labels):
        expr = expr.when(col < e, F.lit(lab))
    return expr.otherwise(F.lit(labels[-1]))


def missing_or_placeholder(col: Column, placeholder: str = "Unknown") -> Column:
    """Absent field or an explicit placeholder value."""
    return col.isNull() | (col == F.lit(placeholder))


def pipe(df: DataFrame, *fns: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Compose frame->frame functions with ``DataFrame.transform``."""
    for fn in fns:
        df = df.transform(fn)
    return df


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """``orderBy.limit`` (planned as TakeOrderedAndProject: each
    task keeps k rows). Callers put a unique tie-break last in ``order``."""
    return df.orderBy(*order).limit(k)


def union_all(*dfs: DataFrame) -> DataFrame:
    """By name (positional unions silently mis-align columns)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def dedupe(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or one row per key."""
    return df.dropDuplicates(list(keys)) if keys else df.distinct()


def dedupe_deterministic(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U4 with a deterministic survivor (the smallest remaining-column
    tuple): an aggregate with map-side combine."""
    rest = [c for c in df.columns if c not in keys]
    m = F.min(F.struct(*rest)).alias("_m")
    return df.groupBy(*keys).agg(m).select(*keys, *[F.col(f"_m.{c}").alias(c) for c in rest])
