"""Reshaping (survey §2.11, H1-H5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_count(df: DataFrame, rows: Sequence[str], col: str, values: Sequence,
                fill: int = 0) -> DataFrame:
    """H1/H2/V7: counts of ``rows`` x ``col``. The value list is always
    passed (otherwise Spark runs an extra distinct job to find it)."""
    out = df.groupBy(*rows).pivot(col, list(values)).count()
    return out.fillna(fill, subset=[str(v) for v in values])


def pivot_agg(df: DataFrame, rows: Sequence[str], col: str, values: Sequence,
              agg: Column) -> DataFrame:
    """Any aggregate in the cells (unstack)."""
    return df.groupBy(*rows).pivot(col, list(values)).agg(agg)


def with_total(df: DataFrame, cols: Sequence[str], name: str = "total") -> DataFrame:
    """H2: row total across pivoted columns."""
    expr = F.lit(0)
    for c in cols:
        expr = expr + F.coalesce(F.col(c), F.lit(0))
    return df.withColumn(name, expr)


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str],
            var: str = "key", val: str = "value") -> DataFrame:
    """H4: columns -> rows, the inverse of the pivot."""
    return df.unpivot(list(ids), list(cols), var, val)


def explode_series(df: DataFrame, keep: Sequence[str], arrays: Sequence[str],
                   pos: str = "pos") -> DataFrame:
    """H5: parallel arrays -> one row per element with its position
    (``arrays_zip`` keeps the arrays aligned; ``posexplode`` adds the
    index)."""
    z = F.arrays_zip(*[F.col(a) for a in arrays])
    x = df.select(*keep, F.posexplode(z).alias(pos, "_e"))
    return x.select(*keep, pos, *[F.col(f"_e.{a}").alias(a) for a in arrays])
