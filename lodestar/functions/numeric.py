"""Deterministic decimal rounding for report columns.

``round`` in Spark rounds the double's shortest decimal text half-up, while
most other engines round the binary value; values that sit exactly on a
half-unit (common for averages of cents) can then differ by one unit.
``fixed`` spells the rounding as plain IEEE arithmetic,
``floor(x * 10^d + 0.5) / 10^d``, which any engine evaluates identically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(col, d: int = 6) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** d)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def fixed_sql(expr: str, d: int = 6) -> str:
    return f"floor(({expr}) * {float(10 ** d)!r} + 0.5) / {float(10 ** d)!r}"
