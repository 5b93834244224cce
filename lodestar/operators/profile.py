"""Inspection and profiling (survey §2.2, I1-I14).

The reference profiles column by column (one job per column). Here every
profile is ONE aggregate over the table, unpivoted afterwards into a long
(column, metric, value) frame, so the cost is one scan at any width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StringType


def _kind(dt) -> str:
    if isinstance(dt, StringType):
        return "string"
    if isinstance(dt, NumericType):
        return "number"
    if isinstance(dt, ArrayType):
        return "array"
    return "other"


def _long(wide: DataFrame, names: Sequence[str], value_name: str) -> DataFrame:
    return wide.unpivot([], list(names), "column", value_name)


def schema_profile(df: DataFrame) -> DataFrame:
    """I1+I2: per column its type, the table's row count and its non-null
    count — the schema joined with one aggregate pass."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count(F.col(c)).alias(f"nn_{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    stack = ", ".join(
        f"{i}, '{c}', '{t}', nn_{i}" for i, (c, t) in enumerate(df.dtypes))
    return wide.selectExpr(
        f"stack({len(cols)}, {stack}) AS (ordinal, column, data_type, non_null)",
        "_rows AS n_rows")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None,
                with_nan: bool = True) -> DataFrame:
    """NULL (and NaN for floating columns) count and percentage
    per column, all columns in one aggregate."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        cond = F.col(c).isNull()
        if with_nan and types[c] in ("double", "float"):
            cond = cond | F.isnan(F.col(c))
        aggs.append(F.count_if(cond).alias(f"m_{i}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', m_{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {stack}) AS (column, n_missing)", "_rows").select(
        "column", "n_missing",
        F.try_divide(F.col("n_missing") * F.lit(100.0), F.col("_rows")).alias("pct_missing"))


def anomaly_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Type-aware "bad value" count in one pass: string -> NULL;
    number -> NULL, NaN or 0; array -> NULL array or any NULL/NaN/0 element.
    (The reference's ``isin([0, None, NaN])`` missed NULLs, and
    ``array_contains`` missed NULL arrays.)"""
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = list(cols or df.columns)
    aggs = []
    kinds = {}
    for i, c in enumerate(cols):
        k = _kind(fields[c])
        kinds[c] = k
        x = F.col(c)
        if k == "number":
            cond = x.isNull() | F.isnan(x.cast("double")) | (x == 0)
        elif k == "array" and isinstance(fields[c].elementType, NumericType):
            cond = x.isNull() | F.exists(
                x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (e == 0))
        elif k == "array":
            cond = x.isNull() | F.exists(x, lambda e: e.isNull())
        else:
            cond = x.isNull()
        aggs.append(F.count_if(cond).alias(f"a_{i}"))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', '{kinds[c]}', a_{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column, kind, n_anomalous)")


def describe_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count / mean / sample stddev / min / max per numeric column in
    one aggregate, long form (column, count, mean, stddev, min, max)."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', c{i}, m{i}, s{i}, lo{i}, hi{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {stack}) AS (column, count, mean, stddev, min, max)")


def summary_long(df: DataFrame, cols: Sequence[str],
                 pcts: Sequence[float] = (0.25, 0.5, 0.75),
                 approx: bool = False) -> DataFrame:
    """``describe`` plus percentiles per column — exact and
    distributed (``windows.exact_quantiles``) or sketch-based
    (``percentile_approx``, one aggregate)."""
    base = describe_long(df, cols)
    names = [f"p{int(round(p * 100)):02d}" for p in pcts]
    if approx:
        aggs = [F.percentile_approx(F.col(c).cast("double"), p, 10000).alias(f"q{i}_{j}")
                for i, c in enumerate(cols) for j, p in enumerate(pcts)]
        wide = df.agg(*aggs)
        stack = ", ".join(
            f"'{c}', " + ", ".join(f"q{i}_{j}" for j in range(len(pcts)))
            for i, c in enumerate(cols))
        q = wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column, {', '.join(names)})")
    else:
        from lodestar.operators.windows import exact_quantiles
        # every column at once: unpivot to (column, value) and rank per column
        long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
            [], list(cols), "column", "_x")
        q = exact_quantiles(long, "column", "_x", pcts, names=names)
    # both sides are one row per column (bounded by the schema width)
    return base.join(F.broadcast(q), "column")


def frequent_items(df: DataFrame, col: str, support: float) -> DataFrame:
    """I6 exact form: values occurring in at least ``support`` of the rows.
    (``DataFrame.freqItems`` is the one-pass approximate variant with false
    positives; this is the exact answer, one aggregate + scalar total.)"""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= F.lit(support) * total))


def correlation(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation for several column pairs in one pass."""
    aggs = [F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{a}', '{b}', r{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, r)")


def entity_summary(df: DataFrame, entities: Sequence[str], by: str) -> DataFrame:
    """Distinct counts of several entity columns, per ``by`` and in
    total (a ROLLUP: the total row has ``by`` = NULL), one aggregate."""
    aggs = [F.countDistinct(e).alias(f"n_{e}") for e in entities]
    return df.rollup(by).agg(F.count(F.lit(1)).alias("n_records"), *aggs)
