"""Grouped and global aggregation (survey §2.5, A1-A15).

All aggregates here are algebraic or have partial (map-side) forms, so a key
holding a large share of the rows is collapsed inside each map task before
the shuffle. Shares of a total use a scalar subquery (one tiny job whose
value is inlined), never an un-partitioned window.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FUNCS = {
    "sum": F.sum, "avg": F.avg, "mean": F.avg, "min": F.min, "max": F.max,
    "count": F.count, "stddev": F.stddev_samp, "variance": F.var_samp,
    "count_distinct": F.countDistinct,
}


def _cols(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def agg_spec(spec: dict[str, str | Sequence[str]]) -> list[Column]:
    """Dict form ``{"col": "sum"}`` or ``{"col": ["min","max"]}`` (A2) ->
    aliased columns ``<fn>_<col>``."""
    out = []
    for col, fns in spec.items():
        for fn in _cols(fns):
            out.append(_FUNCS[fn](col).alias(f"{fn}_{col}"))
    return out


def global_agg(df: DataFrame, spec: dict[str, str | Sequence[str]], *extra: Column) -> DataFrame:
    """A1/A2: one-row aggregate, a single pass (``extra``: more aggregate
    columns, e.g. a row count)."""
    return df.agg(*extra, *agg_spec(spec))


def group_agg(df: DataFrame, keys: str | Sequence[str],
              spec: dict[str, str | Sequence[str]]) -> DataFrame:
    """Grouped sum/avg/min/max/count over one or several keys."""
    return df.groupBy(*_cols(keys)).agg(*agg_spec(spec))


def group_count(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """Frequency table (callers sort; sorting is a separate shuffle)."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, keys: str | Sequence[str], col: str,
                   name: str | None = None, approx: bool = False) -> DataFrame:
    """Distinct values of ``col`` per key. The exact form is planned
    by Catalyst as a two-level aggregate (dedupe (key, col) with map-side
    combine, then count); ``approx`` uses HyperLogLog++ sketches, which merge
    in bounded memory per group."""
    f = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    return df.groupBy(*_cols(keys)).agg(f.alias(name or f"n_{col}"))


def having(df: DataFrame, keys: str | Sequence[str], agg: Column, cond) -> DataFrame:
    """Aggregate then filter on the aggregate."""
    out = df.groupBy(*_cols(keys)).agg(agg)
    return out.where(cond(out) if callable(cond) else cond)


def conditional_counts(df: DataFrame, conds: dict[str, Column],
                       keys: Sequence[str] = ()) -> DataFrame:
    """A10: several filtered counts in one scan (``count_if``)."""
    aggs = [F.count_if(c).alias(n) for n, c in conds.items()]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def series_stats(df: DataFrame, keys: str | Sequence[str], value: str,
                 pcts: Iterable[float] = (0.25, 0.5, 0.75, 0.95),
                 method: str = "distributed", accuracy: int = 10000) -> DataFrame:
    """min/max/mean/sample stddev and percentiles of ``value`` per key.

    Percentiles are linearly interpolated (numpy's default). ``method``:
    * "distributed" (default): exact, via ``windows.exact_quantiles`` — a
      range-partitioned rank computation, so a group holding a third of the
      rows is spread over many tasks;
    * "map": Spark's ``percentile`` aggregate (exact; one value->count map
      per group, merged in one task — fine for small groups);
    * "approx": ``percentile_approx`` sketches (bounded memory, approximate).
    """
    from lodestar.operators.windows import exact_quantiles
    pcts = list(pcts)
    names = [f"p{int(round(p * 100)):02d}" for p in pcts]
    keys = _cols(keys)
    aggs = [F.min(value).alias("min"), F.max(value).alias("max"),
            F.avg(value).alias("mean"), F.stddev_samp(value).alias("stddev"),
            F.count(value).alias("n")]
    if method == "approx":
        aggs += [F.percentile_approx(value, p, accuracy).alias(n) for p, n in zip(pcts, names)]
    elif method == "map":
        aggs += [F.percentile(value, F.lit(p)).alias(n) for p, n in zip(pcts, names)]
    moments = df.groupBy(*keys).agg(*aggs)
    if method != "distributed":
        return moments
    q = exact_quantiles(df, keys, value, pcts, names=names)
    if not keys:                      # one row each: join on a constant key
        moments, q, keys = moments.withColumn("_g", F.lit(0)), q.withColumn("_g", F.lit(0)), ["_g"]
        return moments.join(q, keys).drop("_g")
    return moments.join(q, keys)      # both sides hold one row per group


def share_of_total(df: DataFrame, value: str, name: str = "pct") -> DataFrame:
    """``100 * value / sum(value)`` with the total as a scalar
    subquery (computed once, inlined as a literal)."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, F.col(value) * F.lit(100.0) / total)


def top_k_with_others(df: DataFrame, key: str, value: str, k: int,
                      others_label: str = "Others") -> DataFrame:
    """The k largest groups plus one "others" row = total - sum(top k),
    all in Spark. ``df`` is already aggregated (one row per key). Top-k runs
    as a distributed take-ordered (each task keeps k rows)."""
    ranked = df.select(key, value)
    top = ranked.orderBy(F.col(value).desc(), F.col(key).asc()).limit(k)
    total = ranked.agg(F.sum(value)).scalar()
    rest = top.agg((F.lit(total) - F.sum(value)).alias(value)).select(
        F.lit(others_label).alias(key), value)
    out = top.unionByName(rest)
    return out.withColumn("pct", F.col(value) * F.lit(100.0) / total)


def within_group_share(df: DataFrame, outer: str, inner: str, value: str,
                       name: str = "pct") -> DataFrame:
    """Share of ``inner`` inside each ``outer`` group. The group totals
    are an aggregate joined back on the outer key (the aggregated side has one
    row per key, so a hot key costs one row, not a third of the data)."""
    agg = df.groupBy(outer, inner).agg(F.sum(value).alias(value))
    tot = agg.groupBy(outer).agg(F.sum(value).alias("_tot"))
    return (agg.join(tot, outer)
               .withColumn(name, F.col(value) * F.lit(100.0) / F.col("_tot"))
               .drop("_tot"))


def describe_counts(df: DataFrame, key: str, value: str = "n") -> DataFrame:
    """Count per key, then describe the counts (one more aggregate)."""
    counts = group_count(df, key, value)
    return counts.agg(F.count(value).alias("n_keys"), F.avg(value).alias("mean"),
                      F.stddev_samp(value).alias("stddev"),
                      F.min(value).alias("min"), F.max(value).alias("max"))
