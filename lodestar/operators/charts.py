"""Chart-data operators (survey §2.19, D1-D15): the aggregation behind each
plot, computed in Spark over all rows; drawing is left to the caller.

The reference pulled whole columns to pandas (``toPandas``) for every
histogram / box plot; here each one is a bounded-size aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.operators.joins import small_side
from lodestar.session import cut_lineage


def _bin(x: Column, lo, width, bins: int) -> Column:
    # last bin closed: the maximum falls into bin bins-1, not bins; a constant
    # column (width 0) has all its rows in bin 0 and no density
    return F.least(F.floor(F.coalesce(F.try_divide(x - lo, width), F.lit(0.0))).cast("int"),
                   F.lit(bins - 1))


def histogram(df: DataFrame, col: str, bins: int, keys: Sequence[str] = (),
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width histogram. Bounds are fixed (``lo``/``hi``)
    or the column's min/max as scalar subqueries; with ``keys`` one
    histogram per group. Returns (keys..., bin, lo, hi, n, density)."""
    x = F.col(col).cast("double")
    if lo is None or hi is None:
        mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
        lo_c, hi_c = mm.select("lo").scalar(), mm.select("hi").scalar()
    else:
        lo_c, hi_c = F.lit(float(lo)), F.lit(float(hi))
        df = df.where((x >= lo_c) & (x <= hi_c))
    width = (hi_c - lo_c) / F.lit(float(bins))
    b = df.select(*keys, _bin(x, lo_c, width, bins).alias("bin"))
    h = b.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    out = h.select(*keys, "bin", (lo_c + F.col("bin") * width).alias("lo"),
                   (lo_c + (F.col("bin") + 1) * width).alias("hi"), "n")
    totals = (h.groupBy(*keys).agg(F.sum("n").alias("_tot")) if keys
              else None)
    if totals is not None:
        out = out.join(totals, list(keys))
        tot = F.col("_tot")
    else:
        tot = h.agg(F.sum("n")).scalar()
    return out.withColumn("density", F.try_divide(F.col("n"), tot * width)).drop("_tot")


def line_series(df: DataFrame, x: Column, y: str) -> DataFrame:
    """Mean / total / count of y by x, ordered by x."""
    return (df.groupBy(x.alias("x")).agg(F.avg(y).alias("mean"), F.sum(y).alias("total"),
                                         F.count(F.lit(1)).alias("n"))
              .orderBy("x"))


def box_stats(df: DataFrame, key: str, value: str, k: float = 1.5,
              approx: bool = False) -> DataFrame:
    """Quartiles, whiskers (the most extreme values inside the fences)
    and outlier counts per group, over all rows (no sampling). Quartiles are
    exact and distributed, or with ``approx`` from bounded sketches."""
    from lodestar.operators.windows import exact_quantiles
    if approx:
        q = cut_lineage(df.groupBy(key).agg(*[F.percentile_approx(value, p, 10000).alias(n) for p, n in
                                              ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))]))
    else:
        q = exact_quantiles(df, key, value, [0.25, 0.5, 0.75], names=["q1", "median", "q3"])
    fence = q.select(key, "q1", "median", "q3",
                     (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("_lf"),
                     (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("_uf"))
    x = df.select(key, value).join(small_side(fence.select(key, "_lf", "_uf"), fixed=True), key)
    inside = (F.col(value) >= F.col("_lf")) & (F.col(value) <= F.col("_uf"))
    w = x.groupBy(key).agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(value))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"))
    return fence.drop("_lf", "_uf").join(w, key)


def regression_line(df: DataFrame, y: str, x: str, keys: Sequence[str] = ()) -> DataFrame:
    """Least-squares slope / intercept / r^2 (one aggregate)."""
    aggs = [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
            F.regr_r2(y, x).alias("r2"), F.count(F.lit(1)).alias("n")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def scatter_points(df: DataFrame, keys: Sequence[str], x: str, y: str, n: int,
                   zone: float) -> DataFrame:
    """``n`` distinct points for a scatter plot, those with the least
    hashes of ``keys`` (a distributed take-ordered: each task keeps n), with
    the regression line of all rows and whether the point lies above ``zone``
    times the line."""
    h = F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))
    points = df.select(*keys, F.col(x).alias("x"), F.col(y).alias("y"), h.alias("_h")).distinct() \
        .orderBy("_h", "x", "y").limit(n)
    fit = regression_line(df, y, x)
    line = fit.select("slope").scalar() * F.col("x") + fit.select("intercept").scalar()
    return points.select("x", "y", line.alias("line")).withColumn("in_zone", F.col("y") > zone * F.col("line"))


def ohlc(df: DataFrame, ts: str, price: str, tiebreak: str, period: str = "day",
         volume: str | None = None) -> DataFrame:
    """open/high/low/close per period. Open/close are the first/last
    price by (ts, tiebreak) — ``min``/``max`` over a struct, an ordinary
    map-side-combined aggregate."""
    p = F.date_trunc(period, F.col(ts)).alias("period")
    first = F.min(F.struct(F.col(ts), F.col(tiebreak), F.col(price)))
    last = F.max(F.struct(F.col(ts), F.col(tiebreak), F.col(price)))
    vol = F.sum(volume) if volume else F.count(F.lit(1))
    return df.groupBy(p).agg(first[price].alias("open"), F.max(price).alias("high"),
                             F.min(price).alias("low"), last[price].alias("close"),
                             vol.alias("volume"))


def heatmap(df: DataFrame, row: str, col: Column, values: Sequence, agg: Column) -> DataFrame:
    """Matrix of an aggregate (row x pivoted column); the column values
    are listed up front so no extra job discovers them."""
    return df.withColumn("_hcol", col).groupBy(row).pivot("_hcol", list(values)).agg(agg)


def banded_rate(df: DataFrame, length: str, edges: Sequence[float], num: Column,
                den: Column, name: str = "band", weight: str | None = None) -> DataFrame:
    """Mean of min(num/den, 1) per length band (<= e0, <= e1, ...,
    > last). A row stands for ``weight`` views (one, if not given)."""
    b = None
    for i, e in enumerate(edges):
        lab = f"<={int(e)}"
        b = F.when(F.col(length) <= e, F.lit(lab)) if b is None else b.when(F.col(length) <= e, F.lit(lab))
    b = b.otherwise(F.lit(f">{int(edges[-1])}"))
    rate = F.least(num / den, F.lit(1.0))
    n = F.col(weight) if weight else F.lit(1).cast("bigint")
    return df.groupBy(b.alias(name)).agg(F.try_divide(F.sum(rate * n), F.sum(n)).alias("completion"),
                                         F.sum(n).alias("n"))
