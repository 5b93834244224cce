"""Exact quantiles by distributed selection (survey I4, A12, D5, C7, X5).

A quantile needs one or two values of known rank. Instead of sorting rows, each
pass counts them in value buckets inside the intervals that still hold a wanted
rank, and keeps for every rank only the bucket that covers it, with the
smallest and the largest value found there. A bucket's number is a monotone
function of the value, the two ends of an interval always fall into different
buckets, and an interval whose ends are equal is settled; so a few passes reach
the exact values whatever the distribution (evenly spaced buckets take turns
with buckets of powers of two).

Rows never move: intervals are broadcast (their number is counted first), rows
are counted where they are, and what is shuffled is at most one row per task,
interval and bucket. A group with a third of the rows costs no more than any
other. Beyond ``MOST_GROUPS`` groups ranks come from range partitions instead
(``windows.ranked_quantiles``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

#: Groups whose targets travel through the driver and are broadcast.
MOST_GROUPS = 100_000
#: Value buckets of an interval; all intervals of a pass share MOST_CELLS.
BUCKETS, MOST_CELLS = 4096, 1 << 17
#: Intervals that hold as few rows in all are settled by their values.
FEW_ROWS = 1 << 16


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)


def _finite(value: Column, floating: bool) -> Column:
    return (~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))) if floating else F.lit(True)


def _octave(x: float) -> float:
    """A monotone scale that gives each power of two the same room."""
    return math.copysign(1100 + math.log2(abs(x)), x) if x else 0.0


def value_bucket(value: Column, floating: bool, exact: bool, octaves: bool, n: int) -> Column:
    """Number of the value's bucket in its interval (its columns ``_from``,
    ``_span``, ``_hi``): evenly spaced, or by powers of two (``octaves``).
    ``exact`` takes differences as decimals, for numbers that doubles cannot
    tell apart. Infinities and NaN have buckets of their own, in Spark's order."""
    x = value.cast("double")
    if octaves:
        at = (F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * (1100 + F.log2(F.abs(x))))
              - F.col("_from")) / F.col("_span")
    elif exact:
        value_, lo, hi = (c.cast("decimal(38,10)") for c in (value, F.col("_lo"), F.col("_hi")))
        at = F.try_divide((value_ - lo).cast("double"), (hi - lo).cast("double"))
    else:
        at = (x * F.col("_scale") - F.col("_from")) / F.col("_span")
    b = F.least(F.greatest(F.floor(F.coalesce(at, F.lit(0.0)) * n), F.lit(0)), F.lit(n - 1))
    b = F.when(value == F.col("_hi"), F.lit(n - 1)).otherwise(b)
    if floating:
        inf = float("inf")
        b = (F.when(F.isnan(value), F.lit(n + 1)).when(value == inf, F.lit(n))
             .when(value == -inf, F.lit(-1)).otherwise(b))
    return b.cast("long")


def rank_pass(base: DataFrame, keys: Sequence[str], value: str, intervals: DataFrame,
              targets: DataFrame, bucket: Column) -> DataFrame:
    """(_i, _rank, _before, _n, _least, _most) of the bucket that covers each
    target: rows of ``base`` inside the intervals (broadcast) are counted per
    bucket map-side; a window runs over the bucket counts of one interval."""
    side = intervals.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    inside = base.join(F.broadcast(side), [*match, F.col(value).between(F.col("_lo"), F.col("_hi"))])
    cells = inside.groupBy("_i", bucket.alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias("_least"), F.max(value).alias("_most"))
    w = Window.partitionBy("_i").orderBy("_b")
    cells = cells.withColumn("_before", F.sum("_n").over(w) - F.col("_n"))
    return cells.join(F.broadcast(targets), "_i").where(
        (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    ).select("_i", "_rank", "_before", "_n", "_least", "_most")


def select_ranks(base: DataFrame, keys: Sequence[str], value: str, groups: list,
                 wanted: list[set[int]], few: int = FEW_ROWS) -> dict:
    """{(group number, rank): value}. ``groups`` has (key values, n, least,
    most, least finite, most finite) per group; rows of ``base`` have no null
    value."""
    spark, kind = base.sparkSession, base.schema[value].dataType
    floating = isinstance(kind, (DoubleType, FloatType))
    fields = [base.schema[k] for k in keys] + [
        StructField("_lo", kind), StructField("_hi", kind)]
    doubles = [StructField(c, DoubleType()) for c in ("_scale", "_from", "_span")]
    interval_schema = StructType([*fields, *doubles]).add("_i", "long")
    found: dict = {}
    # (group, lo, hi, least finite, most finite, rows before, rows, ranks)
    open_: list[tuple] = []

    def settle(g, lo, hi, lo_f, hi_f, before, n, ranks):
        left = set()
        for r in ranks:
            if _same(lo, hi) or r == before:
                found[g, r] = lo
            elif r == before + n - 1:
                found[g, r] = hi
            else:
                left.add(r)
        if left:
            open_.append((g, lo, hi, lo_f, hi_f, before, n, left))

    for g, (_, n, *ends) in enumerate(groups):
        settle(g, *ends, 0, n, wanted[g])
    turn = 0
    while open_:
        turn += 1
        octaves = turn % 2 == 0
        rows, targets, exact = [], [], False
        for i, (g, lo, hi, lo_f, hi_f, before, _, ranks) in enumerate(open_):
            low, high = float(lo_f if lo_f is not None else 0), float(hi_f if hi_f is not None else 0)
            scale = 0.5 if max(abs(low), abs(high)) > 1e300 else 1.0
            exact |= not floating and low == high
            start, end = (_octave(low), _octave(high)) if octaves else (low * scale, high * scale)
            rows.append((*groups[g][0], lo, hi, scale, start, (end - start) or 1.0, i))
            targets += [(i, r - before) for r in ranks]
        if sum(x[6] for x in open_) <= few:
            bucket = F.col(value)
        else:
            n = max(4, min(BUCKETS, MOST_CELLS // len(open_)))
            bucket = value_bucket(F.col(value), floating, exact, octaves, n)
        got = rank_pass(base, keys, value, spark.createDataFrame(rows, interval_schema),
                        spark.createDataFrame(targets, "_i long, _rank long"), bucket).collect()
        last, open_[:] = list(open_), []
        cells: dict = {}
        for r in got:
            cells.setdefault((r["_i"], r["_before"], r["_n"], r["_least"], r["_most"]), set()).add(r["_rank"])
        for (i, before, n, lo, hi), ranks in cells.items():
            g, at = last[i][0], last[i][5]
            settle(g, lo, hi, lo, hi, at + before, n, {at + r for r in ranks})
    return found


def exact_quantiles(df: DataFrame, keys, value: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, parts: int | None = None,
                    most_groups: int = MOST_GROUPS, few: int = FEW_ROWS) -> DataFrame:
    """Exact linearly interpolated quantiles per group (position q * (n - 1),
    as numpy / SQL ``percentile_cont``): one row per group with a non-null
    value, one column per quantile. ``df`` is read once for the groups' ends
    and then two or three times as a rule, so write it first if it is costly
    to compute. Groups are counted; beyond ``most_groups`` ranks come from
    range partitions (``parts`` of them)."""
    from lodestar.operators.windows import ranked_quantiles
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = list(names or [f"p{int(round(q * 100)):02d}" for q in probs])
    base = df.select(*keys, value).where(F.col(value).isNotNull())
    by = keys or ["_g"]
    base = base if keys else base.withColumn("_g", F.lit(0))
    kind = base.schema[value].dataType
    finite = _finite(F.col(value), isinstance(kind, (DoubleType, FloatType)))
    ends = base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias("_least"), F.max(value).alias("_most"),
        F.min(F.when(finite, F.col(value))).alias("_least_f"),
        F.max(F.when(finite, F.col(value))).alias("_most_f")).limit(most_groups + 1).collect()
    if len(ends) > most_groups:
        return ranked_quantiles(df, keys, value, probs, parts, names)
    groups = [(tuple(r[k] for k in by), *r[len(by):]) for r in ends]
    places = [[float(q) * (n - 1) for q in probs] for _, n, *_ in groups]
    wanted = [{f(p) for p in at for f in (math.floor, math.ceil)} for at in places]
    found = select_ranks(base, by, value, groups, wanted, few)
    rows = [(*g[0], *[x for p in places[i] for x in (
        found[i, math.floor(p)], found[i, math.ceil(p)], p - math.floor(p))])
        for i, g in enumerate(groups)]
    schema = StructType([base.schema[k] for k in by])
    for j in range(len(names)):
        schema = schema.add(f"_lo{j}", kind).add(f"_hi{j}", kind).add(f"_f{j}", "double")
    wide = df.sparkSession.createDataFrame(rows, schema)
    between = []
    for j, name in enumerate(names):
        lo, hi = F.col(f"_lo{j}"), F.col(f"_hi{j}")
        # equal ends may be infinite
        v = F.when(lo != hi, lo + F.col(f"_f{j}") * (hi - lo)).otherwise(
            lo if isinstance(kind, (DoubleType, FloatType)) else lo.cast("double"))
        between.append(v.alias(name))
    return wide.select(*keys, *between)
