"""Linear recurrences per key by prefix scan (survey W7: exponential average,
relative strength).

``y[t] = m[t] * y[t-1] + c[t]`` is an affine map of the value before, and maps
compose: a run of rows is one pair (M, C). So a key is not walked through row
by row in one task. Rows are dealt to ranges of (key, order); each task
composes the maps of its stretch of every key with a prefix scan (log steps on
whole arrays); one pair per key and stretch is composed along the key; and each
row applies its own pair to the value that enters its stretch. A key with a
third of the rows is spread over as many tasks as any other third.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.joins import small_side
from lodestar.operators.windows import _cols, _stretches


def scan_affine(m: np.ndarray, c: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix compositions of the maps y -> m * y + c inside each run that
    begins where ``first`` is set: doubling steps, so n log n whole-array work."""
    m, c = m.astype(np.float64), c.astype(np.float64)
    at = np.arange(len(m))
    start = np.maximum.accumulate(np.where(first, at, 0))
    step = 1
    while step < len(m):
        on = at - step >= start                 # the partner lies in the same run
        m2, c2 = m.copy(), c.copy()
        c2[on] = m[on] * c[at[on] - step] + c[on]
        m2[on] = m[on] * m[at[on] - step]
        m, c, step = m2, c2, step * 2
    return m, c


def _compose(keys: int, k: int):
    """Rows of a stretch in order: columns key..., then k pairs (m, c), then
    the rest; the pairs become their prefix compositions. A run that goes on in
    the next batch is carried over."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = list(zip(*[batch.column(i).to_pylist() for i in range(keys)], strict=True))
            first = np.array([True] + [a != b for a, b in zip(ids, ids[1:], strict=False)])
            out = list(batch.columns)
            goes_on = ids[0] == last
            upto = np.flatnonzero(first[1:])[0] + 1 if first[1:].any() else len(ids)
            state = []
            for j in range(k):
                m, c = scan_affine(batch.column(keys + 2 * j).to_numpy(zero_copy_only=False),
                                   batch.column(keys + 2 * j + 1).to_numpy(zero_copy_only=False), first)
                if goes_on:
                    c[:upto] = m[:upto] * carry[j][1] + c[:upto]
                    m[:upto] = m[:upto] * carry[j][0]
                out[keys + 2 * j], out[keys + 2 * j + 1] = pa.array(m), pa.array(c)
                state.append((m[-1], c[-1]))
            last, carry = ids[-1], state
            yield pa.RecordBatch.from_arrays(out, names=batch.schema.names)
    return run


def _enter(keys: int, k: int):
    """Rows (key..., stretch, k pairs, k starts) in order: the value that
    enters each stretch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, y = None, [0.0] * k
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            out = [[] for _ in range(k)]
            for i in range(batch.num_rows):
                key = tuple(c[i] for c in columns[:keys])
                for j in range(k):
                    m, c, start = (columns[keys + 1 + at][i] for at in (2 * j, 2 * j + 1, 2 * k + j))
                    before = y[j] if key == last else float("nan") if start is None else start
                    out[j].append(before)
                    y[j] = m * before + c
                last = key
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:keys + 1], *[pa.array(v, pa.float64()) for v in out]],
                names=[*batch.schema.names[:keys + 1], *[f"_y{j}" for j in range(k)]])
    return run


def linear_recurrences(df: DataFrame, keys, order: Sequence[str],
                       maps: dict[str, tuple[Column, Column, Column]],
                       parts: int | None = None) -> DataFrame:
    """``df`` with one column per entry of ``maps``: name -> (m, c, start),
    where the value before a key's first row is ``start`` of that row.
    ``order`` must be a total order inside a key; key columns hold no nulls.
    A null m or c makes its row and all later ones of the key null."""
    keys, order = _cols(keys), _cols(order)
    names = list(maps)
    work = []
    for j, (m, c, start) in enumerate(maps.values()):
        work += [m.cast("double").alias(f"_m{j}"), c.cast("double").alias(f"_c{j}"),
                 start.cast("double").alias(f"_s{j}")]
    x = _stretches(df.select("*", *work), keys, order, parts)
    pairs = [f"_{p}{j}" for j in range(len(names)) for p in "mc"]
    rest = [c for c in x.columns if c not in (*keys, *pairs)]
    x = x.select(*keys, *[F.coalesce(F.col(p), F.lit(float("nan"))).alias(p) for p in pairs], *rest)
    # the checkpointed partitions are the stretches: rows are only put in order
    done = x.sortWithinPartitions(*keys, *order).mapInArrow(_compose(len(keys), len(names)), x.schema)
    by = F.struct(*order)
    starts = [f"_s{j}" for j in range(len(names))]
    ends = done.groupBy(*keys, "_b").agg(
        *[F.max_by(p, by).alias(p) for p in pairs],
        *[F.min_by(p, by).alias(p) for p in starts])
    # a row per key and stretch: at most one per task for a hot key
    schema = ends.select(*keys, "_b", *[F.lit(0.0).alias(f"_y{j}") for j in range(len(names))]).schema
    carry = (ends.select(*keys, "_b", *pairs, *starts).repartition(*keys)
             .sortWithinPartitions(*keys, "_b").mapInArrow(_enter(len(keys), len(names)), schema))
    out = done.join(small_side(carry), [*keys, "_b"])
    values = [F.col(f"_m{j}") * F.col(f"_y{j}") + F.col(f"_c{j}") for j in range(len(names))]
    return out.select(*df.columns, *[F.when(~F.isnan(v), v).alias(n)
                                     for n, v in zip(names, values, strict=True)])


def exponential_average(df: DataFrame, keys, order: Sequence[str], value: str, alpha: float,
                        name: str = "ema", parts: int | None = None) -> DataFrame:
    """y[t] = alpha * x[t] + (1 - alpha) * y[t-1], y[0] = x[0]."""
    x = F.col(value)
    return linear_recurrences(df, keys, order, {name: (F.lit(1 - alpha), alpha * x, x)}, parts)


def previous_value(df: DataFrame, keys, order: Sequence[str], value: str, name: str,
                   parts: int | None = None) -> DataFrame:
    """The value of the row before, per key (null on the first): a recurrence
    that forgets, carried over stretches by one row each."""
    keys, order = _cols(keys), _cols(order)
    x = _stretches(df, keys, order, parts)
    w = Window.partitionBy(*keys, "_b").orderBy(*order)
    x = x.withColumn("_prev", F.lag(value).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    last = x.groupBy(*keys, "_b").agg(F.max_by(value, F.struct(*order)).alias("_last"))
    last = last.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_b")))
    x = x.join(small_side(last.drop("_last")), [*keys, "_b"])
    return x.withColumn(name, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev"))).drop(
        "_b", "_prev", "_first", "_carry")


def relative_strength(df: DataFrame, keys, order: Sequence[str], value: str, n: int = 14,
                      name: str = "rsi", parts: int | None = None) -> DataFrame:
    """100 * up / (up + down), where up and down are exponentially weighted
    sums (decay 1 - 1 / n) of the rises and falls between rows; the common
    weight cancels out, so this is the ratio of the averages. Null on a key's
    first row and as long as nothing has moved."""
    x = previous_value(df, keys, order, value, "_before", parts)
    d = F.coalesce(F.col(value) - F.col("_before"), F.lit(0.0))
    sums = {"_up": F.greatest(d, F.lit(0.0)), "_down": F.greatest(-d, F.lit(0.0))}
    y = linear_recurrences(x, keys, order, {
        k: (F.lit(1 - 1 / n), v, F.lit(0.0)) for k, v in sums.items()}, parts)
    return y.withColumn(name, F.try_divide(100 * F.col("_up"), F.col("_up") + F.col("_down"))).drop(
        "_before", "_up", "_down")
