"""Series-in-an-array functions (survey F7-F15, W4-W6, E9, D10, Q3-Q5).

All are Catalyst expressions and higher-order functions (``transform``,
``aggregate``, ``zip_with``, ``slice``, ``sequence``): they run in the
executor JVM with no Python worker and no per-row serialisation — the
reference used row-at-a-time Python UDFs for the same work. Lambda bodies
are interpreted rather than code-generated, so folds are kept single-pass.
Inputs are arrays whose length is bounded by one series (a workout of at
most 50 events); unbounded series use the row-form operators in
``operators.windows``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double(a) -> Column:
    """``array<int>`` -> ``array<double>``."""
    return _c(a).cast("array<double>")


def epoch_to_ts(a, shift_hours: int = 0) -> Column:
    """Epoch seconds -> timestamps, minus a fixed offset (the
    reference's local-zone shift, made explicit and zone-independent)."""
    return F.transform(_c(a), lambda t: F.timestamp_seconds(t) - F.make_interval(
        hours=F.lit(shift_hours)))


def start_hour(ts_arr) -> Column:
    """F8: hour of the first timestamp."""
    return F.hour(F.array_min(_c(ts_arr)))


def duration_min(epoch_arr, wrap_days: bool = False) -> Column:
    """(max - min) in minutes. ``wrap_days`` reproduces
    ``timedelta.seconds`` (whole days dropped)."""
    a = _c(epoch_arr)
    d = F.array_max(a) - F.array_min(a)
    if wrap_days:
        d = F.pmod(d, F.lit(86400))
    return d / F.lit(60.0)


def intervals(epoch_arr, wrap: bool = False) -> Column:
    """Consecutive differences; a one-element series gives
    ``[0]``. ``wrap`` reproduces ``timedelta.seconds`` on negative steps
    (``pmod(d, 86400)``)."""
    a = _c(epoch_arr)
    n = F.size(a)
    m = F.greatest(n - 1, F.lit(0))                   # empty input: no diffs
    diffs = F.zip_with(F.slice(a, 2, m), F.slice(a, 1, m), lambda x, y: x - y)
    if wrap:
        diffs = F.transform(diffs, lambda d: F.pmod(d, F.lit(86400)))
    return F.when(n == 1, F.array(F.lit(0).cast("bigint"))).otherwise(diffs)


def mean(a) -> Column:
    """fold with a finish step; NULL for an empty array."""
    a = as_double(a)
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x,
                       lambda acc: F.try_divide(acc, F.size(a)))


def std_pop(a) -> Column:
    """Population standard deviation of an array: deviations from the mean
    are squared and summed (sums of squares would cancel for large values
    close together); NULL for an empty array. The mean is bound once, as the
    only element of an array, so the fold reads each element once."""
    a = as_double(a)
    squares = F.transform(F.array(mean(a)), lambda mu: F.aggregate(
        a, F.lit(0.0), lambda acc, x: acc + (x - mu) * (x - mu)))
    return F.sqrt(F.try_divide(F.get(squares, F.lit(0)), F.size(a)))


def trend(a, min_len: int = 4) -> Column:
    """Mean of the last quarter minus mean of the first quarter
    (q = max(1, n // 4)); 0.0 for series shorter than ``min_len``."""
    a = as_double(a)
    n = F.size(a)
    q = F.greatest(F.lit(1), F.floor(n / 4).cast("int"))
    head, tail = F.slice(a, 1, q), F.slice(a, -q, q)
    return F.when(a.isNull() | (n < min_len), F.lit(0.0)).otherwise(mean(tail) - mean(head))


def rolling_std_mean(a, width: int = 5) -> Column:
    """Mean over all width-``width`` windows of the window's
    population std; 0.0 for shorter series (guarded: ``sequence`` would
    count down when n < width)."""
    a = as_double(a)
    n = F.size(a)
    starts = F.sequence(F.lit(1), n - width + 1)
    stds = F.transform(starts, lambda i: std_pop(F.slice(a, i, width)))
    total = F.aggregate(stds, F.lit(0.0), lambda acc, x: acc + x)    # one pass over the windows
    return F.when(a.isNull() | (n < width), F.lit(0.0)).otherwise(total / (n - width + 1))


def trailing(a, k: int) -> Column:
    """the last k elements — the whole array when it is shorter (as
    a Python ``a[-k:]``; a negative ``slice`` start past the front would
    return an empty array)."""
    a = _c(a)
    return F.slice(a, F.greatest(F.size(a) - k + 1, F.lit(1)), F.lit(k))


def relative_to_start(epoch_arr) -> Column:
    """Seconds since the series' first element."""
    a = _c(epoch_arr)
    m = F.array_min(a)
    return F.transform(a, lambda t: t - m)


def padded_bounds(a) -> tuple[Column, Column]:
    """[min - std, max + std] then inset by 1/48 of the span on each
    side (population std, as numpy's default)."""
    a = as_double(a)
    s = std_pop(a)
    lo, hi = F.array_min(a) - s, F.array_max(a) + s
    d = (hi - lo) / F.lit(12.0)
    return lo + d / 4, hi - d / 4


def has_bad_value(a) -> Column:
    """Q2: NULL array, or any NULL / NaN / 0 element."""
    a = _c(a)
    return a.isNull() | F.exists(a, lambda e: e.isNull() | F.isnan(e.cast("double")) | (e == 0))
