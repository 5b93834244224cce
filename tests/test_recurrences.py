"""Linear recurrences by prefix scan against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import recurrences as R
from lodestar.operators import windows as W


def _rows(n=1500):
    """One key holds a third of all rows."""
    rng = random.Random(6)
    return [("hot" if i % 3 == 0 else f"k{rng.randint(0, 25)}", i, round(rng.uniform(-5, 5), 3))
            for i in range(n)] + [("single", n, 4.0), ("flat", n + 1, 1.0), ("flat", n + 2, 1.0)]


def _loops(rows, n):
    ema, rsi, last = {}, {}, {}
    for k, i, x in sorted(rows, key=lambda r: r[1]):
        if k not in last:
            y, up, down = x, 0.0, 0.0
        else:
            y0, x0, up, down = last[k]
            y = 0.3 * x + 0.7 * y0
            up, down = ((1 - 1 / n) * u + max(d, 0) for u, d in ((up, x - x0), (down, x0 - x)))
        last[k] = (y, x, up, down)
        ema[i], rsi[i] = y, 100 * up / (up + down) if up + down else None
    return ema, rsi


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("batch", [10000, 13])
def test_indicators_against_loops(spark, parts, batch):
    rows = _rows()
    df = spark.createDataFrame(rows, "k string, id long, v double").repartition(4)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        x = R.exponential_average(df, "k", "id", "v", 0.3, parts=parts)
        got = R.relative_strength(x, "k", "id", "v", 5, parts=parts).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    ema, rsi = _loops(rows, 5)
    assert len(got) == len(rows)
    for r in got:
        assert math.isclose(r["ema"], ema[r["id"]], rel_tol=1e-9, abs_tol=1e-12)
        assert r["rsi"] is None and rsi[r["id"]] is None or math.isclose(r["rsi"], rsi[r["id"]], rel_tol=1e-9)


def test_a_hot_key_is_spread(spark):
    df = spark.createDataFrame(_rows(6000), "k string, id long, v double")
    sizes = {r["_b"]: r["count"] for r in W._stretches(df, ["k"], ["id"], 12)
             .where("k = 'hot'").groupBy("_b").count().collect()}
    assert len(sizes) >= 3 and max(sizes.values()) < 6000 / 12 * 2


def test_scan_composes_within_runs():
    rng = np.random.default_rng(1)
    m, c = rng.random(200), rng.random(200)
    first = rng.random(200) < 0.1
    first[0] = True
    big_m, big_c = R.scan_affine(m, c, first)
    y = 0.0
    for t in range(200):
        if first[t]:
            y0 = y = 2.5
        y = m[t] * y + c[t]
        assert math.isclose(big_m[t] * y0 + big_c[t], y, rel_tol=1e-12)


def test_edges(spark):
    schema = "k string, id long, v double"
    empty = spark.createDataFrame([], schema)
    assert R.relative_strength(empty, "k", "id", "v").collect() == []
    assert R.exponential_average(empty, "k", "id", "v", 0.5).columns == ["k", "id", "v", "ema"]
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0), ("b", 1, 2.0)], schema)
    got = {(r["k"], r["id"]): r["ema"] for r in R.exponential_average(df, "k", "id", "v", 0.5).collect()}
    assert got == {("a", 1): 1.0, ("a", 2): None, ("a", 3): None, ("b", 1): 2.0}
    back = {(r["k"], r["id"]): r["p"] for r in R.previous_value(df, "k", "id", "v", "p").collect()}
    assert back == {("a", 1): None, ("a", 2): 1.0, ("a", 3): None, ("b", 1): None}
    # a growing recurrence: compound interest per key
    grow = R.linear_recurrences(df.fillna(0.0), "k", "id", {"y": (F.lit(2.0), F.col("v"), F.lit(1.0))})
    assert {(r["k"], r["id"]): r["y"] for r in grow.collect()} == {
        ("a", 1): 3.0, ("a", 2): 6.0, ("a", 3): 15.0, ("b", 1): 4.0}
