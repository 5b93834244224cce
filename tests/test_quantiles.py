"""Exact quantiles by distributed selection."""

import math
import random
import re
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import quantiles as Q
from lodestar.operators import windows as W

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
NAMES = [f"q{i}" for i in range(len(PROBS))]


def _values(kind, n, rng):
    return {
        "even": lambda: [rng.random() for _ in range(n)],
        "tails": lambda: [math.copysign(math.exp(rng.gauss(0, 80)), rng.random() - 0.5) for _ in range(n)],
        "tiny": lambda: [rng.choice([5e-324, 1e-300, 1e-100, 0.0, 1.0]) * rng.randint(0, 9) for _ in range(n)],
        "huge": lambda: [rng.choice([-1.7e308, 1.7e308, 1e307]) * rng.random() for _ in range(n)],
        "close": lambda: [1e15 + rng.randint(0, 50) / 8 for _ in range(n)],
        "ties": lambda: [float(rng.choice([1, 1, 1, 2, 7])) for _ in range(n)],
        "one": lambda: [3.25] * n,
    }[kind]()


@pytest.mark.parametrize("kind", ["even", "tails", "tiny", "huge", "close", "ties", "one"])
def test_quantiles_of_any_distribution(spark, monkeypatch, kind):
    """A hot group (a third of the rows) among others; few rows may be settled
    by value, so the buckets do the work."""
    monkeypatch.setattr(Q, "BUCKETS", 64)
    rng = random.Random(kind)
    groups = {"hot": _values(kind, 700, rng)} | {
        f"g{i}": _values(kind, rng.randint(1, 120), rng) for i in range(20)} | {None: [1.0, 2.0]}
    rows = [(k, v) for k, x in groups.items() for v in x] + [("hot", None), ("empty", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r["k"]: r for r in Q.exact_quantiles(df, "k", "v", PROBS, NAMES, few=20).collect()}
    assert got.keys() == groups.keys()
    for k, x in groups.items():
        x = sorted(x)
        for q, name in zip(PROBS, NAMES, strict=True):
            at = q * (len(x) - 1)
            lo, hi = x[math.floor(at)], x[math.ceil(at)]
            want = lo + (at - math.floor(at)) * (hi - lo)
            assert got[k][name] == want or math.isnan(want) and math.isnan(got[k][name]), (k, q)


def test_infinities_and_nan_sort_as_in_spark(spark):
    inf, nan = float("inf"), float("nan")
    x = [-inf] * 3 + [float(i) for i in range(40)] + [inf] * 4 + [nan] * 5
    df = spark.createDataFrame([(v,) for v in x], "v double").repartition(3)
    probs = [i / (len(x) - 1) for i in range(len(x))]
    got = Q.exact_quantiles(df, [], "v", probs, [f"r{i}" for i in range(len(x))], few=5).first()
    for a, b in zip(got, x, strict=True):
        assert a == b or a != a and b != b or abs(a - b) < 1e-9


@pytest.mark.parametrize("ddl,make", [
    ("long", lambda i: (1 << 60) + i), ("decimal(38,0)", lambda i: Decimal(10) ** 25 + i),
    ("decimal(12,2)", lambda i: Decimal(i) / 100), ("int", lambda i: i - 50), ("float", float)])
def test_other_types(spark, ddl, make):
    x = [make(i) for i in range(101)]
    df = spark.createDataFrame([(1, v) for v in x], f"k int, v {ddl}").repartition(4)
    got = Q.exact_quantiles(df, ["k"], "v", [0.0, 0.25, 0.5, 1.0], list("abcd"), few=3).first()
    assert [got[c] for c in "abcd"] == [float(x[0]), float(x[25]), float(x[50]), float(x[100])]


def test_many_groups_use_range_partitions(spark):
    df = spark.range(900).select((F.col("id") % 30).alias("k"), F.col("id").cast("double").alias("v"))
    few = {r["k"]: tuple(r) for r in Q.exact_quantiles(df, "k", "v", [0.25, 0.5]).collect()}
    many = {r["k"]: tuple(r) for r in
            Q.exact_quantiles(df, "k", "v", [0.25, 0.5], most_groups=10).collect()}
    assert few == many and len(few) == 30
    assert few[4][2] == np.quantile(np.arange(4, 900, 30), 0.5)


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert Q.exact_quantiles(df, "k", "v", [0.5]).collect() == []
    assert Q.exact_quantiles(df, [], "v", [0.5]).collect() == []


def test_rows_stay_where_they_are(spark):
    """With automatic broadcast off a pass exchanges bucket counts only: every
    exchange has an aggregate or a pass's targets below it, none is on the
    group key, and nothing is checkpointed."""
    df = spark.range(0, 1000, numPartitions=4).select(
        (F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    sides = "k long, _lo double, _hi double, _scale double, _from double, _span double, _i long"
    intervals = spark.createDataFrame([(0, 0.0, 999.0, 1.0, 0.0, 999.0, 0)], sides)
    targets = spark.createDataFrame([(0, 5)], "_i long, _rank long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = Q.rank_pass(df, ["k"], "v", intervals, targets,
                          Q.value_bucket(F.col("v"), True, False, False, 64))
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    for keys in re.findall(r"hashpartitioning\((.*?), \d+\)", plan):
        assert "k#" not in keys and "_i#" in keys
    assert "partial_count" in plan and "Checkpoint" not in plan


def test_statistics_are_computed_once(spark):
    """The joined side is written before it is counted."""
    from lodestar.operators.joins import small_side
    seen = spark.sparkContext.accumulator(0)

    def note(rows):
        for r in rows:
            seen.add(1)
            yield r

    df = spark.createDataFrame(spark.range(40).rdd.mapPartitions(note), "id long")
    stats = df.groupBy((F.col("id") % 4).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    out = spark.range(8).select((F.col("id") % 4).alias("k")).join(small_side(stats), "k")
    assert out.count() == 8 and seen.value == 40


def test_box_stats_and_outliers_of_a_hot_group(spark):
    from lodestar.operators.charts import box_stats
    from lodestar.operators.clean import iqr_outliers
    rng = random.Random(4)
    rows = [("hot" if i % 3 == 0 else f"k{i % 7}", rng.gauss(0, 1)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r for r in box_stats(df, "k", "v").collect()}
    out = {r["k"]: r["count"] for r in iqr_outliers(df, "v", "k").groupBy("k").count().collect()}
    for k in {k for k, _ in rows}:
        x = np.array([v for key, v in rows if key == k])
        q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        inside = (x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))
        assert np.allclose([got[k][c] for c in ("q1", "median", "q3")], [q1, q2, q3], rtol=1e-12)
        assert got[k]["whisker_lo"] == x[inside].min() and got[k]["whisker_hi"] == x[inside].max()
        assert got[k]["n_outliers"] == (~inside).sum() == out.get(k, 0)
    assert W.exact_quantiles(df, "k", "v", [0.5]).count() == len(got)
