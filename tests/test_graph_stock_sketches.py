"""Item relation graph, critical stock, mergeable sketches."""

import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lodestar.operators import business as B
from lodestar.operators import sketches as SK
from lodestar.operators.graph import item_edges, item_graph


@pytest.mark.parametrize("tile", [3, 32])
def test_item_graph_against_brute_force(spark, tile):
    """One basket holds a third of the lines."""
    rng = random.Random(5)
    lines = [(0 if i % 3 == 0 else rng.randint(1, 60), rng.randint(1, 45)) for i in range(600)]
    lines += [(None, 1), (3, None), (99, 7)]
    held = defaultdict(set)
    for k, i in lines:
        if k is not None and i is not None:
            held[k].add(i)
    want = Counter(p for items in held.values() for p in itertools.combinations(sorted(items), 2))
    degree = Counter(i for p in want for i in p)
    df = spark.createDataFrame(lines, "k long, i long").repartition(4)
    got = item_graph(df, "k", "i", tile).collect()
    assert {(r["src"], r["dst"]): r["weight"] for r in got} == want and len(got) == len(want)
    assert all(r["src_degree"] == degree[r["src"]] and r["dst_degree"] == degree[r["dst"]] for r in got)
    assert item_edges(df.limit(0), "k", "i").collect() == []


def test_tile_pairs_spread_one_basket(spark):
    df = spark.range(400).select(F.lit(1).alias("k"), F.col("id").alias("i"))
    out = item_edges(df, "k", "i", 20)
    assert out.count() == 400 * 399 // 2
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_t#" in plan and "_u#" in plan


def test_critical_stock_against_loops(spark):
    rng = random.Random(8)
    rows = []
    for i in range(900):
        k = 0 if i % 3 == 0 else rng.randint(1, 20)
        rows.append((k, rng.randint(0, 80), float(rng.randint(-9, 8)), 10.0 + k))
    df = spark.createDataFrame(rows, "k long, s long, d double, o double").select(
        "k", F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("ts"), "d", "o")
    got = {r["k"]: r for r in B.critical_stock(df, "k", "ts", "d", "o", 0.0).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        at = defaultdict(float)
        for key, s, d, o in rows:
            if key == k:
                at[s] += d
                balance = opening = o
        low, first, lowest, fallen = opening < 0, None, None, 0
        for s in sorted(at):
            balance += at[s]
            lowest = balance if lowest is None else min(lowest, balance)
            if balance < 0:
                first = s if first is None else first
                fallen += not low
            low = balance < 0
        if first is not None:
            want[k] = (first, lowest, fallen)
    assert got.keys() == want.keys() and len(want) > 3
    for k, (first, lowest, fallen) in want.items():
        assert (int(got[k]["first_low"].timestamp()) - 1_700_000_000, got[k]["lowest"],
                got[k]["times_fallen"]) == (first, lowest, fallen)


def test_merged_days_agree_with_the_whole(spark):
    """Merged days estimate what one sketch over all rows estimates; quantiles
    stay within the rank error."""
    rng = random.Random(2)
    rows = [("hot" if i % 3 == 0 else f"k{i % 4}", rng.randint(0, 9), rng.randint(0, 5000), rng.gauss(0, 1))
            for i in range(9000)]
    df = spark.createDataFrame(rows, "k string, day int, u long, v double").repartition(6)
    mart = SK.daily_sketches(df, ["k"], F.col("day"), "u", "v")
    whole = SK.daily_sketches(df, ["k"], F.lit(0), "u", "v")
    a = {r["k"]: r for r in SK.merge_days(mart, ["k"]).collect()}
    b = {r["k"]: r for r in SK.merge_days(whole, ["k"]).collect()}
    assert {k: r["n"] for k, r in a.items()} == {k: r["n"] for k, r in b.items()}
    for k, r in a.items():
        x = sorted(v for key, _, _, v in rows if key == k)
        exact = len({u for key, _, u, _ in rows if key == k})
        assert abs(r["n_distinct"] - exact) <= 4 * SK.distinct_error(12) * exact
        # estimators differ by a sketch's history, but by no more than one error
        assert abs(r["n_distinct"] - b[k]["n_distinct"]) <= SK.distinct_error(12) * exact
        for q in (25, 50, 75):
            rank = sum(v <= r[f"q{q}"] for v in x) / len(x)
            assert abs(rank - q / 100) < 0.02
    some = {r["k"]: r["n"] for r in SK.merge_days(mart, ["k"], 2, 4).collect()}
    assert some == Counter(k for k, d, _, _ in rows if 2 <= d <= 4)


def test_receipts_of_many_parts_are_spread(spark, monkeypatch):
    """All parts in one file partition: their rows per quarter come from many tasks."""
    monkeypatch.setattr(B, "PARTS_PER_TASK", 10)
    part = spark.range(95).coalesce(1).select(F.col("id").alias("p_partkey"), F.lit(3).alias("p_size"))
    line = spark.createDataFrame([(1, 5.0)], "l_partkey long, l_quantity double").withColumn(
        "l_shipdate", F.expr("TIMESTAMP_NTZ '2020-02-03'"))
    out = B.stock_movements(line, part, F.expr("DATE '2020-01-15'"), F.expr("DATE '2020-12-31'"))
    assert out.count() == 95 * 4 + 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 10, true" in plan


def test_pairs_to_recommend_are_compared_in_tasks_by_lines(spark, duck, monkeypatch):
    from lodestar.plans import triples_plans as P
    from lodestar.plans.registry import load_all
    from tests.conftest import SF_SMALL
    monkeypatch.setattr(P, "LINES_PER_TASK", 1000)
    got = P.g_multi_hop_recommend(spark, SF_SMALL)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    lines = duck.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    assert plan.count(f", {-(-lines // 1000)}") == 2 and plan.count("RepartitionByExpression") == 2
    sql = load_all()["g_multi_hop_recommend"].sql
    assert sorted(map(tuple, got.collect())) == sorted(duck.execute(sql).fetchall())
