"""Edge results of operators: zero divisors, close values, wide money."""

import math

import pytest
from pyspark.sql import functions as F

from lodestar.functions import arrays as X
from lodestar.operators import business as B, charts, clean, profile, sampling
from lodestar.sources import files, generator


def test_std_of_large_values_close_together(spark):
    df = spark.createDataFrame([([1.7e9, 1.7e9 + 1, 1.7e9 + 2],), ([],), ([4.0],)], "a array<double>")
    got = [r.s for r in df.select(X.std_pop("a").alias("s")).collect()]
    assert math.isclose(got[0], math.sqrt(2 / 3), rel_tol=1e-9) and got[1:] == [None, 0.0]


def test_constant_columns_have_no_deviation(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 1.0)], "k string, v double")
    assert {r.z for r in clean.standardize(df, "v", "k").collect()} == {None}
    assert clean.zscore_outliers(df.where("k = 'a'"), "v").collect() == []
    h = charts.histogram(df.where("k = 'a'"), "v", 4).collect()
    assert [(r.bin, r.n, r.density) for r in h] == [(0, 2, None)]


def test_empty_frames(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert [r.n_missing for r in profile.null_counts(df).collect()] == [0, 0]
    assert clean.retention(df, df).first()["pct_kept"] is None
    assert sampling.sample_to_size(df, "k", 5).collect() == []


def test_wide_money(spark):
    df = spark.range(3).select(F.lit("23000000000000000.25").cast("decimal(38,2)").alias("x"))
    assert df.agg(B.money(F.sum("x")).alias("x")).first()["x"] == 6.9e16


def test_readers_do_not_lose_names_or_rows(spark, tmp_path):
    (tmp_path / "h").write_text("a,b,c")
    (tmp_path / "d").write_text("1,2")
    with pytest.raises(ValueError, match="3 header names"):
        files.with_external_header(spark, str(tmp_path / "d"), str(tmp_path / "h"))
    (tmp_path / "j").write_text('{"a": 1}\n{broken')
    rows = files.read_json(spark, str(tmp_path / "j"), "a int, _corrupt_record string").collect()
    assert sorted((r.a is None, r._corrupt_record is None) for r in rows) == [(False, True), (True, False)]
    assert files.read_json(spark, str(tmp_path / "j"), "a int", mode="DROPMALFORMED").count() == 1


def test_rates_beyond_the_table_raise():
    with pytest.raises(ValueError, match="too large"):
        generator.poisson_cdf(5000.0)


def test_unseen_items_with_one_heavy_user(spark):
    from lodestar.ml import models as M
    rows = [(0, i, 1.0) for i in range(60)] + [(u, (u * 7) % 64, 1.0) for u in range(1, 30)] + [
        (u, u % 64, 2.0) for u in range(30, 64)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating float")
    model = M.als(rank=2).fit(ratings)
    users = ratings.select("user").distinct()
    got = M.recommend_unseen(model, ratings, users, 3).collect()
    seen = {(u, i) for u, i, _ in rows}
    n_items = len({i for _, i, _ in rows})
    by = {}
    for r in got:
        assert (r.user, r["item"]) not in seen
        by.setdefault(r.user, []).append(r["rank"])
    for u in {u for u, _, _ in rows}:
        left = n_items - len({i for x, i in seen if x == u})
        assert sorted(by.get(u, [])) == list(range(1, min(3, left) + 1))


def test_unseen_items_are_those_of_mllib(spark, monkeypatch):
    """Every customer was scored against every part several lists long; cells
    of few users and items must give the same items in the same order."""
    import random
    from lodestar.ml import models as M
    rng = random.Random(7)
    rows = sorted({(rng.randrange(70), rng.randrange(90)) for _ in range(900)}) + [(3, i) for i in range(85)]
    rows = [(u, i, float(rng.randrange(1, 4))) for u, i in sorted(set(rows))]
    ratings = spark.createDataFrame(rows, "user int, item int, rating float")
    model = M.als(rank=4).fit(ratings)
    users = ratings.select("user").union(spark.createDataFrame([(999,), (3,)], "user int"))
    monkeypatch.setattr(model, "recommendForUserSubset", None, raising=False)
    for name, value in (("CELL_MOST", 40), ("USERS_AT_ONCE", 16), ("ITEMS_AT_ONCE", 8)):
        monkeypatch.setattr(M, name, value)
    got = M.recommend_unseen(model, ratings.union(ratings), users, 5).collect()
    seen, want = {(u, i) for u, i, _ in rows}, []
    for r in model.recommendForAllUsers(90).collect():
        left = [x for x in r["recommendations"] if (r["user"], x["item"]) not in seen][:5]
        want += [(r["user"], k + 1, x["item"], x["rating"]) for k, x in enumerate(left)]
    assert sorted((r["user"], r["rank"], r["item"], r["score"]) for r in got) == sorted(want)


def test_few_factors_are_dealt_to_cells():
    """At 5.4 million customers and 7.2 million parts, 36 x 27 cells sent 1.4
    billion rows through the shuffle."""
    from lodestar.ml import models as M
    for users, items, cores in ((5_400_000, 7_200_000, 12), (900_000, 1_200_000, 12), (15_000, 20_000, 8),
                                (10, 3_000_000, 4), (3_000_000, 10, 4), (0, 0, 1)):
        down, across = M.cell_grid(users, items, cores, 5)
        assert users <= down * M.CELL_MOST and items <= across * M.CELL_ITEMS
        assert down * across >= min(4 * cores, users / 1_000)
        if min(users, items) > 500_000:
            assert users * across * 6 + items * down < 40 * (users + items) / 2


def test_recommendations_leave_no_ratings_and_few_shuffle_files(spark, tmp_path):
    """The ratings were made again by every step, and ALS kept what all of its
    iterations had shuffled: beyond the disk at 6 GB."""
    import os
    from pyspark.sql import functions as F
    from lodestar.ml import models as M
    from lodestar.plans.registry import load_all
    from lodestar.session import ensure_checkpoint_dir
    n = spark.range(600)
    n.select(F.col("id").alias("l_orderkey"), (F.col("id") * 7 % 40).alias("l_partkey")).write.parquet(
        f"{tmp_path}/lineitem.parquet")
    n.select(F.col("id").alias("o_orderkey"), (F.col("id") % 30).alias("o_custkey")).write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.range(40).select(F.col("id").alias("p_partkey"), F.lit("p").alias("p_name")).write.parquet(
        f"{tmp_path}/part.parquet")
    kept = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(kept))
    out = load_all()["m_als_recommend"].build(spark, str(tmp_path))
    assert not any("lineitem" in f or "orders" in f for f in out.inputFiles())
    new = {f.split("-")[1] for f in set(os.listdir(kept)) - before if f.startswith("als-")}
    assert new == {"users", "items", "places"}
    assert M.als().getCheckpointInterval() == 1
    rows = out.collect()
    seen = {(i % 30, i * 7 % 40) for i in range(600)}
    assert rows and not any((r["o_custkey"], r["l_partkey"]) in seen for r in rows)
    assert len({r["rmse"] for r in rows}) == 1 and {r["p_name"] for r in rows} == {"p"}
