"""Partitioned upserts, expiry, the newest-first log table, tuned tables."""

import datetime as dt
import os
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from lodestar.plans.registry import load_all
from lodestar.sources import files as IO
from tests.conftest import SF_SMALL

COLS = "k long, v string, version int, ts timestamp_ntz, month string"


def _rows(rng, n):
    out = []
    for k in range(n):
        ts = dt.datetime(2024, rng.randint(1, 6), rng.randint(1, 28))
        out.append((k, "old", 1, ts, ts.strftime("%Y-%m")))
    return out


def _names(path):
    return {os.path.join(d, f) for d, _, found in os.walk(path) for f in found if f.endswith(".parquet")}


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    rows = _rows(random.Random(1), 300)
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, COLS).write.partitionBy("month").parquet(path)
    before = _names(path)
    changes = [(k, "new", 2, ts, m) for k, _, _, ts, m in rows if m in ("2024-02", "2024-05") and k % 3 == 0]
    changes += [(900, "add", 2, dt.datetime(2024, 7, 1), "2024-07")]        # a new partition
    changes += [(rows[0][0], "stale", 0, rows[0][3], rows[0][4])]           # older than what is there
    touched = IO.upsert_partitions(path, spark.createDataFrame(changes, COLS), ["k"], "version", ["month"])
    want_parts = {m for *_, m in changes}
    assert {p for (p,) in touched} == want_parts
    after = _names(path)
    kept = {f for f in before if re.search(r"month=([^/]+)", f)[1] not in want_parts}
    assert kept and kept <= after                                           # same files, same names
    assert not {f for f in before - kept} & after
    want = {r[0]: r[1] for r in rows} | {c[0]: c[1] for c in changes if c[1] != "stale"}
    got = spark.read.schema(COLS).parquet(path).collect()
    assert {r["k"]: r["v"] for r in got} == want and len(got) == len(want)
    assert IO.upsert_partitions(path, spark.createDataFrame([], COLS), ["k"], "version", ["month"]) == []
    assert _names(path) == after


def test_upsert_with_two_partition_columns_and_nulls(spark, tmp_path):
    schema = "k long, v string, version int, a string, b int"
    rows = [(i, "old", 1, ["x", None][i % 2], [1, 2, None][i % 3]) for i in range(30)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, schema).write.partitionBy("a", "b").parquet(path)
    changes = [(i, "new", 2, *rows[i][3:]) for i in (0, 5, 11)]
    IO.upsert_partitions(path, spark.createDataFrame(changes, schema), ["k"], "version", ["a", "b"])
    got = spark.read.schema(schema).parquet(path).collect()
    assert {r["k"]: r["v"] for r in got} == {i: "new" if i in (0, 5, 11) else "old" for i in range(30)}
    with pytest.raises(ValueError):
        IO.partitions_of(spark.createDataFrame(rows, schema), ["a", "b"], most=2)


def test_expiry_deletes_old_and_rewrites_one(spark, tmp_path):
    rows = _rows(random.Random(2), 200)
    path = str(tmp_path / "t")
    df = spark.createDataFrame(rows, COLS)
    df.write.partitionBy("month").parquet(path)
    before = _names(path)
    cut = dt.datetime(2024, 3, 15)
    assert IO.expire_partitions(spark, path, df.schema, "month", "ts", ("2024-03", cut)) == (2, 1)
    got = {r["k"] for r in spark.read.schema(COLS).parquet(path).collect()}
    assert got == {r[0] for r in rows if r[3] > cut}
    later = {f for f in before if "month=2024-03" not in f and re.search("month=2024-0[456]", f)}
    assert later and later <= _names(path)
    # nothing of the edge period is left
    end = dt.datetime(2024, 3, 31)
    assert IO.expire_partitions(spark, path, df.schema, "month", "ts", ("2024-03", end)) == (1, 0)
    assert IO.expire_partitions(spark, path, df.schema, "month", "ts", ("2024-03", end)) == (0, 0)


def _log(spark, slices, n=2000):
    rng = random.Random(3)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randint(0, 30)}",
             dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randint(0, 300)), i) for i in range(n)]
    name = f"newest_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long")
    IO.save_newest_first(df, name, "k", "ts", 8, ["id"], slices=slices)
    want = {}
    for k, ts, i in sorted(rows, key=lambda r: (r[0], -r[1].timestamp(), r[2])):
        want.setdefault(k, []).append((ts, i))
    return name, {(k, r, *x) for k, v in want.items() for r, x in enumerate(v[:4], 1)}


@pytest.mark.parametrize("slices", [1, 5])
def test_newest_n_without_shuffle_or_sort(spark, slices):
    name, want = _log(spark, slices)
    try:
        out = IO.newest_n(spark, name, "k", 4, ["id"], sliced=slices > 1)
        assert {(r["k"], r["rank"], r["ts"], r["id"]) for r in out.collect()} == want
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        if slices == 1:
            assert "Exchange" not in plan and "Sort [" not in plan
            assert "WindowGroupLimit" in plan and "Bucketed: true" in plan
        else:                             # below the candidates nothing moves
            below = plan[plan.rindex("WindowGroupLimit"):]
            assert "Exchange" not in below and "Sort [" not in below
            sizes = [r["n"] for r in spark.table(name).where("k = 'hot'").groupBy("slice").agg(
                F.count("*").alias("n")).collect()]
            assert len(sizes) == 5 and max(sizes) < 2000 / 3 / 2
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_pruning_filter_and_statistics(spark):
    df = load_all()["s_tuned_warehouse"].build(spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan
    scan = [x for x in plan.split("\n") if "FileScan" in x and "lodestar_fact" in x][0]
    assert "PartitionFilters: [isnotnull(month" in scan and "dynamicpruning" in scan
    name = re.search(r"lodestar_fact_\w+", plan)[0]
    stats = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert "rows" in stats["Statistics"]
    column = {r["info_name"]: r["info_value"] for r in
              spark.sql(f"DESCRIBE EXTENDED {name} o_custkey").collect()}
    assert int(column["distinct_count"]) > 0 and column["num_nulls"] == "0"
