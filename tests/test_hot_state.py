"""Hot state (snapshot plus deltas), recovery and rule monitoring."""

import random

import pytest
from pyspark.sql import functions as F

from lodestar.session import scratch_dir
from lodestar.streaming import ops as K
from lodestar.streaming.state import HotState
from tests.conftest import SF_SMALL

SCHEMA = "k string, v long"


@pytest.fixture
def state(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    return HotState(spark, f"file://{tmp_path}/state", df.schema, ["k"])


def view(state):
    return {r["k"]: r["v"] for r in state.read().collect()}


def test_any_history_reads_as_the_last_change_of_each_key(spark, state):
    rng = random.Random(2)
    want = {}
    for epoch in range(12):
        rows = {f"k{rng.randint(0, 8)}": epoch * 100 + i for i in range(rng.randint(0, 4))}
        want |= rows
        batch = spark.createDataFrame(list(rows.items()), SCHEMA)
        state.apply(batch, epoch)
        if epoch % 3 == 0:                      # a replay, also of an epoch that was compacted
            state.apply(batch, epoch)
        assert view(state) == want
    # history is folded away: what is left is bounded by the state and the changes since
    generations = state._markers()
    assert len(generations) == 2 and len(state._names("snapshots")) == 2
    assert min(int(n[6:]) for n in state._names("deltas")) > generations[1][1]["epoch"]


def test_read_during_compaction(spark, state):
    state.ratio = 1e9                                           # compacted by hand
    state.apply(spark.createDataFrame([("a", 1), ("b", 1)], SCHEMA), 0)
    state.apply(spark.createDataFrame([("a", 2)], SCHEMA), 1)
    before = state.read()
    snapshot = state.write_snapshot(1)                          # written, not committed
    assert state.marker() is None and view(state) == {"a": 2, "b": 1}
    state.apply(spark.createDataFrame([("c", 3)], SCHEMA), 2)   # meanwhile
    state.commit(snapshot, 1)
    assert view(state) == {"a": 2, "b": 1, "c": 3}
    state.vacuum()
    # a reader that looked before the commit still finds its files
    assert {r["k"]: r["v"] for r in before.collect()} == {"a": 2, "b": 1}
    state.commit(state.write_snapshot(2), 2)
    state.vacuum()
    assert view(state) == {"a": 2, "b": 1, "c": 3}
    assert sorted(state._names("deltas")) == ["epoch=2"]


def test_a_lost_compaction_is_invisible(spark, state):
    state.ratio = 1e9
    state.apply(spark.createDataFrame([("a", 1)], SCHEMA), 0)
    state.write_snapshot(0)                                     # the run ends here
    spark.createDataFrame([("a", 9)], SCHEMA).where("false").write.parquet(
        f"{state.path}/commits/generation=0")                   # or with a commit under way
    again = HotState(spark, state.path, state.schema, ["k"], ratio=1.0)
    assert view(again) == {"a": 1}
    again.apply(spark.createDataFrame([("a", 5)], SCHEMA), 1)
    assert view(again) == {"a": 5} and again.marker()["epoch"] == 1


def test_a_read_costs_the_state_not_its_history(spark, state):
    for epoch in range(8):
        state.apply(spark.createDataFrame([(f"k{i}", epoch) for i in range(5)], SCHEMA), epoch)
    marker = state.marker()
    rows = state._deltas(marker["epoch"]).count() + marker["rows"]
    assert rows <= 10 and view(state) == {f"k{i}": 7 for i in range(5)}


def test_windows_that_closed_drop_late_rows(spark):
    """Late rows are in the landing data, and the live counts miss exactly
    those whose window had closed."""
    from lodestar.plans.registry import load_all
    from lodestar.plans.streaming_plans import _phases
    from lodestar.tables import Tables
    e = _phases(Tables(spark, SF_SMALL).events)
    assert {r["_own"] for r in e.select("_own").distinct().collect()} == {0, 1, 2}
    assert e.where("event_id % 50 = 0 and _own < 2").count() > 0
    assert load_all()["k_rule_alerts"].build(spark, SF_SMALL).count() > 0


def test_open_windows_reads_only_what_is_open(spark):
    rows = spark.createDataFrame(
        [("2024-01-01 00:30:00", "a", 1.0), ("2024-01-01 05:10:00", "a", 1.0),
         ("2024-01-01 06:00:00", "b", 2.0)], "t string, event_type string, value double").select(
        F.col("t").cast("timestamp_ntz").alias("ts"), "event_type", "value")
    base = scratch_dir(spark, "open-windows")
    rows.write.mode("overwrite").parquet(base)
    landed = spark.read.parquet(base)
    out = K.open_windows(landed, "2024-01-01T05:30:00.000Z", "1 hour")
    got = sorted((str(r["w"]["start"]), r["event_type"], r["n"]) for r in out.collect())
    assert got == [("2024-01-01 05:00:00", "a", 1), ("2024-01-01 06:00:00", "b", 1)]
    assert K.open_windows(landed, None, "1 hour").count() == 3


def test_rules_of_one_window(spark):
    base = spark.createDataFrame([("a", 10.0, 2.0, 5.0, 1.0), ("b", 10.0, None, 5.0, None)],
                                 "event_type string, mean_n double, std_n double, mean_value double, "
                                 "std_value double")
    w = spark.createDataFrame([("a", 15, 75.0), ("a", 10, 50.0), ("a", 4, 40.0), ("b", 99, 1.0),
                               ("c", 1, 1.0)], "event_type string, n long, total double")
    w = w.withColumn("w", F.struct(F.lit("2024-01-01").cast("timestamp").alias("start")))
    got = sorted((r["event_type"], r["n"], r["rule"]) for r in K.rule_alerts(w, base).collect())
    assert got == [("a", 4, "count_low"), ("a", 4, "value_shift"), ("a", 15, "count_high"),
                   ("c", 1, "unknown_type")]
