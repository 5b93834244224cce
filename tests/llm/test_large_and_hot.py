"""Hot ids, large components, large benchmarks, bounds of samples and broadcasts."""

import contextlib
import os
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import common, decontaminate, jaccard_join, line_dedup, sharding, topk, toxicity
from lodestar.llm.common import read_table
from lodestar.llm.components import components

SF = "/root/testdata/sf0.01"


def test_rows_of_a_hot_id_spread_over_the_buckets_of_their_shard(make):
    rows = [(1 if i % 3 == 0 else i, f"text {i} " * 5) for i in range(900)]
    out = sharding.shard_records(make(rows), 2, bucket_bytes=600).collect()
    by = defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values()) and len(out) == 900
    hot = [r for r in out if r["doc_id"] == 1]
    assert len({r["shard"] for r in hot}) == 1
    slots = sorted(r["slot"] for r in hot)
    n = len(by[hot[0]["shard"]])
    assert slots[0] < n // 20 and slots[-1] > n - n // 20
    assert max(np.diff(slots)) < 40


@pytest.mark.parametrize("characters", [decontaminate.CHARACTERS, 50])
def test_windows_of_word_numbers_against_brute_force(characters):
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(200)]
    items = sorted((f"q{i}", " ".join(rng.choices(pool[:60], k=rng.randint(0, 12)))) for i in range(200))
    windows = decontaminate.Windows(items, 3, characters)
    assert windows.width == (1 if characters > 60 else 2)
    for _ in range(200):
        words = rng.choices(pool[:70], k=rng.randint(0, 80))
        hit, found = set(), set()
        for item, text in items:
            w = text.split()
            n = min(3, len(w))
            for i in range(max(1, len(w) - 2) if w else 0):
                for j in range(len(words) - n + 1):
                    if words[j:j + n] == w[i:i + n]:
                        hit |= set(range(j, j + n))
                        found.add(item)
        n_words, spans, got = decontaminate.scan(windows, " ".join(words))
        assert n_words == len(words) and got == found
        assert {k for a, b in spans for k in range(a, b)} == hit


def test_characters_are_distinct_and_no_surrogates():
    some = [0, 1, 0xD7FE, 0xD7FF, 0xD800, 0xFFFF, decontaminate.CHARACTERS - 1]
    codes = [ord(decontaminate.character(i)) for i in some]
    assert codes == sorted(set(codes)) and codes[0] == 1 and codes[-1] == 0x10FFFF
    assert not any(0xD800 <= c < 0xE000 for c in codes)


def test_automaton_of_a_large_benchmark_is_bounded():
    """At most 100 bytes of states for a byte of text: a block of 4 MB stays
    below 400 MB in each worker."""
    rng = random.Random(4)
    pool = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 10))) for _ in range(20_000)]
    items = [(i, " ".join(rng.choices(pool, k=100))) for i in range(300)]
    size = sum(len(t) for _, t in items)
    assert decontaminate.Windows(items, 10).automaton.get_stats()["total_size"] < 100 * size


def test_item_ids_of_any_type_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "zero one two three", "mine", 7, "a"), (2, "nothing here", "yours", 8, "b")],
        "doc_id long, text string, items string, n_words int, HIT_WORDS string")
    bench = spark.createDataFrame([("q-9", "one two"), ("q-10", "two three"), (None, "zero")],
                                  "item_id string, text string")
    out = {r["doc_id"]: r for r in decontaminate.find_hits(docs, bench, window=2).collect()}
    assert out[1]["items"] == ["q-10", "q-9"] and out[2]["items"] == []
    split = decontaminate.find_hits(docs, bench, window=2, block_bytes=8).collect()
    assert {r["doc_id"]: r["items"] for r in split} == {1: ["q-10", "q-9"], 2: []}
    kept = decontaminate.drop_contaminated(docs, bench, window=2)
    assert kept.schema == docs.schema
    assert [tuple(r) for r in kept.collect()] == [(2, "nothing here", "yours", 8, "b")]


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(0, 20_000, (120, 4)).round(3)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<double>")
    q = np.floor(vectors * 1024).astype(int).tolist()
    want = []
    for i in range(0, 120, 10):
        best = sorted((-sum(a * b for a, b in zip(q[i], q[j], strict=True)), j)
                      for j in range(120) if j != i)[:5]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    got = topk.top_k(df, 5, 10, block_rows=32).collect()
    assert sorted(map(tuple, got)) == want


def test_top_k_says_if_scores_do_not_fit(spark):
    df = spark.createDataFrame([(0, [4e6]), (1, [4e6])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="fit in a long"):
        topk.top_k(df).collect()


def test_toxic_scores_keep_their_scale_when_the_sample_is_bounded(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")

    def scores(**kw):
        out = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, labels, **kw))
        return {r["doc_id"]: (r["score"], r["predicted"]) for r in out.collect()}

    whole, half = scores(), scores(clean_sample=400)
    away = np.array([abs(whole[d][0] - half[d][0]) for d in whole])
    assert away.mean() < 0.02
    assert np.mean([whole[d][1] != half[d][1] for d in whole]) < 0.01


def test_weights_count_as_repeated_rows():
    rng = np.random.default_rng(2)
    votes = (rng.random((300, 6)) < 0.2).astype(float)
    target = (votes[:, :3].any(1) * 0.8) + 0.1
    times = rng.integers(1, 4, 300)
    twice = np.repeat(np.arange(300), times)
    a = toxicity.label_model(votes, target, 0.3, weight=times.astype(float))
    b = toxicity.label_model(votes[twice], target[twice], 0.3)
    assert np.allclose(a[twice], b)
    x = toxicity.fit_linear(votes, target, weight=times / times.mean())
    assert np.allclose(x, toxicity.fit_linear(votes[twice], target[twice]), atol=1e-6)


def test_one_step_of_the_label_model_in_plain_python():
    votes, prior = [[1, 0], [1, 1], [0, 1], [0, 0]], 0.25
    first = [0.9, 0.8, 0.3, 0.1]
    logit = [float(np.log(prior / (1 - prior)))] * 4
    for j in range(2):
        a1 = (sum(p * v[j] for p, v in zip(first, votes, strict=True)) + 0.5 * prior) / (sum(first) + 1)
        a0 = (sum((1 - p) * v[j] for p, v in zip(first, votes, strict=True)) + 0.5 * (1 - prior)) / (
            4 - sum(first) + 1)
        logit = [z + v[j] * float(np.log(a1 / a0)) for z, v in zip(logit, votes, strict=True)]
    # a model of one round uses the first fit's posteriors only to tie votes
    got = toxicity.label_model(np.array(votes, float), np.array(first), prior, rounds=1)
    assert np.allclose(got, 1 / (1 + np.exp(-np.array(logit))))


def test_broadcasts_are_bounded_by_rows_and_items(spark, monkeypatch):
    ids = spark.createDataFrame([(1, [1, 2, 3]), (2, None), (3, [4])], "id long, places array<int>")
    assert common.is_small(ids)
    monkeypatch.setattr(common, "BROADCAST_ITEMS", 3)
    assert not common.is_small(ids) and common.is_small(ids.select("id"))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 2)
    assert not common.is_small(ids.select("id"))
    big = spark.createDataFrame([(1, "a"), (3, "b"), (4, "c")], "id long, text string")
    got = common.join_by_id(big, ids, "id")
    assert sorted((r["id"], r["text"], r["places"]) for r in got.collect()) == [
        (1, "a", [1, 2, 3]), (3, "b", [4])]


def test_line_stage_keeps_clashing_columns(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(i, f"own words of document number {i}\nClick here to read more of this", "mine", i)
            for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines string, n_dropped int")
    out = pipeline.line_dedup_stage(spark, docs, SF)
    assert out.schema == docs.schema
    got = {r["doc_id"]: r for r in out.collect()}
    assert all((got[i]["n_lines"], got[i]["n_dropped"]) == ("mine", i) for i in range(6))
    assert got[5]["text"] == "own words of document number 5"


def test_written_tables_leave_no_shuffle_files_and_can_go(spark):
    """The pipeline kept the shuffles and helper tables of every stage to its end."""
    before = spark.conf.get(common.CLEANUP)
    with common.written_tables() as tables:
        first = common.materialise(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "one")
        second = common.materialise(first.groupBy("count").agg(F.count("k").alias("n")), "two")
    assert spark.conf.get(common.CLEANUP) == before and len(tables) == 2
    common.delete_tables(spark, tables[:-1])
    assert [os.path.exists(p.removeprefix("file:")) for p in tables] == [False, True]
    assert sum(r["n"] for r in second.collect()) == 7
    common.materialise(second, "three")
    assert len(tables) == 2


def test_pipeline_keeps_only_what_the_last_stage_reads(spark, monkeypatch):
    pipeline = pytest.importorskip("corpus_pipeline")
    written, whole = [], pipeline.written_tables

    @contextlib.contextmanager
    def noted():
        with whole() as tables:
            yield tables
        written.append(list(tables))
    monkeypatch.setattr(pipeline, "written_tables", noted)
    assert pipeline.run(spark, SF).count() > 0
    assert len(written) == 4
    left = [p for tables in written for p in tables if os.path.exists(p.removeprefix("file:"))]
    assert left == [written[-1][-1]]


@pytest.mark.parametrize("operator", [jaccard_join.join_components, line_dedup.drop_recurring_lines])
def test_operators_leave_only_what_their_result_reads(spark, small, operator):
    """Each left all its helper tables on disk until the session ended."""
    with common.written_tables() as tables:
        out = operator(small("documents").select("doc_id", "text"))
    assert len(tables) > 5
    assert len([p for p in tables if os.path.exists(p.removeprefix("file:"))]) == 1
    assert out.count() == small("documents").count()


def test_ends_of_few_pairs_are_not_sorted_and_merged(spark, monkeypatch):
    """Every round shuffled the bitmaps and arrays of all classes, twice, and
    the table of components for each join with it."""
    rows = spark.createDataFrame([(1, 10, b"a"), (2, 20, b"b"), (2, 21, b"c"), (3, 30, b"d"), (4, 40, b"e")],
                                 "doc long, size long, bits binary")
    pairs = spark.createDataFrame([(3, 1), (3, 2), (2, 1), (9, 1), (2, 8)], "u long, v long")
    monkeypatch.setitem(jaccard_join.__dict__, "is_small", lambda table: True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = jaccard_join._with_ends(pairs, rows, ["nu", "bu"], ["nv", "bv"])
        plan = found._jdf.queryExecution().toString()
        few = sorted(map(tuple, found.collect()))
        joined = components(pairs)._jdf.queryExecution().toString()
        monkeypatch.setitem(jaccard_join.__dict__, "is_small", lambda table: False)
        many = sorted(map(tuple, jaccard_join._with_ends(pairs, rows, ["nu", "bu"], ["nv", "bv"]).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert few == many and [(r[0], r[1], r[2], r[3]) for r in few] == [
        (2, 1, 20, 10), (2, 1, 21, 10), (3, 1, 30, 10), (3, 2, 30, 20), (3, 2, 30, 21)]
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in joined and "BroadcastHashJoin" in joined
