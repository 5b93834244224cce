"""N-gram Jaccard join, components, top-k search, classifiers, pipeline."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.llm import jaccard_join, quality, queries, topk, toxicity
from lodestar.llm.components import components
from tests.conftest import SF_MID, SF_SMALL


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


# --- components

@pytest.mark.parametrize("kind", ["chain", "star", "random", "zigzag"])
def test_components(spark, kind):
    rng = random.Random(4)
    links = {"chain": [(i, i + 1) for i in range(40)], "star": [(50, i) for i in range(50)],
             "zigzag": [(i, 100 - i) for i in range(50)] + [(100 - i, i + 1) for i in range(49)],
             "random": [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(70)]}[kind]
    want = Union()
    for a, b in links:
        want.join(a, b)
    got = {r["node"]: r["component"] for r in components(
        spark.createDataFrame(links + links[:3], "u long, v long")).collect()}
    nodes = {x for link in links for x in link}
    assert {n: got.get(n, n) for n in nodes} == {n: want.find(n) for n in nodes}


# --- Jaccard join

def brute_components(docs, n, percent):
    sets = []
    for d, t in docs:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()))
    u = Union()
    for i, (d, _) in enumerate(docs):
        for j in range(i):
            if d is None or docs[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                u.join(d, docs[j][0])
    return sorted((d is None, d or 0, len(s), None if d is None else u.find(d))
                  for (d, _), s in zip(docs, sets, strict=True))


def near_texts(seed, groups=12, longest=160):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randint(0, 30))
    docs = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(1, longest))]
        for _ in range(rng.randint(1, 6)):
            ws = list(base)
            for _ in range(rng.randint(0, max(1, len(ws) // 25))):
                at = rng.randrange(len(ws) + 1)
                ws[at:at + rng.randint(0, 1)] = [word() for _ in range(rng.randint(0, 1))]
            docs.append((len(docs) * 3, " ".join(ws)))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("n,percent,tile", [(3, 90, 256), (5, 80, 3)])
def test_join_against_brute_force(make, n, percent, tile):
    docs = near_texts(n)
    docs += [(1, None), (2, ""), (4, " \t\n"), (5, "One"), (7, "one"), (8, "one two"),
             (None, docs[0][1]), (None, None), (docs[3][0], docs[3][1]), (docs[4][0], docs[8][1]),
             (10, docs[0][1].upper())]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"])
                 for r in jaccard_join.join_components(make(docs), n, percent, tile=tile).collect())
    assert got == brute_components(docs, n, percent)


def test_many_near_copies_that_hardly_link(make, monkeypatch):
    """2,000 copies of one text, each with four words changed, without the
    text itself: all meet, most pairs do not link. Candidates stay near the
    number of copies, and no link is lost."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(200)]
    docs, sets = [], []
    for i in range(2000):
        ws = list(base)
        for at in rng.sample(range(200), 4):
            ws[at] = f"x{rng.randint(0, 40)}"
        docs.append((i, " ".join(ws)))
        sets.append({hash(tuple(ws[j:j + 3])) for j in range(198)})
    column = {h: k for k, h in enumerate(set().union(*sets))}
    held = np.zeros((len(docs), len(column)), np.float32)
    for i, x in enumerate(sets):
        held[i, [column[h] for h in x]] = 1
    both, sizes = held @ held.T, np.array(list(map(len, sets)))
    u = Union()
    hit = 100 * both >= 90 * (sizes[:, None] + sizes - both)
    for i, j in zip(*np.nonzero(np.triu(hit, 1)), strict=True):
        u.join(int(i), int(j))
    asked = []
    settle = jaccard_join._verified
    monkeypatch.setattr(jaccard_join, "_verified", lambda pairs, *a: (
        asked.append(pairs.count()), settle(pairs, *a))[1])
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.join_components(make(docs)).collect()}
    assert got == {i: u.find(i) for i in range(2000)}
    assert 0 < hit.sum() - 2000 < 0.1 * 2000 * 2000 and sum(asked) < 15 * 2000


def test_every_link_meets_in_a_part():
    """Part keys lose no pair, also where parts are empty or sizes straddle bands."""
    rng = np.random.default_rng(2)
    for percent in (67, 80, 90, 98):
        for size in [*range(2, 40), 57, 83, 120, 300, 700]:
            base = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            most = len(base) * (100 - percent) // 100
            for _ in range(4):
                drop = rng.integers(0, most + 1)
                x = np.sort(np.concatenate([base[drop:], rng.integers(
                    0, 1 << 63, rng.integers(0, most + 1), dtype=np.uint64)]))
                if len(x) and not np.array_equal(x, base) and jaccard_join.linked(base, x, percent):
                    a = jaccard_join.part_keys(base, percent)
                    assert np.intersect1d(a, jaccard_join.part_keys(x, percent)).size
                    size_ = [np.frombuffer(jaccard_join.bitmap(s), np.uint8) for s in (base, x)]
                    least = min(map(len, size_))
                    assert jaccard_join.can_link(*(jaccard_join.fold(s, least) for s in size_),
                                                 len(base), len(x), percent)


def test_op7_query_against_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in small("documents").collect()]
    got = sorted((False, r["doc_id"], r["n_shingles"], r["component_id"])
                 for r in queries.op7_jaccard_join(spark, SF_SMALL).collect())
    assert got == brute_components(docs, 3, 90)


def test_keep_one_per_component(make, spark):
    docs = spark.createDataFrame([(3, "a b c d e f", 1), (2, "A b c d e f", 2), (9, "x", 3),
                                  (None, "a b c d e f", 4)],
                                 "doc_id long, text string, component_id int")
    kept = jaccard_join.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r["component_id"] for r in kept.collect()) == [2, 3, 4]
    assert jaccard_join.join_components(make([])).collect() == []


# --- top-k

def brute_top(rows, k, every):
    clean = [(i, np.floor(np.array(v, np.float64) * 1024).astype(np.int64)) for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, x in {(i, tuple(v)): (i, v) for i, v in clean if i % every == 0}.values():
        scored = sorted((-int(v @ x), i) for i, v in clean if i != q and len(v) == len(x))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.3, 8)]) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(300, 330)]                  # ties
    rows += [(400, None), (410, [None] * 8), (420, [float("nan")] * 8), (430, [float("inf")] * 8),
             (440, [0.5] * 3), (441, [-0.5] * 3), (None, [0.1] * 8), (450, []), (451, []),
             (40, rows[7][1]), (20, rows[20][1]), (460, [0.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    for block_rows, chunk, dropped in ((16384, 16384, 2), (50, 7, 0), (64, 16384, 5)):
        got = topk.top_k(df, 10, 20, block_rows=block_rows, query_chunk=chunk,
                         dropped_slices=dropped).collect()
        assert sorted(tuple(r) for r in got) == brute_top(rows, 10, 20)


def test_top_k_edges(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df).collect() == []
    df = spark.createDataFrame([(0, [1.0], "x"), (1, [2.0], "y")],
                               "vec_id long, embedding array<float>, score string")
    assert [tuple(r) for r in topk.top_k(df).collect()] == [(0, 1, 1, 1024 * 2048)]
    with pytest.raises(Exception, match="quantised component"):
        topk.top_k(spark.createDataFrame([(0, [1e9])], "vec_id long, embedding array<float>")).collect()


# --- classifiers

def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def measured(spark, rows, column):
    truth = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    return [(r, truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]


def test_quality_on_held_out_rows(spark):
    rows = queries.op6_quality(spark, SF_MID).collect()
    assert len(rows) == 1000 and all(r["held_out"] == held(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    told = measured(spark, rows, "quality")
    assert np.mean([r["predicted"] == y for r, y in told]) >= 0.95


def test_toxicity_on_held_out_rows(spark):
    rows = queries.op8_toxicity(spark, SF_MID).collect()
    assert len(rows) == 1000 and all(r["held_out"] == held(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    told = measured(spark, rows, "toxic")
    assert np.mean([r["predicted"] == y for r, y in told]) >= 0.93
    assert not any(r["predicted"] for r, y in told if not y)


@pytest.mark.parametrize("module,column", [(quality, "quality"), (toxicity, "toxic")])
def test_labels_of_held_out_rows_play_no_part(spark, module, column):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    flipped = labels.withColumn(column, F.when(quality.held_out("doc_id"), 1 - F.col(column))
                                .otherwise(F.col(column)))
    a, b = module.train(docs, labels), module.train(docs, flipped)
    assert np.array_equal(a.weights, b.weights)


def test_quality_sample_holds_one_row_per_id(make, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda p, u: seen.append((len(p), len(u))))
    docs = make([(i, f"text of document {i}") for i in range(40)] + [(7, f"more {i}") for i in range(200)])
    quality.train(docs, make([(i, 1) for i in range(0, 40)], "doc_id long, quality int"), sample=300)
    assert seen[0][0] <= 40 and seen[0][1] <= 40


def test_prior_estimate():
    rng = np.random.default_rng(0)
    p = rng.normal(2, 1, 4000)
    u = np.concatenate([rng.normal(2, 1, 2800), rng.normal(-2, 1, 1200)])
    assert abs(quality.class_prior(p, u) - 0.7) < 0.08


def test_label_model_shares_the_votes_of_copies():
    """Ten copies of one poor voter do not outweigh independent good ones."""
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.3
    noisy = np.where(rng.random(4000) < 0.2, ~y, y)
    good = [np.where(rng.random(4000) < 0.1, ~y, y) for _ in range(3)]
    quiet = [~g for g in good]                               # voters for the clean class
    votes = np.column_stack([*[noisy] * 10, *good, *quiet]).astype(float)
    first = np.clip(votes.mean(1), 0.05, 0.95)
    p = toxicity.label_model(votes, first, 0.3)
    alone = toxicity.label_model(votes[:, 9:], first, 0.3)
    assert np.mean((p > 0.5) == y) > 0.93
    assert np.abs(p - alone).mean() < 0.05


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_edges(make, spark, module):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a", "old"), (1, "a", "old"), (None, None, "x"), (2, "", "y")],
                                 "doc_id long, text string, score string")
    assert module.train(docs, labels) is None
    out = module.score(docs, None)
    assert out.columns == ["doc_id", "text", "score", "predicted"] and out.count() == 4
    some = [(i, ("you idiot go " if i % 2 else "fine text ") * 30) for i in range(120)]
    told = spark.createDataFrame(
        [(i, 1 - i % 2, i % 2) for i in range(120)] + [(None, 1, 1), (3, None, None), (0, 0, 1)],
        "doc_id long, quality int, toxic int")
    model = module.train(make([*some, (None, "a"), (500, None), (501, "word " * 50000)]), told)
    rows = module.score(make([(1, None), (2, ""), (None, "a"), (3, "idiot " * 30000)]), model).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r["score"] for r in rows}
    assert by[1] == by[2]
    assert module.score(make([]), model).collect() == []


# --- pipeline

def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as c
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(c.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        if name == "packing":
            break
        assert docs.columns == columns
        after = {r["doc_id"]: r for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "jaccard_join":
            want = brute_components([(d, r["text"]) for d, r in before.items()], 5, 80)
            assert set(after) == {d for _, d, _, c_ in want if d == c_}
        if name == "line_dedup":
            assert set(after) == set(before)
            assert any(after[d]["text"] != before[d]["text"] for d in after)
            assert all(r["n_chars"] == len(r["text"]) for r in after.values())
        counts.append(len(after))
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} == set(after)
    assert sorted(tuple(r) for r in c.run(spark, SF_SMALL).groupBy("doc_id").agg(
        F.sum("length")).collect()) == sorted(tuple(r) for r in docs.groupBy("doc_id").agg(
            F.sum("length")).collect())


def test_pipeline_on_empty_documents(spark):
    import corpus_pipeline as c
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in c.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.collect() == []


def test_entry_lists_the_queries():
    import __spark_entry__ as e
    names = e.queries()
    found = {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))}
    assert found == set(range(1, 14)) and "pipeline" in names
    assert {"op3_decontaminate", "op9_substring_dedup", "op10_topk", "op11_importance",
            "op12_line_rules", "op13_filter_audit"} <= set(e.oracle_sql())
