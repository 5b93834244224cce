"""Jaccard join: settled classes are not dealt to later rounds."""

import random

from lodestar.llm import jaccard_join


def test_classes_without_candidates_leave_their_meetings(spark, monkeypatch):
    rng = random.Random(5)
    texts = []
    for g in range(3):
        base = [f"w{g}x{i}" for i in range(400)]
        for _ in range(30):                                  # meet in parts, far from linked or just below
            words = list(base)
            for i in rng.sample(range(400), rng.choice([3, 4, 4, 4, 12, 20, 20, 20])):
                words[i] = f"z{rng.random()}"
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rounds, chosen = [], jaccard_join._chosen

    def noted(apart, *rest):
        rounds.append(apart.count())
        return chosen(apart, *rest)

    monkeypatch.setattr(jaccard_join, "_chosen", noted)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.join_components(docs).collect()}
    sets = [set(zip(w, w[1:], w[2:])) for w in map(str.split, texts)]
    root = list(range(len(texts)))
    for _ in range(len(texts)):
        last = list(root)
        for i, a in enumerate(sets):
            for j in range(i):
                if 100 * len(a & sets[j]) >= 90 * len(a | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
        if root == last:
            break
    assert got == dict(enumerate(root))
    assert len(rounds) > 1 and rounds[1] < 0.7 * rounds[0]
