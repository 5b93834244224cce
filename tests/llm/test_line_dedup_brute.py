"""Line dedup against plain Python that follows its docstring on tuples."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from math import ceil

import pytest

from lodestar.llm import line_dedup, queries
from tests.conftest import SF_SMALL

ANY = "<*>"


def tokens_of(line):
    return [ANY if re.search("[0-9]", t) else t for t in re.findall("[^ \t\r\f\v\n]+", line)]


def stretch_templates(tokens):
    n = len(tokens)
    fixed = lambda x: sum(t != ANY for t in x)
    if fixed(tokens) < 3:
        return set()
    out = {(n, tuple(tokens))}
    for i in range(4 if n >= 8 else 0):
        a, b = (2 + (n - 2) * k // 4 for k in (i, i + 1))
        if fixed(tokens[:a] + tokens[b:]) >= 3:
            out.add((n, tuple(tokens[:a]), a, b, tuple(tokens[b:])))
    return out


def brute(docs, min_docs=5):
    """{row: (lines, dropped lines)} for (id, text) rows."""
    lines, cell_docs = [], defaultdict(set)
    for row, (doc, text) in enumerate(docs):
        if doc is None or not text:
            continue
        for i, line in enumerate(text.split("\n")):
            tokens = tokens_of(line)
            cells = {(len(tokens), *tokens[:2], k, t) for k, t in enumerate(tokens) if t != ANY}
            enough = len(cells) >= max(3, ceil(0.6 * len(tokens) - 1e-9))
            lines.append((row, doc, zlib.crc32(text.encode()), i, tokens, cells if enough else set()))
            for c in cells if enough else ():
                cell_docs[c].add(row)
    holders, keeper, found = defaultdict(set), {}, []
    for row, doc, crc, i, tokens, cells in lines:
        keys = {("stretch", k, row) for k in stretch_templates(tokens)}
        often = {c: len(cell_docs[c]) for c in cells if len(cell_docs[c]) >= min_docs}
        need = max(3, ceil(0.6 * len(tokens) - 1e-9))
        for cut in set(often.values()):
            some = frozenset(c for c, n in often.items() if n >= cut)
            if len(some) >= need:
                keys.add(("field", some, (doc, crc)))
        for kind, k, holder in keys:
            holders[kind, k].add(holder)
            keeper[kind, k] = min(doc, keeper.get((kind, k), doc))
        found.append((row, doc, crc, i, len(tokens), {(kind, k) for kind, k, _ in keys}))
    size, gone, held = defaultdict(int), defaultdict(set), defaultdict(set)
    carriers = defaultdict(set)
    for _, doc, crc, _, n, keys in found:
        for k in keys:
            if len(holders[k]) >= min_docs:
                carriers[k].add((doc, crc))
    for row, doc, crc, i, n, keys in found:
        size[row] += n
        for k in keys:
            if len(holders[k]) >= min_docs:
                held[doc, crc, keeper[k], frozenset(carriers[k])].add((i, n))
                if doc > keeper[k]:
                    gone[doc, crc].add((i, n))
    total = {(d, zlib.crc32(t.encode())): size[r] for r, (d, t) in enumerate(docs) if t}
    most = {k for k, v in held.items() if sum(n for _, n in v) >= 0.8 * total[k[:2]]}
    first = {k[2:] for k in most if k[0] == k[2]}
    copies = {k[:2] for k in most if k[2:] in first}
    out = []
    for doc, text in docs:
        key = (doc, zlib.crc32((text or "").encode()))
        lost = gone.get(key, set()) if doc is not None and text else set()
        if key in copies and sum(n for _, n in lost) > 0.5 * total[key]:
            lost = set()
        all_lines = text.split("\n") if text else []
        drop = {i for i, _ in lost}
        out.append((doc, len(all_lines), len(drop),
                    "\n".join(x for i, x in enumerate(all_lines) if i not in drop) if drop else text))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(make, seed):
    rng = random.Random(seed)
    names = ["Ann", "Bob", "Cy", "Di", "Ed"]
    fields = ["Posted by {} in {} today", "seen {} times by 12 readers of {}",
              "read on {} and more of this and that from {} here",
              "All rights reserved by the {} press"]
    pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9))) for _ in range(12)]
    docs = []
    for i in range(40):
        lines = [" ".join(f"{rng.choice('klmnop')}{rng.choice('qrstu')}" for _ in range(rng.randint(0, 12)))
                 for _ in range(rng.randint(0, 6))]
        lines += rng.sample(pool, rng.randint(0, 3))
        lines += [rng.choice(fields).format(rng.choice(names), rng.choice(names)) for _ in range(rng.randint(0, 3))]
        rng.shuffle(lines)
        docs.append((i, "\n".join(lines)))
    docs += [(100 + i, docs[1][1] + "\nkk kq lr ms") for i in range(7)]
    docs += [(None, docs[0][1]), (200, None), (201, "")]
    got = line_dedup.drop_recurring_lines(make(docs)).collect()
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got), key=repr) \
        == brute(docs)


def test_query_against_brute_force(spark, small):
    docs = [(r["doc_id"], r["text"]) for r in small("documents").collect()]
    want = {d: (n, gone, hashlib.sha256((t or "").encode()).hexdigest())
            for d, n, gone, t in brute(docs)}
    got = queries.op5_line_dedup(spark, SF_SMALL).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got} == want
