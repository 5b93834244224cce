"""Importance resampling, line frequency rules, filter interaction audit."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from lodestar.llm import filter_audit, importance, line_rules, queries
from tests.conftest import SF_SMALL

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def pool_texts(rng, n, pool, longest=60):
    return [" ".join(rng.choice(pool) for _ in range(rng.randint(0, longest))) for _ in range(n)]


# --- importance resampling

def features(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute_resample(docs, target, n, buckets, percent, least, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text, n)[1]))
    for text in target:
        t.update(map(bucket, features(text, n)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        words, found = features(text, n)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets)
                                                / ((s[b] + 1) * (big_t + buckets))))
                     for b in map(bucket, found))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, words, len(found), weight, score, None])
    able = sorted((r for r in rows if r[1] >= least),
                  key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for k, r in enumerate(able[:len(able) * percent // 100], 1):
        r[5] = k
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3])
@pytest.mark.parametrize("head", [0, 3, 1000])
def test_resample_against_brute_force(make, monkeypatch, n, head):
    monkeypatch.setattr(importance, "BLOCK", 40)
    rng = random.Random(n)
    pool = ["the", "The", "of", "ÉTÉ", "été", "x9", "a-b", "🙂ok", "tail%d" % rng.randint(0, 9), "\u0085"]
    texts = pool_texts(rng, 60, pool) + ["", None, "the", " ".join(["the of"] * 400)]
    docs = [(i % 50, t) for i, t in enumerate(texts)] + [(None, "the of " * 15), (None, None)]
    target = [(1, "the of été " * 5), (2, None), (3, "")]
    got = importance.resample(make(docs), make(target), n=n, buckets=37, percent=40, least_words=5,
                              head_size=head, seed="s")
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resample(
        docs, [t for _, t in target], n, 37, 40, 5, "s")


def test_head_and_tail_give_the_same_crc():
    words = [b"of", b"the", b"rare", b"the", b"of"]
    tail = importance.Head([], []).crcs(words, 3, [])
    head = importance.Head([b"the", b"of"], [b"the of", b"of the"]).crcs(words, 3, [])
    assert tail.tolist() == head.tolist() and tail[5] == zlib.crc32(b"of the")
    assert tail[-1] == zlib.crc32(b"rare the of")


def test_frequency_summary_keeps_heavy_words():
    import pyarrow as pa
    text = " ".join(f"w{i} often" for i in range(5000))
    out = list(importance.frequent(1, 50, 64)([pa.RecordBatch.from_pydict({"t": [text, None, ""]})]))
    words = out[0].column(1).to_pylist()
    assert b"often" in words and len(words) <= 5001 + 50      # one block at a time


def test_ranks_of_equal_rows_and_empty_tables(make):
    docs = make([(1, "w " * 30)] * 300 + [(2, "other " * 30)])
    got = importance.resample(docs, make([]), percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 151))
    assert importance.resample(make([]), make([])).collect() == []
    drawn = importance.draw(docs, make([]), percent=50)
    assert drawn.columns == docs.columns and drawn.count() in (1, 300, 301)


def test_resample_keeps_clashing_columns_apart(spark):
    docs = spark.createDataFrame([(1, "a b " * 20, "x", 3, 4, 5.0, "k")],
                                 "doc_id int, body string, text string, `_at` int, RANK int, "
                                 "Weight double, `_part` string")
    got = importance.resample(docs, docs, text_col="body", target_text="body", percent=100)
    assert got.columns == ["doc_id", "text", "_at", "_part", "n_words", "n_features", "weight",
                           "score", "rank"]
    r = got.first()
    assert (r["text"], r["_at"], r["_part"], r["n_words"], r["rank"]) == ("x", 3, "k", 40, 1)


# --- line frequency

def brute_base(text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = defaultdict(list)
    for i in range(len(w) - 2):
        windows[tuple(w[i:i + 3])].append(i)
    hit = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w))


def test_base_metrics_against_brute_force():
    rng = random.Random(3)
    pool = ["a", "bb", "ccc", "é#", "<|>", "\n", "\n", "a\n", "\t", "\u0085", " ", "🙂 ", "\x0b", "\x1c"]
    for text in pool_texts(rng, 300, pool, 90) + [None, "", "\n\n", "a b c a b c", "a a a a"]:
        assert line_rules.base_metrics(text, 50, 50) == brute_base(text), text


def prose(rng, n=60):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))


def corpus():
    """Own prose, a menu line in most pages of host h, pages of menus only,
    exact and near copies, and the same lines on host g, where they are rare."""
    rng = random.Random(1)
    menu, foot = "Home | News 12 | Contact", "All RIGHTS  reserved 2024"
    docs = []
    for i in range(40):
        body = prose(rng) + "\n" + prose(rng)
        docs.append((i, f"{menu}\n{body}\n{foot.replace('2024', str(1990 + i))}", "h"))
    for i in range(40, 43):                                     # little else than menus
        docs.append((i, "\n".join([menu] * 20) + "\n" + prose(rng, 20), "h"))
    page = [prose(rng, 20) for _ in range(10)]
    for i in range(43, 63):                                     # near copies: one line differs
        own = list(page)
        own[i % 10] = prose(rng, 20)
        docs.append((i, "\n".join(own), "h"))
    docs += [(i, docs[0][1], "h") for i in range(63, 90)]       # exact copies
    docs += [(100, f"{menu}\n{prose(rng)}", "g"), (101, f"{menu}\n{prose(rng)}", "g")]
    docs += [(200, None, None), (201, "", "h"), (201, "", "h")]
    return docs


SCHEMA = "doc_id long, text string, source string"


@pytest.mark.parametrize("held", [1000, 0])
def test_boilerplate_goes_copies_stay(make, held):
    docs = corpus()
    out = line_rules.apply_rules(make(docs, SCHEMA), most_repeat=100, held=held).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(docs)
    for i in (*range(40), *range(63, 90)):
        assert got[i]["kept"] and got[i]["n_boilerplate_lines"] == 2
        assert got[i]["kept_text"] == "\n".join(got[i]["text"].split("\n")[1:-1])
    for i in range(40, 43):
        assert not got[i]["kept"] and not got[i]["base_failed"]
        assert got[i]["n_boilerplate_words"] == 120
    for i in (*range(43, 63), 100, 101):
        assert got[i]["kept"] and got[i]["kept_text"] == got[i]["text"]
    for i in (200, 201):
        assert not got[i]["kept"] and got[i]["kept_text"] == got[i]["text"]
    for i, text, _ in docs:
        assert tuple(got[i][c] for c in line_rules.BASE)[:5] == brute_base(text)[:5]


def test_line_rules_edges(make, spark):
    assert line_rules.apply_rules(make([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(1, "a " * 60 + "\n" + "b c d " * 9000, None, 7, 8, "x")],
                                 SCHEMA + ", KEPT int, `_keys` int, `_body` string")
    out = line_rules.apply_rules(docs, held=0)
    assert out.columns[:5] == ["doc_id", "text", "source", "_keys", "_body"]
    r = out.first()
    assert (r["n_words"], r["_keys"], r["_body"], r["base_failed"]) == (27060, 8, "x", True)


# --- filter audit

def brute_audit(rows, names, outcomes):
    """rows: (part, flags by name, outcomes by name)."""
    parts = sorted({p for p, _, _ in rows})
    out = {}
    for part in parts:
        mine = [(f, o) for p, f, o in rows if p == part]
        total = Counter()
        for order in itertools.permutations(names):
            left = mine
            for step, own in enumerate(order, 1):
                gone = [x for x in left if x[0][own]]
                left = [x for x in left if not x[0][own]]
                fails = sum(f[own] for f, _ in mine)
                alone = sum(f[own] and sum(f.values()) == 1 for f, _ in mine)
                lost = [sum(o[k] for _, o in gone) for k in outcomes]
                out[part, "".join(order), step] = [len(left), len(gone), fails - len(gone), alone, *lost]
                total[own] += len(gone)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def brute_flags(docs, labels):
    rows = []
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, text, source in docs:
        w = re.findall("[^\x20\x09-\x0d]+", text or "")
        t = text or ""
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
             "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i}
        mine = [x for x in labels if x[0] is not None and x[0] == i]
        rows.append((source or "", f, {"good": any(q == 1 for _, q, _ in mine),
                                       "toxic": any(x == 1 for _, _, x in mine)}))
    return rows


def test_audit_against_brute_force(make):
    rng = random.Random(9)
    docs = []
    for i in range(120):
        n = rng.choice([5, 150, 250])
        words = [rng.choice(["x", "y"]) if rng.random() < rng.choice([0.2, 0.9]) else f"w{j}"
                 for j in range(n)]
        text = rng.choice(["", "A " * 30, "#", "|"]) + rng.choice([" ", "\x0b", "\u0085"]).join(words)
        docs.append((i, text, rng.choice(["s", "t", "", None])))
    docs += [(i + 200, docs[i][1], "s") for i in range(0, 60, 2)] + [docs[3]] * 4
    docs += [(None, docs[0][1], "s"), (None, None, None), (300, None, "t"), (301, "", "t")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 300, 3)]
    labels += [(0, 1, 1), (None, 1, 1)]
    got = filter_audit.audit_documents(make(docs, SCHEMA), make(
        labels, "doc_id long, quality int, toxic int"))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant",
                           "unique_fails", "good_lost", "toxic_lost", "shapley"]
    want = brute_audit(brute_flags(docs, labels), list("ABCDE"), ["good", "toxic"])
    rows = got.collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in rows} == want and len(rows) == len(want)


def test_audit_of_other_filters(make):
    rows = make([("p", True, False, 3), ("p", True, True, 2), ("p", False, False, 1)],
                "part string, X boolean, Y boolean, n long")
    got = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.audit(rows, "part", ["X", "Y"], {}).collect()}
    assert got == {("p", "XY", 1): (1, 5, 0, 3, 8), ("p", "XY", 2): (1, 0, 2, 0, 2),
                   ("p", "YX", 1): (4, 2, 0, 0, 2), ("p", "YX", 2): (1, 3, 2, 3, 8)}
    with pytest.raises(ValueError):
        filter_audit.audit(rows, "part", list("ABCDEFG"), {})


def test_audit_of_nothing(make):
    empty = make([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_documents(make([], SCHEMA), empty).collect() == []
    got = filter_audit.audit_documents(make([(1, "a", "s")], SCHEMA), empty).collect()
    assert len(got) == 600 and {r["removed"] for r in got} <= {0, 1}


# --- registered SQL

@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_registered_sql(spark, duck, name):
    """Every SQL of the subpackage, against its query."""
    got = queries.QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(map(repr, cur.fetchall()))
    assert sorted(repr(tuple(r)) for r in got.select(*names).collect()) == want


def test_duckdb_crc_is_zlibs():
    sql = queries.ORACLE_SQL["op11_importance"]
    con = duckdb.connect()
    con.execute("create table documents as select 1 as doc_id, 'abc été abc' as text")
    con.execute("create table benchmark as select 1 as item_id, 'abc' as text")
    got = con.execute(sql[:sql.index("c AS (\n")].rstrip().rstrip(",") + " SELECT x, bucket FROM word").fetchall()
    assert sorted(got) == sorted((w, zlib.crc32(w.encode()) % 10000) for w in ("abc", "été"))
