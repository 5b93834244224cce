"""Token counts, decontamination, packing, line dedup, substring dedup."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lodestar.llm import (
    decontaminate, line_dedup, packing, queries, substring_dedup, token_counts)
from tests.conftest import SF_SMALL

ODD = ["", " ", "a", "don't we'll I'VE 'tis ''s rock'n'roll", "x" * 3000, "1234 ５٣ ½²",
       "<|endoftext|>a<|startoftext|> b <|ENDOFTEXT|>", "ÀÉÎ Σίσυφος ΟΔΟΣ İstanbul ﬁne Å é",
       "日本語のテキスト 中文", "😀👩‍🚀 !?!'s", "a b\u0085c d\x1ce", "tab\tnew\nline\r\f\v."]


@pytest.fixture(scope="module")
def fuzz():
    rng = random.Random(5)
    pool = list("abestrvld''''SRE  \n\t019é.,!?-_<|Σσςİßﬁ①²½\u0085́日本עبريतя😀𝔘") + [
        "<|endoftext|>", "'re", "'ll", " the", "ing "]
    return ODD + ["".join(rng.choice(pool) for _ in range(rng.randint(0, 80))) for _ in range(1500)]


def test_counts_equal_the_library(fuzz):
    path = P.path("word_bpe_49k.json")
    got = token_counts.Compiled(path).counts(fuzz).tolist()
    assert got == [len(e.ids) for e in
                   Tokenizer.from_file(path).encode_batch(fuzz, add_special_tokens=False)]


def test_counts_do_not_depend_on_table_limits(fuzz):
    path = P.path("word_bpe_49k.json")
    tight = token_counts.Compiled(path, max_words=10)
    tight.encoder.max_states = 50
    want = token_counts.Compiled(path).counts(fuzz).tolist()
    assert [int(tight.counts([t])[0]) for t in fuzz] == want


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 128])
def test_word_starts_do_not_depend_on_chunks(chunk):
    classes = np.random.default_rng(1).integers(0, 10, 500).astype(np.uint8)
    classes[-1] = token_counts.SPACE
    whole = token_counts.word_starts(classes, 1000)
    assert (token_counts.word_starts(classes, chunk) == whole).all()


def test_op2_query(spark, small):
    tk = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {}
    for r in small("documents").collect():
        n = len(tk.encode(r["text"] or "", add_special_tokens=False).ids)
        want[r["doc_id"]] = (len((r["text"] or "").encode()), n, n > 2048)
    got = queries.op2_token_counts(spark, SF_SMALL).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want and len(got) == len(want)


def test_op2_edges(make, spark):
    docs = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 6), (2, "hi", 7)],
                                 "doc_id long, text string, N_TOKENS int")
    out = token_counts.count_tokens(docs, P.path("word_bpe_49k.json"), limit=0)
    assert out.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(tuple(r)[2:] for r in out.collect()) == [
        (0, 0, False), (0, 0, False), (0, 0, False), (2, 1, True)]
    assert token_counts.count_tokens(make([]), P.path("word_bpe_49k.json")).collect() == []


# --- decontamination

def brute_hits(text, items, window=10):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item, t in items:
        if item is None:
            continue
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub(
            "[A-Z]", lambda m: m[0].lower(), t or ""))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for j in range(len(words) - n + 1):
                if words[j:j + n] == w[i:i + n]:
                    hit.update(range(j, j + n))
                    found.add(item)
    return len(words), hit, found


def test_decontaminate_against_brute_force(make, spark):
    rng = random.Random(3)
    vocab = ["a", "b", "Ä", "9x", "É"]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", "\n", ", ", "-"])
                             for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 5, 8]))) for i in range(30)] + [
        (None, "a b"), (3, "b b b b"), (40, None), (41, "...")]
    docs = [(i, text(rng.randint(0, 40))) for i in range(60)] + [(None, "a a"), (7, None), (7, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (1 << 20, 40):
        out = decontaminate.find_hits(make(docs), bench, window=4, block_bytes=block_bytes)
        rows = out.collect()
        assert len(rows) == len(docs)
        for r in rows:
            n, hit, found = brute_hits(r["text"], items, 4)
            spans = [range(s["start"], s["stop"]) for s in r["hit_words"]]
            assert (r["n_words"], {k for s in spans for k in s}, set(r["items"])) == (n, hit, found)
            for s, c in zip(r["hit_words"], r["hit_chars"], strict=True):
                got = decontaminate.words_of(r["text"][c["start"]:c["stop"]])
                assert got == decontaminate.words_of(r["text"])[s["start"]:s["stop"]]


def test_decontaminate_edges(make, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c", "x")], "doc_id long, text string, items string")
    out = decontaminate.find_hits(docs, none).first()
    assert (out["n_words"], out["hit_words"], out["items"]) == (3, [], [])
    some = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontaminate.find_hits(make([]), some).collect() == []
    kept = decontaminate.drop_contaminated(make([(1, "Zero ONE, two"), (2, "one"), (3, None)]), some)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    assert kept.columns == ["doc_id", "text"]


# --- packing

def pieces_are_right(rows, texts, window=2048):
    tk = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {d: np.array([*tk.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
           for d, t in texts.items()}
    seen = {d: 0 for d in ids}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["start"] == seen[r["doc_id"]] and len(part) == r["length"] > 0
        assert r["ids_crc32"] == zlib.crc32(part.tobytes())
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        seen[r["doc_id"]] += r["length"]
    assert seen == {d: len(x) for d, x in ids.items()}
    by = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == by.get(r["sequence_id"], 0)
        by[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(0 < n <= window for n in by.values())
    return by


def test_op4_query(spark, small):
    rows = queries.op4_packing(spark, SF_SMALL).collect()
    by = pieces_are_right(rows, {r["doc_id"]: r["text"] for r in small("documents").collect()})
    assert sum(by.values()) >= 0.97 * 2048 * len(by)


def test_packing_cuts_what_nothing_fills(make):
    # all lengths just above half a window: only cutting avoids half-empty sequences
    docs = [(i, "the " * 40) for i in range(30)] + [(99, None), (98, "a <|endoftext|> 日本")]
    out = packing.pack(make(docs), P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"),
                       P.PATTERN, window=64)
    by = pieces_are_right(out.collect(), dict(docs), 64)
    assert sum(by.values()) >= 0.95 * 64 * len(by)
    seqs = packing.sequences(out, 64).collect()
    assert all(len(r["ids"]) == 256 for r in seqs)
    assert sum(r["used"] for r in seqs) == sum(by.values())


def test_packing_edges(make):
    enc = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN
    assert packing.pack(make([]), *enc).collect() == []
    rows = packing.pack(make([(1, "a"), (1, "a"), (None, "b")]), *enc).collect()
    assert len(rows) == 3 and sum(r["length"] for r in rows) == 6


def test_plan_uses_up_the_histogram():
    rng = np.random.default_rng(0)
    for window in (8, 100, 512):
        have = np.zeros(window + 1, np.int64)
        have[1:] = rng.integers(0, 30, window)
        segments, n = packing.plan(have, window)
        fill = np.zeros(n, np.int64)
        used = np.zeros(window + 1, np.int64)
        for length, lo, hi, first, each, _, position in segments:
            used[length] += hi - lo
            for k in range(hi - lo):
                if position < 0:
                    fill[first + k // each] += length
        assert (used[1:] == have[1:]).all()
        assert (fill <= window).all()


def test_encoder_paths_agree():
    enc = packing.Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for t in ODD:
        assert enc.ids(t) == enc.slow.encode(t, add_special_tokens=False).ids, t


# --- line dedup

def test_line_dedup_drops_templates(make):
    own = "own words of document number"
    rows = [(i, f"{own} {w} alpha beta gamma delta\nReleased {2000 + i} under the License\n\nshort one")
            for i, w in enumerate("abcdefg")]
    out = {r["doc_id"]: r for r in line_dedup.drop_recurring_lines(make(rows), most=0.9).collect()}
    assert out[0]["text"] == rows[0][1] and out[0]["n_dropped"] == 0      # the first keeps
    for i in range(1, 7):
        # the own line differs in one stretch only, so it is a template too
        assert (out[i]["n_lines"], out[i]["n_dropped"]) == (4, 2), out[i]
        assert out[i]["text"] == "\nshort one"


def test_line_dedup_keeps_clean_and_copied_documents(make):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(4000)]
    line = lambda: " ".join(rng.sample(words, 12))
    clean = [(i, "\n".join(line() for _ in range(4))) for i in range(40)]
    copies = [(100 + i, clean[0][1]) for i in range(8)]
    out = line_dedup.drop_recurring_lines(make(clean + copies)).collect()
    assert all(r["n_dropped"] == 0 for r in out)


def test_line_dedup_drops_lines_whatever_their_share(make):
    rng = random.Random(2)
    own = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(7))
                           for _ in range(4))
    shared = "this passage of many words recurs in every one of the documents here and is long"
    rows = [(0, "\n".join([shared, *(own() for _ in range(20))]))]
    rows += [(i, f"{own()}\n{shared}") for i in range(1, 7)] + [(7, shared)]
    out = {r["doc_id"]: r["text"] for r in line_dedup.drop_recurring_lines(make(rows)).collect()}
    assert out[0] == rows[0][1]
    assert all(out[i] == rows[i][1].split("\n")[0] for i in range(1, 7))
    assert out[7] == ""                                     # boilerplate alone is no copy


def test_line_dedup_finds_word_fields_at_any_place(make):
    names = ["Alice", "Bob", "Carol", "Dave", "Eve", "Frank"]
    places = ["Travel", "Sports", "Travel", "Food", "Music", "Travel"]
    rng = random.Random(3)
    own = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(7))
                           for _ in range(30))
    rows = [(i, f"{own()}\nPosted by {a} in {b}\n"
                f"This page of {a} was last looked at by readers of {b} and by others\n{own()}")
            for i, (a, b) in enumerate(zip(names, places, strict=True))]
    rows.append((9, own() + "\nPosted by hand under a"))     # same leaf, no such template
    out = {r["doc_id"]: r for r in line_dedup.drop_recurring_lines(make(rows)).collect()}
    assert [out[i]["n_dropped"] for i in (*range(6), 9)] == [0, 2, 2, 2, 2, 2, 0]
    assert out[4]["text"].split("\n") == [rows[4][1].split("\n")[k] for k in (0, 3)]


def test_line_dedup_edges(make, spark):
    line = "All rights of the owner reserved"
    rows = [(i, f"unique {i} x{i} y{i} z{i} q{i} r{i} a{i}\n{line}") for i in range(6)]
    rows += [(None, line), (7, None), (8, ""), (5, line), (5, line)]
    docs = spark.createDataFrame([(*r, "z", "w") for r in rows],
                                 "doc_id long, text string, `_id` string, n_lines string")
    out = line_dedup.drop_recurring_lines(docs, most=1.0)
    assert out.columns == ["doc_id", "text", "_id", "n_lines", "n_dropped"]
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_lines"], r["n_dropped"])
                  for r in out.collect()))
    assert got == [(False, 0, 2, 0), (False, 1, 2, 1), (False, 2, 2, 1), (False, 3, 2, 1),
                   (False, 4, 2, 1), (False, 5, 1, 1), (False, 5, 1, 1), (False, 5, 2, 1),
                   (False, 7, 0, 0), (False, 8, 0, 0), (True, 0, 1, 0)]
    assert line_dedup.drop_recurring_lines(make([])).collect() == []


# --- substring dedup

def brute_removed(docs, window):
    words = [(d, (t or "").replace("\t", " ").split(" ")) for d, t in docs]
    words = [(d, [w for w in ws if w]) for d, ws in words]
    least = {}
    for d, ws in words:
        for i in range(len(ws) - window + 1):
            if d is not None:
                k = tuple(ws[i:i + window])
                least[k] = min(least.get(k, d), d)
    out = []
    for d, ws in words:
        gone = set()
        for i in range(len(ws) - window + 1):
            if d is not None and least[tuple(ws[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d is None, d or 0, len(ws), len(gone), kept))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [60, 1 << 20])
def test_substring_dedup_against_brute_force(make, block_bytes):
    rng = random.Random(block_bytes)
    passage = [rng.choice("abcdefgh") * 2 for _ in range(30)]
    docs = []
    for i in range(50):
        ws = [rng.choice(["a", "b", "c", "dd", "É"]) for _ in range(rng.randint(0, 25))]
        if i % 3 == 0:
            a = rng.randint(0, 15)
            ws[5:5] = passage[a:a + rng.randint(3, 15)]
        docs.append((i, rng.choice([" ", "\t", "  "]).join(ws)))
    docs += [(None, docs[9][1]), (60, docs[12][1]), (60, docs[12][1]), (60, docs[15][1]), (61, None),
             (62, ""), (63, "a " * 40), (64, "a " * 30)]
    out = substring_dedup.drop_repeated_spans(make(docs), window=5, seed_words=2,
                                              block_bytes=block_bytes)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept_text"])
                 for r in out.collect())
    assert got == brute_removed(docs, 5)


def test_substring_dedup_query_against_brute_force(spark, small):
    docs = [(r["doc_id"], re.sub(r"[\n\r\f\v]", " ", r["text"] or ""))
            for r in small("documents").collect()]
    want = {d: (n, m, hashlib.sha256(t.encode()).hexdigest())
            for _, d, n, m, t in brute_removed(docs, 13)}
    got = queries.op9_substring_dedup(spark, SF_SMALL).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want


def test_substring_dedup_verifies_words_behind_equal_hashes(make):
    rng = random.Random(4)
    ws = lambda: " ".join(rng.choice("abcdefgh") * 3 for _ in range(30))
    docs = make([(1, ws()), (2, ws()), (3, ws())])
    rows = docs.select(docs.doc_id.alias("doc"), "text")
    text = {r["doc"]: r["text"] for r in rows.collect()}
    crc = {d: zlib.crc32(t.encode()) for d, t in text.items()}
    spans = docs.sparkSession.createDataFrame(
        [(3, crc[3], 2, 15, 1, crc[1], 4)], substring_dedup.SPAN_TYPES)   # as if hashes were equal
    digest = substring_dedup.with_digests(spans, rows).first()["digest"]
    assert digest == substring_dedup.digest(text[1].encode().split()[4:17])
    assert digest != substring_dedup.digest(text[3].encode().split()[2:15])


@pytest.mark.parametrize("block_bytes", [60, 1 << 20])
def test_substring_dedup_keeps_words_of_false_pairs(make, monkeypatch, block_bytes):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice("abcdefgh") * 3 for _ in range(30))) for i in (1, 2)]

    def weak(rows, *args, real=substring_dedup._edges):
        edges = real(rows, *args)
        return edges and (edges[0] & np.uint64(0), edges[1] * 0, *edges[2:])
    monkeypatch.setattr(substring_dedup, "_edges", weak)
    dealt = list(substring_dedup._deal(5, 2, 4, block_bytes)(iter(
        [pa.RecordBatch.from_pydict({"doc": [1, 2], "text": [t for _, t in docs]})])))
    met = substring_dedup._meet(5)(pa.Table.from_batches(dealt)).to_pylist()
    assert met and all(m["doc"] == 2 and m["src"] == 1 for m in met)
    words = {d: t.encode().split() for d, t in docs}
    spans = [{"start": m["start"], "stop": m["stop"], "digest": substring_dedup.digest(
        words[1][m["src_start"]:m["src_start"] + m["stop"] - m["start"]])} for m in met]
    out = next(substring_dedup._remove("text")(iter([pa.RecordBatch.from_pydict(
        {"text": [docs[1][1]], "removed": [spans]})])))
    assert out.column(out.schema.names.index("n_removed")).to_pylist() == [0]


def test_substring_dedup_edges(make, spark):
    docs = spark.createDataFrame([(1, "a b c", 1, 2)],
                                 "doc_id long, text string, `_id` int, kept_text int")
    out = substring_dedup.drop_repeated_spans(docs)
    assert out.columns == ["doc_id", "text", "_id", "n_words", "n_removed", "removed", "kept_text"]
    assert out.first()["kept_text"] == "a b c" and out.first()["_id"] == 1
    assert substring_dedup.drop_repeated_spans(make([])).collect() == []
