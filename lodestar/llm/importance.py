"""Target-distribution importance resampling with a head-tail vocabulary.

Features are runs of 1 to ``n`` consecutive words; a feature's bucket is its
CRC-32 modulo ``buckets``. A CRC is a state machine over bytes, so the state
behind a word is computed once: the head (words frequent in the corpus) keeps
these states in a table every worker holds, and frequent pairs keep their whole
CRC. A word or pair that is in neither, the tail, takes the CRC of its bytes.
Both ways give the same number: the head only saves work, so it may come from a
bounded frequency summary, and bucket totals are exact whatever it holds.

Three passes over the texts: one gathers the head, one counts buckets of both
tables, one weighs documents by the buckets' log ratios. Only tables of a
documented size (head, buckets) pass through the driver. The draw ranks scores
by range partitions and their row counts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import materialise, shuffle_partitions, unused, without

OUTPUTS = ("n_features", "weight", "score", "rank")
#: A-Z to lower case; bytes outside words to spaces; the rest unchanged.
WORD_BYTES = bytes(c + 32 if 0x41 <= c <= 0x5A
                   else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A
                   else 0x20 for c in range(256))
#: A text is cut into blocks of about this many bytes, at the end of a word.
BLOCK = 1 << 20


def word_blocks(text: str | None, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of a text, block by block: memory follows the block (or the
    longest word), not the text."""
    data, at = (text or "").encode().translate(WORD_BYTES), 0
    while at < len(data):
        stop = at + block
        if stop < len(data):
            stop = data.find(b" ", stop)
            stop = len(data) if stop < 0 else stop
        yield data[at:stop].split()
        at = stop


class Head:
    """CRC states of frequent words, CRCs of frequent pairs."""

    def __init__(self, words: list[bytes], pairs: list[bytes]):
        self.words = {w: zlib.crc32(w) for w in words}
        self.pairs = {tuple(p.split(b" ")): zlib.crc32(p) for p in pairs}

    def crcs(self, words: list[bytes], n: int, before: list[bytes]) -> np.ndarray:
        """CRCs of all runs of 1 to ``n`` words that end in ``words``;
        ``before`` are the (at most n - 1) words ahead of them."""
        crc, known = zlib.crc32, self.words.get
        run = before + words
        states = [s if (s := known(w)) is not None else crc(w) for w in run]
        out = [np.array(states[len(before):], np.uint32)]
        for size in range(2, n + 1):
            tails = run[size - 1:]
            if size == 2:
                pair = self.pairs.get
                states = [s if (s := pair((a, b))) is not None else crc(b" " + b, state)
                          for a, b, state in zip(run, tails, states, strict=False)]
            else:
                states = [crc(b" " + b, state) for state, b in zip(states, tails, strict=False)]
            # runs that lie within ``before`` were counted with the last block
            out.append(np.array(states[max(0, len(before) - size + 1):], np.uint32))
        return np.concatenate(out)

    def buckets(self, text: str | None, n: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
        """(words, buckets of the features that end there) of each block."""
        before: list[bytes] = []
        for words in word_blocks(text):
            yield len(words), self.crcs(words, n, before) % np.uint32(buckets)
            before = (before + words)[-(n - 1):] if n > 1 else []


def frequent(n: int, room: int, longest: int):
    """Per task: counts of words and pairs of at most ``longest`` bytes, in bounded memory. Beyond ``room``
    entries the count at the middle is taken off all and those at zero go, so
    whatever makes up more than 2 / ``room`` of a task's words stays in."""

    def shrink(found: Counter) -> Counter:
        cut = sorted(found.values())[len(found) // 2]
        return Counter({w: c - cut for w, c in found.items() if c > cut})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Counter(), Counter()]
        for batch in batches:
            for value in batch.column(0):
                last: list[bytes] = []
                for words in word_blocks(value.as_py()):
                    found[0].update(words)
                    if n > 1:
                        found[1].update(map(b" ".join, zip(last + words, (last + words)[1:],
                                                           strict=False)))
                        last = words[-1:] or last
                    for k in (0, 1):
                        if len(found[k]) > room:
                            found[k] = shrink(found[k])
        for k in (0, 1):
            short = {w: c for w, c in found[k].items() if len(w) <= longest}
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(short), pa.int32()), pa.array(list(short), pa.binary()),
                 pa.array(list(short.values()), pa.int64())], names=["k", "word", "n"])
    return run


def head_of(texts: DataFrame, n: int, size: int, longest: int = 64) -> Head:
    """The ``size`` most frequent words and pairs by the tasks' summaries,
    each of at most ``longest`` bytes: at most 2 * size * longest bytes."""
    found = (texts.mapInArrow(frequent(n, 4 * size, longest), "k int, word binary, n long")
             .groupBy("k", "word").agg(F.sum("n").alias("n")))
    lists = [[bytes(r["word"]) for r in found.filter(F.col("k") == k)
              .orderBy(F.col("n").desc(), "word").limit(size).collect()]
             for k in range(min(n, 2))]
    return Head(lists[0], lists[1] if n > 1 else [])


def _totals(head: Head, n: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                for _, found in head.buckets(value.as_py(), n, buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])],
                                         names=["bucket", "n"])
    return run


def bucket_totals(texts: DataFrame, head: Head, n: int, buckets: int) -> np.ndarray:
    """Features of all rows by bucket: each task sends its sums, at most one
    row a bucket; the driver gets one number a bucket."""
    out = np.zeros(buckets, np.int64)
    for r in (texts.mapInArrow(_totals(head, n, buckets), "bucket int, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed target share over its source
    share (one is added to each bucket)."""
    s, t, k = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log(float((b + 1) * (s + k)) / float((a + 1) * (t + k))))
                     for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weigh(head: Head, n: int, gain: np.ndarray):
    """The text is the last column; sums take its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(batch.num_columns - 1):
                words = features = weight = 0
                for some, found in head.buckets(value.as_py(), n, len(gain)):
                    words, features = words + some, features + len(found)
                    weight += int(gain[found].sum())
                rows.append((words, features, weight))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(c, pa.int64()) for c in columns]],
                names=[*batch.schema.names[:-1], "n_words", "n_features", "weight"])
    return run


def gumbel(id_col: Column, seed: str) -> Column:
    """floor of 1000 times a standard Gumbel draw from the id's hash."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(
        id_col.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, eligible: str, order: list[Column], percent: int, rank: str) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, 3... by ``order`` among the first
    ``percent`` in a hundred of the ``eligible`` rows, else null). Rows are
    dealt to ranges of the order, ties further by where they were written, so
    no run of equal rows lands in one task; a row's place is its place in its
    range plus the rows of the ranges before (one number a range)."""
    tie, at, p_, first_ = unused(rows, "_tie", "_at", "_part", "_first")
    fixed = materialise(rows.withColumn(tie, F.monotonically_increasing_id()), "ranked")
    parts = shuffle_partitions(rows.sparkSession)
    by = [F.col(eligible).desc(), *order, F.col(tie)]
    dealt = materialise(
        fixed.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop(tie)
        .withColumn(at, F.monotonically_increasing_id()), "ranges")
    part = F.shiftright(at, 33)
    counts = {r["part"]: (r["n"], r["able"]) for r in dealt.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(eligible).alias("able")).collect()}
    drawn = sum(able for _, able in counts.values()) * percent // 100
    starts, before = [], 0
    for p in sorted(counts):
        starts.append((p, before))
        before += counts[p][0]
    first = rows.sparkSession.createDataFrame(starts, f"`{p_}` long, `{first_}` long")
    place = F.col(first_) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    out = dealt.withColumn(p_, part).join(F.broadcast(first), p_)    # one row a range
    return out.select(*[F.col(f"`{c}`") for c in rows.columns],
                      F.when(F.col(eligible) & (place <= drawn), place).alias(rank))


def resample(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000,
             percent: int = 10, least_words: int = 20, seed: str = "2024",
             head_size: int = 1 << 15, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text") -> DataFrame:
    """One row per row of ``docs``: all its columns but the text, with
    ``n_words``, ``n_features``, ``weight`` (sum of the gains of its features'
    buckets), ``score`` (weight plus a Gumbel draw from the id) and ``rank``:
    of the N rows with ``least_words`` words or more the ``percent`` * N // 100
    of the highest scores are drawn without replacement and numbered from 1,
    ties by id. Input columns of these names are replaced.

    Words are runs of digits, letters and bytes beyond ASCII, A-Z in lower
    case. A null or empty text has no words, no features and weight 0; a null
    id draws as the empty text does and comes last among ties; rows that repeat
    an id share its draw, and equal rows get neighbouring ranks; texts are read
    whole, in blocks. With an empty target, or an empty ``docs``, the gains
    follow from zero counts; an empty ``docs`` gives no rows."""
    body, = unused(docs, "_body")
    df = without(docs, text_col, "n_words", *OUTPUTS)
    rest = [F.col(f"`{c}`") for c in df.columns]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)
    texts = docs.select(F.col(f"`{text_col}`"))
    head = head_of(texts, n, head_size)
    gain = gains(bucket_totals(texts, head, n, buckets),
                 bucket_totals(target.select(F.col(f"`{target_text}`")), head, n, buckets))
    weighed = docs.select(*rest, F.col(f"`{text_col}`").alias(body)).mapInArrow(
        _weigh(head, n, gain), f"{fields}n_words long, n_features long, weight long")
    able, = unused(weighed, "_able")
    scored = weighed.withColumn("score", (F.col("weight") + gumbel(F.col(f"`{id_col}`"), seed))
                                .cast("long")).withColumn(able, F.col("n_words") >= least_words)
    order = [F.col("score").desc(), F.col(f"`{id_col}`").asc_nulls_last(),
             F.col("n_features"), F.col("weight")]
    return ranked(scored, able, order, percent, "rank").drop(able)


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The rows of ``docs`` whose ids are drawn, columns unchanged."""
    ids = (resample(docs, target, id_col=id_col, **kw).filter("rank is not null")
           .select(F.col(f"`{id_col}`")).distinct())
    return docs.join(ids, id_col, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
