"""Line dedup with a log-template tree.

A line descends a tree of fixed depth: its number of tokens, then its leading
tokens, where a token with a digit counts as a variable field. In the leaf it
meets the lines with the same template: the tokens with variable fields as
wildcards and, for lines of ``general`` tokens or more, also with any one of
four stretches behind the leading tokens as a wildcard. In a leaf that enough
documents reach, lines of every length are also compared position by position:
the tokens of a line are ranked by the documents that hold them at the same
place, and for each rank the more frequent ones are the constants of a
template, the others its variable fields. A template that recurs in ``min_docs`` documents is dropped from all of them but the one with
the smallest id.

Templates are hashed where the text is; counting is one aggregation (combined
before its shuffle) over hashes, and only the lines to drop travel to the
texts. Hashes that recur are broadcast to the lines while they are few; beyond
that the hashes travel with a line's number alone, never with the line.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import discard, is_small, materialise, maybe_broadcast, unused, without
from lodestar.llm.hashing import mix, word_hashes

OUTPUTS = ("n_lines", "n_dropped")
#: Depth of the tree below the token count, and stretches of the tokens behind.
LEADING, STRETCHES = 2, 4
LINE = ["doc", "crc", "line", "size", "total"]
#: Buckets of the leaves in the filter that tells which lines to compare.
LEAF_BITS = 24
_ZERO = np.uint8(0x30)
#: Odd multipliers that keep token counts, leading tokens, places and
#: stretches apart in hashes, and the hash of a variable field.
_N, _LEAD, _PLACE, _CUT, VARIABLE = (np.uint64(x) for x in (
    0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
    0x85EBCA77C2B2AE63))
_POWERS = [np.ones(1, np.uint64)]


def powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        row = np.full(1 << (n - 1).bit_length(), 0xD6E8FEB86659FD93, np.uint64)
        row[0] = 1
        _POWERS[0] = np.cumprod(row)
    return _POWERS[0][:n]


class Lines:
    """The lines of some texts (which begin at ``begin`` in the bytes, each but
    the last with a line feed behind it) that have tokens, as arrays: ``text``
    (which one), ``line`` (number in the text), ``size`` (tokens), ``constant`` (tokens that are no variable
    fields), ``leaf`` (hash of token count and leading tokens); and by token:
    ``words`` (hashes, variable fields all alike), ``variable``, ``row`` (index
    of its line here) and ``place``."""

    def __init__(self, data: bytes, begin: np.ndarray):
        self.words, at = word_hashes(data)
        raw = np.frombuffer(data, np.uint8)
        # digits belong to words, so those up to the next word's start are a word's
        self.variable = np.zeros(len(at), bool)
        self.variable[np.searchsorted(at, np.flatnonzero(raw - _ZERO < 10), side="right") - 1] = True
        self.words = np.where(self.variable, VARIABLE, self.words)
        feeds = np.flatnonzero(raw == 0x0A)
        edges = np.concatenate([[0], np.searchsorted(at, feeds), [len(at)]])
        number = np.flatnonzero(np.diff(edges))              # lines with tokens
        self.start = edges[number]
        self.text = np.searchsorted(begin, at[self.start], side="right") - 1
        self.line = number - np.searchsorted(feeds, begin)[self.text]
        self.size = np.diff(np.append(self.start, len(at)))
        self.row = np.repeat(np.arange(len(self.line)), self.size)
        self.place = np.arange(len(at)) - self.start[self.row]
        self.total = np.bincount(self.text, self.size, len(begin)).astype(np.int64)
        self.fixed = np.concatenate([[0], np.cumsum(~self.variable)])
        self.constant = self.fixed[self.start + self.size] - self.fixed[self.start]
        second = np.where(self.size > 1, self.words[np.minimum(self.start + 1, len(at) - 1)], np.uint64(0)) \
            if len(at) else np.zeros(0, np.uint64)
        self.leaf = mix(self.words[self.start] + second * _LEAD + self.size.astype(np.uint64) * _N)

    def templates(self, general: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(lines x (1 + STRETCHES)) hashes of the lines' templates and which
        of them there are: each has ``least`` constant tokens or more. The
        first has the variable fields as wildcards, the others one of the
        stretches behind the leading tokens too."""
        upto = np.concatenate([[np.uint64(0)], np.cumsum(
            self.words * powers(max(1, int(self.size.max(initial=1))))[self.place], dtype=np.uint64)])
        total = upto[self.start + self.size] - upto[self.start]
        n = self.size.astype(np.uint64) * _N
        keys, there = [mix(total + n)], [self.constant >= least]
        for i in range(STRETCHES):
            a = LEADING + (self.size - LEADING) * i // STRETCHES
            b = LEADING + (self.size - LEADING) * (i + 1) // STRETCHES
            long = self.size >= general
            a, b = (self.start + np.where(long, x, 0) for x in (a, b))
            rest = total - (upto[b] - upto[a]) + n
            keys.append(mix(mix(rest) + np.uint64(i + 1) * _CUT))
            there.append(long & (self.constant >= least)
                         & (self.constant - (self.fixed[b] - self.fixed[a]) >= least))
        return np.stack(keys, 1), np.stack(there, 1)


def first_of(x: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Which entries are the first of their value in their text."""
    out = np.zeros(len(x), bool)
    out[np.unique(mix(x ^ mix(text.astype(np.uint64))), return_index=True)[1]] = True
    return out


def lists(counts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    """Arrow lists of ``counts`` entries each from their joined values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)),
                                    pa.array(values.view(np.int64)))


def longs(x: np.ndarray, kind=np.int64) -> pa.Array:
    return pa.array(x.astype(kind))


def texts_of(batch: pa.RecordBatch, block: int = 1 << 20) -> Iterator[tuple]:
    """(ids, checksums, Lines) of consecutive texts of about ``block`` bytes
    in all (or one longer text)."""
    def done():
        begin = np.cumsum([0, *[len(d) + 1 for d in held[:-1]]])
        return np.array(ids, np.int64), np.array([zlib.crc32(d) for d in held]), Lines(b"\n".join(held), begin)

    ids, held, size = [], [], 0
    for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        data = text.as_py().encode()
        if held and size + len(data) > block:
            yield done()
            ids, held, size = [], [], 0
        ids.append(doc)
        held.append(data)
        size += len(data)
    if held:
        yield done()


def _cells(shared: bytes, least: int, agree: float):
    """Lines in ``shared`` leaves with one hash of (leaf, place, token) for
    each constant token: ``new`` has those not seen before in the document,
    ``again`` the others."""
    bits = np.frombuffer(shared, np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, crc, x in texts_of(batch):              # memory follows a block of texts
                at = (x.leaf & np.uint64((1 << LEAF_BITS) - 1)).astype(np.int64)
                need = np.maximum(least, np.ceil(agree * x.size - 1e-9))
                on = (x.constant >= need) & ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
                if not on.any():
                    continue
                taken = on[x.row] & ~x.variable
                row = x.row[taken]
                cells = mix(x.leaf[row] ^ mix(x.words[taken] + x.place[taken].astype(np.uint64) * _PLACE))
                new = first_of(cells, x.text[row])
                number, k, text = np.cumsum(on) - 1, int(on.sum()), x.text[on]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[text]), longs(crc[text]), longs(x.line[on], np.int32),
                     longs(x.size[on], np.int32), longs(x.total[text], np.int32),
                     lists(np.bincount(number[row[new]], minlength=k), cells[new]),
                     lists(np.bincount(number[row[~new]], minlength=k), cells[~new])],
                    names=[*LINE, "new", "again"])
    return run


def field_templates(counts: np.ndarray, cells: np.ndarray, begin: np.ndarray,
                    need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of the templates of some lines. Line i has the cells
    ``begin[i]`` up to ``begin[i + 1]``, each held by ``counts`` documents; for
    each count, the cells that as many documents or more hold are a template
    if they are ``need[i]`` or more."""
    line = np.repeat(np.arange(len(need)), np.diff(begin))
    order = np.lexsort((-counts, line))                      # lines stay in order
    counts = counts[order]
    upto = np.concatenate([[np.uint64(0)], np.cumsum(mix(cells[order].view(np.uint64)), dtype=np.uint64)])
    held = np.arange(1, len(line) + 1) - begin[line]         # cells of the line so far
    last = np.ones(len(line), bool)
    last[:-1] = (line[1:] != line[:-1]) | (counts[1:] < counts[:-1])
    at = np.flatnonzero(last & (held >= need[line]))
    sums = upto[at + 1] - upto[begin[line[at]]]
    return line[at], mix(mix(sums) + held[at].astype(np.uint64) * _N)


def _fields(least: int, agree: float):
    """Rows (at, size, n, cell), those of a line (``at``) in a row, -> the line's
    templates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[np.ndarray]) -> pa.RecordBatch:
            at, size, n, cells = rows
            begin = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            need = np.maximum(least, np.ceil(agree * size[begin] - 1e-9)).astype(np.int64)
            line, keys = field_templates(n, cells, np.append(begin, len(at)), need)
            return pa.RecordBatch.from_arrays([pa.array(at[begin[line]]), pa.array(keys.view(np.int64))],
                                              names=["at", "key"])

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [c.to_numpy() for c in batch.columns]
            if held is not None:
                rows = [np.concatenate(both) for both in zip(held, rows, strict=True)]
            cut = np.searchsorted(rows[0], rows[0][-1])      # the last line may go on
            held = [c[cut:] for c in rows]
            if cut:
                yield done([c[:cut] for c in rows])
        if held is not None:
            yield done(held)
    return run


def _shared_leaves(lines: DataFrame, min_docs: int) -> bytes:
    """One bit per bucket of leaves: whether ``min_docs`` documents reach one."""
    shared = (lines.filter("new_leaf").groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") >= min_docs)
              .select(F.pmod("leaf", F.lit(1 << LEAF_BITS)).alias("at"))
              .groupBy(F.expr("at div 32768").alias("part"))
              .agg(F.expr("bitmap_construct_agg(at % 32768)").alias("bits")).collect())
    whole = bytearray((1 << LEAF_BITS) // 8)
    for r in shared:
        whole[r["part"] * 4096:(r["part"] + 1) * 4096] = r["bits"]
    return bytes(whole)


def _field_lines(rows: DataFrame, shared: bytes, min_docs: int, least: int, agree: float) -> DataFrame:
    """Lines with the recurring templates that are found position by position
    in the ``shared`` leaves, and the keepers of these, written."""
    cells = materialise(rows.mapInArrow(
        _cells(shared, least, agree),
        "doc long, crc long, line int, size int, total int, new array<long>, again array<long>")
        .withColumn("at", F.monotonically_increasing_id()), "cells")
    counts = materialise(
        cells.select(F.explode("new").alias("cell")).groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs), "counts")
    small = is_small(counts)
    every = cells.select("at", "size", F.explode(F.concat("new", "again")).alias("cell"))
    held = every.join(F.broadcast(counts), "cell") if small else every.join(counts, "cell").repartition("at")
    found = materialise(
        held.select("at", "size", "n", "cell").sortWithinPartitions("at")
        .mapInArrow(_fields(least, agree), "at long, key long"), "found")
    keyed = materialise(found.join(cells.select("at", *LINE), "at").select(*LINE, "key"), "fields")
    discard(cells, counts, found)
    recurring = (keyed.select("doc", "crc", "key").distinct().groupBy("key")
                 .agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("keeper"))
                 .filter(F.col("n") >= min_docs).select("key", "keeper"))
    hits = materialise(keyed.join(recurring, "key"), "field-hits")
    discard(keyed)
    return hits


def _keys(general: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, crc, x in texts_of(batch):              # memory follows a block of texts
                keys, there = x.templates(general, least)
                on = there.any(1)
                if not on.any():
                    continue
                keys, there, k, text = keys[on], there[on], int(on.sum()), x.text[on]
                flat = keys[there]
                row = np.nonzero(there)[0]
                new = first_of(flat, text[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc[text]), longs(crc[text]), longs(x.line[on], np.int32),
                     longs(x.size[on], np.int32), longs(x.total[text], np.int32),
                     lists(np.bincount(row[new], minlength=k), flat[new]),
                     lists(np.bincount(row[~new], minlength=k), flat[~new]),
                     pa.array(x.leaf[on].view(np.int64)), pa.array(first_of(x.leaf[on], text))],
                    names=[*LINE, "new", "again", "leaf", "new_leaf"])
    return run


def _copies(hits: DataFrame, whole: float) -> DataFrame:
    """(doc, crc) of copies: one set of carriers holds ``whole`` of their
    tokens, and as much of the tokens of its document with the smallest id."""
    sets = hits.select("key", "doc", "crc").distinct().groupBy("key").agg(
        F.struct(F.bit_xor(F.xxhash64("doc", "crc")), F.count(F.lit(1))).alias("carriers"))
    held = (hits.join(sets, "key")
            .select("doc", "crc", "line", "size", "total", "keeper", "carriers").distinct()
            .groupBy("doc", "crc", "keeper", "carriers", "total")
            .agg(F.sum("size").alias("size")).filter(F.col("size") >= whole * F.col("total")))
    return held.join(held.filter("doc = keeper").select("keeper", "carriers").distinct(),
                     ["keeper", "carriers"]).select("doc", "crc").distinct()


def _drop(text_col: str, dropped: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            at = names.index(text_col)
            texts, n_lines, n_dropped = [], [], []
            for value, gone in zip(batch.column(at).to_pylist(),
                                   batch.column(names.index(dropped)).to_pylist(), strict=True):
                lines = value.split("\n") if value else []
                gone = set(gone or ())
                n_lines.append(len(lines))
                n_dropped.append(len(gone))
                texts.append("\n".join(x for i, x in enumerate(lines) if i not in gone)
                             if gone else value)
            columns = dict(zip(names, batch.columns, strict=True))
            del columns[dropped]
            columns |= {text_col: pa.array(texts, pa.string()),
                        "n_lines": pa.array(n_lines, pa.int64()),
                        "n_dropped": pa.array(n_dropped, pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)
    return run


def drop_recurring_lines(docs: DataFrame, min_docs: int = 5, general: int = 8, least: int = 3,
                         most: float = 0.5, whole: float = 0.8, agree: float = 0.6,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, the text without dropped lines, with
    ``n_lines`` (lines before) and ``n_dropped``; input columns of these names
    are replaced. Lines end in a line feed, tokens are runs without ASCII
    white space.

    Templates need ``least`` constant tokens, so blank and very short lines
    stay; templates found position by position also need ``agree`` of the
    line's tokens constant, so a word field is found in lines of four tokens
    or more. A copy that would lose more than ``most`` of its tokens keeps all
    (whole copies are the near-duplicate join's task). A document is a copy if
    lines that recur in exactly the same documents make up ``whole`` of its
    tokens and of the tokens of the first of these documents; any other loses
    its recurring lines whatever their share. A null or empty text has no
    lines and stays as it is; rows with a null id neither count nor lose
    lines; rows that repeat an id count as documents each, and none of them
    removes another's lines (for templates found position by position, and for
    telling copies, rows that repeat the text too count once); a line repeated within one document counts once.
    An empty table gives no rows."""
    df = without(docs, *OUTPUTS)
    i, j, a, b, dropped = unused(df, "_id", "_sum", "_doc", "_crc", "_dropped")
    rows = (df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
            .filter("doc is not null and text is not null"))
    lines = materialise(
        rows.mapInArrow(_keys(general, least),
                        "doc long, crc long, line int, size int, total int, new array<long>, "
                        "again array<long>, leaf long, new_leaf boolean")
        .withColumn("at", F.monotonically_increasing_id()), "lines")
    recurring = materialise(
        lines.select("doc", F.explode("new").alias("key")).groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("keeper"))
        .filter(F.col("n") >= min_docs).select("key", "keeper"), "recurring")
    key = F.explode(F.concat("new", "again")).alias("key")
    if is_small(recurring):
        found = lines.select(*LINE, key).join(F.broadcast(recurring), "key")
    else:
        found = lines.select("at", key).join(recurring, "key").join(lines.select("at", *LINE), "at").drop("at")
    found = materialise(found, "hits")
    shared = _shared_leaves(lines, min_docs)
    discard(lines, recurring)
    fields = _field_lines(rows, shared, min_docs, least, agree)
    hits = found.unionByName(fields)
    lost = (hits.filter("doc > keeper").select(*LINE).distinct()
            .groupBy("doc", "crc", "total")
            .agg(F.collect_list("line").alias(dropped), F.sum("size").alias("size")))
    copies = _copies(hits, whole).withColumn("copy", F.lit(True))
    gone = materialise(
        lost.join(copies, ["doc", "crc"], "left")
        .filter(F.col("copy").isNull() | (F.col("size") <= most * F.col("total")))
        .select("doc", "crc", dropped).withColumnsRenamed({"doc": a, "crc": b}), "gone")
    discard(found, fields)
    keyed = df.withColumns({i: F.col(id_col).cast("long"),
                            j: F.crc32(F.col(text_col).cast("binary"))})
    joined = keyed.join(maybe_broadcast(gone), (F.col(i) == F.col(a)) & (F.col(j) == F.col(b)), "left").drop(
        i, j, a, b)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return joined.mapInArrow(_drop(text_col, dropped), f"{fields}, n_lines long, n_dropped long")
