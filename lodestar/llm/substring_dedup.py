"""Substring dedup on a de Bruijn graph of word windows.

Nodes are runs of ``window - 1`` words, edges runs of ``window`` words. An
edge is dealt by its minimiser (the least hash of the ``seed_words``-word runs
inside it), so a path through the graph falls into stretches of consecutive
edges that travel together: hashes of the edges plus one source coordinate
(document, first word) per stretch. Where the same edges meet, the document
with the smallest id keeps them; in every other document the repeated edges
next to each other (a path without a branch in its source coordinates)
compact to one span, as long as the places they repeat also follow each other
in one keeping document. A span carries that place: a join with the keeping
documents fetches a digest of the words there, and a join on the documents
glues the spans of all stretches and removes those whose words have the same
digest. Equal 64-bit hashes alone remove nothing.

Edges that repeat inside one task's block of documents are settled there, so
a passage that a third of all documents share ships one row per block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import (
    join_by_id, materialise, shuffle_partitions, text_bytes, unused, without)
from lodestar.llm.hashing import mix, sliding_min, window_hashes, word_hashes

OUTPUTS = ("n_words", "n_removed", "removed", "kept_text")
SPANS = pa.schema([("doc", pa.int64()), ("crc", pa.int64()), ("start", pa.int32()),
                   ("stop", pa.int32()), ("src", pa.int64()), ("src_crc", pa.int64()),
                   ("src_start", pa.int32())])
SPAN_TYPES = ("doc long, crc long, start int, stop int, src long, src_crc long, src_start int")
STRETCHES = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("runs", pa.binary()),
                       ("spans", pa.binary())])
#: One stretch: source document, checksum of its text, first word, edges.
RUN = np.dtype([("doc", "<i8"), ("crc", "<u4"), ("start", "<i4"), ("edges", "<i4")])
#: A span with the place it repeats.
SPAN = np.dtype([*RUN.descr, ("src", "<i8"), ("src_crc", "<u4"), ("src_start", "<i4")])


def pack(columns: np.ndarray) -> bytes:
    """Stretches column by column, documents as differences, compressed."""
    parts = [np.diff(columns["doc"], prepend=np.int64(0)), columns["crc"], columns["start"],
             columns["edges"]]
    return zstandard.compress(b"".join(np.ascontiguousarray(p).tobytes() for p in parts), 1)


def unpack(data: bytes) -> np.ndarray:
    raw = zstandard.decompress(data)
    n = len(raw) // RUN.itemsize
    out, at = np.empty(n, RUN), 0
    for name in RUN.names:
        size = n * RUN[name].itemsize
        out[name] = np.frombuffer(raw, RUN[name], n, at)
        at += size
    out["doc"] = np.cumsum(out["doc"])
    return out


def runs_of(doc: np.ndarray, crc: np.ndarray, start: np.ndarray,
            key: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of edges that follow each other in one document (and share
    ``key``): (first index, RUN rows). Edges come in source order."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, RUN)
    new = np.ones(len(start), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (crc[1:] != crc[:-1]) | (start[1:] != start[:-1] + 1)
    if key is not None:
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    out = np.empty(len(first), RUN)
    out["doc"], out["crc"], out["start"] = doc[first], crc[first], start[first]
    out["edges"] = np.diff(first, append=len(start))
    return first, out


def keepers(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each edge the index of an equal edge in the document with the
    smallest id, the first one there."""
    order = np.lexsort((doc, hashes))
    h = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    out = np.empty(len(h), np.int64)
    out[order] = np.repeat(order[first], np.diff(first, append=len(h)))
    return out


def spans_of(doc: np.ndarray, crc: np.ndarray, start: np.ndarray, key: np.ndarray,
             known: np.ndarray, keeper: np.ndarray) -> np.ndarray:
    """SPAN rows of the edges at the indices ``known``, in source order: runs
    that share ``key`` and repeat places that follow each other, too."""
    at = keeper[known]
    new = np.ones(len(known), bool)
    new[1:] = (doc[at][1:] != doc[at][:-1]) | (crc[at][1:] != crc[at][:-1]) | (
        start[at][1:] != start[at][:-1] + 1) | (key[known][1:] != key[known][:-1])
    first, runs = runs_of(doc[known], crc[known], start[known], np.cumsum(new))
    out = np.empty(len(runs), SPAN)
    for name in RUN.names:
        out[name] = runs[name]
    out["src"], out["src_crc"], out["src_start"] = doc[at][first], crc[at][first], start[at][first]
    return out


def digest(words: list[bytes]) -> bytes:
    return blake2b(b" ".join(words), digest_size=16).digest()


def _edges(rows: list[tuple[int, bytes]], window: int, seed_words: int, buckets: int):
    """Edges of documents sorted by id: hash, bucket, document, crc, start."""
    hashes, bucket, doc, crc, start = [], [], [], [], []
    for doc_id, data in rows:
        words, _ = word_hashes(data)
        n = len(words) - window + 1
        if n > 0:
            hashes.append(window_hashes(words, window))
            seeds = sliding_min(window_hashes(words, seed_words), window - seed_words + 1)
            bucket.append((mix(seeds) % np.uint64(buckets)).astype(np.int32))
            doc.append(np.full(n, doc_id, np.int64))
            crc.append(np.full(n, zlib.crc32(data), np.uint32))
            start.append(np.arange(n, dtype=np.int32))
    if not hashes:
        return None
    return tuple(np.concatenate(x) for x in (hashes, bucket, doc, crc, start))


def _deal(window: int, seed_words: int, buckets: int, block_bytes: int):
    def block(rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        edges = _edges(sorted(rows), window, seed_words, buckets)
        if edges is None:
            return
        hashes, bucket, doc, crc, start = edges
        keeper = keepers(hashes, doc)
        known = doc > doc[keeper]
        spans = spans_of(doc, crc, start, doc, np.flatnonzero(known), keeper)
        hashes, bucket, doc, crc, start = (x[~known] for x in edges)
        first, runs = runs_of(doc, crc, start, bucket)
        order = np.argsort(bucket[first], kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[first][order], prepend=-1))
        out = []
        for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
            which = order[a:b]
            n = runs["edges"][which]
            at = np.repeat(first[which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) \
                + np.arange(n.sum())
            out.append((int(bucket[first[which[0]]]), hashes[at].tobytes(), pack(runs[which]), None))
        if len(spans):
            # what this block settled itself rides with any one bucket
            out.append((int(spans["doc"][0]) % buckets, b"", pack(np.zeros(0, RUN)), zstandard.compress(spans.tobytes(), 1)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*out, strict=True), STRETCHES.types, strict=True)],
            schema=STRETCHES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py().encode()
                rows.append((doc_id, data))
                size += len(data)
                if size >= block_bytes:
                    yield from block(rows)
                    rows, size = [], 0
        if rows:
            yield from block(rows)

    return run


def _meet(window: int):
    def run(table: pa.Table) -> pa.Table:
        hashes, runs, settled = [], [], []
        for h, r, s in zip(table.column("hashes"), table.column("runs"), table.column("spans"),
                           strict=True):
            hashes.append(np.frombuffer(h.as_py(), np.uint64))
            runs.append(unpack(r.as_py()))
            if s.is_valid:
                settled.append(np.frombuffer(zstandard.decompress(s.as_py()), SPAN))
        h, r = np.concatenate(hashes), np.concatenate(runs)
        del hashes, runs
        n = r["edges"]
        own = np.repeat(np.arange(len(r)), n)
        doc, crc = r["doc"][own], r["crc"][own]
        start = r["start"][own] + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
        keeper = keepers(h, doc) if len(h) else np.zeros(0, np.int64)
        del h
        # source coordinates of repeated edges, compacted along each stretch
        spans = spans_of(doc, crc, start, own, np.flatnonzero(doc > doc[keeper]), keeper)
        spans = np.concatenate([spans, *settled])
        return pa.Table.from_arrays(
            [pa.array(spans["doc"]), pa.array(spans["crc"].astype(np.int64)),
             pa.array(spans["start"]), pa.array(spans["start"] + spans["edges"] + window - 1,
                                                pa.int32()),
             pa.array(spans["src"]), pa.array(spans["src_crc"].astype(np.int64)),
             pa.array(spans["src_start"])], schema=SPANS)

    return run


def repeated_spans(docs: DataFrame, window: int = 13, seed_words: int = 3,
                   bucket_bytes: int = 16 << 20, block_bytes: int = 4 << 20,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, crc, start, stop, src, src_crc, src_start): word spans of each
    document covered by windows whose hashes also start in a document with a
    smaller id, and the place there. Spans of one document
    may overlap. ``crc`` (of the text) tells rows that repeat an id apart."""
    spark = docs.sparkSession
    rows = (docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
            .filter("doc is not null and text is not null"))
    buckets = max(4 * shuffle_partitions(spark), -(-text_bytes(rows) // bucket_bytes))
    dealt = rows.mapInArrow(_deal(window, seed_words, buckets, block_bytes),
                            "bucket int, hashes binary, runs binary, spans binary")
    return dealt.groupBy("bucket").applyInArrow(
        _meet(window), SPAN_TYPES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for src, crc, text, places in zip(
                *(batch.column(batch.schema.names.index(x)).to_pylist()
                  for x in ("src", "src_crc", "text", "places")), strict=True):
            words = text.encode().split()
            rows += [(src, crc, p["src_start"], p["n"],
                      digest(words[p["src_start"]:p["src_start"] + p["n"]])) for p in places]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(columns, (
                pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
            names=["src", "src_crc", "src_start", "n", "digest"])


def with_digests(spans: DataFrame, rows: DataFrame) -> DataFrame:
    """``spans`` with the digest of the words at the place they repeat; every
    place is looked up once, however many spans repeat it."""
    place = ["src", "src_crc", "src_start", "n"]
    spans = materialise(spans.withColumn("n", F.col("stop") - F.col("start")), "spans")
    asked = materialise(spans.select(*place).distinct().groupBy("src", "src_crc").agg(
        F.collect_list(F.struct("src_start", "n")).alias("places")), "places")
    texts = rows.select(F.col("doc").alias("src"),
                        F.crc32(F.col("text").cast("binary")).alias("src_crc"), "text")
    found = join_by_id(texts, asked, ["src", "src_crc"]).mapInArrow(
        _digests, "src long, src_crc long, src_start int, n int, digest binary").dropDuplicates(place)
    return spans.join(found, place).select("doc", "crc", "start", "stop", "digest")


def _remove(text_col: str):
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            n_words, n_removed, removed, kept = [], [], [], []
            for text, spans in zip(batch.column(names.index(text_col)),
                                   batch.column(names.index("removed")).to_pylist(), strict=True):
                words = (text.as_py() or "").encode().split()
                out, merged, at = [], [], 0
                same = {(s["start"], s["stop"]) for s in spans or ()
                        if digest(words[s["start"]:s["stop"]]) == s["digest"]}
                for a, b in sorted(same):
                    if merged and a <= merged[-1]["stop"]:
                        merged[-1]["stop"] = max(merged[-1]["stop"], b)
                    else:
                        merged.append({"start": a, "stop": b})
                for s in merged:
                    out += words[at:s["start"]]
                    at = s["stop"]
                out += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(out))
                removed.append(merged)
                kept.append(b" ".join(out).decode())
            fresh = {"n_words": pa.array(n_words, pa.int64()),
                     "n_removed": pa.array(n_removed, pa.int64()),
                     "removed": pa.array(removed, span), "kept_text": pa.array(kept, pa.string())}
            columns = {n: c for n, c in zip(names, batch.columns, strict=True) if n != "removed"}
            yield pa.RecordBatch.from_pydict(columns | fresh)

    return run


def drop_repeated_spans(docs: DataFrame, window: int = 13, id_col: str = "doc_id",
                        text_col: str = "text", **kw) -> DataFrame:
    """All rows and columns of ``docs`` with ``n_words``, ``n_removed``,
    ``removed`` (merged word spans, [start, stop)) and ``kept_text`` (kept
    words joined by one space). Input columns of these names are replaced.

    Words are runs without space or U+0009 to U+000D, unchanged. A null text
    has no words; texts of fewer than ``window`` words lose none; a null id
    is neither smaller nor larger than any, so such rows lose nothing; rows
    that repeat an id never remove each other's words. Empty tables give no
    rows; texts of any length are worked through whole."""
    df = without(docs, *OUTPUTS)
    i, j, a, b = unused(df, "_id", "_sum", "_doc", "_crc")
    rows = (df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
            .filter("doc is not null and text is not null"))
    spans = (with_digests(repeated_spans(df, window, id_col=id_col, text_col=text_col, **kw), rows)
             .groupBy("doc", "crc")
             .agg(F.collect_list(F.struct("start", "stop", "digest")).alias("removed"))
             .withColumnsRenamed({"doc": a, "crc": b}))
    keyed = df.withColumns({i: F.col(id_col).cast("long"),
                            j: F.crc32(F.col(text_col).cast("binary"))})
    joined = keyed.join(spans, (F.col(i) == F.col(a)) & (F.col(j) == F.col(b)), "left").drop(
        i, j, a, b)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return joined.mapInArrow(_remove(text_col), f"{fields}, n_words long, n_removed long, removed "
                             "array<struct<start:int,stop:int>>, kept_text string")
