"""Quality rules with the frequency of lines across documents.

A line is normalised (A-Z lower-cased, runs of digits as one mark, white space
squeezed) and hashed where the text is; each host counts the distinct texts
that hold it. A line above the limits, ``most_docs`` texts and ``most_share`` of the host's
texts, goes from all documents of the host, and a document that keeps less than
``least_kept`` of its words is rejected, as is one that fails the base rules.

Copies of one page repeat whole, so their lines are above the limits too, but
they are the near-duplicate operators' task. A boilerplate line is told by what
is left around it: if most texts that hold a line would be depleted, it
is the body of copies and stays.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import join_by_id, materialise, unused, without
from lodestar.llm.hashing import LOWER, SPACES, window_hashes, word_hashes

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
OUTPUTS = (*BASE, "n_boilerplate_lines", "n_boilerplate_words", "kept_text", "kept")
SYMBOLS = b"#*$%&|<>"
_DIGITS = re.compile(rb"[0-9]+")
_SPACE = b" \t\n\x0b\x0c\r"


def line_key(host: int, line: bytes) -> int:
    """Hash of a host and a normalised line."""
    normal = b" ".join(_DIGITS.sub(b"0", line.translate(LOWER)).split())
    return xxhash.xxh64_intdigest(normal, seed=host & (1 << 64) - 1) - (1 << 63)


def lines_of(data: bytes, host: int) -> list[tuple[int, int, bytes]]:
    """(key, words, line) of each line; a line without words has key 0 and
    is never counted or removed."""
    out = []
    for line in data.split(b"\n"):
        words = len(line.split())
        out.append((line_key(host, line) if words else 0, words, line))
    return out


def repeated_words(data: bytes, n: int = 3) -> tuple[int, int]:
    """(words, words inside windows of ``n`` words that occur twice or more)."""
    words, _ = word_hashes(data)
    windows = window_hashes(words, n)
    if len(windows) < 2:
        return len(words), 0
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(counts[which] > 1)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return len(words), int((np.cumsum(edge[:-1]) > 0).sum())


def base_metrics(text: str | None, least_words: int, most_repeat: int) -> tuple:
    """The columns BASE of one text."""
    data = (text or "").encode()
    n_words, repeat = repeated_words(data)
    blanks = len(data) - len(data.translate(None, _SPACE))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    again = 0
    for line in data.split(b"\n"):
        if line in seen:
            again += 1
        elif line.strip(_SPACE):
            seen.add(line)
    failed = n_words < least_words or 100 * repeat > most_repeat * n_words
    return n_words, len(text or "") - blanks, symbols, again, repeat, failed


LINES = "row long, doc long, host long, words long, keys array<long>, sizes array<int>"


def document_lines(docs: DataFrame, host_col: str, text_col: str) -> DataFrame:
    """``LINES`` of each text that has any; doc is the text's hash."""
    text = F.col(f"`{text_col}`")
    return docs.select(F.monotonically_increasing_id().alias("row"), F.xxhash64(text).alias("doc"),
                       host_hash(host_col).alias("host"), text.alias("text")).filter(
        "text is not null").mapInArrow(_lines, LINES)


def host_hash(host_col: str) -> Column:
    return F.xxhash64(F.col(f"`{host_col}`").cast("string"))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct lines of each text, with the words in all their occurrences."""
    for batch in batches:
        rows = []
        for row, doc, host, value in zip(*[c.to_pylist() for c in batch.columns[:3]],
                                         batch.column(3), strict=True):
            sizes: dict[int, int] = {}
            for key, words, _ in lines_of(value.as_py().encode(), host):
                if words:
                    sizes[key] = sizes.get(key, 0) + words
            if sizes:
                rows.append((row, doc, host, sum(sizes.values()), list(sizes), list(sizes.values())))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        types = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["row", "doc", "host", "words", "keys", "sizes"])


def frequent_lines(docs: DataFrame, most_docs: int = 3, most_share: float = 0.01,
                   least_kept: float = 0.5, host_col: str = "source",
                   text_col: str = "text") -> DataFrame:
    """(key, host, n_docs): lines that go, by host; key as ``line_key`` gives
    it with xxhash64 of the host (null hosts are one host)."""
    lines = materialise(document_lines(docs, host_col, text_col), "lines")
    # copies of a text count once; (host, doc) rows are few numbers, combined before they move
    hosts = lines.select("host", "doc").distinct().groupBy("host").agg(
        F.count(F.lit(1)).alias("all"))
    often = (lines.select("host", "doc", F.explode("keys").alias("key")).distinct()
             .groupBy("key", "host").agg(F.count(F.lit(1)).alias("n_docs"))
             .filter(F.col("n_docs") > most_docs))
    above = materialise(often.join(hosts, "host").filter(F.col("n_docs") > most_share * F.col("all"))
                        .select("key", "host", "n_docs"), "above")
    hits = materialise(
        join_by_id(lines.select("row", "doc", "words", F.explode(F.arrays_zip("keys", "sizes")).alias("l"))
                   .select("row", "doc", "words", F.col("l.keys").alias("key"),
                           F.col("l.sizes").alias("size")), above.select("key"), "key"), "hits")
    # by text, not row: copies lose the same; a text on two hosts keeps its worse share
    depleted = (hits.groupBy("row", "doc", "words").agg(F.sum("size").alias("gone"))
                .filter(F.col("words") - F.col("gone") < least_kept * F.col("words"))
                .select("doc").distinct())
    bodies = (hits.select("key", "doc").distinct().join(depleted, "doc")
              .groupBy("key").agg(F.count(F.lit(1)).alias("n_depleted")))
    return above.join(bodies, "key", "left").filter(
        2 * F.coalesce("n_depleted", F.lit(0)) <= F.col("n_docs")).select("key", "host", "n_docs")


def removed(lines: list[tuple[int, int, bytes]], gone: np.ndarray) -> np.ndarray:
    """Which of the lines have words and a key in ``gone`` (sorted)."""
    if not len(gone):
        return np.zeros(len(lines), bool)
    keys = np.array([k for k, _, _ in lines], np.int64)
    at = np.minimum(np.searchsorted(gone, keys), len(gone) - 1)
    return (gone[at] == keys) & np.array([w > 0 for _, w, _ in lines], bool)


def _judge(gone: np.ndarray | None, least_words: int, most_repeat: int, least_kept: float):
    """The last three columns are text, host hash and, without ``gone``, the
    keys that go from the row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            first = batch.num_columns - (2 if gone is not None else 3)
            lists = itertools.repeat(None) if gone is not None else batch.column(first + 2).to_pylist()
            for value, host, keys in zip(batch.column(first), batch.column(first + 1).to_pylist(),
                                         lists, strict=False):
                text = value.as_py()
                base = base_metrics(text, least_words, most_repeat)
                lines = lines_of((text or "").encode(), host)
                out = removed(lines, gone if gone is not None
                              else np.sort(np.array(keys or [], np.int64)))
                lost = sum(lines[i][1] for i in np.flatnonzero(out))
                kept = text if not out.any() else b"\n".join(
                    line for (_, _, line), x in zip(lines, out, strict=True) if not x).decode()
                rows.append((*base, int(out.sum()), lost, kept,
                             not base[-1] and base[0] - lost >= least_kept * base[0]))
            columns = list(zip(*rows, strict=True)) or [()] * len(OUTPUTS)
            types = [pa.int64()] * 5 + [pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:first], *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                names=[*batch.schema.names[:first], *OUTPUTS])
    return run


def apply_rules(docs: DataFrame, least_words: int = 50, most_repeat: int = 50,
                most_docs: int = 3, most_share: float = 0.01, least_kept: float = 0.5,
                held: int = 1 << 22, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the base measures (words are runs
    without ASCII white space), ``base_failed`` (fewer than ``least_words``
    words, or more than ``most_repeat`` percent of them in repeated windows of
    three), ``n_boilerplate_lines`` and ``n_boilerplate_words`` (removed by the
    line frequency rule), ``kept_text`` (the text without these lines) and
    ``kept``. Input columns of these names are replaced.

    ``held`` is how many line hashes a worker holds (8 bytes each); if more
    lines go, each text is joined to the keys of its own lines instead, with
    the same result. A null or empty text has no words and fails the base
    rules; its kept text is as it was. Null hosts are one host. Repeated rows
    and equal texts of a host count once for its lines and get equal verdicts;
    ids play no part. Texts are read whole. An empty table gives no rows."""
    df = without(docs, *OUTPUTS)
    host, body, keys, doc, at = unused(docs, "_host", "_body", "_keys", "_doc", "_at")
    rest = [F.col(f"`{c}`") for c in df.columns]
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)
    gone = materialise(frequent_lines(docs, most_docs, most_share, least_kept, host_col, text_col),
                       "gone")
    rows = docs.select(*rest, F.col(f"`{text_col}`").alias(body),
                       F.xxhash64(F.col(f"`{host_col}`").cast("string")).alias(host))
    rules = (least_words, most_repeat, least_kept)
    schema = (f"{fields}n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, base_failed boolean, n_boilerplate_lines long, "
              "n_boilerplate_words long, kept_text string, kept boolean")
    if gone.count() <= held:
        hashes = np.sort(np.array([r["key"] for r in gone.select("key").collect()], np.int64))
        return rows.mapInArrow(_judge(hashes, *rules), schema)
    own = (document_lines(docs, host_col, text_col)
           .select(F.col("doc").alias(doc), F.col("host").alias(at), F.explode("keys").alias("key"))
           .distinct().join(gone.select("key"), "key").groupBy(doc, at)
           .agg(F.collect_list("key").alias(keys)))          # lines of one text
    marked = rows.join(own, (F.xxhash64(F.col(body)) == F.col(doc)) & (F.col(host) == F.col(at)), "left")
    return marked.drop(doc, at).mapInArrow(_judge(None, *rules), schema)
