"""Packing of token sequences: non-negative least squares over a length
histogram.

Documents are tokenised once, cut every ``window`` ids, and written as pieces
with their ids. What meets on the driver is the histogram of piece lengths:
at most ``window`` numbers, however many documents there are. Combinations of
two to four lengths that fill a window exactly are enumerated; non-negative
least squares finds how often to repeat each so that the histogram is used
up; the counts are rounded down, what is left is packed greedily (largest
first, each next the largest that fits), and lengths that nothing fills up
are laid end to end and cut at window edges.

The plan is a short table of segments: the pieces of one length whose ranks
(among pieces of that length) lie in a range go to consecutive sequences at a
fixed offset. Ranks are counted in (length, salt) groups, so one frequent
length spreads over all tasks.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import materialise, shuffle_partitions

_ENCODERS: dict[tuple[str, str], "Encoder"] = {}


class Encoder:
    """Ids as the tokenizers library gives them for a byte-level BPE file. The
    same vocabulary as tiktoken ranks, where given, encodes texts without
    special strings and characters beyond U+024F several times faster."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.slow.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_path:
            import tiktoken
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={})

    def ids(self, text: str) -> list[int]:
        plain = self.fast and (text.isascii() or max(text) < "ɐ") and not (
            "<|" in text and any(s in text for s in self.special))
        if plain:
            return self.fast.encode_ordinary(text)
        return self.slow.encode(text, add_special_tokens=False).ids


def _pieces(json_path: str, ranks_path: str, pattern: str, window: int, end_id: int):
    schema = pa.schema([("doc", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("doc_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                        ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = json_path, ranks_path
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(json_path, ranks_path, pattern)
        encoder = _ENCODERS[key]
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encoder.ids(text.as_py() or ""), end_id], "<u4")
                for at in range(0, len(ids), window):
                    part = ids[at:at + window].tobytes()
                    rows.append((doc, at, len(part) // 4, len(ids), zlib.crc32(part), part))
                if len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types,
                                                        strict=True)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), schema.types,
                                                    strict=True)], schema=schema)
    return run


def combinations(have: np.ndarray, window: int, per_length: int, seed: int) -> np.ndarray:
    """Rows of four lengths (0: none) that fill a window exactly: for each
    length that occurs, its exact partner, and up to ``per_length`` triples and
    quadruples whose further lengths follow the histogram."""
    lengths = np.flatnonzero(have)
    lengths = lengths[lengths < window]
    rng = np.random.default_rng(seed)
    found = [np.stack([lengths, window - lengths, 0 * lengths, 0 * lengths], 1)]
    if len(lengths):
        share = have[lengths] / have[lengths].sum()
        for more in (1, 2):
            base = np.repeat(lengths, per_length)
            rest = rng.choice(lengths, (len(base), more), p=share)
            last = window - base - rest.sum(1)
            rest = np.pad(rest, ((0, 0), (0, 2 - more)))
            found.append(np.column_stack([base, rest, last])[:, [0, 1, 3, 2]])
    rows = np.concatenate(found)
    last = rows.min(axis=1)
    ok = (last >= 0) & (rows.sum(1) == window)
    rows = np.sort(rows[ok], axis=1)[:, ::-1]
    used = (rows == 0) | (have[rows] > 0)
    return np.unique(rows[used.all(1)], axis=0)


def repeat_counts(rows: np.ndarray, have: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative least squares: repeats x >= 0 of each combination with the
    lengths used as near to the histogram as can be (accelerated projected
    gradient; every combination has at most four entries)."""
    if not len(rows):
        return np.zeros(0)
    target = have.astype(float).copy()
    target[0] = 0
    real = rows > 0

    def uses(x: np.ndarray) -> np.ndarray:
        out = np.bincount(rows.ravel(), np.repeat(x, 4), len(have))
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return (r[rows] * real).sum(1)

    v = np.ones(len(rows))
    for _ in range(30):                                     # largest eigenvalue of A'A
        v = back(uses(v))
        size = np.linalg.norm(v)
        v /= size
    step = 1 / (1.05 * size)
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        nxt = np.maximum(0, y - step * back(uses(y) - target))
        t2 = (1 + (1 + 4 * t * t) ** .5) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x


def plan(have: np.ndarray, window: int, per_length: int = 6, waste: int | None = None,
         seed: int = 7) -> tuple[list[tuple], int]:
    """Segments (length, from rank, to rank, first sequence, pieces a sequence,
    offset, first position) and the number of sequences. ``have[n]``: pieces
    of length n. First position is -1, or where the segment begins in the run
    of pieces laid end to end from the first sequence on."""
    waste = window // 100 if waste is None else waste
    left = have.astype(np.int64).copy()
    used = np.zeros_like(left)
    segments: list[tuple] = []
    sequences = 0

    def place(pattern: list[tuple[int, int]], times: int) -> None:
        nonlocal sequences
        at = 0
        for length, each in pattern:
            lo = int(used[length])
            segments.append((length, lo, lo + times * each, sequences, each, at, -1))
            used[length] += times * each
            left[length] -= times * each
            at += length * each
        sequences += times

    if left[window]:
        place([(window, 1)], int(left[window]))
    rows = combinations(left, window, per_length, seed)
    for i in np.argsort(-(x := repeat_counts(rows, left)), kind="stable"):
        lengths, each = np.unique(rows[i][rows[i] > 0], return_counts=True)
        times = min(int(x[i]), int((left[lengths] // each).min()))
        if times:
            place(list(zip(lengths[::-1].tolist(), each[::-1].tolist(), strict=True)), times)
    ends: list[int] = []
    for length in range(window - 1, 0, -1):
        while left[length]:
            pattern, room, free = [(length, 1)], window - length, left.copy()
            free[length] -= 1
            while room:
                fits = np.flatnonzero(free[1:room + 1])
                if not len(fits):
                    break
                n = int(fits[-1]) + 1
                each = min(room // n, int(free[n]))
                pattern.append((n, each))
                free[n] -= each
                room -= n * each
            if room > waste:
                ends.append(length)
                break
            total: dict[int, int] = {}
            for n, each in pattern:
                total[n] = total.get(n, 0) + each
            place(list(total.items()), min(int(left[n]) // each for n, each in total.items()))
    position, first = 0, sequences
    for length in ends:
        n = int(left[length])
        if n:
            segments.append((length, int(used[length]), int(used[length]) + n, first, 1, 0, position))
            position += n * length
    return segments, sequences + -(-position // window)


def pack(docs: DataFrame, tokenizer_json: str, ranks_path: str = "", pattern: str = "",
         window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
         ) -> DataFrame:
    """Pieces of all documents of ``docs``: ``doc_id`` (named as ``id_col``),
    ``start`` (ids of the document before it), ``length``, ``ids_crc32``
    (unsigned, of the little-endian 32-bit ids), ``doc_tokens``,
    ``sequence_id``, ``offset`` (in its sequence; pieces of a sequence follow
    each other without a gap from 0) and ``ids`` (binary, little-endian 32-bit;
    not read unless selected). A sequence holds at most ``window`` ids.

    Each document's ids end in ``end_id``. A null text counts as empty: one
    piece of one id. Null ids and repeated rows are packed like any other row;
    an empty table gives no pieces; other columns are not looked at."""
    spark = docs.sparkSession
    pieces = materialise(
        docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
        .mapInArrow(_pieces(tokenizer_json, ranks_path, pattern, window, end_id),
                    "doc long, start long, length long, doc_tokens long, ids_crc32 long, ids binary")
        .withColumn("uid", F.monotonically_increasing_id()), "pieces")
    have = np.zeros(window + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():    # at most ``window`` rows
        have[r["length"]] = r["count"]
    segments, _ = plan(have, window)
    table = spark.createDataFrame(
        segments, "length long, lo long, hi long, first long, each long, at long, position long")

    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("uid"),
                                              F.lit(shuffle_partitions(spark))))
    before = Window.partitionBy("length").orderBy("salt")
    base = (salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
            .select("length", "salt", (F.sum("n").over(before) - F.col("n")).alias("base")))
    group = Window.partitionBy("length", "salt").orderBy("uid")
    ranked = (salted.withColumn("nth", F.row_number().over(group) - 1)
              .join(base, ["length", "salt"])
              .withColumn("rank", F.col("base") + F.col("nth")))
    # the plan's rows are bounded by the window, whatever the input
    placed = ranked.join(F.broadcast(table), "length").filter("rank >= lo and rank < hi")
    nth = F.col("rank") - F.col("lo")
    names = [F.col("doc").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
             "sequence_id", "offset", "ids"]
    whole = placed.filter("position < 0").withColumns({
        "sequence_id": F.col("first") + F.floor(nth / F.col("each")),
        "offset": F.col("at") + (nth % F.col("each")) * F.col("length")}).select(*names)
    if all(s[6] < 0 for s in segments):
        return whole
    # laid end to end: a piece that crosses a window's edge becomes two
    cut_lengths = sorted({s[0] for s in segments if s[6] >= 0})
    begin = (F.col("position") + nth * F.col("length"))
    room = F.lit(window) - F.col("begin") % window
    parts = F.when(room < F.col("length"), F.array(
        F.struct(F.lit(0).cast("long").alias("skip"), room.alias("take")),
        F.struct(room.alias("skip"), (F.col("length") - room).alias("take")))).otherwise(
        F.array(F.struct(F.lit(0).cast("long").alias("skip"), F.col("length").alias("take"))))
    where = (placed.filter("position >= 0").withColumn("begin", begin)
             .select("uid", "first", "begin", F.explode(parts).alias("part")))
    cut = (pieces.filter(F.col("length").isin(cut_lengths)).join(where, "uid")
           .withColumn("ids", F.substring("ids", F.col("part.skip") * 4 + 1, F.col("part.take") * 4))
           .withColumns({
               "ids_crc32": F.crc32("ids"), "start": F.col("start") + F.col("part.skip"),
               "length": F.col("part.take"),
               "sequence_id": F.col("first") + F.floor((F.col("begin") + F.col("part.skip")) / window),
               "offset": (F.col("begin") + F.col("part.skip")) % window}).select(*names))
    return whole.unionByName(cut)


def sequences(packed: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, used, ids): each sequence's ids, padded to ``window``."""
    size = F.sum("length").alias("used")
    joined = F.concat_ws("", F.transform(F.array_sort(F.collect_list(
        F.struct("offset", F.hex("ids").alias("h")))), lambda p: p["h"]))
    out = packed.groupBy("sequence_id").agg(size, joined.alias("h"))
    pad = F.lit(f"{pad_id & 0xFF:02X}{pad_id >> 8 & 0xFF:02X}{pad_id >> 16 & 0xFF:02X}"
                f"{pad_id >> 24 & 0xFF:02X}")
    return out.select("sequence_id", "used",
                      F.unhex(F.rpad("h", window * 8, pad)).alias("ids"))
