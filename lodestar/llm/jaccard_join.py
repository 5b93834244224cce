"""N-gram Jaccard join: components of documents whose word-shingle sets are
similar, exactly.

1. Documents with equal sets form one class, represented by the smallest id.
2. Classes are dealt into size bands. Two sets of a band differ by at most
   ``k`` shingles if they link, so of ``k + 1`` or more parts (by shingle hash)
   at least one is equal in both: equal parts are where candidates meet. A
   pair across a band edge meets in a band of its own around that edge.
3. Each class is held against one leader (the smallest class it meets), then
   against a few more, one a round; links found so give components, and large
   groups of near copies are mostly one before any pairs are made. Then, in
   rounds: the classes of each meeting that lie in different components are
   compared inside a task, a large meeting in tiles, and each component keeps
   only its most promising candidates (as many as the round allows, four times
   as many each round). Meetings of the same classes are one. These are settled, links contract components, refuted
   pairs are remembered, classes without a candidate leave their meetings, and
   the rounds end when no candidate is left.
4. A comparison inside a tile bounds the overlap from above by bit counts: with
   hashed parity bitmaps, every bit that differs takes a shingle that only one
   set has. Pairs that it refutes die in the task. What is chosen is bounded
   once more by whole bitmaps and settled by intersecting sorted arrays, which
   are made once per class.

No pair is skipped unless its ends are already connected, and no group is
capped, so no component is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import (
    delete_tables, discard, is_small, join_by_id, materialise, maybe_broadcast, written_tables)
from lodestar.llm.components import components, roots
from lodestar.llm.hashing import LOWER, mix, window_hashes, word_hashes

BAND_RATIO = 1.8
TILE_BITS = 2048                  # of a bitmap inside a tile, at most
AT_ONCE = 256                     # texts whose arrays a worker holds, at most
ROWS = 32                         # of a tile compared with another at once
MIXING = 3                        # rounds against further leaders before tiles


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its ``n``-word shingles (A-Z
    lower-cased); of fewer words, the whole sequence is one; without words
    there is none. The texts are hashed as one stretch of bytes."""
    data = [(t or "").encode() for t in texts.to_pylist()]
    begin = np.cumsum([0, *[len(d) + 1 for d in data]])
    words, at = word_hashes(b"\n".join(data).translate(LOWER))
    first = np.searchsorted(at, begin)
    shingles = mix(window_hashes(words, n))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(shingles[a:b - n + 1]))
        elif b > a:
            out.append(mix(window_hashes(words[a:b], b - a) ^ np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def blocks(batch: pa.RecordBatch, block: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Stretches of the rows with texts (second column) of about ``block``
    bytes in all, or one longer text; ``AT_ONCE`` rows at most."""
    size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
    start = held = 0
    for i, s in enumerate(size):
        if i > start and (held + s > block or i - start == AT_ONCE):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += s
    if start < batch.num_rows:
        yield batch.slice(start)


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    a = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    b = mix(shingles ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(np.array(a, np.uint64).view(np.int64)), int(np.array(b, np.uint64).view(np.int64))


@lru_cache(1 << 14)
def bands(size: int, percent: int) -> list[tuple[int, int, int]]:
    """(band, k, parts) of a set: its own size band, and the band around an
    edge that is near enough for links across it."""
    low, number = 1, 0
    while True:
        high = max(low + 1, int(low * BAND_RATIO))          # sizes low .. high - 1
        if size < high:
            break
        low, number = high, number + 1
    out = []

    def add(band: int, least: int, a: int, b: int) -> None:
        k = (a + b) * (100 - percent) // (100 + percent)    # most shingles in only one
        if k:
            # beyond k + 1, as many parts as the smallest sets may leave empty
            empty = (k + 1) * float(np.exp(-least / (k + 1)))
            out.append((band, k, k + 2 + int(1.3 * empty + 4 * empty ** 0.5)))

    add(2 * number, low, high - 1, high - 1)
    if size * 100 >= percent * high:
        add(2 * number + 1, percent * high // 100, high - 1, (high - 1) * 100 // percent)
    if number and (low - 1) * 100 >= percent * size:
        add(2 * number - 1, percent * low // 100, low - 1, (low - 1) * 100 // percent)
    return out


def part_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Where a set meets others: one key per part of each of its bands. Parts
    empty in both sets also agree; if all the parts that must agree can be
    empty in this set, it has a key for its empty parts too."""
    out = []
    for band, k, parts in bands(len(shingles), percent):
        seed = mix(np.array([band + 1], np.uint64))
        part = (mix(shingles ^ seed) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        total = np.add.reduceat(mix(shingles[order] + seed), first)
        out.append(mix(total ^ mix(seed + part[first].astype(np.uint64))))
        if parts - len(first) >= parts - k:
            empty = np.setdiff1d(np.arange(parts), part[first]).astype(np.uint64)
            out.append(mix(~mix(seed + empty)))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the shingles hashed to each bit; as many bits as the next
    power of two from four times the set's size, 256 at least."""
    bits = max(256, 1 << (4 * max(1, len(shingles)) - 1).bit_length())
    at = (mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def fold(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmap rows (bytes) folded to ``size`` bytes: parities add."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def can_link(x: np.ndarray, y: np.ndarray, nx, ny, percent: int) -> np.ndarray:
    """Whether bit counts allow 100 * overlap >= percent * union, for bitmap
    rows x against y (broadcast together)."""
    apart = np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)
    most = (nx + ny - apart) // 2                           # overlap at most
    return (most >= 0) & (100 * most >= percent * (nx + ny - most))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                sets = shingle_sets(batch.column(1), n)
                keys = [set_key(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1))],
                    names=["doc", "size", "a", "b"])
    return run


def _keys(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                keys = [part_keys(s, percent) for s in shingle_sets(batch.column(1), n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["doc", "keys"])
    return run


def _signatures(n: int):
    """Size, whole bitmap, bitmap for tiles (about one bit a shingle) and
    sorted shingles of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole):
                sets = shingle_sets(batch.column(1), n)
                bits = [bitmap(s) for s in sets]
                few = [fold(np.frombuffer(b, np.uint8), min(TILE_BITS // 8, max(32, len(b) // 4)))
                       .tobytes() for b in bits]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(bits, pa.binary()), pa.array(few, pa.binary()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    names=["doc", "size", "bits", "few", "shingles"])
    return run


def _bit_bound(percent: int):
    """Pairs (u, v) with sizes and bitmaps -> those that bit counts let through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, nu, nv, bu, bv = (batch.column(i).to_pylist() for i in range(6))
            keep = []
            for i in range(len(u)):
                x, y = np.frombuffer(bu[i], np.uint8), np.frombuffer(bv[i], np.uint8)
                size = min(len(x), len(y))
                keep.append(bool(can_link(fold(x, size), fold(y, size), nu[i], nv[i], percent)))
            yield pa.RecordBatch.from_pydict(
                {"u": pa.array([x for x, k in zip(u, keep, strict=True) if k], pa.int64()),
                 "v": pa.array([x for x, k in zip(v, keep, strict=True) if k], pa.int64())})
    return run


def _best(comps: np.ndarray, most: int) -> np.ndarray:
    """Which entries are among the first ``most`` of their component."""
    order = np.argsort(comps, kind="stable")
    start = np.flatnonzero(np.diff(comps[order], prepend=comps[order[:1]] - 1))
    rank = np.arange(len(comps)) - np.repeat(start, np.diff(np.append(start, len(comps))))
    out = np.empty(len(comps), bool)
    out[order] = rank < most
    return out


class Tile:
    """Columns of the classes of a tile (doc, component, size, few, refuted)."""

    def __init__(self, rows: pa.StructArray, size: int):
        doc, component, sizes, few, refuted = rows.flatten()
        self.ids, self.comps, self.sizes = (x.to_numpy() for x in (doc, component, sizes))
        few = few.to_pylist()
        length = np.array([len(b) for b in few])
        bits = np.empty((len(few), size), np.uint8)
        for n in np.unique(length).tolist():
            at = np.flatnonzero(length == n)
            bits[at] = fold(np.frombuffer(b"".join([few[i] for i in at]), np.uint8).reshape(-1, n), size)
        self.bits = bits.view(np.uint64)
        n = pc.fill_null(refuted.value_lengths(), 0).to_numpy(zero_copy_only=False)
        self.refuted = np.repeat(self.ids, n), refuted.flatten().to_numpy()


def known(a: Tile, b: Tile) -> np.ndarray | None:
    """Which pairs of rows of two tiles are refuted, if any may be."""
    u, v = (np.concatenate([a.refuted[i], b.refuted[i]]) for i in (0, 1))
    if not len(u):
        return None
    (one, i), (two, j) = (np.unique(t.ids, return_inverse=True) for t in (a, b))
    out = np.zeros((len(one), len(two)), bool)
    for x, y in ((u, v), (v, u)):
        p, q = (np.minimum(np.searchsorted(ids, z), len(ids) - 1) for ids, z in ((one, x), (two, y)))
        here = (one[p] == x) & (two[q] == y)
        out[p[here], q[here]] = True
    return out[i][:, j]


def candidates(x: pa.StructArray, y: pa.StructArray, percent: int, most: int) -> list[np.ndarray]:
    """(u, v, components of u and v, differing bits in a million of the sizes)
    of the pairs of two tiles (or of one with itself) that lie in different
    components, are not refuted and may link; of each component the ``most``
    that differ least. Last, the classes that are ends of the others only."""
    size = min(pc.min(pc.binary_length(rows.field("few"))).as_py() for rows in (x, y))
    a = Tile(x, size)
    b = a if x is y else Tile(y, size)
    no = known(a, b)
    found = []
    for at in range(0, len(a.ids), ROWS):
        ids, comps = a.ids[at:at + ROWS, None], a.comps[at:at + ROWS, None]
        may = (comps != b.comps) & (b.ids > ids if a is b else b.ids != ids)
        if no is not None:
            may &= ~no[at:at + ROWS]
        i, j = np.nonzero(may)
        i += at
        total = a.sizes[i] + b.sizes[j]
        apart = np.bitwise_count(a.bits[i] ^ b.bits[j]).sum(axis=-1, dtype=np.int64)
        both = (total - apart) // 2                           # overlap at most
        ok = (both >= 0) & (100 * both >= percent * (total - both))
        i, j = i[ok], j[ok]
        mine = a.ids[i] >= b.ids[j]
        found.append((np.maximum(a.ids[i], b.ids[j]), np.minimum(a.ids[i], b.ids[j]),
                      np.where(mine, a.comps[i], b.comps[j]), np.where(mine, b.comps[j], a.comps[i]),
                      apart[ok] * 1_000_000 // total[ok]))
    out = [np.concatenate(c) for c in zip(*found, strict=True)]
    if not len(out[0]):
        return [*out, out[0]]
    order = np.lexsort((out[1], out[0], out[4]))
    out = [c[order] for c in out]
    keep = _best(out[2], most) | _best(out[3], most)
    rest = np.setdiff1d(np.concatenate([c[~keep] for c in out[:2]]), np.concatenate([c[keep] for c in out[:2]]))
    return [*(c[keep] for c in out), rest]


def _tile_candidates(percent: int, most: int):
    """Rows of one tile, or of two (the second column), -> ``candidates``; an
    end of none but candidates that were left out is a row of its own, without v."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                x = batch.column(0)[i].values
                y = batch.column(1)[i].values if batch.num_columns > 1 else x
                found.append(candidates(x, y, percent, most))
            *columns, rest = [np.concatenate([np.zeros(0, np.int64), *c])
                              for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 6
            names = ["u", "v", "cu", "cv", "far"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rest), *(pa.nulls(len(rest), pa.int64()) for _ in names[1:])], names=names)
    return run


def _chosen(apart: DataFrame, sets: DataFrame, refuted: DataFrame, percent: int, tile: int,
            most: int) -> tuple[DataFrame, DataFrame]:
    """(u, v): the ``most`` best candidates of each component over all
    meetings, written; and (doc): the ends of all candidates, written. What is
    no candidate never becomes one (components and refuted pairs only grow),
    so the other classes are done. A meeting of more than ``tile`` classes is dealt into
    tiles by hash, and each pair of its tiles is a row of its own."""
    out = "u long, v long, cu long, cv long, far long"
    known = refuted.groupBy("u").agg(F.collect_list("v").alias("refuted"))
    # a class has its refuted pairs before it is dealt to its meetings
    rows = sets.select("doc", "size", "few").join(known.withColumnRenamed("u", "doc"), "doc", "left")
    held = apart.join(rows, "doc")
    row = F.struct("doc", "component", "size", "few", "refuted")
    n_tiles = F.ceil(F.col("n") / tile)
    one = held.filter(F.col("n") <= tile).groupBy("key").agg(F.collect_list(row).alias("x"))
    cut = materialise(
        held.filter(F.col("n") > tile)
        .withColumn("t", F.pmod(F.xxhash64(F.lit(7), "doc"), n_tiles)).withColumn("tiles", n_tiles)
        .groupBy("key", "t", "tiles").agg(F.collect_list(row).alias("x")), "tiles")
    left = cut.filter("t + 1 < tiles").select(
        "key", "t", "x", F.explode(F.sequence(F.col("t") + 1, F.col("tiles") - 1)).alias("u"))
    right = cut.filter("t > 0").select(
        "key", F.col("t").alias("u"), F.col("x").alias("y"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("t") - 1)).alias("t"))
    pairs = left.join(right, ["key", "t", "u"]).select("x", "y")
    run = _tile_candidates(percent, most)
    found = materialise(one.select("x").mapInArrow(run, out)
                        .unionByName(cut.select("x").mapInArrow(run, out))
                        .unionByName(pairs.mapInArrow(run, out)).distinct(), "found")
    opened = materialise(found.select(F.explode(F.array("u", "v")).alias("doc"))
                         .filter("doc is not null").distinct(), "open")
    ends = found.filter("v is not null").select("u", "v", "far", F.explode(F.array("cu", "cv")).alias("c"))
    first = Window.partitionBy("c").orderBy("far", "u", "v")
    # a pair may meet in several parts: rank distinct ones
    best = materialise(
        ends.distinct().withColumn("r", F.row_number().over(first)).filter(F.col("r") <= most)
        .select("u", "v").distinct(), "candidates")
    discard(cut, found)
    return best, opened


def _exact(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = [linked(x[i].values.to_numpy(), y[i].values.to_numpy(), percent)
                    for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def _with_ends(pairs: DataFrame, rows: DataFrame, u: list[str], v: list[str]) -> DataFrame:
    """The written ``pairs`` (u, v) with the further columns of ``rows`` (their
    first is doc) for both ends, under the names ``u`` and ``v``. While the
    pairs are few enough to be broadcast, only rows of their ends travel."""
    left, right = rows.toDF("u", *u), rows.toDF("v", *v)
    if is_small(pairs):
        left = left.join(F.broadcast(pairs), "u")
        right = right.join(F.broadcast(pairs.select("v").distinct()), "v", "left_semi")
    else:
        left = pairs.join(left, "u")
    return left.join(right, "v").select("u", "v", *(c for both in zip(u, v, strict=True) for c in both))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the written pairs (u, v) that link, written: whole bitmaps
    first, then arrays."""
    may = materialise(
        _with_ends(pairs, sets.select("doc", "size", "bits"), ["nu", "bu"], ["nv", "bv"])
        .mapInArrow(_bit_bound(percent), "u long, v long").distinct(), "pairs")
    links = materialise(
        _with_ends(may, sets.select("doc", "shingles"), ["x"], ["y"])
        .mapInArrow(_exact(percent), "u long, v long").distinct(), "links")
    discard(may)
    return links


def _apart(met: DataFrame, found: DataFrame) -> DataFrame:
    """(key, doc, component, n) of the meetings of more than one component."""
    placed = met.select("key", "doc").join(
        maybe_broadcast(found), F.col("doc") == F.col("node"), "left").select(
        "key", "doc", F.coalesce("component", "doc").alias("component"))
    split = (placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                       F.count(F.lit(1)).alias("n"))
             .filter("x < y").select("key", "n"))
    return materialise(placed.join(split, "key"), "apart")


def _contracted(links: DataFrame, found: DataFrame) -> DataFrame:
    """Links between documents -> links between their components."""
    at = maybe_broadcast(found.select(F.col("node").alias("at"), F.col("component").alias("above")))
    for end in ("u", "v"):
        links = links.join(at, F.col(end) == F.col("at"), "left").withColumn(
            end, F.coalesce("above", end)).select("u", "v")
    return links


def _merged(found: DataFrame, joined: DataFrame) -> DataFrame:
    """``found`` after its components were ``joined`` to smaller ones."""
    at = materialise(joined.select(F.col("node").alias("at"), F.col("component").alias("above")),
                     "joined")
    moved = found.join(maybe_broadcast(at), F.col("component") == F.col("at"), "left").select(
        "node", F.coalesce("above", "component").alias("component"))
    tops = at.join(maybe_broadcast(found.select(F.col("node").alias("at"))), "at", "left_anti").select(
        F.col("at").alias("node"), F.col("above").alias("component"))
    merged = materialise(moved.unionByName(tops), "components")
    discard(at, found)
    return merged


def join_components(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id",
                    text_col: str = "text", tile: int = 256) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` (distinct ``n``-word
    shingles), ``class_id`` (smallest id with the same set) and
    ``component_id`` (smallest id reachable by links, where two documents
    link if 100 * intersection >= percent * union). Other columns of ``docs``
    are not looked at.

    A null text, or one without words, has an empty set and links with
    nothing: class and component are its own id. A row with a null id has
    its shingles counted; its class and component are null. Rows that repeat
    an id are one node with the links of each of them. An empty table gives
    no rows; texts of any length are taken whole."""
    if not 67 <= percent < 100:                             # bands link to the next at most
        raise ValueError("percent must lie in 67 .. 99")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    with written_tables() as tables:
        out = materialise(_joined(rows, n, percent, tile), "joined")
    delete_tables(docs.sparkSession, tables[:-1])
    return out.withColumnRenamed("doc", id_col)


def _joined(rows: DataFrame, n: int, percent: int, tile: int) -> DataFrame:
    """``join_components`` of rows (doc, text), the id column named doc. What
    it reads of written tables goes with them; the large ones go as soon as no
    later step reads them."""
    member = materialise(
        rows.mapInArrow(_sets(n), "doc long, size long, a long, b long"), "members")
    # written, so that joins on it are plain ones, whose large partitions split
    classes = materialise(member.filter("size > 0 and doc is not null").groupBy("a", "b")
                          .agg(F.min("doc").alias("class")), "classes")
    chosen = classes.select(F.col("class").alias("doc")).distinct()
    copies = materialise(member.filter("size > 0").select("doc").distinct().join(
        chosen, "doc", "left_anti").filter("doc is not null"), "copies")
    own = join_by_id(rows.filter("doc is not null"), copies, "doc", "left_anti")

    by_key = Window.partitionBy("key")
    hashes = [F.bit_xor(F.xxhash64(F.lit(i), "doc")).over(by_key).alias(f"h{i}") for i in (1, 2)]
    every = materialise(
        own.mapInArrow(_keys(n, percent), "doc long, keys array<long>")
        .select(F.explode("keys").alias("key"), "doc")
        .select("key", "doc", F.min("doc").over(by_key).alias("leader"),
                F.max("doc").over(by_key).alias("last"), F.count(F.lit(1)).over(by_key).alias("n"),
                *hashes)
        .filter("leader < last"), "meetings")
    # copies of a text meet in many parts: meetings of the same classes (by two
    # hashes and their number) are one
    one = every.groupBy("n", "h1", "h2").agg(F.min("key").alias("key")).select("key")
    met = materialise(every.join(one, "key", "left_semi").select("key", "doc", "leader"), "met")
    discard(every, copies)

    involved = materialise(met.select("doc").distinct(), "involved")
    sets = materialise(join_by_id(rows, involved, "doc", "left_semi").mapInArrow(
        _signatures(n), "doc long, size long, bits binary, few binary, shingles array<long>"), "sets")
    first = materialise(met.groupBy("doc").agg(F.min("leader").alias("v")).filter("v < doc").select(
        F.col("doc").alias("u"), "v"), "first")
    # one leader each, and smaller: the links found form a forest
    links = _verified(first, sets, percent)
    found = materialise(roots(links.select(F.col("u").alias("node"), F.col("v").alias("parent")),
                              is_small(links)), "components")

    # meetings of more than one component (components only grow, so the others
    # stay settled): first against a few more leaders
    apart = _apart(met, found)
    discard(met)
    for r in range(MIXING):
        if apart.isEmpty():
            break
        lead = (apart.groupBy("key").agg(F.min_by(
            F.struct("doc", "component"), F.xxhash64(F.lit(r), "doc")).alias("l"))
            .select("key", F.col("l.doc").alias("other"), F.col("l.component").alias("theirs")))
        tried = materialise(
            apart.join(lead, "key").filter("component <> theirs").groupBy("doc")
            .agg(F.min_by("other", F.xxhash64(F.lit(r), "other", "doc")).alias("other"))
            .select(F.greatest("doc", "other").alias("u"), F.least("doc", "other").alias("v"))
            .distinct(), "tried")
        more = _verified(tried, sets, percent)
        found = _merged(found, components(_contracted(more, found)))
        before, apart = apart, _apart(apart, found)
        discard(before, tried)
    # then the best candidates of each component, until none is left
    refuted, most = first.limit(0), 4
    while not apart.isEmpty():
        tried, opened = _chosen(apart, sets, refuted, percent, tile, most)
        if tried.isEmpty():
            break
        more = _verified(tried, sets, percent)
        refuted = materialise(refuted.unionByName(tried.join(more, ["u", "v"], "left_anti")), "refuted")
        found = _merged(found, components(_contracted(more, found)))
        left = apart.join(maybe_broadcast(opened), "doc", "left_semi")
        before, apart, most = apart, _apart(left, found), 4 * most
        discard(before, tried, opened)
    discard(sets, apart)
    placed = member.join(classes, ["a", "b"], "left").select(
        "doc", "size", F.when(F.col("size") > 0, F.col("class")).otherwise(F.col("doc")).alias("class"))
    # an id that repeats with other texts ties its classes together
    twice = (placed.groupBy("doc").agg(F.min("class").alias("v"), F.max("class").alias("last"))
             .filter("v < last").select("doc", "v"))
    ties = placed.join(twice, "doc").select(F.col("class").alias("u"), "v")
    joined = components(_contracted(ties, found)).select(F.col("node").alias("at"), F.col("component").alias("above"))
    own = F.coalesce("component", "class")
    return (placed.join(found, F.col("class") == F.col("node"), "left").withColumn("own", own)
            .join(joined, F.col("own") == F.col("at"), "left")
            .select("doc", F.col("size").alias("n_shingles"),
                    F.when(F.col("doc").isNotNull(), F.col("class")).alias("class_id"),
                    F.when(F.col("doc").isNotNull(), F.coalesce("above", "own"))
                    .alias("component_id")))


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; rows
    with a null id stay. Columns unchanged."""
    placed = join_components(docs, id_col=id_col, **kw)
    gone = materialise(placed.filter(F.col(id_col) > F.col("component_id")).select(id_col).distinct(), "gone")
    discard(placed)
    return join_by_id(docs, gone, id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
