"""Exact top-k search by inner product over a bit-sliced index.

Vectors become integers (``floor(scale * x)``). A task holds a block of
candidate rows as bit slices: for each component and bit, one bitmap over
the block's rows. For a query, the weighted component slices are added with
carry-save bitmap arithmetic (three bitmaps of one weight become one of that
weight and one of the next); a negative weight uses the complement slices,
which only shifts all scores. The lowest slices are left out, so each score
is known up to an error bound. Walking the summed slices from the most
significant one down gives the k-th largest lower bound; the rows that can
still reach it are resolved exactly with integer products, ties to the
smaller id. Blocks' winners meet in a ranked window per query.

Queries travel in chunks of ``query_chunk`` rows (the bound of what one
broadcast holds); each chunk scans all rows once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import shared_path

#: Quantised components stay below this, so that their differences fit in a
#: long, and products of two vectors below that, so that scores do.
COMPONENT_LIMIT = 1 << 61
SCORE_LIMIT = 9.2e18


class SlicedBlock:
    """Bit slices of one block of integer vectors (rows x dims)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, dropped: int):
        self.ids, self.vectors = ids, vectors
        n, dims = vectors.shape
        self.words = -(-n // 64)
        self.rows = self._bitmap(np.ones(n, bool))
        low = vectors.min(axis=0) if dims else np.zeros(0, np.int64)
        self.most = np.abs(vectors).max(axis=0).astype(float) if dims else np.zeros(0)
        shifted = vectors - low
        self.bits = [int(x).bit_length() for x in shifted.max(axis=0)] if dims else []
        self.dropped = dropped
        place = [(j, b) for j in range(dims) for b in range(dropped, self.bits[j])]
        slices = [self._bitmap((shifted[:, j] >> b) & 1) for j, b in place]
        plain = np.array(slices, np.uint64).reshape(len(place), self.words)
        self.slices = np.concatenate([plain, ~plain & self.rows])
        self.dim = np.array([j for j, _ in place], np.int64)
        self.bit = np.array([b for _, b in place], np.int64)

    def _bitmap(self, flags: np.ndarray) -> np.ndarray:
        packed = np.zeros(self.words * 8, np.uint8)
        bits = np.packbits(flags.astype(np.uint8))
        packed[:len(bits)] = bits
        return packed.view(np.uint64)

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of sum |q_j| * (u_j, or its complement where q_j < 0)."""
        weight = np.abs(query)[self.dim]
        at = np.arange(len(self.dim)) + np.where(query[self.dim] < 0, len(self.dim), 0)
        top = int(np.abs(query).max(initial=0)).bit_length() + max(self.bits, default=0)
        out: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        p = 0
        while p < top or carried:
            shift = p - self.bit
            use = (shift >= 0) & ((weight >> np.clip(shift, 0, 63)) & 1 == 1)
            now = np.concatenate([self.slices[at[use]], *carried])
            carried = []
            while len(now) > 2:
                m = len(now) // 3
                a, b, c = now[:m], now[m:2 * m], now[2 * m:3 * m]
                ab = a ^ b
                carried.append((a & b) | (ab & c))
                now = np.concatenate([ab ^ c, now[3 * m:]])
            if len(now) == 2:
                carried.append((now[0] & now[1])[None])
                now = (now[0] ^ now[1])[None]
            out.append(now[0] if len(now) else np.zeros(self.words, np.uint64))
            p += 1
        return out

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows other than ``query_id``'s own."""
        if np.abs(query).astype(float) @ self.most >= SCORE_LIMIT:
            raise ValueError("a quantised component is so large that a score need not fit in a long")
        own = self.ids == query_id
        live = self.rows & ~self._bitmap(own) if own.any() else self.rows
        sums = self.sums(query)
        kth, sure, open_ = 0, 0, live
        for p in range(len(sums) - 1, -1, -1):
            one = open_ & sums[p]
            n = int(np.bitwise_count(one).sum())
            if sure + n >= k:
                open_, kth = one, kth | (1 << p)
            else:
                sure, open_ = sure + n, open_ & ~sums[p]
        least = kth - sum(np.abs(query).tolist()) * ((1 << self.dropped) - 1)
        found = live
        if least > 0:
            more, same = np.zeros_like(live), live
            for p in range(max(len(sums), least.bit_length()) - 1, -1, -1):
                s = sums[p] if p < len(sums) else np.zeros_like(live)
                if (least >> p) & 1:
                    same = same & s
                else:
                    more, same = more | (same & s), same & ~s
            found = more | same
        rows = np.flatnonzero(np.unpackbits(found.view(np.uint8)))
        scores = self.vectors[rows] @ query
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][best], scores[best]


def _quantised(array: pa.ListArray, scale: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: (row numbers, integer vectors)."""
    lengths = np.asarray(array.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    values = np.floor(array.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(values) and np.abs(values).max() >= COMPONENT_LIMIT:
        raise ValueError(f"a quantised component reaches {COMPONENT_LIMIT}")
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    out = {}
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        out[int(n)] = (rows, values[starts[rows][:, None] + np.arange(n)].astype(np.int64))
    return out


def _search(queries: dict, k: int, scale: int, block_rows: int, dropped: int):
    """queries: vector length -> (query keys, query ids, integer vectors)."""
    schema = pa.schema([("query_key", pa.int64()), ("query_id", pa.int64()),
                        ("vec_id", pa.int64()), ("score", pa.int64())])

    def block(n: int, held: list) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate([i for i, _ in held])
        index = SlicedBlock(ids, np.concatenate([v for _, v in held]), dropped)
        keys, query_ids, vectors = queries[n]
        out: list[list[np.ndarray]] = [[], [], [], []]
        for key, query_id, vector in zip(keys, query_ids, vectors, strict=True):
            found, scores = index.top(int(query_id), vector, k)
            for column, x in zip(out, (np.full(len(found), key), np.full(len(found), query_id),
                                       found, scores), strict=True):
                column.append(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x), pa.int64()) for x in out], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for n, (rows, vectors) in _quantised(batch.column(1), scale).items():
                if n in queries:
                    held.setdefault(n, []).append((ids[rows], vectors))
                    if sum(len(i) for i, _ in held[n]) >= block_rows:
                        yield from block(n, held.pop(n))
        for n, rest in held.items():
            yield from block(n, rest)

    return run


def top_k(vectors: DataFrame, k: int = 10, query_every: int = 100, scale: int = 1024,
          id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = 16384,
          query_chunk: int = 16384, dropped_slices: int = 2) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by
    ``query_every``, the ``k`` other rows of highest integer inner product
    (all, if fewer), ties to the smaller id.

    Rows with a null id, a null vector, or a null or non-finite component
    take no part; a vector meets those of its own length only; rows that
    repeat an id are candidates each, none of them for a query of that id,
    and repeated query rows count once. An empty table gives no rows.
    Components may be large: only if a query's absolute components times the
    largest of a block (its own row included) reach 9.2e18, so that a score
    need not fit in a long, or a quantised component reaches 2^61, the search
    ends with a ValueError, as Spark's checked arithmetic does.
    """
    spark = vectors.sparkSession
    x = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
    x = x.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    asked = x.filter(F.col("id") % query_every == 0).distinct()
    chunks = max(1, -(-asked.count() // query_chunk))
    path = shared_path(spark, "topk") if chunks > 1 else None
    found = None
    for chunk in range(chunks):
        held = asked if chunks == 1 else asked.filter(
            F.pmod(F.xxhash64("id", "v"), F.lit(chunks)) == chunk)
        table = held.orderBy("id", "v").toArrow().combine_chunks()
        queries = {}
        if table.num_rows:
            ids = table.column("id").chunk(0).to_numpy(zero_copy_only=False)
            for n, (rows, q) in _quantised(table.column("v").chunk(0), scale).items():
                queries[n] = (rows, ids[rows], q)
        best = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
        found = (x.mapInArrow(_search(queries, k, scale, block_rows, dropped_slices),
                              "query_key long, query_id long, vec_id long, score long")
                 .withColumn("rank", F.row_number().over(best))
                 .filter(F.col("rank") <= k)
                 .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
        if path:
            found.write.mode("append").parquet(path)
    return spark.read.schema(found.schema).parquet(path) if path else found
