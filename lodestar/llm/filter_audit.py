"""Filter interaction audit by contractions of contingency tensors.

Each document either passes or fails each of k filters, so a part of the table
is one tensor of counts with k axes of length two (pass, fail). What a filter
does at a step of an order is a contraction: earlier axes take "pass", its own
axis "fail", later axes "all". One einsum over the tensors of many parts gives
every order and step at once.

Spark computes the flags in the JVM and counts cells (combined before the
shuffle, so neither a hot part nor a hot text matters); only tensors, 2**k
numbers a part and outcome, meet Python.
"""

from __future__ import annotations

import itertools
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import materialise, unused

#: Selections along an axis: counts of those that pass, that fail, of all.
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
COUNTS = ("kept", "removed", "redundant", "unique_fails")


def text_filters(text: Column, least_words: int = 200, distinct_percent: int = 50,
                 upper_percent: int = 2, symbols: str = "#$%&*|") -> dict[str, Column]:
    """Failure conditions of a whole text: too few words, too few distinct
    words, too many capitals, any of ``symbols``. A null text is empty."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, "[ \\t-\\r]+", -1), "")
    n = F.size(words).cast("long")
    return {
        "A": n < least_words,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < distinct_percent * n,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long")
        > upper_percent * F.length(text).cast("long"),
        "D": text.rlike("[" + "".join(f"\\{c}" for c in symbols) + "]"),
    }


def repeated_texts(rows: DataFrame, id_col: str, key: str, name: str) -> DataFrame:
    """``rows`` (id, key of the text and a few numbers) with the flag ``name``:
    a smaller id has the same text. Rows that share the smallest id do not
    repeat each other; a null id neither repeats nor is repeated. The join is
    on key and id, so a text that a third of the rows share is spread by id."""
    k, i = unused(rows, "_key", "_id")
    first = (rows.filter(F.col(id_col).isNotNull()).groupBy(F.col(key).alias(k))
             .agg(F.min(id_col).alias(i)))
    found = rows.join(first, (F.col(key) == F.col(k)) & (F.col(id_col) == F.col(i)), "left")
    return found.withColumn(name, F.col(id_col).isNotNull() & F.col(i).isNull()).drop(k, i)


def cells(rows: DataFrame, part: str, filters: list[str], outcomes: dict[str, Column]) -> DataFrame:
    """One row per part: ``cells``, its sums of ``n`` by failed filters (the first
    filter is the highest bit) as structs of cell, n and one n per outcome."""
    bits = sum((F.col(f).cast("int") * (1 << (len(filters) - 1 - i))
                for i, f in enumerate(filters)), F.lit(0))
    sums = [F.sum("n").alias("n"),
            *[F.sum(F.when(c, F.col("n")).otherwise(F.lit(0))).alias(o) for o, c in outcomes.items()]]
    counted = rows.groupBy(F.col(part).alias("part"), bits.alias("cell")).agg(*sums)
    return counted.groupBy("part").agg(                       # at most 2 ** k structs
        F.collect_list(F.struct("cell", "n", *outcomes)).alias("cells"))


def steps(k: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of k filters and, for (order, step, kind, axis), the
    selection along the axis; kinds as in COUNTS, with ``redundant`` still
    holding what the step removes."""
    orders = list(itertools.permutations(range(k)))
    pick = np.zeros((len(orders), k, len(COUNTS), k, 2), np.int64)
    for o, order in enumerate(orders):
        for s, own in enumerate(order):
            for axis in range(k):
                before = order.index(axis) < s
                pick[o, s, 0, axis] = PASS if before or axis == own else ALL
                pick[o, s, 1, axis] = FAIL if axis == own else PASS if before else ALL
                pick[o, s, 2, axis] = FAIL if axis == own else ALL
                pick[o, s, 3, axis] = FAIL if axis == own else PASS
    return orders, pick


def contract(tensors: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """(part, outcome, order, step, kind) counts of ``tensors`` (part, outcome,
    axis...): the axes are contracted one after the other."""
    k = pick.shape[3]
    axes = "abcdefgh"[:k]
    out = np.einsum(f"yz{axes},xa->yzx{axes[1:]}", tensors, pick[..., 0, :].reshape(-1, 2))
    for i in range(1, k):
        out = np.einsum(f"yzx{axes[i:]},x{axes[i]}->yzx{axes[i + 1:]}", out,
                        pick[..., i, :].reshape(-1, 2))
    return out.reshape(*out.shape[:2], *pick.shape[:3])


def _audit(filters: list[str], outcomes: list[str], parts_at_once: int = 64):
    k = len(filters)
    orders, pick = steps(k)
    names = ["".join(filters[i] for i in order) for order in orders]
    own = np.array(orders)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, parts_at_once):
                some = batch.slice(at, parts_at_once)
                tensors = np.zeros((some.num_rows, 1 + len(outcomes), 1 << k), np.int64)
                for p, found in enumerate(some.column(1).to_pylist()):
                    for c in found:
                        tensors[p, :, c["cell"]] = [c["n"], *[c[o] for o in outcomes]]
                out = contract(tensors.reshape(*tensors.shape[:2], *[2] * k), pick)
                kept, gone, fails, alone = (out[:, 0, :, :, i] for i in range(len(COUNTS)))
                # a filter's removals, summed over the orders
                by_filter = np.stack([np.where(own == f, gone, 0).sum((1, 2)) for f in range(k)], 1)
                shape = gone.shape
                yield pa.RecordBatch.from_pydict({
                    "part": some.column(0).take(pa.array(np.repeat(np.arange(shape[0]), len(orders) * k))),
                    "filter_order": pa.array(np.broadcast_to(np.array(names)[None, :, None], shape).ravel()),
                    "step": pa.array(np.broadcast_to(np.arange(1, k + 1, dtype=np.int32), shape).ravel()),
                    "kept": pa.array(kept.ravel()), "removed": pa.array(gone.ravel()),
                    "redundant": pa.array((fails - gone).ravel()),
                    "unique_fails": pa.array(alone.ravel()),
                    **{f"{o}_lost": pa.array(out[:, 1 + i, :, :, 1].ravel())
                       for i, o in enumerate(outcomes)},
                    "shapley": pa.array(by_filter[:, own].ravel())})
    return run


def audit(rows: DataFrame, part: str, filters: list[str], outcomes: dict[str, Column]) -> DataFrame:
    """One row per value of the string column ``part``, order of ``filters``
    (boolean columns with one-letter names, at most six; true: fails) and step.
    A row stands for ``n`` documents. Columns:
    counts of the documents kept after the step, removed by it, redundant
    (failing its filter, removed earlier), failing its filter only, removed
    with each outcome (``<outcome>_lost``), and the filter's removals summed
    over all orders (``shapley``). An empty table gives no rows."""
    if not 1 <= len(filters) <= 6:
        raise ValueError("orders are listed one by one: one to six filters")
    lost = "".join(f"{o}_lost long, " for o in outcomes)
    schema = ("part string, filter_order string, step int, kept long, removed long, "
              f"redundant long, unique_fails long, {lost}shapley long")
    return cells(rows, part, filters, outcomes).mapInArrow(_audit(filters, list(outcomes)), schema)


def flag_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", part_col: str = "source", **limits) -> DataFrame:
    """(part, A to E, quality, toxic, n): ``n`` rows of ``docs`` of one id that
    fail these filters (E: the text is a smaller id's); quality and toxic are 1
    if any label of the id says so, null without label. A null text is empty,
    and equals other empty texts; a null part is the empty string; a null id
    has no labels and is in no relation to other texts. Rows may repeat: equal
    ones are counted before they move. Other columns play no part."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    flags = text_filters(text, **limits)
    # texts end here: 16 bytes stand for them in the shuffles
    small = materialise(
        docs.select(F.col(f"`{id_col}`").alias("id"),
                    F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                    F.unhex(F.md5(text.cast("binary"))).alias("key"),
                    *[c.alias(f) for f, c in flags.items()])
        .groupBy("id", "part", "key", *flags).agg(F.count(F.lit(1)).alias("n")), "flags")
    marked = (repeated_texts(small, "id", "key", "E")
              .groupBy("id", "part", *flags, "E").agg(F.sum("n").alias("n")))
    known = (labels.select(F.col(f"`{id_col}`").alias("id"), "quality", "toxic")
             .filter("id is not null").groupBy("id")
             .agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic")))
    return marked.join(known, "id", "left").drop("id")


def audit_documents(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """``audit`` of ``flag_documents`` by part, with good (quality 1) and toxic
    (toxic 1) documents lost."""
    return audit(flag_documents(docs, labels, **kw), "part", list("ABCDE"),
                 {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})
