"""Line dedup: each hash is written once, and lines may go on in the next batch."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import line_dedup


@pytest.mark.parametrize("small", [True, False])
def test_line_dedup_moves_each_hash_once(spark, monkeypatch, small):
    rows = [(i, f"Read all our news on {'abcdef'[i]} right here\nown{i} words{i} only{i}\nRead all our news on {'abcdef'[i]} right here")
            for i in range(6)]
    held, write = {}, line_dedup.materialise

    def noted(df, name):
        out = write(df, name)
        lists = [c for c, kind in out.dtypes if kind == "array<bigint>"]
        if lists:
            held[name] = out.agg(*[F.sum(F.size(c)) for c in lists]).first()
        return out

    monkeypatch.setattr(line_dedup, "materialise", noted)
    monkeypatch.setattr(line_dedup, "is_small", lambda table: small)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_dedup.drop_recurring_lines(docs, most=1.0, whole=1.1).collect()}
    # 8 constant tokens in either line of each document, each hash in one list only
    assert sum(held["cells"]) == 6 * 2 * 8
    assert [got[i]["n_dropped"] for i in range(6)] == [0, 2, 2, 2, 2, 2]
    assert all(got[i]["text"] == f"own{i} words{i} only{i}" for i in range(1, 6))


def test_field_templates_of_lines_across_batches():
    n = 40
    at = np.repeat(np.arange(10), 4)
    columns = [at, np.full(n, 4), np.tile([5, 7, 9, 9], 10), np.arange(n) + 1000]
    whole = [pa.array(c) for c in columns]
    names = ["at", "size", "n", "cell"]
    run = line_dedup._fields(3, 0.6)

    def keys(step):
        parts = (pa.RecordBatch.from_arrays([c.slice(i, step) for c in whole], names=names) for i in range(0, n, step))
        return sorted((r["at"], r["key"]) for b in run(parts) for r in b.to_pylist())

    assert len(keys(n)) == 20 and all(keys(step) == keys(n) for step in (1, 3, 4, 7))
