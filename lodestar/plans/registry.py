"""Query registry: name -> (builder, oracle SQL, survey ids).

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input tables. The oracle SQL is the same question in DuckDB SQL over
the pre-registered views; ``None`` means the result is not SQL-expressible
(seeded ML, native sampling) and only row counts are compared.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Builder
    sql: str | None
    ids: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def _bigint_count_if(sql: str) -> str:
    """DuckDB types ``count_if`` as HUGEINT; Spark's is BIGINT. Wrap every
    ``count_if(...)`` of an oracle in a BIGINT cast so the schemas agree."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j])
        out.append(f"CAST({sql[j:k]} AS BIGINT)")
        i = k


def query(name: str, ids: str = "", sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        oracle = _bigint_count_if(sql) if sql else None
        REGISTRY[name] = Entry(name, fn, oracle, tuple(ids.split()))
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # importing the plan modules fills REGISTRY
    from lodestar.plans import (  # noqa: F401
        business, charts, core, ml_plans, model_selection, profiling, series_plans,
        sources_plans, streaming_plans, text_plans, triples_plans, windows_plans)
    return REGISTRY
