"""Every registered query with an oracle matches DuckDB on sf0.001
(row count, column names, order-insensitive values)."""

import math

import pytest

from lodestar.plans.registry import load_all

ENTRIES = load_all()
WITH_SQL = sorted(n for n, e in ENTRIES.items() if e.sql)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, duck, name):
    from tests.conftest import SF_SMALL
    e = ENTRIES[name]
    df = e.build(spark, SF_SMALL)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(e.sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)


def test_registry_covers_every_survey_group():
    ids = {i for e in ENTRIES.values() for i in e.ids}
    for prefix in "S I P J A W O U F R H C X N E M V T G K D B Y".split():
        assert any(i.startswith(prefix) for i in ids), prefix


def test_no_query_named_like_a_pipeline_step():
    for n in ENTRIES:
        assert "pipeline" not in n and not n.startswith("op")
