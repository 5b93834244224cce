"""Library helpers not exercised by a registered query, on small inputs
derived from the fixtures."""

import math

from pyspark.sql import functions as F

from lodestar.operators import aggregates as A
from lodestar.operators import reshape as H
from lodestar.tables import Tables
from tests.conftest import SF_SMALL


def test_group_agg_and_distinct_count(spark):
    o = Tables(spark, SF_SMALL).orders
    g = {r.o_orderstatus: r for r in A.group_agg(o, "o_orderstatus", {"o_totalprice": ["min", "max"]}).collect()}
    d = {r.o_orderstatus: r.n_o_custkey for r in A.distinct_count(o, "o_orderstatus", "o_custkey").collect()}
    pdf = o.toPandas()
    for s, grp in pdf.groupby("o_orderstatus"):
        assert math.isclose(g[s].min_o_totalprice, grp.o_totalprice.min())
        assert d[s] == grp.o_custkey.nunique()
    approx = A.distinct_count(o, "o_orderstatus", "o_custkey", approx=True).collect()
    assert all(r.n_o_custkey > 0 for r in approx)


def test_pivot_agg(spark):
    li = Tables(spark, SF_SMALL).lineitem
    p = H.pivot_agg(li, ["l_returnflag"], "l_linestatus", ["F", "O"], F.sum("l_quantity"))
    tot = sum((r.F or 0) + (r.O or 0) for r in p.collect())
    assert math.isclose(tot, li.agg(F.sum("l_quantity")).first()[0])


def test_generate_churn_and_binary_metrics(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from lodestar.ml.evaluate import binary_metrics
    from lodestar.ml.models import tabular_stages
    from lodestar.sources.generator import generate_churn
    ch = generate_churn(spark, 3000, seed=7)
    assert ch.count() == 3000 and ch.select("CustomerID").distinct().count() == 3000
    rates = {r.ContractType: r.n for r in ch.groupBy("ContractType").agg(F.count("*").alias("n")).collect()}
    assert abs(rates["Month-to-month"] / 3000 - 0.5) < 0.05
    prep = tabular_stages(["ContractType"], ["TenureMonths", "MonthlyCharges", "TechSupportCalls"],
                          label="Churn")
    m = Pipeline(stages=prep + [LogisticRegression(maxIter=30)]).fit(ch)
    mets = binary_metrics(m.transform(ch))
    assert mets["areaUnderROC"] > 0.8 and 0 < mets["areaUnderPR"] <= 1


def test_read_text_and_fetch(spark, tmp_path):
    from lodestar.sources import files as IO
    p = str(tmp_path / "t")
    Tables(spark, SF_SMALL).region.select(F.col("r_name").alias("value")).write.text(p)
    assert sorted(r.value for r in IO.read_text(spark, p).collect()) == \
        sorted(r.r_name for r in Tables(spark, SF_SMALL).region.collect())


def test_box_stats_approx_close_to_exact(spark):
    from lodestar.operators.charts import box_stats
    e = Tables(spark, SF_SMALL).events
    ex = {r.event_type: r for r in box_stats(e, "event_type", "value").collect()}
    ap = {r.event_type: r for r in box_stats(e, "event_type", "value", approx=True).collect()}
    assert ex.keys() == ap.keys()
    for k in ex:
        assert abs(ex[k].median - ap[k].median) <= 0.05 * max(1.0, abs(ex[k].median))
