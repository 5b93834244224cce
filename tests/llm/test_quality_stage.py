"""Quality stage: what passes through Python."""

from pyspark.sql.types import StructType

from lodestar.llm import quality


def test_quality_stage_sends_texts_once(spark, monkeypatch):
    rows = [(i, "Good text, clean and calm.\n" * 3 if i % 2 else "BUY!!! NOW|||" * 9, float(i), "own") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, c0 string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    sent, score = [], quality.score

    def noted(df, *rest, **kw):
        sent.append(df.schema)
        return score(df, *rest, **kw)

    monkeypatch.setattr(quality, "score", noted)
    out = quality.drop_rejected(docs, labels)
    assert out.schema == docs.schema
    want = {r["doc_id"] for r in score(docs, quality.train(docs, labels)).filter("predicted = 1").collect()}
    assert sorted(map(tuple, out.collect())) == [r for r in rows if r[0] in want]
    fields = [f.dataType for f in sent[0].fields]
    assert len(fields) == 4 and not any(isinstance(t, StructType) for t in fields)
