"""Quality classifier by positive-unlabelled learning.

Trusted positives are training rows labelled good; everything else a row says
(bad labels included) is ignored, and unlabelled web text stands for the
mixture of good and bad. A linear model on features of the text's bytes
minimises the non-negative unbiased risk
``prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))``; the class prior is
estimated from scores: of all cuts, the least ratio (with its confidence
margin) between the shares of unlabelled and of positive rows above it.

Fitting reads a bounded sample (``sample`` positives and as many unlabelled
rows, those of the least hashes); scoring maps over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import without

#: Byte classes: lower case and digits, upper case, space, line end, sentence
#: marks, shouting marks, bars, other marks, letters beyond ASCII.
CLASSES = np.full(256, 7, np.uint8)
for _i, _bytes in enumerate(((*range(0x61, 0x7B), *range(0x30, 0x3A)), range(0x41, 0x5B),
                             (0x20, 0x09), (0x0A, 0x0D), b".,;:'\"()-", b"!?", b"|")):
    CLASSES[list(_bytes)] = _i
CLASSES[0x80:] = 8
N_CLASSES = 9
N_FEATURES = N_CLASSES ** 2 + 6
#: Standardised features beyond this many deviations count as this many.
LIMIT = 6.0
#: Features that hardly vary are not blown up beyond this.
LEAST_SCALE = 1.0
#: Rows whose features a worker holds at once, and returns at once.
AT_ONCE = 500


def features(text: str | None) -> np.ndarray:
    """How often each byte class follows each other one, and how long and how
    repetitive the text is. An empty text has zeros but for its length."""
    out = np.zeros(N_FEATURES)
    data = (text or "").encode()
    if not data:
        return out
    c = CLASSES[np.frombuffer(data, np.uint8)]
    pairs = np.bincount(c[:-1].astype(np.int64) * N_CLASSES + c[1:], minlength=N_CLASSES ** 2)
    out[:N_CLASSES ** 2] = np.log1p(pairs * (1000 / len(data)))
    words = data.split()
    n = max(1, len(words))
    again = sum(map(bytes.__eq__, words, words[1:]))
    out[-6:] = (1, np.log1p(len(data)), len(set(words)) / n, 20 * again / n,
                np.log1p(len(data) / n), np.log1p(n / (1 + data.count(b"\n"))))
    return out


def held_out(id_col: str):
    """Folds: rows whose crc32(id as text) mod 3 is 1 are never learnt from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores of both."""
    cuts = np.unique(np.quantile(positive, np.linspace(0, 0.95, 96)))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    margin = (np.sqrt(np.log(4 / delta) / (2 * len(positive)))
              + np.sqrt(np.log(4 / delta) / (2 * len(unlabelled)))) / p
    best = int(np.argmin(u / p + margin))
    return float(np.clip(u[best] / p[best], 0.02, 0.98))


class Model:
    def __init__(self, mean, scale, weights, bias):
        self.mean, self.scale, self.weights, self.bias = mean, scale, weights, bias

    def logits(self, x: np.ndarray) -> np.ndarray:
        # row by row: equal texts score alike in any batch
        return (np.clip((x - self.mean) / self.scale, -LIMIT, LIMIT) * self.weights).sum(1) + self.bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -35, 35)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, rounds: int = 400, ridge: float = 1e-2,
        rate: float = 0.05) -> Model:
    """Non-negative PU risk with logistic loss, by full-batch Adam; the prior
    starts from a first fit at one half and is estimated from its scores."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0)
    scale = np.maximum(scale, LEAST_SCALE)
    xp, xu = (np.clip((x - mean) / scale, -LIMIT, LIMIT) for x in (positive, unlabelled))
    prior, model = 0.5, None
    for _ in range(3):
        w = np.zeros(xp.shape[1] + 1)
        m, v = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, rounds + 1):
            zp, zu = xp @ w[:-1] + w[-1], xu @ w[:-1] + w[-1]
            sp, su = 1 / (1 + np.exp(-np.clip(zp, -35, 35))), 1 / (1 + np.exp(-np.clip(zu, -35, 35)))
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            gp, gu = sp / len(sp) * prior, su / len(su)       # slopes of the negative part
            if negative >= 0:
                gp = (sp - 1) / len(sp) * prior - gp
            else:                                             # climb back, as the bound is crossed
                gu = -gu
            g = np.concatenate([xp.T @ gp + xu.T @ gu, [gp.sum() + gu.sum()]])
            g[:-1] += ridge * w[:-1]
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        model = Model(mean, scale, w[:-1], w[-1])
        prior = class_prior(model.logits(positive), model.logits(unlabelled))
    model.prior = prior
    return model


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, ``AT_ONCE`` at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        x = [features(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))],
                                         names=["positive", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = 6000, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Fit on at most ``sample`` trusted positives and ``sample`` rows of
    ``docs`` as unlabelled text. An id labelled both ways is not trusted. None
    if there is nothing to learn from. Of rows that repeat an id the least text
    stands for all."""
    ids = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    good = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
            .filter("id is not null and y is not null").filter(~held_out("id"))
            .groupBy("id").agg(F.min("y").alias("y")).filter("y = 1"))
    by_hash = [F.xxhash64(F.lit(11), "id"), F.col("id")]
    # both lists are bounded by ``sample``
    trusted = good.select("id").orderBy(*by_hash).limit(sample).withColumn("positive", F.lit(True))
    web = ids.select("id").distinct().orderBy(F.xxhash64(F.lit(12), "id"), "id").limit(sample) \
        .withColumn("positive", F.lit(False))
    rows = ids.join(F.broadcast(trusted.unionByName(web)), "id").groupBy("id", "positive").agg(
        F.min("text").alias("text")).select("positive", "text")
    got = rows.mapInArrow(_features, "positive boolean, x array<double>").toArrow().combine_chunks()
    if not got.num_rows:
        return None
    flag = got.column("positive").to_numpy(zero_copy_only=False).astype(bool)
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, N_FEATURES)
    order = np.lexsort((*x.T[::-7], flag))                  # rows come in any order
    x, flag = x[order], flag[order]
    return fit(x[flag], x[~flag]) if flag.any() and not flag.all() else None


def score(docs: DataFrame, model: Model | None, text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """All rows and columns of ``docs`` with ``score`` (0 to 1, higher: good
    likelier) and ``predicted`` (1 if score >= threshold). Input columns of
    these names are replaced. Whole texts are scored; a null text scores as
    an empty one; equal texts score alike; without a model (no trusted
    positives) every score is 0.5."""
    out = without(docs, "score", "predicted")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column(batch.schema.names.index(text_col))
            if model is None:
                s = np.full(len(column), 0.5)
            else:
                s = model.scores(np.stack([features(t.as_py()) for t in column]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"])

    return out.mapInArrow(run, f"{fields}, score double, predicted int")


def drop_rejected(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, columns unchanged."""
    names = [f"c{i}" for i in range(len(docs.columns))]      # whatever the columns are called
    kept = score(docs.toDF(*names), train(docs, labels, **kw), names[docs.columns.index("text")])
    return kept.filter("predicted = 1").select(*names).toDF(*docs.columns)
