"""Factorization machine fitted over blocks of rows (survey M12).

MLlib's ``FMClassifier`` takes every row by itself in each of its passes, some
6 microseconds a row here; the same steps over numpy blocks take a small part
of that. Parameters, first weights, loss and updates are those of MLlib, so
the weights agree up to rounding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.classification import FMClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: rows of a block; AdamW's decays and its least divisor
BLOCK_ROWS = 4_096
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8


def _matrix(x: pa.Array) -> np.ndarray:
    """The rows of an array column without nulls, all of one length."""
    flat = x.flatten().to_numpy(zero_copy_only=False)
    if x.null_count or np.ptp(x.value_lengths().to_numpy(zero_copy_only=False)):
        raise ValueError("features must be vectors of one length")
    return flat.reshape(len(x), -1)


def _blocks(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            x, y = _matrix(part["x"]), part["y"].to_numpy(zero_copy_only=False)
            if not (np.isfinite(x).all() and np.isin(y, (0.0, 1.0)).all()):
                raise ValueError("features must be finite and labels 0 or 1")
            yield pa.record_batch({"n": pa.array([len(y)], pa.int32()), "x": pa.array([x.T.tobytes()], pa.binary()),
                                   "y": pa.array([y.tobytes()], pa.binary())})


def _raw(x: np.ndarray, factors: np.ndarray, linear: np.ndarray, intercept: float):
    """Of rows that are the columns of ``x``: raw predictions, the sums by
    factor, the squares of ``x``."""
    s, xx = factors.T @ x, x * x
    return intercept + linear @ x + 0.5 * ((s * s).sum(0) - (factors * factors).sum(1) @ xx), s, xx


def _scores(x: np.ndarray, factors: np.ndarray, linear: np.ndarray, intercept: float) -> np.ndarray:
    """Raw predictions of the columns of ``x``, summed term by term as MLlib
    does it: equal rows score the same wherever they lie."""
    raw = np.full(x.shape[1], intercept)
    for w, c in zip(linear, x, strict=True):
        raw += w * c
    for v in factors.T:
        total, squares = np.zeros_like(raw), np.zeros_like(raw)
        for f, c in zip(v, x, strict=True):
            total += f * c
            squares += (f * c) * (f * c)
        raw += (total * total - squares) / 2
    return raw


def _gradient(blocks, factors: np.ndarray, linear: np.ndarray, intercept: float):
    """The logistic loss' gradient over the blocks, summed: factors, linear
    part, intercept."""
    v, w, b = np.zeros_like(factors), np.zeros_like(linear), 0.0
    for n, x, y in blocks:
        x = np.frombuffer(x).reshape(-1, n)
        raw, s, xx = _raw(x, factors, linear, intercept)
        with np.errstate(over="ignore"):
            e = 1.0 / (1.0 + np.exp(-raw)) - np.frombuffer(y)
        v += x @ (s * e).T - factors * (xx @ e)[:, None]
        w += x @ e
        b += e.sum()
    yield np.concatenate([v.ravel(), w, [b]])


class BlockFMClassifier(FMClassifier):
    """``FMClassifier`` whose passes over all rows go block by block (the
    ``gd`` solver, a penalty and passes over a part of the rows are left to
    MLlib)."""

    def _fit(self, dataset: DataFrame):
        if self.getSolver() != "adamW" or self.getRegParam() or self.getMiniBatchFraction() != 1.0:
            return super()._fit(dataset)
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"),
                              F.col(self.getLabelCol()).cast("double").alias("y"))
        blocks = rows.mapInArrow(_blocks, "n int, x binary, y binary").rdd.map(tuple).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            n = blocks.map(lambda b: b[0]).sum()
            width = len(dataset.select(vector_to_array(self.getFeaturesCol())).first()[0]) if n else 0
            return self._model(*self._steps(blocks, n, width))
        finally:
            blocks.unpersist()

    def _steps(self, blocks, n: int, d: int):
        k = self.getFactorSize()
        rnd = blocks.context._jvm.java.util.Random(self.getSeed())
        at = np.array([rnd.nextGaussian() * self.getInitStd() for _ in range(d * k)] + [0.0] * (d + 1))
        free = np.ones(len(at))                     # parts that are not asked for stay 0
        free[d * k:-1], free[-1] = self.getFitLinear(), self.getFitIntercept()
        m, v = np.zeros(len(at)), np.zeros(len(at))
        for i in range(1, self.getMaxIter() + 1 if n else 0):
            parts = at[:d * k].reshape(d, k), at[d * k:-1], at[-1]
            g = free * blocks.mapPartitions(lambda b, p=parts: _gradient(b, *p)).reduce(np.add) / n
            m, v = BETA1 * m + (1 - BETA1) * g, BETA2 * v + (1 - BETA2) * g * g
            before, step = at, (m / (1 - BETA1 ** i)) / (np.sqrt(v / (1 - BETA2 ** i)) + EPSILON)
            at = at - self.getStepSize() * step
            if i > 1 and np.linalg.norm(before - at) < self.getTol() * max(np.linalg.norm(at), 1.0):
                break
        return at[:d * k].reshape(d, k), at[d * k:-1], float(at[-1])

    def _model(self, factors, linear, intercept):
        return BlockFMModel(factors, linear, intercept, *(self.getOrDefault(c) for c in (
            "featuresCol", "rawPredictionCol", "probabilityCol", "predictionCol")))


class BlockFMModel(Model):
    """Scores with fitted factors, linear part and intercept."""

    def __init__(self, factors, linear, intercept, features, raw, probability, prediction):
        super().__init__()
        self.factors, self.linear, self.intercept = factors, linear, intercept
        self._cols = features, raw, probability, prediction

    def _transform(self, dataset: DataFrame) -> DataFrame:
        parts = self.factors, self.linear, self.intercept
        features, raw, probability, prediction = self._cols

        @F.arrow_udf("double")
        def score(x: pa.Array) -> pa.Array:
            return pa.array(_scores(np.ascontiguousarray(_matrix(x).T), *parts) if len(x) else np.zeros(0))

        r = vector_to_array(raw)[1]
        p = 1 / (1 + F.exp(-r))
        return (dataset.withColumn(raw, score(vector_to_array(features))).withColumn(raw, array_to_vector(F.array(-F.col(raw), F.col(raw))))
                .withColumn(probability, array_to_vector(F.array(1 - p, p)))
                .withColumn(prediction, F.when(r > 0, 1.0).otherwise(0.0)))
