"""An ordinal model of star ratings, fitted by distributed gradients.

Stars are ordered: a review of four stars that is called five is less wrong
than one that is called one. The cumulative (proportional-odds) model keeps
that order. With one score ``s = w.x`` and growing thresholds t_1 < ... < t_(K-1)

    P(class <= k) = 1 / (1 + exp(-(t_k - s)))

so one weight a feature tells low from high, and a class is an interval of s.

Fitting. Each step is one pass: tasks add up the gradient of the weighted
log-likelihood over their rows, Spark sums the parts by feature, and the driver
makes an Adam step with a ridge penalty. The driver holds weights, never rows.
Rows are written once as sparse blocks. Thresholds are the first one and the
logarithms of the gaps, so they stay in order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_code, work_path

BLOCK = 2048


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def thresholds(raw: np.ndarray) -> np.ndarray:
    """The first threshold, and the gaps' logarithms behind it."""
    return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def loss_and_gradient(score: np.ndarray, y: np.ndarray, weight: np.ndarray, raw: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(loss, gradient by row's score, gradient by ``raw``) of classes ``y`` from 0."""
    t = thresholds(raw)
    k = len(t)
    # The class is between an upper and a lower threshold; the ends have none.
    upper = np.where(y < k, _sigmoid(t[np.minimum(y, k - 1)] - score), 1.0)
    lower = np.where(y > 0, _sigmoid(t[np.maximum(y - 1, 0)] - score), 0.0)
    p = np.maximum(upper - lower, 1e-12)
    du, dl = upper * (1 - upper), lower * (1 - lower)
    by_score = weight * (du - dl) / p
    by_t = np.zeros(k)
    at = y < k
    np.add.at(by_t, y[at], -(weight * du / p)[at])
    at = y > 0
    np.add.at(by_t, y[at] - 1, (weight * dl / p)[at])
    tail = np.cumsum(by_t[::-1])[::-1]
    return float(-(weight * np.log(p)).sum()), by_score, np.concatenate([[tail[0]], tail[1:] * np.exp(raw[1:])])


@dataclass
class OrdinalModel:
    weights: np.ndarray
    raw: np.ndarray
    features: str
    prediction: str

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the most probable class."""
        ship_code(df.sparkSession)
        weights, t = self.weights, thresholds(self.raw)

        @F.pandas_udf("int")
        def classify(x: pd.DataFrame) -> pd.Series:
            # A vector comes as its parts.
            s = np.array([weights[i] @ v for i, v in zip(x["indices"], x["values"], strict=True)]) if len(x) else np.empty(0)
            below = np.column_stack([np.zeros(len(s)), _sigmoid(t[None, :] - s[:, None]), np.ones(len(s))])
            return pd.Series(np.diff(below, axis=1).argmax(axis=1), dtype="int32")

        return df.withColumn(self.prediction, classify(self.features))


def _sparse(df: DataFrame, features: str) -> DataFrame:
    """(index, value, y, w): the entries of sparse ML vectors, with label and weight."""
    def entries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.concat_arrays([batch.column(0)])
            yield pa.RecordBatch.from_arrays([x.field("indices"), x.field("values"), batch.column(1), batch.column(2)], ["index", "value", "y", "w"])

    return df.select(features, "y", "w").mapInArrow(entries, "index array<int>, value array<double>, y int, w double")


def fit_ordinal(df: DataFrame, classes: int, features: str = "_features", label: str = "label", weight: str | None = None, size: int | None = None,
                ridge: float = 1e-4, steps: int = 60, rate: float = 0.1, prediction: str = "_class") -> OrdinalModel:
    """Fit on sparse vectors with a class number (0 .. classes - 1) as label; ``weight`` evens out classes of very different sizes."""
    ship_code(df.sparkSession)
    labelled = df.where(F.col(label).isNotNull()).select(
        features, F.col(label).cast("int").alias("y"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    source = _sparse(labelled, features)
    path = work_path(df.sparkSession, "ordinal")
    source.write.parquet(path)
    rows = df.sparkSession.read.schema(source.schema).parquet(path)
    shares = rows.agg(F.sum("w").alias("n"), F.max(F.array_max("index")).alias("last"), *[F.sum(F.when(F.col("y") <= k, F.col("w")).otherwise(0.0)).alias(f"c{k}") for k in range(classes - 1)]).first()
    if not shares["n"]:
        raise ValueError("no rows with a label")
    size = size or (shares["last"] or 0) + 1
    cumulated = np.clip(np.array([shares[f"c{k}"] / shares["n"] for k in range(classes - 1)]), 1e-4, 1 - 1e-4)
    t = np.log(cumulated / (1 - cumulated))
    raw = np.concatenate([[t[0]], np.log(np.maximum(np.diff(t), 1e-3))])
    values, n = np.concatenate([np.zeros(size), raw]), float(shares["n"])
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        got = _gradient(rows, values[:size], values[size:])
        slope = np.zeros_like(values)
        for r in got:
            slope[r["i"]] = r["g"]
        slope = slope / n
        slope[:size] += ridge * values[:size]
        first += 0.1 * (slope - first)
        second += 0.001 * (slope * slope - second)
        values = values - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-10)
    return OrdinalModel(values[:size], values[size:], features, prediction)


def _gradient(rows: DataFrame, weights: np.ndarray, raw: np.ndarray) -> list:
    """(i, g): the summed gradient, the thresholds behind the weights."""
    size = len(weights)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + len(raw))
        for batch in batches:
            index, value = batch.column(0), batch.column(1)
            counts = np.diff(index.offsets.to_numpy())
            at, x = index.flatten().to_numpy(zero_copy_only=False), value.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), counts)
            score = np.bincount(row, weights[at] * x, batch.num_rows)
            _, by_score, by_raw = loss_and_gradient(score, batch.column(2).to_numpy(), batch.column(3).to_numpy(), raw)
            total[:size] += np.bincount(at, by_score[row] * x, size)
            total[size:] += by_raw
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["i", "g"])

    return rows.mapInArrow(add, "i int, g double").groupBy("i").agg(F.sum("g").alias("g")).collect()
