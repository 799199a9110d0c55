"""Linear models whose gradients are one aggregate; weights live on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import key_hash, sigmoid, weighted_sum
from millrace.session import cut


def linear_score(features: list[str], weights, bias: float = 0.0) -> Column:
    return weighted_sum(features, weights, bias)


def logreg_gradient_ascent(df: DataFrame, features: list[str], label: str, alpha: float = 0.001,
                           cycles: int = 500) -> list[float]:
    """Full-batch ascent from all weights 1; a constant feature gives the intercept."""
    weights = [1.0] * len(features)
    for _ in range(cycles):
        error = F.col(label) - sigmoid(linear_score(features, weights))
        row = df.agg(*[F.sum(F.col(f) * error).alias(f"g{j}") for j, f in enumerate(features)]).first()
        weights = [w + alpha * row[f"g{j}"] for j, w in enumerate(weights)]
    return weights


def logreg_fit(df: DataFrame, features: list[str], label: str, c: float = 1.0, l1_share: float = 0.0,
               max_iter: int = 100):
    """L2 (or elastic-net) logistic model with inverse strength ``c``; features are not rescaled."""
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(df)
    n = df.count()
    model = LogisticRegression(labelCol=label, regParam=1.0 / (c * n), elasticNetParam=l1_share, maxIter=max_iter,
                               standardization=False).fit(rows)
    return model


def logreg_report(model, features: list[str]) -> list[tuple[str, float]]:
    """Coefficients, the intercept and the share of zero weights."""
    w = model.coefficients.toArray()
    return [*zip(features, map(float, w)), ("intercept", float(model.intercept)),
            ("zero_share", float((np.abs(w) <= 1e-5).mean()))]


# Optimizer constants.
ADAM = {"beta1": 0.9, "beta2": 0.999, "epsilon": 1e-8}
ADAGRAD_START = 1e-8
MOMENTUM = 0.95
FTRL_START = 0.1


class Optimizer:
    """One update of the weight vector per call."""

    def __init__(self, kind: str, size: int, rate: float):
        self.kind, self.rate, self.t = kind, rate, 0
        self.a, self.b = np.zeros(size), np.zeros(size)
        if kind == "adagrad":
            self.a += ADAGRAD_START
        elif kind == "ftrl":
            self.a += FTRL_START
        elif kind not in ("adam", "momentum"):
            raise ValueError(kind)

    def step(self, w: np.ndarray, g: np.ndarray) -> np.ndarray:
        self.t += 1
        if self.kind == "momentum":
            self.a = MOMENTUM * self.a + g
            return w - self.rate * self.a
        if self.kind == "adagrad":
            self.a = self.a + g * g
            return w - self.rate * g / np.sqrt(self.a)
        if self.kind == "adam":
            b1, b2 = ADAM["beta1"], ADAM["beta2"]
            self.a, self.b = b1 * self.a + (1 - b1) * g, b2 * self.b + (1 - b2) * g * g
            rate = self.rate * np.sqrt(1 - b2 ** self.t) / (1 - b1 ** self.t)
            return w - rate * self.a / (np.sqrt(self.b) + ADAM["epsilon"])
        new = self.a + g * g
        self.b = self.b + g - (np.sqrt(new) - np.sqrt(self.a)) / self.rate * w
        self.a = new
        return -self.b * self.rate / np.sqrt(new)


def logreg_minibatch(df: DataFrame, key: str, features: list[str], label: str, loss: str = "cross_entropy",
                     opt: str = "adam", rate: float = 0.01, reg: str = "l2", reg_param: float = 0.0, batches: int = 8,
                     epochs: int = 1, seed: int = 0) -> tuple[list[float], list[dict]]:
    """Mini-batch logistic model; ``loss='ftlr'`` is another name of ``'squared'``.

    Rows are written once by hash batch, so a step reads its own batch only. Returns the
    weights (bias last) and per step the loss, mean weight and share of weights near 0.
    """
    if loss not in ("cross_entropy", "squared", "ftlr"):
        raise ValueError(f"unknown loss {loss}")
    rows = cut(df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("_y"),
                         (key_hash(key, seed) % batches).cast("int").alias("_batch")), partition_by=["_batch"])
    present = sorted(r[0] for r in rows.select("_batch").distinct().collect())
    w, steps = np.zeros(len(features) + 1), []
    tool = Optimizer(opt, len(w), rate)
    for _ in range(epochs):
        for b in present:
            z = linear_score(features, w[:-1], w[-1])
            p = sigmoid(z)
            if loss == "cross_entropy":
                value, slope = F.greatest(z, F.lit(0.0)) - z * F.col("_y") + F.log1p(F.exp(-F.abs(z))), p - F.col("_y")
            else:
                value, slope = (F.col("_y") - p) ** 2, 2 * (p - F.col("_y")) * p * (1 - p)
            batch = rows.where(F.col("_batch") == b)
            row = batch.withColumn("_s", slope).agg(
                F.count(F.lit(1)).alias("n"), F.avg(value).alias("loss"),
                *[F.avg(F.col("_s") * F.col(f)).alias(f"g{j}") for j, f in enumerate(features)],
                F.avg("_s").alias(f"g{len(features)}")).first()
            g = np.array([row[f"g{j}"] for j in range(len(w))])
            weights = w[:-1]
            penalty = reg_param * (np.abs(weights).sum() if reg == "l1" else 0.5 * (weights ** 2).sum())
            g[:-1] += reg_param * (np.sign(weights) if reg == "l1" else weights)
            steps.append({"step": len(steps), "loss": float(row["loss"] + penalty), "w_avg": float(weights.mean()),
                          "w_zero_ratio": float((np.abs(weights) <= 1e-5).mean())})
            w = tool.step(w, g)
    return w.tolist(), steps


def linear_regression_fit(df: DataFrame, features: list[str], label: str):
    """Least squares with intercept by the normal equations."""
    rows = VectorAssembler(inputCols=features, outputCol="features").transform(df)
    return LinearRegression(labelCol=label, solver="normal").fit(rows)


def simple_regression(df: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept and R² of one feature in one aggregate."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_r2(y, x).alias("r2"))
