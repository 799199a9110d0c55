"""Dimensionality reduction. Row data stays on the executors; d x d sums reach the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.nearest import knn_join, stack
from millrace.session import cut

MAX_DIMS = 4_096


def moments(df: DataFrame, array_col: str) -> DataFrame:
    """``(i, j, s)``: sums of x_i x_j, with row i = -1 for the sums of x_j and (-1, -1) for the count.

    Each task adds up its rows as one matrix product, so d² numbers leave it, and any two
    results merge by adding.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                x = stack(pdf["x"])
                x = np.hstack([np.ones((len(x), 1)), x])
                part = x.T @ x
                total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            keep = i <= j
            yield pd.DataFrame({"i": i[keep] - 1, "j": j[keep] - 1, "s": total[keep]})

    rows = df.select(F.col(array_col).cast("array<double>").alias("x")).where("x is not null")
    return rows.mapInPandas(partial, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))


def merge_moments(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("i", "j").agg(F.sum("s").alias("s"))


def covariance(m: DataFrame) -> DataFrame:
    """Sample covariance ``(i, j, cov)`` for i <= j from a moment table."""
    n = m.where("i = -1 and j = -1").select(F.col("s").alias("n"))
    si = m.where("i = -1 and j >= 0").select(F.col("j").alias("i"), F.col("s").alias("si"))
    sj = si.withColumnsRenamed({"i": "j", "si": "sj"})
    cells = m.where("i >= 0").join(si, "i").join(sj, "j").withColumn("n", n.scalar())
    return cells.select("i", "j", ((F.col("s") - F.col("si") * F.col("sj") / F.col("n")) / (F.col("n") - 1)).alias("cov"))


class Pca:
    """Leading components of centred data; signs make the largest loading positive."""

    def __init__(self, k: int):
        self.k = k

    def fit(self, df: DataFrame, array_col: str) -> Pca:
        return self.fit_moments(moments(df, array_col))

    def fit_moments(self, m: DataFrame) -> Pca:
        size = m.agg(F.max("j")).first()[0] + 1
        if size > MAX_DIMS:
            raise ValueError(f"{size} dimensions; the driver solves up to {MAX_DIMS}")
        full = np.zeros((size + 1, size + 1))
        for i, j, s in m.select("i", "j", "s").collect():
            full[i + 1, j + 1] = full[j + 1, i + 1] = s
        n = full[0, 0]
        self.mean = full[0, 1:] / n
        cov = (full[1:, 1:] - n * np.outer(self.mean, self.mean)) / (n - 1)
        values, vectors = np.linalg.eigh(cov)
        order = np.argsort(values)[::-1][: self.k]
        self.variance, self.components = values[order], vectors[:, order].T
        largest = np.abs(self.components).argmax(axis=1)
        self.components *= np.sign(self.components[np.arange(len(order)), largest])[:, None]
        self.ratio = self.variance / values.sum()
        return self

    def transform(self, df: DataFrame, array_col: str, out: str = "scores") -> DataFrame:
        mean, components = self.mean, self.components

        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            rows = stack(x)
            return pd.Series(list((rows - mean) @ components.T)) if len(rows) else pd.Series([], dtype=object)

        return df.withColumn(out, project(F.col(array_col).cast("array<double>")))


def incremental_pca(df: DataFrame, array_col: str, batch: str, k: int) -> Pca:
    """PCA from moments kept per value of ``batch`` and merged; equal to the PCA of all rows.

    Batches are a key of the same aggregate: a task emits one moment table per batch it
    saw, never the rows.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, part in pdf.groupby("b"):
                x = stack(part["x"])
                x = np.hstack([np.ones((len(x), 1)), x])
                total = x.T @ x
                i, j = np.indices(total.shape)
                keep = i <= j
                yield pd.DataFrame({"b": part["b"].iloc[0], "i": i[keep] - 1, "j": j[keep] - 1, "s": total[keep]})

    rows = df.select(F.col(batch).cast("int").alias("b"), F.col(array_col).cast("array<double>").alias("x"))
    per_batch = rows.mapInPandas(partial, "b int, i int, j int, s double").groupBy("b", "i", "j").agg(
        F.sum("s").alias("s"))
    return Pca(k).fit_moments(per_batch.groupBy("i", "j").agg(F.sum("s").alias("s")))


def isomap_landmark(points: DataFrame, k: int, dim: int, landmarks: int = 50, max_iter: int = 200) -> DataFrame:
    """``(id, coords)``: neighbour graph, path lengths from landmarks, scaling of the landmarks,
    and every row placed by its distances to them.

    Landmarks are a bounded sample by hash. A round of the path search keeps, per row and
    landmark, the smallest length over its edges; only improved rows are sent on. Rows in
    a part of the graph that the first landmark cannot reach have null coordinates.
    """
    near = knn_join(points, points, k, exclude_self=True).select(
        F.col("qid").alias("src"), F.col("cid").alias("dst"), "dist")
    edges = cut(near.unionByName(near.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "dist"))
                .groupBy("src", "dst").agg(F.min("dist").alias("dist")))
    starts = [r["id"] for r in points.select("id").orderBy(F.xxhash64("id"), "id").limit(landmarks).collect()]
    spark = points.sparkSession
    reached = spark.createDataFrame([(s, i, 0.0) for i, s in enumerate(starts)], "id long, mark int, len double")
    fresh = reached
    for _ in range(max_iter):
        step = fresh.join(edges, fresh["id"] == edges["src"]).groupBy(F.col("dst").alias("id"), "mark").agg(
            F.min(F.col("len") + F.col("dist")).alias("new"))
        merged = cut(reached.join(step, ["id", "mark"], "full").select(
            "id", "mark", F.least("len", "new").alias("len"),
            F.coalesce(F.col("new") < F.col("len"), F.col("len").isNull()).alias("better")))
        reached, fresh = merged.select("id", "mark", "len"), merged.where("better").select("id", "mark", "len")
        if fresh.isEmpty():
            break
    else:
        raise RuntimeError("path search did not settle")
    table = np.full((len(starts), len(starts)), np.nan)
    marks = spark.createDataFrame([(s, i) for i, s in enumerate(starts)], "id long, other int")
    for row in reached.join(F.broadcast(marks), "id").collect():
        table[row["mark"], row["other"]] = row["len"]
    # a landmark the first one does not reach lies in another part of the graph
    part = np.flatnonzero(~np.isnan(table[0]))
    d2 = table[np.ix_(part, part)] ** 2
    centre = np.eye(len(part)) - 1.0 / len(part)
    values, vectors = np.linalg.eigh(-0.5 * centre @ d2 @ centre)
    order = np.argsort(values)[::-1][:dim]
    root = np.sqrt(np.maximum(values[order], 1e-12))
    vectors = vectors[:, order]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    back, mean = (vectors / root).T, d2.mean(axis=1)
    place = {int(m): p for p, m in enumerate(part)}
    weights = F.array(*[F.array(*[F.lit(float(back[a, place[m]])) if m in place else F.lit(0.0) for a in range(len(order))])
                        for m in range(len(starts))])
    means = F.array(*[F.lit(float(mean[place[m]])) if m in place else F.lit(0.0) for m in range(len(starts))])
    at = F.col("mark") + 1
    term = reached.where(F.col("mark").isin([int(m) for m in part])).withColumns(
        {"w": F.element_at(weights, at), "g": F.col("len") * F.col("len") - F.element_at(means, at)})
    sums = term.groupBy("id").agg(F.count(F.lit(1)).alias("n"),
                                  *[(-0.5 * F.sum(F.col("w")[a] * F.col("g"))).alias(f"c{a}") for a in range(len(order))])
    return points.select("id").join(sums.where(F.col("n") == len(part)), "id", "left").select(
        "id", F.when(F.col("n").isNotNull(), F.array(*[F.col(f"c{a}") for a in range(len(order))])).alias("coords"))
