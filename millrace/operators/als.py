"""Alternating least squares over rating blocks, with the loss of every round.

Ratings lie in cells of a user block and an item block, written once. A half round sends each factor once to every cell that has a
rating of it (the out-links of its block), and every cell answers with partial normal equations of its users (or items): one row for each of
them and cell, whatever the number of their ratings, so somebody with a third of all ratings is spread over as many tasks as there are
blocks of the other side. One aggregate adds the partial equations up and solves them. The squared error of a round follows from the
equations of its second half without another pass over the ratings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import key_hash
from millrace.session import cut

CELL_RATINGS = 200_000


class BlockALS:
    """``min sum (r - x_u . y_i)² + reg (sum n_u |x_u|² + sum n_i |y_i|²)`` with n the number of ratings.

    ``history`` holds ``(round, rmse, loss)``; the fit ends when the RMSE falls by less than ``tol`` (``converged``) or after
    ``max_iter`` rounds. Items start at hashes of their ids in (-0.5, 0.5), so a fit is repeatable. Several ratings of a cell
    of the matrix count as several.
    """

    def __init__(self, rank: int = 10, reg: float = 0.1, max_iter: int = 10, tol: float = 1e-4, cell_ratings: int = CELL_RATINGS):
        self.rank, self.reg, self.max_iter, self.tol, self.cell_ratings = rank, reg, max_iter, tol, cell_ratings

    def fit(self, ratings: DataFrame) -> BlockALS:
        rows = ratings.where("u is not null and i is not null and r is not null").select(
            F.col("u").cast("long").alias("u"), F.col("i").cast("long").alias("i"), F.col("r").cast("double").alias("r"))
        n = rows.count()
        side = max(1, math.ceil(math.sqrt(n / self.cell_ratings)))
        block = lambda c: F.pmod(F.xxhash64(c), F.lit(side)).cast("int")
        cells = cut(rows.withColumns({"ub": block("u"), "ib": block("i")}))
        # where each factor is wanted, in either direction
        item_links, user_links = cut(cells.select("i", "ub", "ib").distinct()), cut(cells.select("u", "ub", "ib").distinct())
        self.items = cut(cells.select("i").distinct().select("i", initial("i", self.rank).alias("x")))
        self.history: list[tuple[int, float, float]] = []
        self.converged = False
        for step in range(self.max_iter):
            users = cut(self._half(cells, self.items, item_links, "u", "i"))
            items = cut(self._half(cells, users.select("u", "x"), user_links, "i", "u"))
            self.users, self.items = users.select("u", "x"), items.select("i", "x")
            penalty = F.sum(F.col("n") * F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
            error, more = items.agg(F.sum("error"), penalty).first()
            most = users.agg(penalty).first()[0]
            if not n:
                break
            # what is left after the best fit may come out below 0 by rounding
            error = max(error, 0.0)
            self.history.append((step, math.sqrt(error / n), error + self.reg * (most + more)))
            if step and self.history[-2][1] - self.history[-1][1] < self.tol:
                self.converged = True
                break
        return self

    def _half(self, cells: DataFrame, factors: DataFrame, links: DataFrame, mine: str, other: str) -> DataFrame:
        """``(mine, x, n, error)``: the solved side, with the squared error that it leaves."""
        k, reg = self.rank, self.reg
        upper = np.triu_indices(k)
        sent = links.join(factors, other)

        def partial(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return pa.table({mine: pa.array([], pa.int64()), "eq": pa.array([], pa.binary())})
            ids = right.column(other).to_numpy()
            order = np.argsort(ids)
            x = right.column("x").combine_chunks().flatten().to_numpy().reshape(len(ids), k)[order]
            x = x[np.searchsorted(ids[order], left.column(other).to_numpy())]
            who, at = np.unique(left.column(mine).to_numpy(), return_inverse=True)
            by = np.argsort(at, kind="stable")
            x, r = x[by], left.column("r").to_numpy()[by]
            first = np.searchsorted(at[by], np.arange(len(who)))
            out = np.empty((len(who), len(upper[0]) + k + 2))
            # one column of the equations at a time, so memory is that of the cell
            for c, (a, b) in enumerate(zip(*upper)):
                out[:, c] = np.add.reduceat(x[:, a] * x[:, b], first)
            for a in range(k):
                out[:, len(upper[0]) + a] = np.add.reduceat(x[:, a] * r, first)
            out[:, -2], out[:, -1] = np.add.reduceat(r * r, first), np.diff(np.append(first, len(r)))
            raw, size = out.tobytes(), 8 * out.shape[1]
            return pa.table({mine: pa.array(who, pa.int64()), "eq": pa.array([raw[i: i + size] for i in range(0, len(raw), size)], pa.binary())})

        def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def solved(ids: np.ndarray, eq: np.ndarray) -> pa.RecordBatch:
                a = np.zeros((len(ids), k, k))
                a[:, upper[0], upper[1]] = a[:, upper[1], upper[0]] = eq[:, : len(upper[0])]
                b, rr, n = eq[:, len(upper[0]): -2], eq[:, -2], eq[:, -1]
                ridge = a + (reg * n)[:, None, None] * np.eye(k)
                # without a ridge an equation may be singular
                x = np.linalg.solve(ridge, b[:, :, None])[:, :, 0] if reg > 0 else np.stack([np.linalg.lstsq(m, v)[0] for m, v in zip(ridge, b)])
                error = rr - 2 * (b * x).sum(1) + np.einsum("ni,nij,nj->n", x, a, x)
                return pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * k, pa.int32()), pa.array(x.reshape(-1))),
                    pa.array(n.astype(np.int64)), pa.array(error)], [mine, "x", "n", "error"])

            rest_id, rest = None, None   # a row's equations may go on in the next batch
            for batch in batches:
                ids = batch.column(mine).to_numpy()
                eq = np.frombuffer(b"".join(batch.column("eq").to_pylist())).reshape(len(ids), -1)
                first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, int)
                if not len(first):
                    continue
                ids, eq = ids[first], np.add.reduceat(eq, first, axis=0)
                if rest_id is not None and rest_id == ids[0]:
                    eq[0] += rest
                elif rest_id is not None:
                    yield solved(np.array([rest_id]), rest[None])
                if len(ids) > 1:
                    yield solved(ids[:-1], eq[:-1])
                rest_id, rest = ids[-1], eq[-1]
            if rest_id is not None:
                yield solved(np.array([rest_id]), rest[None])

        keys = ["ub", "ib"]
        parts = cells.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(partial, f"{mine} long, eq binary")
        return parts.repartition(mine).sortWithinPartitions(mine).mapInArrow(solve, f"{mine} long, x array<double>, n long, error double")

    def predict(self, cells: DataFrame) -> DataFrame:
        """``(u, i, pred)`` of the cells whose user and item have factors, null for the others."""
        a, b = self.users.withColumnRenamed("x", "xu"), self.items.withColumnRenamed("x", "xi")
        product = F.aggregate(F.zip_with("xu", "xi", lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
        return cells.join(a, "u", "left").join(b, "i", "left").select("u", "i", product.alias("pred"))

    def rounds(self, spark) -> DataFrame:
        return spark.createDataFrame(self.history, "round int, rmse double, loss double")


def initial(key: str, rank: int):
    """Start factors from a portable hash of the id."""
    return F.array(*[(key_hash(key, j) + 0.5) / 1000003.0 - 0.5 for j in range(rank)])

