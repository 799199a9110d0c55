"""Exact nearest neighbours and range pairs on vectors of any length.

Points are put into cells around a bounded number of pivots. The triangle inequality
tells which cells can hold an answer for a query, so a query is only sent there. A full
cell is divided into blocks, and one task compares a block of queries with a block of
points. For the k nearest, neighbouring cells make up shards: a query is sent once to each shard that it
has to look into, and its bar rises in the task from cell to cell. Exact copies are looked up once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.operators.tree import NeighbourTree
from millrace.operators.windows import topn_per_group
from millrace.session import cut, spread

MAX_PIVOTS = 512
CELL_ROWS = 512       # points per cell aimed at, up to MAX_PIVOTS cells
BLOCK = 2_048
SHARD = 32_768        # points, and queries, that a task of the k nearest holds
TREE_ROWS = 4_194_304   # points that one level of pivots serves
STEP = 1_024          # queries compared at a time
SLACK = 1e-9


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed one dimension after the other, so equal rows are exactly 0 apart."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        step = a[:, j][:, None] - b[:, j][None, :]
        out += step * step
    return out


def stack(col: pd.Series) -> np.ndarray:
    return np.concatenate(col.to_numpy()).astype("float64").reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def candidates(a: np.ndarray, b: np.ndarray, limit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and column numbers and exact squared distances of the pairs that may be within a limit.

    ``limit(d2)`` gives the bar per row. The matrix product only preselects, with a margin above
    its rounding error; the kept pairs are measured by differences.
    """
    na, nb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    rough = na[:, None] + nb[None, :] - 2 * (a @ b.T)
    margin = 1e-10 * (na[:, None] + nb.max() + 1.0)
    r, c = np.nonzero(rough <= limit(rough) + margin)
    gap = a[r] - b[c]
    return r, c, (gap * gap).sum(axis=1)


class Cells:
    """Pivots with the size, radius and k smallest radii of their cells (at most MAX_PIVOTS rows)."""

    def __init__(self, points: DataFrame, k: int, pivots: int | None = None):
        n = points.count()
        wanted = pivots or max(1, min(MAX_PIVOTS, math.ceil(n / CELL_ROWS)))
        # whole-row order of the sample is by hash, so reruns pick the same pivots
        picked = points.orderBy(F.xxhash64("id"), "id").limit(wanted).select("x").collect()
        self.pivots = np.unique(np.array([r["x"] for r in picked], dtype="float64"), axis=0)
        centers = self.pivots

        @F.pandas_udf("struct<cell:int,d:double>")
        def assign(x: pd.Series) -> pd.DataFrame:
            d2 = squared_distances(stack(x), centers)
            cell = d2.argmin(axis=1)
            return pd.DataFrame({"cell": cell.astype("int32"), "d": np.sqrt(d2[np.arange(len(d2)), cell])})

        points = spread(points, "id")
        self.points = cut(points.select("id", "x", assign("x").alias("a")).select("id", "x", "a.cell", "a.d"))
        shape = self.points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("r")).collect()
        kth = topn_per_group(self.points.select("cell", "d", "id"), ["cell"], ["d", "id"], k).groupBy("cell").agg(
            F.max("d").alias("kd")).collect() if k else []
        size = len(self.pivots)
        self.count, self.radius, self.kth = np.zeros(size, "int64"), np.full(size, -1.0), np.full(size, np.inf)
        for row in shape:
            self.count[row["cell"]], self.radius[row["cell"]] = row["n"], row["r"]
        for row in kth:
            if self.count[row["cell"]] >= k:
                self.kth[row["cell"]] = row["kd"]
        self.apart = np.sqrt(squared_distances(self.pivots, self.pivots))

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distance of each row to all pivots, the nearest one and the distance to it."""
        d = np.sqrt(squared_distances(x, self.pivots))
        near = d.argmin(axis=1)
        return d, near, d[np.arange(len(d)), near]

    def bounds(self, d: np.ndarray, near: np.ndarray, gap: np.ndarray, cells: np.ndarray | slice = slice(None)) -> np.ndarray:
        """What a point of each of the cells, whose pivots are ``d`` away, is away from each row at least."""
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d * d - (gap * gap)[:, None]) / (2 * self.apart[near][:, cells])
        return np.maximum(d - self.radius[cells][None, :], np.where(np.isfinite(plane), plane, 0.0))

    def shards(self, rows: int) -> np.ndarray:
        """The shard of each cell: cells in a chain of near pivots, cut where the next one would pass ``rows`` points."""
        shard, left, at, held, number = np.zeros(len(self.pivots), "int64"), set(range(len(self.pivots))), 0, 0, 0
        while left:
            left.remove(at)
            if held and held + self.count[at] > rows:
                held, number = 0, number + 1
            held += int(self.count[at])
            shard[at] = number
            if left:
                rest = np.fromiter(left, "int64")
                at = int(rest[self.apart[at][rest].argmin()])
        return shard

    def visits(self, eps: float | None):
        """UDF: the cells that may hold a neighbour within ``eps``."""
        shape, used = self.shape(), self.count > 0

        @F.pandas_udf("array<int>")
        def udf(x: pd.Series) -> pd.Series:
            go = (shape.bounds(*shape.home(stack(x))) <= eps + SLACK) & used[None, :]
            return pd.Series([np.flatnonzero(g).astype("int32") for g in go])

        return udf

    def shape(self) -> Cells:
        """The same without its points, to go to tasks."""
        out = object.__new__(Cells)
        out.__dict__.update({k: v for k, v in self.__dict__.items() if k != "points"})
        return out

    def tiles(self, queries: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
        """Queries ``(id, x, bar, near, gap)`` and points ``(id, x, cell)`` keyed by ``(shard, sub, chunk)``; a query stands once for each
        shard (and part of a shard of one large cell) that may hold one of its k nearest."""
        cores = queries.sparkSession.sparkContext.defaultParallelism
        n = int(self.count.sum())
        # small inputs are cut finer, so that every core has work
        rows = min(rows, max(256, math.ceil(n / math.sqrt(2 * cores))))
        shard, shape, used = self.shards(rows), self.shape(), self.count > 0
        sizes = np.bincount(shard, self.count)

        @F.pandas_udf("struct<bar:double,near:int,gap:double,shards:array<int>>")
        def reach(x: pd.Series) -> pd.DataFrame:
            d, near, gap = shape.home(stack(x))
            bar = (d + shape.kth[None, :]).min(axis=1)
            go = (shape.bounds(d, near, gap) <= bar[:, None] + SLACK) & used[None, :]
            return pd.DataFrame({"bar": bar, "near": near.astype("int32"), "gap": gap, "shards": [np.unique(shard[g]).astype("int32") for g in go]})

        sent = cut(spread(queries, "id").select("id", "x", reach("x").alias("r")).select("id", "x", "r.bar", "r.near", "r.gap", "r.shards"))
        load = {r["shard"]: r["n"] for r in sent.select(F.explode("shards").alias("shard")).groupBy("shard").agg(
            F.count(F.lit(1)).alias("n")).collect()}
        of_cell = F.array(*[F.lit(int(k)) for k in shard])
        subs = F.array(*[F.lit(max(1, math.ceil(int(c) / rows))) for c in sizes])
        chunks = F.array(*[F.lit(max(1, math.ceil(load.get(k, 0) / rows))) for k in range(len(sizes))])

        def place(df: DataFrame, own: str, own_n, other: str, other_n):
            return df.withColumns({
                own: F.pmod(F.xxhash64("id"), F.element_at(own_n, F.col("shard") + 1)).cast("int"),
                other: F.explode(F.sequence(F.lit(0), F.element_at(other_n, F.col("shard") + 1) - 1))})

        points = self.points.select("id", "x", "cell", F.element_at(of_cell, F.col("cell") + 1).alias("shard"))
        left = sent.select("id", "x", "bar", "near", "gap", F.explode("shards").alias("shard"))
        return place(left, "chunk", chunks, "sub", subs), place(points, "sub", subs, "chunk", chunks)

    def blocks(self, queries: DataFrame, eps: float, block: int):
        """Queries and points keyed by ``(cell, sub, chunk)``: blocks against blocks of bounded size."""
        probes = cut(spread(queries, "id").select("id", "x", F.explode(self.visits(eps)("x")).alias("cell")))
        load = {r["cell"]: r["n"] for r in probes.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        # small inputs are cut finer, so that every core has a block
        cores = queries.sparkSession.sparkContext.defaultParallelism
        block = min(block, max(256, math.ceil(sum(load.values()) / (2 * cores))))
        subs = F.array(*[F.lit(max(1, math.ceil(int(c) / block))) for c in self.count])
        chunks = F.array(*[F.lit(max(1, math.ceil(load.get(i, 0) / block))) for i in range(len(self.count))])

        def place(df: DataFrame, own: str, own_n, other: str, other_n):
            return df.withColumns({
                own: F.pmod(F.xxhash64("id"), F.element_at(own_n, F.col("cell") + 1)).cast("int"),
                other: F.explode(F.sequence(F.lit(0), F.element_at(other_n, F.col("cell") + 1) - 1))})

        points = place(self.points.select("id", "x", "cell"), "sub", subs, "chunk", chunks)
        return place(probes, "chunk", chunks, "sub", subs), points


def _k_in_shard(shape: Cells, q: pd.DataFrame, p: pd.DataFrame, k: int) -> pd.DataFrame:
    """``(qid, cid, d2)``: the k nearest of the points ``(id, x, cell)`` to each query ``(id, x, bar, near, gap)``, none beyond its bar.

    Cells come in the order of their bounds for the slice of queries, and a cell is left out for those whose bar it cannot reach.
    """
    p = p.sort_values(["cell", "id"])
    pid, points, cell = p["id"].to_numpy(), stack(p["x"]), p["cell"].to_numpy()
    cells, start = np.unique(cell, return_index=True)
    ends = [*start.tolist(), len(cell)]
    out = []
    qid, x, bars = q["id"].to_numpy(), stack(q["x"]), q["bar"].to_numpy()
    bounds = shape.bounds(np.sqrt(squared_distances(x, shape.pivots[cells])), q["near"].to_numpy(), q["gap"].to_numpy(), cells)
    # queries that are near each other can leave out the same cells
    order = np.argsort(bounds.argmin(axis=1), kind="stable")
    for lo in range(0, len(order), STEP):
        rows = order[lo: lo + STEP]
        a, low, bar2 = x[rows], bounds[rows], (bars[rows] + SLACK) ** 2
        best = (np.zeros(0, "int64"), np.zeros(0), np.zeros(0, "int64"))   # row, squared distance, id
        waiting = list(np.argsort(low.mean(axis=0), kind="stable"))
        while waiting:
            # small cells are taken together
            taken, held = [], 0
            while waiting and (not taken or held + ends[waiting[0] + 1] - ends[waiting[0]] <= STEP):
                c = waiting.pop(0)
                taken.append(c)
                held += ends[c + 1] - ends[c]
            go = np.flatnonzero((low[:, taken].min(axis=1) <= np.sqrt(bar2) + SLACK))
            if not len(go):
                continue
            at = np.concatenate([np.arange(ends[c], ends[c + 1]) for c in taken])
            for s in range(0, len(at), 4 * STEP):
                part = at[s: s + 4 * STEP]
                b = points[part]

                def limit(rough, mine=bar2[go][:, None]):
                    if rough.shape[1] <= k or np.count_nonzero(rough <= mine) <= 4 * k * len(rough):
                        return mine
                    return np.minimum(mine, np.partition(rough, k - 1, axis=1)[:, k - 1][:, None])

                r, c, d2 = candidates(a[go], b, limit)
                row = np.concatenate([best[0], go[r]])
                dist, ids = np.concatenate([best[1], d2]), np.concatenate([best[2], pid[part[c]]])
                first = np.lexsort((ids, dist, row))
                row, dist, ids = row[first], dist[first], ids[first]
                place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
                keep = place < k
                best = row[keep], dist[keep], ids[keep]
                full = place == k - 1
                bar2[row[full]] = np.minimum(bar2[row[full]], dist[full])
        out.append(pd.DataFrame({"qid": qid[rows[best[0]]], "cid": best[2], "d2": best[1]}))
    return pd.concat(out, ignore_index=True)


def _k_smallest(qid: np.ndarray, pid: np.ndarray, a: np.ndarray, b: np.ndarray, k: int) -> pd.DataFrame:
    if len(b) > k:
        q, p, dist = candidates(a, b, lambda d: np.partition(d, k - 1, axis=1)[:, k - 1][:, None])
    else:
        q, p, dist = candidates(a, b, lambda d: d)
    ids = pid[p]
    order = np.lexsort((ids, dist, q))
    q, dist, ids = q[order], dist[order], ids[order]
    place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    keep = place < k
    return pd.DataFrame({"qid": qid[q[keep]], "cid": ids[keep], "d2": dist[keep]})


def knn_join(queries: DataFrame, points: DataFrame, k: int, exclude_self: bool = False, pivots: int | None = None,
             block: int = SHARD, tree_rows: int = TREE_ROWS) -> DataFrame:
    """``(qid, cid, dist, rank)``: the k nearest points of each query, ties to the lower id.

    Both inputs are ``(id, x)`` with x an array of doubles. ``exclude_self`` leaves out the
    point with the query's own id. More than ``tree_rows`` points, which one level of pivots would leave in large cells,
    are searched by a tree of pivots.
    """
    depth = k + 1 if exclude_self else k
    same = queries is points
    points = cut(points.select("id", "x"))
    queries = points if same else cut(queries.select("id", "x"))
    # of many copies only the first ``depth`` ids can be an answer
    copies = W.partitionBy("x").orderBy("id")
    thin = points.withColumn("_c", F.row_number().over(copies)).where(F.col("_c") <= depth).drop("_c")
    heads = queries.groupBy("x").agg(F.min("id").alias("id"))
    if thin.count() > tree_rows:
        best = NeighbourTree(thin).search(heads, depth)
    else:
        best = _by_cells(heads, Cells(thin, depth, pivots), depth, block)
    # hand the answer of the first copy to all copies
    mine = queries.select("x", F.col("id").alias("me")).join(heads.withColumnRenamed("id", "qid"), "x").select("me", "qid")
    out = mine.join(best, "qid").select(F.col("me").alias("qid"), "cid", F.sqrt("d2").alias("dist"), "rank")
    if not exclude_self:
        return out
    # dropping the own row moves the later ranks up by one
    own = out.where("qid = cid").select("qid", F.col("rank").alias("_own"))
    moved = out.where("qid <> cid").join(own, "qid", "left")
    rank = F.when(F.col("rank") > F.coalesce("_own", F.lit(k + 2)), F.col("rank") - 1).otherwise(F.col("rank"))
    return moved.withColumn("rank", rank).where(F.col("rank") <= k).drop("_own")


def _by_cells(heads: DataFrame, cells: Cells, depth: int, block: int) -> DataFrame:
    """``(qid, cid, d2, rank)`` by blocks of queries against the shards of cells that they visit."""
    left, right = cells.tiles(heads, block)
    shape = cells.shape()

    def compare(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({"qid": [], "cid": [], "d2": []}).astype({"qid": "int64", "cid": "int64"})
        return _k_in_shard(shape, q, p, depth)

    keys = ["shard", "sub", "chunk"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "qid long, cid long, d2 double")
    return topn_per_group(found, ["qid"], ["d2", "cid"], depth)


def pairs_within(points: DataFrame, eps: float, pivots: int | None = None, block: int = BLOCK) -> DataFrame:
    """``(a, b, dist)`` with ``a < b`` and a distance of at most ``eps``."""
    points = cut(points.select("id", "x"))
    cells = Cells(points, 0, pivots)
    left, right = cells.blocks(points, eps, block)

    def compare(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({"a": [], "b": [], "dist": []}).astype({"a": "int64", "b": "int64"})
        r, c, d2 = candidates(stack(q["x"]), stack(p["x"]), lambda d: eps * eps)
        out = pd.DataFrame({"a": q["id"].to_numpy()[r], "b": p["id"].to_numpy()[c], "dist": np.sqrt(d2)})
        return out[(out["dist"] <= eps) & (out["a"] < out["b"])]

    keys = ["cell", "sub", "chunk"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "a long, b long, dist double")


def knn_classify(train: DataFrame, test: DataFrame, k: int = 1) -> DataFrame:
    """``(id, pred)``: the label most frequent among the k nearest train rows, ties to the lower label.

    ``train`` is ``(id, x, label)``, ``test`` is ``(id, x)``.
    """
    near = knn_join(test, train.select("id", "x"), k)
    labels = train.select(F.col("id").alias("cid"), "label")
    votes = near.join(labels, "cid").groupBy("qid", "label").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), "label"))
    return votes.groupBy("qid").agg(best.alias("b")).select(F.col("qid").alias("id"), F.col("b.label").alias("pred"))


def leave_one_out_knn(rows: DataFrame) -> DataFrame:
    """``(id, label, pred)``: every row predicted by its nearest other row, in one job."""
    near = knn_join(rows.select("id", "x"), rows.select("id", "x"), 1, exclude_self=True)
    labels = rows.select(F.col("id").alias("cid"), F.col("label").alias("pred"))
    return near.join(labels, "cid").select(F.col("qid").alias("id"), "pred").join(rows.select("id", "label"), "id")
