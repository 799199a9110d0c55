"""Exact nearest neighbours by a tree of pivots that is written level by level.

A node with more than ``leaf`` points is split: ``fan`` of its points, chosen by a hash, become pivots, and every point
goes to its nearest one. Nodes are numbered as in a heap, a node's pivots and the radii of its children are one row of the tree
table, and a leaf's points are one packed row for each ``leaf`` of them. Nothing of this reaches the driver but counts.

A search descends twice. First every query follows the nearest pivot to one leaf, whose k-th distance is its bar. Then it goes, level by
level, to all children that may hold something nearer: a child is passed over when the distance to its pivot less its radius, or
the distance to the plane between it and the query's nearest pivot, is above the bar. At each level, queries are dealt by node and salted by
their number there, behind one copy of the node's row, so a node that a third of the queries visit is many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import topn_per_group
from millrace.session import cut

FAN = 64
LEAF = 1_024
MAX_LEVELS = 9          # heap numbers of 64-fold nodes stay within a long
SALT_ROWS = 8_192       # queries behind one copy of a node's row
SLACK = 1e-9

HEAD = ["children", "radii", "own", "flat"]
STREAM = "id long, x array<double>, bar double, bound double, node long"


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed one dimension after the other, so equal rows are exactly 0 apart."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        step = a[:, j][:, None] - b[:, j][None, :]
        out += step * step
    return np.sqrt(out)


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, pa.RecordBatch]]:
    """The stretches of rows behind a head row (``id`` null), with that head's lists as arrays."""
    head: dict = {}
    for batch in batches:
        heads = np.flatnonzero(batch.column("id").is_null().to_numpy(zero_copy_only=False))
        edges = [0, *heads.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if a in heads:
                head = {c: np.array(batch.column(c)[a].values if batch.column(c)[a].is_valid else []) for c in HEAD}
                a += 1
            if b > a:
                yield head, batch.slice(a, b - a)


def _meet(heads: DataFrame, rows: DataFrame, task: Callable, kind: str) -> DataFrame:
    """Rows ``(id, x, bar, bound, node)`` behind copies of their node's head ``(node, children, radii, own, flat)``."""
    load = rows.groupBy("node").agg(F.count(F.lit(1)).alias("load"))
    copies = heads.join(load, "node").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("load") - 1) / SALT_ROWS))))
    load = load.withColumn("salts", F.floor((F.col("load") - 1) / SALT_ROWS) + 1)
    dealt = rows.join(load, "node").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts"))).drop("load", "salts")
    both = dealt.unionByName(copies.drop("load"), allowMissingColumns=True)
    return both.repartition("node", "salt").sortWithinPartitions("node", "salt", F.col("id").asc_nulls_first(), *(["part"] if "part" in both.columns else [])).select(
        "id", "x", "bar", "bound", "node", *HEAD).mapInArrow(task, kind)


def _assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points go to the child of their nearest pivot; ``bar`` is the distance."""
    for head, part in _behind(batches):
        x = _matrix(part.column("x"), part.num_rows)
        d = _distances(x, head["flat"].reshape(-1, x.shape[1]))
        near = d.argmin(1)
        far = pa.array(d[np.arange(len(d)), near])
        yield pa.RecordBatch.from_arrays([part.column("id"), part.column("x"), far, part.column("bound"), pa.array(head["children"][near])],
                                         ["id", "x", "bar", "bound", "node"])


def _nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for head, part in _behind(batches):
        x = _matrix(part.column("x"), part.num_rows)
        near = _distances(x, head["flat"].reshape(-1, x.shape[1])).argmin(1)
        yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "x", "bar", "bound")), pa.array(head["children"][near])], ["id", "x", "bar", "bound", "node"])


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Queries go to all children that may hold a point within their bar."""
    for head, part in _behind(batches):
        x = _matrix(part.column("x"), part.num_rows)
        pivots = head["flat"].reshape(-1, x.shape[1])
        d = _distances(x, pivots)
        home = d.argmin(1)
        apart = _distances(pivots, pivots)
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (d * d - (d * d)[np.arange(len(d)), home][:, None]) / (2 * apart[home])
        bound = np.maximum(d - head["radii"][None, :], np.where(np.isfinite(plane), plane, 0.0))
        bound = np.maximum(bound, part.column("bound").to_numpy()[:, None])
        bar = part.column("bar").to_numpy(zero_copy_only=False)
        row, child = np.nonzero(bound <= np.where(np.isnan(bar), np.inf, bar)[:, None] + SLACK)
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays([*(part.column(c).take(take) for c in ("id", "x", "bar")), pa.array(bound[row, child]), pa.array(head["children"][child])],
                                         ["id", "x", "bar", "bound", "node"])


class NeighbourTree:
    """The tree over ``points (id, x)``, distinct vectors of one length."""

    def __init__(self, points: DataFrame, fan: int = FAN, leaf: int = LEAF):
        self.leaf = leaf
        rows = points.select("id", "x", F.lit(0.0).alias("bar"), F.lit(0.0).alias("bound"), F.lit(0).cast("long").alias("node"))
        rows = cut(rows)
        done: DataFrame | None = None
        self.heads: list[DataFrame] = []
        while len(self.heads) < MAX_LEVELS:
            sizes = cut(rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > leaf))
            if sizes.isEmpty():
                break
            small = rows.join(sizes, "node", "left_anti")
            done = small if done is None else done.unionByName(small)
            large = rows.join(sizes.select("node"), "node")
            picked = topn_per_group(large.select("node", "id", "x"), ["node"], [F.xxhash64("id"), F.asc("id")], fan)
            # at most fan pivots in a row
            pivots = picked.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("rank", "x"))).alias("p")).select(
                "node", F.transform("p", lambda q: F.col("node") * fan + q["rank"].cast("long")).alias("children"),
                F.flatten(F.transform("p", lambda q: q["x"])).alias("flat"))
            pivots = cut(pivots.withColumns({"radii": F.lit(None).cast("array<double>"), "own": F.lit(None).cast("array<long>")}))
            rows = cut(_meet(pivots, large, _assign, STREAM))
            radii = rows.groupBy("node").agg(F.max("bar").alias("r")).select(F.col("node").alias("child"), "r")
            # children without points cannot be there: each pivot is a point, and distinct
            shaped = pivots.select("node", "flat", F.posexplode("children").alias("at", "child")).join(radii, "child", "left")
            shaped = shaped.groupBy("node").agg(F.first("flat").alias("flat"), F.array_sort(F.collect_list(F.struct("at", "child", F.coalesce("r", F.lit(-1e300)).alias("r")))).alias("c"))
            self.heads.append(cut(shaped.select("node", F.transform("c", lambda c: c["child"]).alias("children"), F.transform("c", lambda c: c["r"]).alias("radii"),
                                                F.lit(None).cast("array<long>").alias("own"), "flat")))
        done = rows if done is None else done.unionByName(rows)
        done = cut(done.select("id", "x", "node"))
        parts = done.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / leaf).alias("parts"))
        packed = done.join(parts, "node").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).groupBy("node", "part").agg(
            F.collect_list(F.struct("id", "x")).alias("p"))
        self.leaves = cut(packed.select(
            "node", "part", F.lit(None).cast("array<long>").alias("children"), F.lit(None).cast("array<double>").alias("radii"),
            F.transform("p", lambda p: p["id"]).alias("own"), F.flatten(F.transform("p", lambda p: p["x"])).alias("flat")))

    @property
    def levels(self) -> int:
        return len(self.heads) + 1

    def _descend(self, queries: DataFrame, task: Callable) -> DataFrame:
        """``(id, x, bar, bound, node)``: the queries at the leaves they come to."""
        rows, arrived = queries, None
        for heads in self.heads:
            inner = rows.join(heads.select("node"), "node", "left_semi")
            outer = rows.join(heads.select("node"), "node", "left_anti")
            arrived = outer if arrived is None else arrived.unionByName(outer)
            rows = cut(_meet(heads, inner, task, STREAM))
        return rows if arrived is None else arrived.unionByName(rows)

    def _compare(self, visits: DataFrame, k: int) -> DataFrame:
        """``(qid, cid, d2)``: the k nearest points of each visited leaf part."""
        from millrace.operators.nearest import _k_smallest

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for head, part in _behind(batches):
                x = _matrix(part.column("x"), part.num_rows)
                points = head["flat"].reshape(-1, x.shape[1])
                # differences of every pair kept by the preselection are held, so queries go in slices
                for lo in range(0, len(x), 1024):
                    got = _k_smallest(part.column("id").to_numpy()[lo: lo + 1024], head["own"], x[lo: lo + 1024], points, k)
                    yield pa.RecordBatch.from_pandas(got, preserve_index=False)

        # a leaf of several parts is several nodes here
        sub = self.leaves.select(F.col("node").alias("leaf"), "part")
        rows = visits.join(sub, visits.node == sub.leaf).withColumn("node", F.struct("leaf", "part")).drop("leaf", "part")
        heads = self.leaves.withColumn("node", F.struct(F.col("node").alias("leaf"), "part")).drop("part")
        return _meet(heads, rows, task, "qid long, cid long, d2 double")

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """``(qid, cid, d2, rank)``: the k nearest points of each query ``(id, x)``, ties to the lower id."""
        at_root = queries.select("id", "x", F.lit(None).cast("double").alias("bar"), F.lit(0.0).alias("bound"), F.lit(0).cast("long").alias("node"))
        home = cut(self._descend(cut(at_root), _nearest))
        first = cut(topn_per_group(self._compare(home, k), ["qid"], ["d2", "cid"], k))
        self.visits = home.count()
        if not self.heads:
            return first
        bars = first.where(F.col("rank") == k).select(F.col("qid").alias("id"), F.sqrt("d2").alias("bar"))
        armed = cut(at_root.drop("bar").join(bars, "id", "left").select("id", "x", "bar", "bound", "node"))
        visits = cut(self._descend(armed, _open).join(home.select("id", "node"), ["id", "node"], "left_anti"))
        self.visits += visits.count()
        found = first.drop("rank").unionByName(self._compare(visits, k))
        return topn_per_group(found, ["qid"], ["d2", "cid"], k)
