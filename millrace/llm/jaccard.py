"""N-gram Jaccard join by chosen paths.

Each run hashes the shingles of a set and keeps every one with probability ``1 / (threshold * size)``: the
sampled shingles are the children of the root that the set goes to, and two similar sets sample a common one with
good probability. A node with few sets is compared by brute force; a larger one is split again, by
shingles sampled with a hash of their own, down to ``max_depth``, where the sets of a node are alike
in nearly all cases and are compared in tiles. Runs are added until the estimated recall reaches the target.

Equal sets are one class throughout, so copies never meet each other. A linked pair counts in the
first of its common nodes only, so counting needs no list of pairs, and what leaves a task is one row
for each set and node.

Defined results: null text is the empty text; a text without words has no shingles and no links; a
text of 1 to 4 words is one shingle; rows of equal shingles are copies, repeated rows and rows of
equal ``doc_id`` included; null ``doc_id`` is allowed; a very long text is one set, held whole where it is compared; equal sizes and ids are in order of the class; an empty
table gives no rows. Other columns of the input are not looked at. Texts without words are no copies of each other.
"""

from __future__ import annotations

import hashlib
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import flat
from millrace.operators.graph import connected_components
from millrace.session import cut

RUN_BITS = 5
RUN_MASK = np.uint64((1 << RUN_BITS) - 1)


def chosen(sets: list[np.ndarray], parents: np.ndarray, salt: np.uint64, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """``(row, node)`` of the children: the sampled shingles of each set under its parent node."""
    size = np.array([len(s) for s in sets], np.int64)
    row = np.repeat(np.arange(len(sets)), size)
    token = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    share = np.minimum(1.0, 1.0 / (threshold * np.maximum(size, 1)))
    bar = np.where(share >= 1, np.uint64(0xFFFFFFFFFFFFFFFF), (share * 2.0**64 * (1 - 2**-53)).astype(np.uint64))
    h = flat.mix(token ^ flat.mix(parents + salt)[row])
    pick = h <= bar[row]
    return row[pick], flat.mix(h[pick] + salt)


def sketch(docs: DataFrame, runs: range, threshold: float, width: int) -> DataFrame:
    """``(doc_id, cls, size, nodes)``: the class of equal sets, and the first nodes of all runs."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(flat.shingles(batch.column("text"), width))
            names = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            found = []
            for run in runs:
                row, node = chosen(sets, np.zeros(len(sets), np.uint64), flat.seed(1, run), threshold)
                found.append((row, (node & ~RUN_MASK) | np.uint64(run)))
            row, node = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(row, kind="stable")
            ends = np.searchsorted(row[order], np.arange(len(sets) + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(names, pa.binary()), pa.array([len(s) for s in sets], pa.int32()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(node[order].view(np.int64)))],
                ["doc_id", "cls", "size", "nodes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        task, "doc_id long, cls binary, size int, nodes array<long>")


def set_table(docs: DataFrame, wanted: DataFrame, width: int, repeated_ids: bool) -> DataFrame:
    """``(cls, grams)`` of the wanted classes, each from the text of one of its rows."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(flat.shingles(batch.column("text"), width))
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            grams = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), batch.column("want"),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(grams))], ["cls", "want", "grams"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    picked = texts.join(wanted.select(F.col("cls").alias("want"), "rep"), texts.doc_id.eqNullSafe(F.col("rep")))
    got = picked.select("text", "want").mapInArrow(task, "cls binary, want binary, grams array<long>")
    # a doc_id that stands on several rows brings other texts, and the same one again
    got = got.where("cls = want").select("cls", "grams")
    return got.dropDuplicates(["cls"]) if repeated_ids else got


def split(rows: DataFrame, sets: DataFrame, depth: int, threshold: float) -> DataFrame:
    """``(node, cls, size)`` of the children of each ``(node, cls, size)``. A set is looked up once, with all nodes that it is in."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("grams").flatten().to_numpy().view(np.uint64)
            ends = np.concatenate([[0], np.cumsum(batch.column("grams").value_lengths().to_numpy())])
            node = batch.column("nodes").flatten().to_numpy().view(np.uint64)
            of = np.repeat(np.arange(batch.num_rows), batch.column("nodes").value_lengths().to_numpy())
            row, child = chosen([values[ends[k]:ends[k + 1]] for k in of], node, flat.seed(2, depth), threshold)
            child = (child & ~RUN_MASK) | (node[row] & RUN_MASK)
            at = pa.array(of[row])
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), batch.column("cls").take(at), batch.column("size").take(at)],
                                             ["node", "cls", "size"])

    held = rows.groupBy("cls", "size").agg(F.collect_list("node").alias("nodes"))
    return held.join(sets, "cls").select("nodes", "cls", "size", "grams").mapInArrow(task, "node long, cls binary, size int")


def comparable(level: DataFrame, threshold: float, small: int) -> DataFrame:
    """Rows of the small nodes whose set has another of a size in reach: sizes further apart than ``threshold`` cannot be
    similar, and in order of size the nearest one is next to it."""
    few = level.where(F.col("n") <= small).groupBy("node").agg(F.array_sort(F.collect_list(F.struct("size", "cls"))).alias("m"))

    def near(x, i):
        def size(k):
            return F.get(F.col("m"), k)["size"]
        return (F.coalesce(size(i - 1), F.lit(0)) >= x["size"] * threshold) | (x["size"] >= size(i + 1) * threshold)

    kept = few.select("node", F.filter("m", near).alias("m")).where(F.size("m") > 1)
    return kept.select("node", F.explode("m").alias("x")).select("node", "x.cls", "x.size", F.lit(2).cast("long").alias("n"))


def buckets(first: DataFrame, classes: DataFrame, docs: DataFrame, threshold: float, width: int, small: int,
            max_depth: int, repeated_ids: bool) -> tuple[DataFrame, DataFrame]:
    """The leaves ``(node, cls, size, n)`` of the recursion, and the sets of all classes in them."""
    def counted(rows: DataFrame) -> DataFrame:
        # written first: counting and the two kinds of nodes below read it again, and would hash every set again for each
        rows = cut(rows)
        n = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        rows = rows.join(n, "node")
        return cut(comparable(rows, threshold, small).unionByName(rows.where(F.col("n") > small).select("node", "cls", "size", "n")))

    level = counted(first)
    wanted = level.select("cls").distinct().join(classes, "cls")
    sets = cut(set_table(docs, wanted, width, repeated_ids))
    leaves = [level.where(F.col("n") <= small)]
    for depth in range(1, max_depth):
        large = level.where(F.col("n") > small).select("node", "cls", "size")
        if large.isEmpty():
            return _union(leaves), sets
        level = counted(split(large, sets, depth, threshold))
        leaves.append(level.where(F.col("n") <= small))
    leaves.append(level.where(F.col("n") > small))
    return _union(leaves), sets


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compare(leaves: DataFrame, sets: DataFrame, threshold: float, small: int, tile: int) -> DataFrame:
    """One row for each class with a link in a leaf: ``(cls, low, links, copies, f1, f2)``.

    ``low`` is the smallest class of its linked group in the leaf; ``links`` counts the linked classes whose first
    common leaf this is and ``copies`` the documents in them; ``f1`` and ``f2`` count those pairs,
    once a pair, that one and two runs have found.
    """
    # leaves with the same members are one leaf
    few = leaves.where(F.col("n") <= small).groupBy("node").agg(F.array_sort(F.collect_list("cls")).alias("members"))
    few = few.groupBy("members").agg(F.min("node").alias("node")).select("node", F.explode("members").alias("cls"))
    few = few.select("node", "cls", F.lit(1).alias("tiles"))
    many = leaves.where(F.col("n") > small).select("node", "cls", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    homes = leaves.groupBy("cls").agg(F.array_sort(F.collect_set("node")).alias("homes"))
    # a set is looked up once, with all nodes that it is in, before it is dealt to nodes and pairs of tiles
    held = few.unionByName(many).groupBy("cls").agg(F.collect_list(F.struct("node", "tiles")).alias("at"))
    rows = held.join(homes, "cls").join(sets, "cls").withColumn("at", F.explode("at")).select("*", "at.*").drop("at")
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")})
    rows = rows.withColumn("part", F.xxhash64("node", "a", "b"))
    rows = rows.repartition("part").sortWithinPartitions("part", "node", "a", "b")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["part", "node", "a", "b"]):
            out = links(group, threshold)
            if out is not None:
                yield out

    return rows.select("part", "node", "a", "b", "tile", "cls", "homes", "grams", "copies").mapInArrow(
        task, "cls binary, low binary, links long, copies long, f1 long, f2 long")


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of rows that come sorted, whole across batches."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        if not len(table):
            continue
        key = np.stack([table.column(k).to_numpy() for k in keys])
        edge = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1])
        for a, b in zip(edge[:-1], edge[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(edge[-1])
    if rest is not None and len(rest):
        yield rest


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    column = column.combine_chunks()
    return column.flatten().to_numpy(), np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())


def _common(values: np.ndarray, row: np.ndarray, n: int, left: np.ndarray, right: np.ndarray, columns: int = 1024) -> np.ndarray:
    """How many values each row of ``left`` shares with each of ``right``; a row has each value once. Takes ``columns`` values at a time."""
    out = np.zeros((len(left), len(right)), np.float32)
    _, at, count = np.unique(values, return_inverse=True, return_counts=True)
    keep = count[at] > 1
    column, row = (np.cumsum(count > 1) - 1)[at[keep]], row[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, [lo, lo + columns])
        part = np.zeros((n, min(columns, int(column[-1]) + 1 - lo)), np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        out += part[left] @ part[right].T
    return out


def links(group: pa.Table, threshold: float) -> pa.RecordBatch | None:
    """Brute force on the sets of one leaf, or on two tiles of a large one, of which only pairs across are compared."""
    names = group.column("cls").combine_chunks()
    n = len(names)
    values, row = _lists(group.column("grams"))
    size = np.bincount(row, minlength=n)
    tile, a, b = (group.column(c).to_numpy() for c in ("tile", "a", "b"))
    across = a[0] != b[0]
    left, right = (np.flatnonzero(tile == x) for x in (a[0], b[0])) if across else (np.arange(n),) * 2
    similar = _common(values, row, n, left, right) * (1 + threshold) >= threshold * (size[left][:, None] + size[right][None, :]) - 1e-6
    if not across:
        similar &= ~np.eye(n, dtype=bool)
    if not similar.any():
        return None
    node, homes = group.column("node")[0].as_py(), _lists(group.column("homes"))
    earlier = homes[0] < node
    new = similar & (_common(homes[0][earlier], homes[1][earlier], n, left, right) == 0)
    # runs that have found the pair: those of its common nodes
    shared = np.zeros(similar.shape, np.float32)
    run = homes[0] & int(RUN_MASK)
    for r in np.unique(run):
        shared += _common(homes[0][run == r], homes[1][run == r], n, left, right) > 0
    root = np.arange(n, dtype=np.int32)
    while True:
        low = root.copy()
        low[left] = np.minimum(low[left], np.where(similar, low[right][None, :], np.int32(n)).min(1))
        low[right] = np.minimum(low[right], np.where(similar, low[left][:, None], np.int32(n)).min(0))
        if (low == root).all():
            break
        root = low
    copies = group.column("copies").to_numpy().astype(float)
    ids = names.to_pylist()
    once = new if across else np.triu(new)
    found = np.zeros((4, n), np.int64)
    found[:, left] = new.sum(1), new @ copies[right], (once & (shared == 1)).sum(1), (once & (shared == 2)).sum(1)
    linked = np.zeros(n, bool)
    linked[left] = similar.any(1)
    if across:
        found[:2, right] = new.sum(0), copies[left] @ new
        linked[right] = similar.any(0)
    keep = np.flatnonzero(linked)
    return pa.RecordBatch.from_arrays([
        names.take(pa.array(keep)), pa.array([ids[i] for i in root[keep]], pa.binary()), *(pa.array(x[keep]) for x in found)],
        ["cls", "low", "links", "copies", "f1", "f2"])


def jaccard_join(docs: DataFrame, threshold: float = 0.8, width: int = 5, recall: float = 0.99, small: int = 128,
                 tile: int = 1536, max_depth: int = 4, step: int = 8) -> DataFrame:
    """``(doc_id, class_id, set_id, n_links, n_texts)``, one row for each row of ``docs (doc_id, text)``.

    ``set_id`` is the smallest doc_id with the same shingles, ``class_id`` the smallest of all documents that chains of
    links reach, ``n_texts`` the number of other shingle sets at ``threshold`` or more, ``n_links`` the number of other
    documents, copies included. Recall is estimated from the pairs that one and that two runs have found; ``step`` runs
    are added until it reaches ``recall``; if the last of 32 runs has not, a warning says so.
    """
    runs = range(step)
    seen: DataFrame | None = None
    while True:
        table = cut(sketch(docs, runs, threshold, width))
        if seen is None:
            members = table.select("doc_id", "cls", "size")
            classes = cut(members.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                     F.max("size").alias("size")))
            repeated_ids = members.count() > members.select("doc_id").distinct().count()
        # copies have the same nodes, so one row of each class is enough
        firsts = table.join(classes.select("cls", "rep"), "cls").where("doc_id <=> rep").select("cls", "size", F.explode("nodes").alias("node"))
        firsts = firsts.distinct() if repeated_ids else firsts
        leaves, sets = buckets(firsts, classes, docs, threshold, width, small, max_depth, repeated_ids)
        if seen is not None:
            leaves, sets = seen[0].unionByName(leaves), seen[1].unionByName(sets).dropDuplicates(["cls"])
        found = cut(compare(leaves, sets.join(classes.select("cls", "copies"), "cls"), threshold, small, tile))
        got = found.agg(F.sum("links"), F.sum("f1"), F.sum("f2")).first()
        pairs, f1, f2 = ((x or 0) for x in got)
        missing = f1 * max(f1 - 1, 0) / (2 * (f2 + 1)) * (1 - 1 / len(runs))
        reached = pairs / 2 >= recall * (pairs / 2 + missing)
        if reached or runs.stop + step > 1 << RUN_BITS:
            if not reached:
                warnings.warn(f"estimated recall {pairs / 2 / (pairs / 2 + missing):.4f} after {runs.stop} runs, below {recall}", stacklevel=2)
            break
        seen, runs = (leaves, sets), range(runs.stop, runs.stop + step)

    edges = found.select(F.col("cls").alias("src"), F.col("low").alias("dst")).distinct()
    own = classes.where("size > 0").select(F.col("cls").alias("id"))
    parts = connected_components(own.join(edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct(), "id", "left_semi"), edges)
    total = found.groupBy("cls").agg(F.sum("links").alias("n_texts"), F.sum("copies").alias("others"))
    info = classes.join(total, "cls", "left").join(parts.withColumnRenamed("id", "cls"), "cls", "left")
    info = cut(info.withColumn("component", F.coalesce("component", "cls")))
    lowest = info.groupBy("component").agg(F.min("rep").alias("class_id"))
    info = info.join(lowest, "component")
    return members.join(info.drop("size"), "cls").select(
        "doc_id", F.when(F.col("size") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(F.col("size") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("set_id"),
        F.when(F.col("size") > 0, F.coalesce("others", F.lit(0)) + F.col("copies") - 1).otherwise(0).cast("long").alias("n_links"),
        F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class one row stays, that of the smallest doc_id.

    Texts without words all stay. Where doc_id is null or stands on several rows, rows are numbered first.
    """
    rows, key = docs, "doc_id"
    n, ids = docs.agg(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
    if n != ids:
        rows, key = cut(docs.withColumn("row_id__", F.monotonically_increasing_id())), "row_id__"
    found = jaccard_join(rows.select(F.col(key).alias("doc_id"), "text"), **options)
    return rows.join(found.where("doc_id <> class_id").select(F.col("doc_id").alias(key)), key, "left_anti").select(*docs.columns)
