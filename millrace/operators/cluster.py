"""Clustering. Only centres, cell tables and cluster counts reach the driver."""

from __future__ import annotations

import math

from pyspark.ml.clustering import GaussianMixture, KMeans, PowerIterationClustering
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import HASH_PRIME, key_hash
from millrace.operators.graph import connected_components
from millrace.operators.joins import epsilon_range_join, euclid, grid_cell, nearest_center, neighbour_cells
from millrace.operators.nearest import knn_join
from millrace.operators.quantiles import positions
from millrace.session import cut


def kmeanspp_seeds(df: DataFrame, key: str, coords: list[str], k: int, seed: int = 0) -> list[list[float]]:
    """k-means++ seeds; each pass is one aggregate.

    Drawing with probability ~ d² is the smallest of ``-ln(u) / d²``, with u hashed from
    the key, so no running sum over all rows is needed.
    """
    chosen: list[list[float]] = []
    for step in range(k):
        draw = -F.log((key_hash(key, seed * 1_000_003 + step) + 0.5) / float(HASH_PRIME))
        if not chosen:
            order = draw
        else:
            d2 = nearest_center(chosen, coords)["d2"]
            order = F.when(d2 > 0, draw / d2)
        row = df.agg(F.min_by(F.struct(*coords), F.struct(order.isNull().alias("n"), order.alias("o"), F.col(key))).alias("p")).first()["p"]
        chosen.append([float(row[c]) for c in coords])
    return chosen


def lloyd_step(df: DataFrame, centers: list[list[float]], coords: list[str]) -> DataFrame:
    """``(center, n, means…, sse)`` after one assignment."""
    near = df.select(*coords, nearest_center(centers, coords).alias("_near"))
    return near.groupBy(F.col("_near.idx").alias("center")).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in coords], F.sum("_near.d2").alias("sse"))


def lloyd_kmeans(df: DataFrame, key: str, coords: list[str], k: int, seed: int = 0, max_iter: int = 50,
                 centers: list[list[float]] | None = None) -> tuple[list[list[float]], list[float]]:
    """Centres and the objective of every round; stops when at most n/1024 rows changed cell."""
    df = df.select(key, *coords).persist()
    try:
        centers = centers or kmeanspp_seeds(df, key, coords, k, seed)
        history: list[float] = []
        previous = None
        for _ in range(max_iter):
            near = nearest_center(centers, coords)
            before = nearest_center(previous, coords)["idx"] if previous else F.lit(-1)
            rows = df.select(*coords, near.alias("_near"), (near["idx"] != before).alias("_moved")).groupBy(
                F.col("_near.idx").alias("center")).agg(
                F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in coords], F.sum("_near.d2").alias("sse"),
                F.count_if("_moved").alias("moved")).collect()
            history.append(sum(r["sse"] for r in rows))
            previous, centers = centers, [list(c) for c in centers]
            for r in rows:
                centers[r["center"]] = [r[c] for c in coords]
            if len(history) > 1 and sum(r["moved"] for r in rows) <= sum(r["n"] for r in rows) / 1024:
                break
        return centers, history
    finally:
        df.unpersist()


def kmeans_objective(df: DataFrame, array_col: str, k: int, niter: int = 20, seed: int = 0) -> DataFrame:
    """Final sum of squared distances of k-means with a fixed number of rounds, and the rows."""
    rows = df.select(array_to_vector(F.col(array_col).cast("array<double>")).alias("features")).persist()
    model = KMeans(k=k, maxIter=niter, tol=0.0, seed=seed).fit(rows)
    out = (model.summary.trainingCost, rows.count(), k)
    rows.unpersist()
    return df.sparkSession.createDataFrame([out], "objective double, rows long, k int")


def estimate_bandwidth(points: DataFrame, quantile: float = 0.2, sample: int = 500) -> DataFrame:
    """Mean distance of ``sample`` hashed rows to their q-quantile neighbour in the sample, itself counted.

    The sample size is the operator's own parameter.
    """
    picked = cut(points.orderBy(key_hash("id"), "id").limit(sample))
    k = max(1, int(picked.count() * quantile))
    return knn_join(picked, picked, k).where(F.col("rank") == k).agg(F.avg("dist").alias("bandwidth"))


def mean_shift(df: DataFrame, key: str, coords: list[str], bandwidth: float, max_iter: int = 100) -> DataFrame:
    """``(key, cluster)``: flat-kernel modes from grid seeds, rows labelled with the nearest mode.

    Rows with equal coordinates are counted once with a weight. A row meets only the
    seeds of its surrounding cells (at most three dimensions).
    """
    if len(coords) > 3:
        raise ValueError("grid seeds serve up to 3 dimensions")
    points = cut(df.groupBy(*coords).agg(F.count(F.lit(1)).alias("w")).withColumn("_cell", grid_cell(coords, bandwidth)))
    near = points.withColumn("_cell", F.explode(neighbour_cells("_cell", len(coords))))
    seeds = points.select(*[F.round(F.col(c) / bandwidth).alias(c) for c in coords]).distinct()
    seeds = cut(seeds.select(*[(F.col(c) * bandwidth).alias(c) for c in coords]))
    done = None
    for _ in range(max_iter):
        placed = seeds.withColumn("_cell", grid_cell(coords, bandwidth))
        met = placed.alias("s").join(near.alias("p"), "_cell").where(euclid("s", "p", coords) <= bandwidth)
        total = F.sum("p.w")
        moved = met.groupBy(*[F.col(f"s.{c}").alias(f"o_{c}") for c in coords]).agg(
            *[(F.sum(F.col("p.w") * F.col(f"p.{c}")) / total).alias(c) for c in coords], total.alias("mass"))
        gap = F.sqrt(sum(((F.col(c) - F.col(f"o_{c}")) * (F.col(c) - F.col(f"o_{c}")) for c in coords), F.lit(0.0)))
        moved = cut(moved.withColumn("_gap", gap))
        # seeds that have met go on as one: of those in one thousandth of the bandwidth the heaviest
        spot = [F.floor(F.col(c) / (1e-3 * bandwidth)) for c in coords]
        heaviest = F.max(F.struct("mass", *coords)).alias("m")
        done = moved.groupBy(*spot).agg(heaviest).select("m.*")
        seeds = done.select(*coords)
        if (moved.agg(F.max("_gap")).first()[0] or 0.0) <= 1e-3 * bandwidth:
            break
    else:
        raise RuntimeError(f"modes still move after {max_iter} rounds")
    modes = cut(merged_modes(done, coords, bandwidth))
    if modes.count() <= 64:
        few = [[r[c] for c in coords] for r in modes.orderBy("id").collect()]
        return df.select(key, nearest_center(few, coords)["idx"].alias("cluster"))
    kept = modes.select("id", F.array(*coords).alias("x"))
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.array(*[F.col(c).cast("double") for c in coords]).alias("x"))
    return knn_join(rows, kept, 1).select(F.col("qid").alias(key), F.col("cid").cast("int").alias("cluster"))


def merged_modes(modes: DataFrame, coords: list[str], bandwidth: float) -> DataFrame:
    """``(id, coords…)`` of the modes ``(mass, coords…)`` that stay: heaviest first, a mode within the bandwidth of a kept one is dropped.

    That is the first maximal independent set in order of mass, found in rounds: of the open modes those without a heavier open neighbour stay and
    their neighbours go. Only counts reach the driver.
    """
    ranked = cut(positions(modes, [F.desc("mass"), *[F.asc(c) for c in coords]]).withColumn("_pos", F.col("_pos").cast("long")))
    pairs = cut(epsilon_range_join(ranked, "_pos", coords, bandwidth).select("a", "b"))
    open_ids = ranked.select(F.col("_pos").alias("id"))
    kept = None
    while True:
        behind = pairs.select(F.col("b").alias("id")).distinct()
        new = cut(open_ids.join(behind, "id", "left_anti"))
        kept = new if kept is None else kept.unionByName(new)
        gone = pairs.join(new, pairs.a == new.id, "left_semi").select(F.col("b").alias("id")).distinct()
        open_ids = cut(behind.join(gone, "id", "left_anti"))
        if open_ids.isEmpty():
            break
        left = pairs.join(open_ids.withColumnRenamed("id", "a"), "a", "left_semi")
        pairs = cut(left.join(open_ids.withColumnRenamed("id", "b"), "b", "left_semi").select("a", "b"))
    found = ranked.join(kept.withColumnRenamed("id", "_pos"), "_pos").withColumnRenamed("_pos", "_rank")
    return positions(found, [F.asc("_rank")]).select((F.col("_pos") - 1).cast("long").alias("id"), *coords)


def dbscan(df: DataFrame, key: str, coords: list[str], eps: float, min_samples: int, light: int = 10_000) -> DataFrame:
    """``(key, kind, cluster)``: kind is core, border or noise; noise has cluster -1.

    A cluster is named by its smallest core id; a border row joins its nearest core row.
    Cells have the diagonal eps, so all rows of a cell are neighbours: a cell with
    ``min_samples`` rows is core as a whole and its rows need no pairs. Rows of thinner
    cells look around, at most ``min_samples - 1`` per cell. Clusters are components of
    cells, linked where two core rows of different cells are within eps.
    """
    dims = len(coords)
    if dims > 3:
        raise ValueError("grid cells serve up to 3 dimensions")
    side, reach = eps / math.sqrt(dims) * (1 - 1e-12), math.ceil(math.sqrt(dims))
    points = cut(df.groupBy(*coords).agg(F.count(F.lit(1)).alias("w"), F.min(key).alias("id"))
                 .withColumn("_cell", grid_cell(coords, side)))
    full = points.groupBy("_cell").agg(F.sum("w").alias("cw"))
    sized = points.join(full, "_cell")
    thin = sized.where(F.col("cw") < min_samples)
    asks = thin.withColumn("_cell", F.explode(neighbour_cells("_cell", dims, reach, skip_own=True)))
    seen = asks.alias("q").join(points.alias("p"), "_cell").where(euclid("q", "p", coords) <= eps).groupBy(
        F.col("q.id").alias("id")).agg(F.sum("p.w").alias("near"))
    state = thin.join(seen, "id", "left").withColumn(
        "core", F.col("cw") + F.coalesce("near", F.lit(0)) >= min_samples).select("id", *coords, "_cell", "core")
    dense = sized.where(F.col("cw") >= min_samples).select("id", *coords, "_cell", F.lit(True).alias("core"))
    state = cut(state.unionByName(dense))
    cores = state.where("core")
    ids = cores.groupBy("_cell").agg(F.min("id").alias("cid"))
    named = cut(_boxes(cores, ["_cell"], coords).join(ids, "_cell").withColumn("own", F.col("_cell")))
    links = _cell_links(cores, named, coords, eps, reach, side, light)
    comp = connected_components(named.select(F.col("cid").alias("id")), links)
    cell_cluster = named.join(comp.withColumnRenamed("id", "cid"), "cid").select("_cell", F.col("component").alias("cluster"))
    core_rows = cores.join(cell_cluster, "_cell").select("id", *coords, "_cell", "cluster")
    rest = state.where("not core")
    look = rest.withColumn("_cell", F.explode(neighbour_cells("_cell", dims, reach)))
    edge = look.alias("q").join(core_rows.alias("p"), "_cell").withColumn("d", euclid("q", "p", coords)).where(
        F.col("d") <= eps).groupBy(F.col("q.id").alias("id")).agg(
        F.min_by("p.cluster", F.struct("d", F.col("p.cluster"))).alias("cluster"))
    others = rest.join(edge, "id", "left").select(
        *coords, F.when(F.col("cluster").isNull(), "noise").otherwise("border").alias("kind"),
        F.coalesce("cluster", F.lit(-1)).cast("bigint").alias("cluster"))
    labelled = core_rows.select(*coords, F.lit("core").alias("kind"), F.col("cluster").cast("bigint")).unionByName(others)
    return df.select(key, *coords).join(labelled, coords).select(key, "kind", "cluster")


def _cell_links(cores: DataFrame, named: DataFrame, coords: list[str], eps: float, reach: int, side: float,
                light: int) -> DataFrame:
    """Links between core cells that have two core rows within eps.

    Bounding boxes settle a pair when their span is within eps or their gap is not. An open
    pair with at most ``light`` row pairs compares rows; any other is tried again on boxes
    of half the size, down to single rows. So a full cell never meets a full cell row by row.
    """
    around = named.withColumn("_cell", F.explode(neighbour_cells("_cell", len(coords), reach, skip_own=True)))
    open_pairs = _measure(around.alias("l").join(named.alias("r"), "_cell").where(F.col("l.cid") < F.col("r.cid")),
                          coords).where(F.col("gap") <= eps)
    rows = cores.join(named.select("_cell", "cid"), "_cell").select("cid", *coords)
    open_pairs = cut(open_pairs.select("src", "dst", "lcell", "rcell", "span", "work"))
    links, width = None, side
    while True:
        sure = open_pairs.where(F.col("span") <= eps).select("src", "dst")
        rest = open_pairs.where(F.col("span") > eps).join(sure, ["src", "dst"], "left_anti")
        few = rest.where(F.col("work") <= light)
        l, r = (rows.withColumn("_k", grid_cell(coords, width)).alias(n) for n in ("l", "r"))
        met = few.join(l, (F.col("src") == F.col("l.cid")) & (F.col("lcell") == F.col("l._k"))).join(
            r, (F.col("dst") == F.col("r.cid")) & (F.col("rcell") == F.col("r._k")))
        close = met.where(euclid("l", "r", coords) <= eps).select("src", "dst")
        found = cut(sure.unionByName(close).distinct())
        links = found if links is None else links.unionByName(found)
        many = cut(rest.where(F.col("work") > light).join(found, ["src", "dst"], "left_anti"))
        if many.isEmpty():
            return links.distinct()
        half = rows.withColumns({"_p": grid_cell(coords, width), "own": grid_cell(coords, width / 2)})
        boxes = _boxes(half, ["cid", "_p", "own"], coords)
        width /= 2
        tried = many.select("src", "dst", "lcell", "rcell").alias("o").join(
            boxes.alias("l"), (F.col("o.src") == F.col("l.cid")) & (F.col("o.lcell") == F.col("l._p"))).join(
            boxes.alias("r"), (F.col("o.dst") == F.col("r.cid")) & (F.col("o.rcell") == F.col("r._p")))
        open_pairs = cut(_measure(tried, coords).where(F.col("gap") <= eps).select(
            "src", "dst", "lcell", "rcell", "span", "work"))


def _boxes(rows: DataFrame, by: list[str], coords: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[
        f(c).alias(f"{n}_{c}") for c in coords for n, f in (("lo", F.min), ("hi", F.max))])


def _measure(pairs: DataFrame, coords: list[str]) -> DataFrame:
    """Smallest and largest possible distance between the boxes ``l`` and ``r``."""
    gap, span = ["0D"], ["0D"]
    for c in coords:
        near = f"greatest(r.lo_{c} - l.hi_{c}, l.lo_{c} - r.hi_{c}, 0D)"
        far = f"greatest(r.hi_{c} - l.lo_{c}, l.hi_{c} - r.lo_{c})"
        gap.append(f"{near} * {near}")
        span.append(f"{far} * {far}")
    return pairs.selectExpr("l.cid AS src", "r.cid AS dst", "l.own AS lcell", "r.own AS rcell", f"sqrt({' + '.join(gap)}) AS gap",
                            f"sqrt({' + '.join(span)}) AS span", "l.n * r.n AS work")


def spectral_clusters(points: DataFrame, k: int, neighbours: int = 10, max_iter: int = 20) -> DataFrame:
    """``(id, cluster)`` by power iteration on the symmetric k-nearest-neighbour graph."""
    near = knn_join(points, points, neighbours, exclude_self=True)
    edges = near.select(F.least("qid", "cid").alias("src"), F.greatest("qid", "cid").alias("dst"),
                        F.exp(-F.col("dist") * F.col("dist")).alias("w")).groupBy("src", "dst").agg(F.max("w").alias("w"))
    edges = cut(edges)
    pic = PowerIterationClustering(k=k, maxIter=max_iter, initMode="degree", weightCol="w")
    return pic.assignClusters(edges)


def gmm_fit(df: DataFrame, array_col: str, k: int, seed: int = 0, max_iter: int = 50):
    """Full-covariance mixture: the model and ``(…, cluster, probability)`` rows."""
    rows = df.withColumn("_f", array_to_vector(F.col(array_col).cast("array<double>")))
    gmm = GaussianMixture(k=k, featuresCol="_f", predictionCol="cluster", probabilityCol="_p", seed=seed, maxIter=max_iter)
    model = gmm.fit(rows)
    return model, model.transform(rows).withColumn("probability", vector_to_array("_p")).drop("_f", "_p")
