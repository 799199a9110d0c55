"""Queries on clustering, dimensionality reduction, word vectors, grids and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.scalar import HASH_PRIME, hash_sql
from millrace.operators import cluster, joins, reduce, text, voronoi
from millrace.plans import views as v
from millrace.plans.preparation import NEAREST
from millrace.plans.registry import query
from millrace.plans.scoring import _SCORED, _scored
from millrace.session import scratch_path
from millrace.streaming import jobs

R6 = v.rnd
XY = ["x", "y"]


def _seeds_sql(k: int) -> str:
    """CTEs of the seeds: ``c0 (c, x)``."""
    parts = []
    for i in range(k):
        draw = f"-ln(({hash_sql('id', i)} + 0.5::double) / {HASH_PRIME}::double)"
        near = f"(SELECT min({v.sql_d2('v.x', 's.x')}) FROM ({' UNION ALL '.join(f'SELECT x FROM s{j}' for j in range(i))}) s)"
        order = f"CASE WHEN d2 > 0 THEN {draw} / d2 END" if i else draw
        parts.append(f"s{i} AS MATERIALIZED (SELECT x FROM (SELECT id, x, {near if i else '0'} AS d2 FROM vectors v) ORDER BY {order} NULLS LAST, id LIMIT 1)")
    return ", ".join(parts) + ", c0 AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT {i} AS c, x FROM s{i}" for i in range(k)) + ")"


def _near_sql(centers: str) -> str:
    return (f"(SELECT id, c, d2 FROM (SELECT v.id, k.c, {v.sql_d2('v.x', 'k.x')} AS d2, row_number() OVER (PARTITION BY v.id ORDER BY {v.sql_d2('v.x', 'k.x')}, k.c) AS rk "
            f"FROM vectors v, {centers} k) WHERE rk = 1)")


def _lloyd_sql(rounds: int) -> str:
    """``rounds`` unrolled rounds; once no row moves, further rounds change nothing."""
    parts = []
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED {_near_sql(f'c{r}')}")
        parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c, list(m ORDER BY d) AS x FROM (SELECT c, d, avg(v) AS m FROM a{r} JOIN cells USING (id) GROUP BY c, d) GROUP BY c "
                     f"UNION ALL SELECT c, x FROM c{r} WHERE c NOT IN (SELECT c FROM a{r}))")
    return ", ".join(parts)


@query("kmeanspp_seeds", f"""WITH {v.VECTORS}, {_seeds_sql(4)} SELECT c::int AS seed, d::int AS d, round(x, 6) + 0.0 AS x FROM (SELECT c, unnest(range(len(x))) AS d, unnest(x) AS x FROM c0)""")
def _(spark, sf):
    rows, names = v.coordinates(spark, sf)
    seeds = cluster.kmeanspp_seeds(rows, "id", names, 4)
    return spark.createDataFrame([(i, d, x) for i, s in enumerate(seeds) for d, x in enumerate(s)], "seed int, d int, x double").withColumn("x", R6("x"))


@query("lloyd_step", f"""WITH {NEAREST}, s AS (SELECT c, count(*) AS n, round(sum(d2), 6) AS sse FROM near GROUP BY 1) SELECT c AS center, n, sse, d::int AS d,
       round(avg(v), 6) + 0.0 AS mean FROM (SELECT c, unnest(range(len(x))) AS d, unnest(x) AS v FROM near) JOIN s USING (c) GROUP BY ALL""")
def _(spark, sf):
    rows, names = v.coordinates(spark, sf)
    out = cluster.lloyd_step(rows, v.first_vectors(spark, sf, 4), names)
    return out.select("center", "n", R6("sse").alias("sse"), F.posexplode(F.array(*names)).alias("d", "mean")).withColumn("mean", R6("mean"))


@query("lloyd_kmeans", f"""WITH {v.VECTORS}, {v.LONG}, {_seeds_sql(4)}, {_lloyd_sql(15)} SELECT id, c::int AS center, (SELECT round(sum(d2), 5) FROM a14) AS objective
       FROM {_near_sql('c15')}""")
def _(spark, sf):
    rows, names = v.coordinates(spark, sf)
    centers, history = cluster.lloyd_kmeans(rows, "id", names, 4, max_iter=15)
    return joins.nearest_center_join(rows, centers, names).select("id", "center", R6(F.lit(history[-1]), 5).alias("objective"))


@query("kmeans_objective")
def _(spark, sf):
    return cluster.kmeans_objective(v.vectors(spark, sf), "x", 10, niter=20)


_PICK = f"ORDER BY {hash_sql('vec_id')}, vec_id LIMIT 200"


@query("estimate_bandwidth", f"""WITH s AS (SELECT vec_id AS id, embedding::double[] AS x FROM embeddings {_PICK}),
       d AS (SELECT a.id, sqrt({v.sql_d2('a.x', 'b.x')}) AS d, row_number() OVER (PARTITION BY a.id ORDER BY {v.sql_d2('a.x', 'b.x')}, b.id) AS rk FROM s a, s b) SELECT round(avg(d), 6) AS bandwidth FROM d WHERE rk = 40""")
def _(spark, sf):
    return cluster.estimate_bandwidth(v.vectors(spark, sf).select("id", "x"), 0.2, 200).select(R6("bandwidth").alias("bandwidth"))


@query("mean_shift")
def _(spark, sf):
    return cluster.mean_shift(v.points2d(spark, sf), "id", XY, 0.15)


DB_EPS, DB_MIN = 0.025, 6


@query("dbscan", f"""WITH {v.POINTS}, d AS (SELECT p.id AS a, q.id AS b, sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) AS d
       FROM points p, points q WHERE sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) <= {DB_EPS}), c AS (SELECT a AS id FROM d
       GROUP BY 1 HAVING count(*) >= {DB_MIN}) SELECT id, CASE WHEN id IN (SELECT id FROM c) THEN 'core' WHEN id IN (SELECT a FROM d WHERE b IN
       (SELECT id FROM c)) THEN 'border' ELSE 'noise' END AS kind FROM points""")
def _(spark, sf):
    return cluster.dbscan(v.points2d(spark, sf), "id", XY, DB_EPS, DB_MIN).select("id", "kind")


@query("dbscan_clusters", f"""WITH RECURSIVE {v.POINTS}, d AS MATERIALIZED (SELECT p.id AS a, q.id AS b, sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y))
       AS d FROM points p, points q WHERE sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) <= {DB_EPS}), c AS MATERIALIZED (SELECT a AS id FROM d GROUP BY 1
       HAVING count(*) >= {DB_MIN}), e AS MATERIALIZED (SELECT a, b FROM d WHERE a IN (SELECT id FROM c) AND b IN (SELECT id FROM c)), reach AS (SELECT a, b FROM e UNION
       SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b), k AS (SELECT b AS id, min(a) AS cluster FROM reach GROUP BY 1), n AS (SELECT a AS id, cluster,
       row_number() OVER (PARTITION BY a ORDER BY d, cluster) AS rk FROM d JOIN k ON k.id = d.b WHERE a NOT IN (SELECT id FROM c))
       SELECT p.id, CASE WHEN k.id IS NOT NULL THEN 'core' WHEN n.id IS NOT NULL THEN 'border' ELSE 'noise' END AS kind,
       coalesce(k.cluster, n.cluster, -1)::bigint AS cluster FROM points p LEFT JOIN k ON k.id = p.id LEFT JOIN n ON n.id = p.id AND n.rk = 1""")
def _(spark, sf):
    return cluster.dbscan(v.points2d(spark, sf), "id", XY, DB_EPS, DB_MIN)


@query("spectral_clusters")
def _(spark, sf):
    return cluster.spectral_clusters(v.vectors(spark, sf).select("id", "x"), 4)


@query("gmm_fit")
def _(spark, sf):
    return cluster.gmm_fit(v.vectors(spark, sf).select("id", "x"), "x", 3, max_iter=15)[1].select("id", "cluster")


_COV = f"""WITH {v.VECTORS}, {v.LONG}, n AS (SELECT count(*)::double AS n FROM vectors) SELECT a.d::int AS i, b.d::int AS j, round((sum(a.v * b.v) - sum(a.v)
       * sum(b.v) / any_value(n)) / (any_value(n) - 1), 6) + 0.0 AS cov FROM cells a JOIN cells b ON a.id = b.id AND a.d <= b.d, n GROUP BY 1, 2"""


@query("pca_covariance", _COV)
def _(spark, sf):
    return reduce.covariance(reduce.moments(v.vectors(spark, sf), "x")).withColumn("cov", R6("cov"))


@query("pca_project")
def _(spark, sf):
    rows = v.vectors(spark, sf)
    return reduce.Pca(2).fit(rows, "x").transform(rows, "x").select("id", F.col("scores")[0].alias("p0"), F.col("scores")[1].alias("p1"))


@query("incremental_pca", "SELECT count(*) AS n, 0.0::double AS gap FROM embeddings")
def _(spark, sf):
    rows = v.vectors(spark, sf).withColumn("batch", F.col("id") % 5)
    whole = reduce.Pca(2).fit(rows, "x")
    parts = reduce.incremental_pca(rows, "x", "batch", 2)
    both = parts.transform(whole.transform(rows, "x", "a"), "x", "b")
    gap = F.abs(F.abs(F.col("a")[0]) - F.abs(F.col("b")[0])) + F.abs(F.abs(F.col("a")[1]) - F.abs(F.col("b")[1]))
    return both.agg(F.count(F.lit(1)).alias("n"), R6(F.avg(gap)).alias("gap"))


@query("isomap_landmark")
def _(spark, sf):
    out = reduce.isomap_landmark(v.vectors(spark, sf).select("id", "x"), 8, 2, landmarks=30)
    return out.select("id", F.col("coords")[0].alias("c0"), F.col("coords")[1].alias("c1"))


@query("word_vectors")
def _(spark, sf):
    vectors, _ = text.word_vectors(v.documents(spark, sf), "text", dim=16, window=1, vocabulary=1000)
    return vectors.select("word", F.size("vector").alias("size"))


@query("project_top_words")
def _(spark, sf):
    vectors, vocab = text.word_vectors(v.documents(spark, sf), "text", dim=16, window=1, vocabulary=1000)
    return text.project_top_words(vectors, vocab, 100)


WIDTH, HEIGHT = 64, 48


def _seeds(spark, sf):
    p = v.points2d(spark, sf)
    return p.select("id", F.round((F.col("x") + 0.5) * WIDTH, 2).alias("x"), F.round((F.col("y") + 0.5) * HEIGHT, 2).alias("y"))


_GRID = f"""{v.POINTS}, seeds AS (SELECT id, round((x + 0.5) * {WIDTH}, 2) AS x, round((y + 0.5) * {HEIGHT}, 2) AS y FROM points), grid AS (SELECT px, py
       FROM range({WIDTH}) a(px), range({HEIGHT}) b(py)), own AS (SELECT px, py, id AS owner FROM (SELECT px, py, id, row_number() OVER (PARTITION BY px, py
       ORDER BY (px - x) * (px - x) + (py - y) * (py - y), id) AS rk FROM grid, seeds) WHERE rk = 1)"""


@query("voronoi_cells", f"WITH {_GRID} SELECT owner, count(*) AS area FROM own GROUP BY 1")
def _(spark, sf):
    return voronoi.cell_areas(voronoi.voronoi_cells(_seeds(spark, sf), WIDTH, HEIGHT))


@query("voronoi_neighbours", f"""WITH {_GRID} SELECT least(p.owner, q.owner) AS a, greatest(p.owner, q.owner) AS b, count(*) AS border FROM own p JOIN own q
       ON (q.px = p.px + 1 AND q.py = p.py) OR (q.px = p.px AND q.py = p.py + 1) WHERE p.owner <> q.owner GROUP BY 1, 2""")
def _(spark, sf):
    return voronoi.voronoi_neighbours(voronoi.voronoi_cells(_seeds(spark, sf), WIDTH, HEIGHT))


# --- streams -------------------------------------------------------------------------------------
def _as_stream(spark, df, key: str):
    """The table as four files, read one per micro-batch."""
    path = scratch_path(spark, "stream")
    df.repartitionByRange(4, key).write.parquet(path)
    return jobs.file_stream(spark, path, df.schema)


@query("stream_incremental_pca", _COV)
def _(spark, sf):
    stream = _as_stream(spark, v.vectors(spark, sf), "id")
    return reduce.covariance(jobs.stream_moments(stream, "x")).withColumn("cov", R6("cov"))


_BINS = 100


@query("stream_accumulated_auc", f"""WITH {_SCORED}, c AS (SELECT least(floor(p * {_BINS}), {_BINS - 1})::int AS b, sum(y)::double AS pos, sum(1 - y)::double AS neg
       FROM scored GROUP BY 1), t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM c), r AS (SELECT b, sum(neg) OVER w / n AS x, sum(pos) OVER w / p AS y
       FROM c, t WINDOW w AS (ORDER BY b DESC)), s AS (SELECT x, y, lag(x, 1, 0) OVER w AS px, lag(y, 1, 0) OVER w AS py FROM r WINDOW w AS (ORDER BY b DESC))
       SELECT (SELECT count(*) FROM scored) AS rows, round(sum((x - px) * (y + py) / 2), 5) AS accumulated_auc FROM s""")
def _(spark, sf):
    stream = _as_stream(spark, _scored(spark, sf), "event_id")
    lines = jobs.stream_accumulated_auc(stream, "y", "p", _BINS)
    return lines.agg(F.sum("rows").alias("rows"), R6(F.max_by("accumulated_auc", "batch"), 5).alias("accumulated_auc"))
