"""Queries on similarity, recommendation and click-through ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import scalar as S
from millrace.operators import als, ctr, factor, metrics, similarity, simjoin
from millrace.plans import views as v
from millrace.plans.preparation import _EUCLID, _TOPN, _USER_PAIRS
from millrace.plans.registry import query

R6 = v.rnd
SUMMARY = "SELECT a, count(*) AS partners, round(sum(sim), 5) + 0.0 AS total, round(max(sim), 6) + 0.0 AS best FROM {} GROUP BY a"


def summary(pairs):
    """Per left entity over all of its pairs."""
    return pairs.groupBy("a").agg(F.count(F.lit(1)).alias("partners"), R6(F.sum("sim"), 5).alias("total"),
                                  R6(F.max("sim")).alias("best"))


@query("euclid_similarity", f"WITH {v.RATINGS}, {_USER_PAIRS}, {_EUCLID} {SUMMARY.format('e')}")
def _(spark, sf):
    return summary(similarity.euclid_similarity(v.ratings(spark, sf)))


@query("pearson_similarity", f"""WITH {v.RATINGS}, {_USER_PAIRS}, p AS (SELECT a, b, CASE WHEN saa - sa * sa / n <= 1e-12 * saa OR
       sbb - sb * sb / n <= 1e-12 * sbb THEN 0 ELSE (sab - sa * sb / n) / sqrt((saa - sa * sa / n) * (sbb - sb * sb / n)) END AS sim
       FROM pairs) {SUMMARY.format('p')}""")
def _(spark, sf):
    return summary(similarity.pearson_similarity(v.ratings(spark, sf)))


def _unit(source: str, e: str) -> str:
    return (f"norm_{e} AS (SELECT {e}, sqrt(sum(r * r)) AS norm FROM {source} GROUP BY 1), "
            f"unit_{e} AS (SELECT u, i, r, r / norm AS x FROM {source} JOIN norm_{e} USING ({e}))")


@query("cosine_similarity", f"""WITH {v.RATINGS}, {_unit('ratings', 'i')}, p AS (SELECT x.i AS a, y.i AS b, sum(x.x * y.x) AS sim
       FROM unit_i x JOIN unit_i y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2) {SUMMARY.format('p')}""")
def _(spark, sf):
    return summary(similarity.cosine_similarity(v.ratings(spark, sf), "item"))


_UNIT_PAIRS = f"""{v.RATINGS}, {_unit('ratings', 'u')}, p AS (SELECT x.u AS a, y.u AS b, sum(x.x * y.x) AS sim
       FROM unit_u x JOIN unit_u y ON x.i = y.i AND x.u <> y.u GROUP BY 1, 2)"""


@query("cosine_partners_above", f"""WITH {_UNIT_PAIRS} SELECT a AS id, count(*) AS partners, round(sum(sim), 5) + 0.0 AS total,
       round(max(sim), 6) + 0.0 AS best FROM p WHERE sim >= 0.15 GROUP BY 1""")
def _(spark, sf):
    out = simjoin.cosine_partners_above(v.ratings(spark, sf), 0.15)
    return out.select("id", "partners", R6("total", 5).alias("total"), R6("best").alias("best"))


@query("topn_cosine", f"""WITH {_UNIT_PAIRS} SELECT a, b, round(sim, 6) + 0.0 AS sim, rank::int AS rank FROM (SELECT *, row_number() OVER
       (PARTITION BY a ORDER BY round(sim, 9) DESC, b) AS rank FROM p) WHERE rank <= 10""")
def _(spark, sf):
    return simjoin.topn_cosine(v.ratings(spark, sf), 10).select("a", "b", R6("sim").alias("sim"), "rank")


_PREDICT_USER = f"""{v.SPLIT}, {_unit('train', 'u')}, sims AS (SELECT x.u AS a, y.u AS b, sum(x.x * y.x) AS sim FROM unit_u x
       JOIN unit_u y ON x.i = y.i GROUP BY 1, 2), w AS (SELECT a AS u, sum(abs(sim)) AS w FROM sims GROUP BY 1),
       means AS (SELECT u, avg(r) AS mean FROM train GROUP BY 1), num AS (SELECT t.u, t.i, sum(s.sim * (r.r - m.mean)) AS num
       FROM test t JOIN train r ON t.i = r.i JOIN means m ON m.u = r.u JOIN sims s ON s.a = t.u AND s.b = r.u GROUP BY 1, 2),
       pu AS (SELECT t.u, t.i, coalesce(mean, 0) + coalesce(num / w, 0) AS pred FROM test t LEFT JOIN means USING (u)
       LEFT JOIN w USING (u) LEFT JOIN num ON num.u = t.u AND num.i = t.i)"""
_PREDICT_ITEM = f"""{_unit('train', 'i')}, isims AS (SELECT x.i AS a, y.i AS b, sum(x.x * y.x) AS sim FROM unit_i x
       JOIN unit_i y ON x.u = y.u GROUP BY 1, 2), iw AS (SELECT a AS i, sum(abs(sim)) AS w FROM isims GROUP BY 1),
       inum AS (SELECT t.u, t.i, sum(s.sim * r.r) AS num FROM test t JOIN train r ON t.u = r.u JOIN isims s ON s.a = t.i AND s.b = r.i
       GROUP BY 1, 2), pi AS (SELECT t.u, t.i, coalesce(num / w, 0) AS pred FROM test t LEFT JOIN iw USING (i)
       LEFT JOIN inum ON inum.u = t.u AND inum.i = t.i)"""


@query("predict_user_based", f"WITH {_PREDICT_USER} SELECT u, i, round(pred, 5) + 0.0 AS pred FROM pu")
def _(spark, sf):
    train, test = v.split_ratings(v.ratings(spark, sf))
    return similarity.predict_user_based(train, test).withColumn("pred", R6("pred", 5))


@query("predict_item_based", f"WITH {v.SPLIT}, {_PREDICT_ITEM} SELECT u, i, round(pred, 5) + 0.0 AS pred FROM pi")
def _(spark, sf):
    train, test = v.split_ratings(v.ratings(spark, sf))
    return similarity.predict_item_based(train, test).withColumn("pred", R6("pred", 5))


@query("masked_rmse", f"""WITH {v.SPLIT}, {_PREDICT_ITEM} SELECT round(sqrt(avg((pred - r) * (pred - r))), 5) AS rmse
       FROM pi JOIN test USING (u, i)""")
def _(spark, sf):
    train, test = v.split_ratings(v.ratings(spark, sf))
    return similarity.masked_rmse(similarity.predict_item_based(train, test), test).select(R6("rmse", 5).alias("rmse"))


def _recommend(source: str, n: int) -> str:
    pairs = _USER_PAIRS.replace("ratings", source)
    return f"""{pairs}, {_EUCLID}, {_TOPN}, offered AS (SELECT top.a AS u, r.i, r.r AS score, row_number() OVER (PARTITION BY top.a
       ORDER BY r.r DESC, r.i) AS rank FROM top JOIN {source} r ON r.u = top.b WHERE top.rank = 1 AND NOT EXISTS
       (SELECT 1 FROM {source} s WHERE s.u = top.a AND s.i = r.i)), rec AS (SELECT u, i, score, rank::int AS rank FROM offered
       WHERE rank <= {n})"""


@query("user_cf_recommend", f"WITH {v.RATINGS}, {_recommend('ratings', 10)} SELECT * FROM rec")
def _(spark, sf):
    return similarity.user_cf_recommend(v.ratings(spark, sf), 10).select("u", "i", "score", "rank")


@query("item_overlap_estimate", f"""WITH {v.SPLIT}, p AS (SELECT x.i AS a, y.i AS b, 0.5::double + 0.5::double * sum(x.r * y.r) /
       sqrt(sum(x.r * x.r) * sum(y.r * y.r)) AS sim FROM train x JOIN train y ON x.u = y.u AND x.i <> y.i GROUP BY 1, 2),
       e AS (SELECT t.u, t.i, sum(sim * r.r) / sum(sim) AS est FROM test t JOIN train r ON r.u = t.u JOIN p ON p.a = t.i AND p.b = r.i
       GROUP BY 1, 2) SELECT t.u, t.i, round(coalesce(est, 0), 5) + 0.0 AS est FROM test t LEFT JOIN e ON e.u = t.u AND e.i = t.i""")
def _(spark, sf):
    train, test = v.split_ratings(v.ratings(spark, sf))
    return similarity.item_overlap_estimate(train, test).withColumn("est", R6("est", 5))


@query("scaled_cosine", """SELECT a.vec_id AS id, b.vec_id AS partner, round(0.5 + 0.5 * list_sum(list_transform(
       list_zip(a.embedding::double[], b.embedding::double[]), lambda z: z[1] * z[2])), 5) AS sim FROM embeddings a JOIN embeddings b
       ON b.vec_id = a.vec_id + 1""")
def _(spark, sf):
    x = v.vectors(spark, sf)
    other = x.select((F.col("id") - 1).alias("id"), F.col("id").alias("partner"), F.col("x").alias("y"))
    return x.join(other, "id").select("id", "partner", R6(S.scaled_cosine(S.dot("x", "y")), 5).alias("sim"))


@query("svd_item_factors")
def _(spark, sf):
    model = factor.SvdFactors(k=4, max_iter=6, tol=1e-3).fit(v.ratings(spark, sf))
    return model.item_factors().select("i", *[F.col("x")[j].alias(f"f{j}") for j in range(4)])


@query("svd_recommend")
def _(spark, sf):
    r = v.ratings(spark, sf)
    model = factor.SvdFactors(k=4, max_iter=6, tol=1e-3).fit(r)
    return factor.svd_recommend(r, model, 3)


@query("als_explicit")
def _(spark, sf):
    train, test = v.split_ratings(v.ratings(spark, sf))
    model = factor.als_explicit(train, rank=8, reg=0.1, iters=5)
    return factor.als_mse(model, train).withColumn("part", F.lit("train")).unionByName(
        factor.als_mse(model, test).withColumn("part", F.lit("test")))


def _init(key: str, j: int) -> str:
    return f"({v.hash_sql(key, j)} + 0.5::double) / 1000003.0::double - 0.5::double"


def _als_half(new: str, mine: str, other: str, factors: str, reg: float) -> str:
    """One half round at rank 2 in SQL: sums of the normal equations, solved by Cramer's rule."""
    return f"""e_{new} AS (SELECT {mine}, sum(x0 * x0) + {reg}::double * count(*) AS a, sum(x0 * x1) AS b, sum(x1 * x1) + {reg}::double * count(*) AS c,
       sum(x0 * r) AS p, sum(x1 * r) AS q FROM ratings JOIN {factors} USING ({other}) GROUP BY 1), {new} AS (SELECT {mine}, (c * p - b * q) / (a * c - b * b)
       AS x0, (a * q - b * p) / (a * c - b * b) AS x1 FROM e_{new})"""


@query("als_rounds", f"""WITH {v.RATINGS}, i0 AS (SELECT i, {_init('i', 0)} AS x0, {_init('i', 1)} AS x1 FROM (SELECT DISTINCT i FROM ratings)),
       {_als_half('u1', 'u', 'i', 'i0', 0.1)}, {_als_half('i1', 'i', 'u', 'u1', 0.1)}, {_als_half('u2', 'u', 'i', 'i1', 0.1)},
       {_als_half('i2', 'i', 'u', 'u2', 0.1)}, fits AS (SELECT 0 AS round, r, u1.x0 * i1.x0 + u1.x1 * i1.x1 AS p FROM ratings JOIN u1 USING (u) JOIN i1 USING (i)
       UNION ALL SELECT 1, r, u2.x0 * i2.x0 + u2.x1 * i2.x1 FROM ratings JOIN u2 USING (u) JOIN i2 USING (i))
       SELECT round, round(sqrt(avg((r - p) * (r - p))), 4) AS rmse FROM fits GROUP BY 1""")
def _(spark, sf):
    model = als.BlockALS(rank=2, reg=0.1, max_iter=2, tol=0.0).fit(v.ratings(spark, sf))
    return model.rounds(spark).select("round", R6("rmse", 4).alias("rmse"))


@query("als_implicit")
def _(spark, sf):
    model = factor.als_implicit(v.ratings(spark, sf), rank=8, alpha=0.5, iters=5)
    return model.userFactors.select(F.col("id").alias("u"), F.size("features").alias("size"))


@query("als_recommend_topn")
def _(spark, sf):
    r = v.ratings(spark, sf)
    return factor.als_recommend_topn(factor.als_explicit(r, rank=8, iters=5), r, 5)


@query("reclist_precision_recall", f"""WITH {v.SPLIT}, {_recommend('train', 10)} SELECT round(count(*) / (SELECT count(*) FROM rec), 6)
       AS precision, round(count(*) / (SELECT count(*) FROM test), 6) AS recall FROM rec JOIN test USING (u, i)""")
def _(spark, sf):
    train, test = v.split_ratings(v.ratings(spark, sf))
    out = similarity.reclist_precision_recall(similarity.user_cf_recommend(train, 10), test)
    return out.select(R6("precision").alias("precision"), R6("recall").alias("recall"))


def ctr_rows(spark, sf):
    events = v.clicks(spark, sf)
    return ctr.ctr_features(events, v.profiles(spark, sf, events), v.articles(spark, sf))


@query("ctr_features", f"""WITH {v.CLICKS}, {v.PREFS}, w AS (SELECT event_id, round(sum(v), 4) AS w FROM (SELECT event_id, v, row_number()
       OVER (PARTITION BY event_id ORDER BY v DESC) AS rk FROM clicks c JOIN prefs p ON c.user_id = p.user_id AND c.channel_id = p.channel_id)
       WHERE rk <= 10 GROUP BY 1), k AS (SELECT vec_id AS article_id, sum(x) AS k FROM (SELECT vec_id, abs(unnest(embedding)::double) AS x,
       row_number() OVER (PARTITION BY vec_id ORDER BY x DESC) AS rk FROM (SELECT vec_id, abs(unnest(embedding)::double) AS x, [x] AS embedding
       FROM embeddings)) WHERE rk <= 10 GROUP BY 1) SELECT c.event_id, click_flag, channel_id::double AS channel, (c.user_id % 2)::double AS gender,
       (18 + c.user_id % 50)::double AS age, coalesce(w, 0) + 0.0 AS user_weights, round(k, 4) AS article_weights,
       round(list_sum(embedding::double[]), 4) + 0.0 AS vector_sum FROM clicks c LEFT JOIN w USING (event_id) JOIN k USING (article_id)
       JOIN embeddings ON vec_id = c.article_id""")
def _(spark, sf):
    x = F.col("features")

    def total(a, b):
        return R6(F.aggregate(F.slice(x, a, b), F.lit(0.0), lambda s, y: s + y), 4)

    return ctr_rows(spark, sf).select(
        "event_id", "click_flag", x[0].alias("channel"), x[1].alias("gender"), x[2].alias("age"), total(4, 10).alias("user_weights"),
        total(14, 10).alias("article_weights"), total(24, 64).alias("vector_sum"))


@query("ctr_ranking")
def _(spark, sf):
    _, scored = ctr.ctr_pipeline(ctr_rows(spark, sf))
    return ctr.ctr_report(scored)
