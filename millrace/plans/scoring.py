"""Queries on splits, validation and metrics."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from millrace.functions.scalar import HASH_PRIME, hash_sql
from millrace.operators import bayes, forest, linear, metrics, nearest, validate
from millrace.plans import views as v
from millrace.plans.registry import query
from millrace.session import cut

R6 = v.rnd
HASH = hash_sql("vec_id", "{seed}")


# --- splits and search -----------------------------------------------------------------------
@query("holdout_split", f"""SELECT vec_id AS id, CASE WHEN {HASH.format(seed=3)} < {int(round(0.3 * HASH_PRIME))} THEN 'test' ELSE 'train' END
       AS part FROM embeddings""")
def _(spark, sf):
    train, test = validate.holdout_split(v.vectors(spark, sf).select("id"), "id", 0.3, 3)
    validate.check_disjoint(train, test, "id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("fold_extract", f"SELECT vec_id AS id, ({HASH.format(seed=1)} % 5 = 2) AS test FROM embeddings")
def _(spark, sf):
    train, test = validate.fold_extract(v.vectors(spark, sf).select("id"), "id", 2, 5, 1)
    return train.withColumn("test", F.lit(False)).unionByName(test.withColumn("test", F.lit(True)))


@query("kfold_assign", f"""SELECT o_orderkey, (ntile(10) OVER (ORDER BY {hash_sql('o_orderkey')}, o_orderkey) - 1)::int AS fold,
       (ntile(10) OVER (ORDER BY o_orderkey) - 1)::int AS run FROM orders""")
def _(spark, sf):
    o = v.table(spark, sf, "orders").select("o_orderkey")
    runs = validate.kfold_assign(o, "o_orderkey", 10, shuffle=False).withColumnRenamed("fold", "run")
    return validate.kfold_assign(runs, "o_orderkey", 10)


@query("stratified_kfold", f"""SELECT vec_id AS id, rep AS repeat, ((row_number() OVER (PARTITION BY label, rep ORDER BY
       {hash_sql('vec_id', 'rep')}, vec_id) - 1) % 5)::int AS fold FROM embeddings, (SELECT unnest([0, 1]) AS rep)""")
def _(spark, sf):
    return validate.stratified_kfold(v.vectors(spark, sf).select("id", "label"), "id", "label", 5, 2).select("id", "repeat", "fold")


def _nb_accuracy(train, test):
    model = bayes.GaussianNB().fit(train, "x", "label")
    return model.transform(test, "x").agg(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]


def _score_table(spark, found: dict):
    rows = [(i, s, found["mean"], found["std"]) for i, s in enumerate(found["scores"])]
    return spark.createDataFrame(rows, "fold int, score double, mean double, std double").select("fold", *[R6(c).alias(c) for c in ("score", "mean", "std")])


def _nb_sql(fit: str, judge: str) -> str:
    """``acc (k, kind, score)``: naive Bayes fitted on the rows ``fit (k, id)`` of each k, judged on ``judge (k, kind, id)``."""
    return f"""WITH {v.VECTORS}, {v.LONG}, fit AS MATERIALIZED ({fit}), judge AS MATERIALIZED ({judge}), m AS MATERIALIZED (SELECT k, c.label, d, avg(v) AS m, var_pop(v) AS s FROM fit
       JOIN cells c USING (id) GROUP BY ALL), e AS MATERIALIZED (SELECT k, 1e-9 * max(s) AS e FROM (SELECT k, d, var_pop(v) AS s FROM fit JOIN cells USING (id) GROUP BY ALL) GROUP BY ALL),
       p AS MATERIALIZED (SELECT k, label, ln(count(*) / sum(count(*)) OVER (PARTITION BY k)) AS prior FROM fit JOIN vectors USING (id) GROUP BY k, label),
       s AS (SELECT j.k, j.kind, j.id, m.label AS pred, any_value(c.label) AS label, any_value(prior) + sum(-0.5 * ln(2 * pi() * (s + e)) - (v - m) * (v - m) / (2 * (s + e))) AS score
       FROM judge j JOIN cells c ON c.id = j.id JOIN m ON m.k = j.k AND m.d = c.d JOIN p ON p.k = j.k AND p.label = m.label JOIN e ON e.k = j.k GROUP BY j.k, j.kind, j.id, m.label),
       acc AS (SELECT k, kind, avg(hit) AS score FROM (SELECT k, kind, id, (arg_max(pred, score) = any_value(label))::int AS hit FROM s GROUP BY k, kind, id) GROUP BY k, kind)"""


def _folds_sql(n: int) -> str:
    fold = f"{hash_sql('id')} % {n}"
    ks = f"(SELECT unnest(range({n})) AS k)"
    return (_nb_sql(f"SELECT k, id FROM vectors, {ks} WHERE {fold} <> k", f"SELECT k, 'test' AS kind, id FROM vectors, {ks} WHERE {fold} = k")
            + " SELECT k::int AS fold, round(score, 6) AS score, round(avg(score) OVER (), 6) AS mean, round(stddev_pop(score) OVER (), 6) AS std FROM acc")


@query("cross_val_scores", _folds_sql(4))
def _(spark, sf):
    rows = cut(v.vectors(spark, sf))
    return _score_table(spark, validate.cross_val_scores(rows, "id", 4, _nb_accuracy))


@query("two_fold_swap", _folds_sql(2))
def _(spark, sf):
    return _score_table(spark, validate.two_fold_swap(cut(v.vectors(spark, sf)), "id", _nb_accuracy))


@query("leave_one_out_knn", f"""WITH {v.VECTORS}, n AS (SELECT a.label AS label, b.label AS pred, row_number() OVER (PARTITION BY a.id ORDER BY
       {v.sql_d2('a.x', 'b.x')}, b.id) AS rk FROM vectors a JOIN vectors b ON a.id <> b.id) SELECT count(*) AS n,
       round(avg((label = pred)::int), 6) AS accuracy FROM n WHERE rk = 1""")
def _(spark, sf):
    out = nearest.leave_one_out_knn(v.vectors(spark, sf))
    return out.agg(F.count(F.lit(1)).alias("n"), R6(F.avg((F.col("label") == F.col("pred")).cast("double"))).alias("accuracy"))


def _forest_score(train, test, p):
    model = forest.random_forest_classifier(train, "x", "label", trees=p.get("trees", 8), depth=p.get("depth", 4))
    judge = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    return judge.evaluate(model.transform(forest.with_features(test, "x")))


def _grid_rows(spark, found):
    rows = [(i, r["params"].get("trees"), r["params"].get("depth"), r["mean"], r["std"]) for i, r in enumerate(found)]
    return spark.createDataFrame(rows, "place int, trees int, depth int, mean double, std double")


@query("grid_search")
def _(spark, sf):
    rows = cut(v.vectors(spark, sf))
    return _grid_rows(spark, validate.grid_search(rows, "id", {"trees": [4, 8], "depth": [2, 4]}, 2, _forest_score))


@query("sweep_one_parameter")
def _(spark, sf):
    rows = cut(v.vectors(spark, sf))
    return _grid_rows(spark, validate.sweep_one_parameter(rows, "id", "trees", [2, 6, 12], 2, _forest_score))


_SHARES = "(SELECT unnest([0.25, 0.5, 1.0]) AS k)"
_PART = f"{hash_sql('id')} >= {int(round(0.25 * HASH_PRIME))} AND {hash_sql('id', 1)} < round(k * {HASH_PRIME})"


@query("learning_curve", _nb_sql(f"SELECT k, id FROM vectors, {_SHARES} WHERE {_PART}", f"""SELECT k, 'train' AS kind, id FROM vectors, {_SHARES} WHERE {_PART} UNION ALL
       SELECT k, 'test', id FROM vectors, {_SHARES} WHERE {hash_sql('id')} < {int(round(0.25 * HASH_PRIME))}""") + """ SELECT k::double AS share,
       round(any_value(score) FILTER (kind = 'train'), 6) AS train, round(any_value(score) FILTER (kind = 'test'), 6) AS test FROM acc GROUP BY 1""")
def _(spark, sf):
    found = validate.learning_curve(cut(v.vectors(spark, sf)), "id", [0.25, 0.5, 1.0], _nb_accuracy)
    out = spark.createDataFrame([(r["share"], r["train"], r["test"]) for r in found], "share double, train double, test double")
    return out.select("share", R6("train").alias("train"), R6("test").alias("test"))


@query("cv_with_preprocess")
def _(spark, sf):
    def weigh(train, test):
        ratio = train.agg((F.count_if(F.col("quality") == 0) / F.count_if(F.col("quality") == 1)).alias("w")).first()[0]
        return train.withColumn("w", F.when(F.col("quality") == 1, ratio).otherwise(1.0)), test

    def fit(train, test):
        from pyspark.ml.classification import LogisticRegression
        model = LogisticRegression(labelCol="quality", weightCol="w", maxIter=10).fit(forest.with_features(train, v.DOC_FEATURES))
        return model.transform(forest.with_features(test, v.DOC_FEATURES)).agg(
            F.avg((F.col("prediction") == F.col("quality")).cast("double"))).first()[0]

    return _score_table(spark, validate.cv_with_preprocess(cut(v.docs(spark, sf)), "doc_id", 3, weigh, fit))


@query("pipeline_search")
def _(spark, sf):
    """Mean accuracy of a whole pipeline, features included, for each point of a grid."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.tuning import ParamGridBuilder

    rows = cut(validate.with_fold(v.docs(spark, sf), "doc_id", 3))
    lang = StringIndexer(inputCol="lang", outputCol="lang_id", handleInvalid="keep")
    parts = VectorAssembler(inputCols=[*v.DOC_FEATURES, "lang_id"], outputCol="features")
    model = LogisticRegression(labelCol="quality", maxIter=10)
    grid = ParamGridBuilder().addGrid(model.regParam, [0.0, 0.1]).addGrid(model.elasticNetParam, [0.0, 1.0]).build()
    judge = MulticlassClassificationEvaluator(labelCol="quality", metricName="accuracy")
    found = validate.ml_grid_search(Pipeline(stages=[lang, parts, model]), grid, judge, rows, "fold", 3)
    points = [(float(g[model.regParam]), float(g[model.elasticNetParam]), float(a)) for g, a in zip(grid, found.avgMetrics)]
    return spark.createDataFrame(points, "reg double, elastic double, accuracy double")


# --- metrics -----------------------------------------------------------------------------------
def _scored(spark, sf):
    """Label and a score of every event: purchases or errors, scored by value."""
    return v.table(spark, sf, "events").select(
        "event_id", "user_id", F.col("event_type").isin("purchase", "error").cast("int").alias("y"),
        (F.round("value") / (F.round("value") + 20)).alias("p"), F.col("value"))


_SCORED = """scored AS (SELECT event_id, user_id, (event_type IN ('purchase', 'error'))::int AS y, round(value) / (round(value) + 20) AS p, value
       FROM events)"""


@query("binary_confusion", f"""WITH {_SCORED} SELECT count(*) FILTER (y = 1 AND p > 0.5) AS tp, count(*) FILTER (y = 0 AND p > 0.5) AS fp,
       count(*) FILTER (y = 0 AND p <= 0.5) AS tn, count(*) FILTER (y = 1 AND p <= 0.5) AS fn FROM scored""")
def _(spark, sf):
    return metrics.binary_confusion(_scored(spark, sf).withColumn("h", (F.col("p") > 0.5).cast("int")), "y", "h")


@query("classification_scores", f"""WITH {_SCORED}, c AS (SELECT count(*) FILTER (y = 1 AND p > 0.4)::double AS tp, count(*) FILTER
       (y = 0 AND p > 0.4)::double AS fp, count(*) FILTER (y = 0 AND p <= 0.4)::double AS tn, count(*) FILTER (y = 1 AND p <= 0.4)::double AS fn
       FROM scored) SELECT round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy, round(tp / (tp + fp), 6) AS precision,
       round(tp / (tp + fn), 6) AS recall, round(tp / (tp + fn), 6) AS tpr, round(fp / (fp + tn), 6) AS fpr,
       round((fp + fn) / (tp + fp + tn + fn), 6) AS error, round(5 * tp / (5 * tp + 4 * fn + fp), 6) AS f_beta FROM c""")
def _(spark, sf):
    out = metrics.classification_scores(_scored(spark, sf), "y", "p", 0.4, 2.0)
    return out.select([R6(c).alias(c) for c in out.columns])


def _labels2(spark, sf):
    return v.vectors(spark, sf).select("id", "label", (F.col("id") * 7 % 10).cast("int").alias("pred"))


@query("multiclass_confusion", "SELECT label, (vec_id * 7 % 10)::int AS pred, count(*) AS n FROM embeddings GROUP BY 1, 2")
def _(spark, sf):
    return metrics.multiclass_confusion(_labels2(spark, sf), "label", "pred")


@query("merror", "SELECT round(avg((label <> vec_id * 7 % 10)::int), 6) AS merror FROM embeddings")
def _(spark, sf):
    return metrics.merror(_labels2(spark, sf), "label", "pred").select(R6("merror").alias("merror"))


_ROC = f"""{_SCORED}, c AS (SELECT p AS score, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY 1), roc AS (SELECT score,
       sum(neg) OVER w / (SELECT sum(neg) FROM c) AS fpr, sum(pos) OVER w / (SELECT sum(pos) FROM c) AS tpr FROM c
       WINDOW w AS (ORDER BY score DESC))"""


@query("roc_points", f"WITH {_ROC} SELECT round(score, 6) AS score, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM roc")
def _(spark, sf):
    out = metrics.roc_points(_scored(spark, sf), "y", "p")
    return out.select([R6(c).alias(c) for c in out.columns])


@query("auc_polygon", f"""WITH {_ROC}, s AS (SELECT fpr, tpr, lag(fpr, 1, 0) OVER w AS pf, lag(tpr, 1, 0) OVER w AS pt FROM roc
       WINDOW w AS (ORDER BY fpr, tpr)) SELECT round(sum((fpr - pf) * (tpr + pt) / 2), 6) AS auc FROM s""")
def _(spark, sf):
    return metrics.auc_polygon(metrics.roc_points(_scored(spark, sf), "y", "p")).select(R6("auc").alias("auc"))


@query("auc_rank", f"""WITH {_SCORED}, r AS (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::double AS rk
       FROM scored) SELECT round((sum(rk) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * sum(1 - y)), 6) AS auc FROM r""")
def _(spark, sf):
    return metrics.auc_rank(_scored(spark, sf), "y", "p").select(R6("auc").alias("auc"))


@query("log_losses", f"""WITH {_SCORED}, c AS (SELECT y, greatest(least(p, 1 - 1e-16), 1e-16) AS p, greatest(1 - p, 1e-16) AS q, value + 1 AS m,
       (event_id % 5)::double AS k FROM scored) SELECT round(avg(-(y * ln(p) + (1 - y) * ln(q))), 5) AS logloss,
       round(avg(m - k * ln(m) + lgamma(k + 1)), 5) AS poisson_nloglik, round(avg((k + 1) / m + ln(m)), 5) AS gamma_nloglik,
       round(avg(2 * (ln(m / (k + 1)) + (k + 1) / m - 1)), 5) AS gamma_deviance,
       round(avg(k * pow(m, -0.5) * 2 + pow(m, 0.5) * 2), 5) AS tweedie_nloglik FROM c""")
def _(spark, sf):
    rows = _scored(spark, sf).withColumns({"m": F.col("value") + 1, "k": (F.col("event_id") % 5).cast("double"),
                                           "k1": (F.col("event_id") % 5 + 1).cast("double")})
    a = metrics.log_losses(rows, "y", {"logloss": "p"})
    b = metrics.log_losses(rows, "k", {"poisson-nloglik": "m", "tweedie-nloglik": "m"})
    c = metrics.log_losses(rows, "k1", {"gamma-nloglik": "m", "gamma-deviance": "m"})
    return a.select(R6("logloss", 5).alias("logloss"), *[
        R6(t.select(n).scalar(), 5).alias(n) for t, names in ((b, ("poisson_nloglik", "tweedie_nloglik")),
                                                             (c, ("gamma_nloglik", "gamma_deviance"))) for n in names])


@query("mlogloss", """SELECT round(avg(-ln(CASE WHEN label = vec_id % 10 THEN 0.7 ELSE 0.3 / 9 END::double)), 6) AS mlogloss FROM embeddings""")
def _(spark, sf):
    probs = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: F.when(c == F.col("id") % 10, 0.7).otherwise(0.3 / 9))
    return metrics.mlogloss(v.vectors(spark, sf).withColumn("p", probs), "label", "p").select(R6("mlogloss").alias("mlogloss"))


@query("regression_scores", """SELECT round(sqrt(avg(e * e)), 5) AS rmse, round(avg(abs(e)), 5) AS mae, round(avg(e * e), 5) AS mse,
       round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) + 0.0 AS r2 FROM (SELECT l_extendedprice AS y, l_extendedprice - 1500 * l_quantity AS e
       FROM lineitem)""")
def _(spark, sf):
    rows = v.table(spark, sf, "lineitem").withColumn("p", 1500 * F.col("l_quantity"))
    out = metrics.regression_scores(rows, "l_extendedprice", "p")
    return out.select(*[R6(c, 5).alias(c) for c in ("rmse", "mae", "mse")], R6("r2").alias("r2"))


_RANKED = f"""{_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p DESC, event_id) AS rk,
       row_number() OVER (PARTITION BY user_id ORDER BY y DESC, event_id) AS best FROM scored)"""


@query("ndcg_at", f"""WITH {_RANKED} SELECT user_id, round(CASE WHEN sum(CASE WHEN best <= 10 THEN y / log2(best + 1) END) > 0 THEN
       sum(CASE WHEN rk <= 10 THEN y / log2(rk + 1) END) / sum(CASE WHEN best <= 10 THEN y / log2(best + 1) END) ELSE 1 END, 6) + 0.0 AS ndcg
       FROM r GROUP BY 1""")
def _(spark, sf):
    return metrics.ndcg_at(_scored(spark, sf), "user_id", "y", "p", "event_id", 10).withColumn("ndcg", R6("ndcg"))


@query("map_at", f"""WITH {_RANKED}, h AS (SELECT user_id, rk, row_number() OVER (PARTITION BY user_id ORDER BY rk) AS hit FROM r WHERE y = 1),
       a AS (SELECT user_id, avg(hit / rk) AS ap FROM h GROUP BY 1) SELECT user_id, round(coalesce(ap, 1), 6) AS ap FROM
       (SELECT DISTINCT user_id FROM scored) LEFT JOIN a USING (user_id)""")
def _(spark, sf):
    return metrics.map_at(_scored(spark, sf), "user_id", "y", "p", "event_id").withColumn("ap", R6("ap"))


@query("mrr", f"""WITH {_RANKED} SELECT round(avg(coalesce(1.0::double / f, 0)), 6) AS mrr FROM (SELECT user_id, min(rk) FILTER (y = 1) AS f FROM r
       GROUP BY 1)""")
def _(spark, sf):
    return metrics.mrr(_scored(spark, sf), "user_id", "y", "p", "event_id").select(R6("mrr").alias("mrr"))
