"""Click-through ranking: one uncut plan from clicks and profiles to model features."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import HASH_PRIME, assemble_array, key_hash, map_topk_values, map_topk_weights_by_prefix
from millrace.operators.metrics import auc_rank, binary_confusion
from millrace.session import cut, scratch_path


def ctr_features(clicks: DataFrame, profiles: DataFrame, articles: DataFrame, k: int = 10) -> DataFrame:
    """``(event_id, click_flag, features)``: channel, gender, age, k channel weights of the
    user, k keyword weights of the article, and the article vector."""
    rows = clicks.join(profiles, "user_id", "left")
    item = articles.select("article_id", map_topk_values("keywords", k).alias("article_weights"), "vector")
    user = rows.select("event_id", "article_id", "channel_id", "click_flag",
                       F.col("basic_info.gender").alias("gender"), F.col("basic_info.age").alias("age"),
                       map_topk_weights_by_prefix("preference_info", "channel_id", k).alias("channel_weights"))
    scalars = F.array(F.col("channel_id").cast("double"), F.coalesce(F.col("gender").cast("double"), F.lit(0.0)),
                      F.coalesce(F.col("age").cast("double"), F.lit(0.0)))
    return user.join(item, "article_id").select(
        "event_id", "click_flag", assemble_array(scalars, "channel_weights", "article_weights", "vector").alias("features"))


def ctr_pipeline(features: DataFrame, test_share: float = 0.25, max_iter: int = 20, reg: float = 0.0):
    """Splits a written feature table by event, fits the ranking model on one part, saves and reloads it and scores both.

    Returns the reloaded model and the written ``(event_id, part, label, score, prediction)``, which is scored once.
    """
    rows = cut(features.select("event_id", F.col("click_flag").cast("double").alias("label"),
                               array_to_vector("features").alias("features"),
                               F.when(key_hash("event_id") < int(round(test_share * HASH_PRIME)), "test").otherwise("train").alias("part")))
    path = scratch_path(features.sparkSession, "ctr-model")
    LogisticRegression(maxIter=max_iter, regParam=reg).fit(rows.where("part = 'train'")).write().save(path)
    model = LogisticRegressionModel.load(path)
    scored = cut(model.transform(rows).select("event_id", "part", F.col("label").cast("int").alias("label"),
                                              vector_to_array("probability")[1].alias("score"), "prediction"))
    return model, scored


def ctr_report(scored: DataFrame, part: str = "test") -> DataFrame:
    """AUC, confusion counts, accuracy, precision and recall of the rows of a part, and the rows of both."""
    own = scored.where(F.col("part") == part)
    sizes = scored.agg(F.count_if(F.col("part") == "train").alias("train_rows"), F.count_if(F.col("part") == "test").alias("test_rows"))
    counts = binary_confusion(own, "label", "prediction")
    return counts.withColumn("auc", auc_rank(own, "label", "score").scalar()).withColumns({
        "accuracy": F.try_divide(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")),
        "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))}).crossJoin(sizes)
